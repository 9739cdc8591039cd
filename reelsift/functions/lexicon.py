"""Word lists, and matching releases against them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import effective_title, has_any_token, norm, once, py_norm

#: Names that are no releases.
JUNK_NAMES = ("readme", "sample", "trailer", "test", "placeholder", "rarbg", "ettv", "eztv", "yts", "yify")
JUNK_TOKEN = "readme"

#: Blocked tokens.
CORE_TOKENS = (
    "xxx", "onlyfans", "porn", "porno", "hentai", "jav", "brazzers", "chaturbate", "creampie", "milf", "nsfw", "xvideos", "xvideo", "xnxx",
    "xhamster", "pornhub", "redtube", "youporn", "ahegao", "bukkake", "gangbang", "orgy", "bdsm", "fetish", "escort", "camgirl", "stripchat",
    "livejasmin", "myfreecams", "fansly", "manyvids", "clips4sale", "naughtyamerica", "realitykings", "bangbros", "mofos", "teamskeet",
    "blacked", "tushy", "vixen", "anal", "blowjob", "handjob", "cumshot", "stepmom", "stepsis", "taboo", "incest", "adult", "sex", "18+",
)
#: Tokens blocked on demand.
SOFT_TOKENS = ("nude", "erotic", "erotica", "playboy", "webcam", "swinger", "swingers", "softcore", "pinup", "boudoir", "glamour", "sensual")
#: Phrases that are never blocked.
ALLOWED = ("xxx 2002", "xxx 2005", "xxx 2017", "xander cage", "state of the union", "adult swim", "sex and the city", "sex education", "analytics", "the analytics of love")
#: Tokens of the wanted language.
SPANISH_TOKENS = (
    "es", "spa", "esp", "spanish", "espanol", "castellano", "castellanos", "latino", "latina", "latinos", "latinas", "latin", "lat",
    "latinoamericano", "vose", "doblaje", "doblado", "doblada", "doblados", "subtitulado", "subtitulada", "subtitulados", "subtitulos",
)


def _joined(*parts: str) -> Column:
    out = []
    for p in parts:
        out += [F.lit(" ")] * bool(out) + [F.coalesce(F.col(p), F.lit(""))]
    return F.concat(*out)


def is_raw(token: str) -> bool:
    """A token with other characters than letters, digits and spaces is looked for as it stands."""
    return re.search(r"[^a-zA-Z0-9 ]", token) is not None


def allowed(extra: tuple[str, ...] = ()) -> Column:
    """Whether the effective title has an allowed phrase anywhere."""
    phrases = [p for p in dict.fromkeys(map(py_norm, (*ALLOWED, *extra))) if p]
    return F.coalesce(norm(effective_title(F.col("title"), F.col("title_text"))).rlike("|".join(phrases)), F.lit(False))


def blocked(tokens: tuple[str, ...] | None = None, soft: tuple[str, ...] = (), allow: tuple[str, ...] = ()) -> Column:
    """Whether a release is blocked: ``tokens`` replace the core ones, ``soft`` ones are added, allowed phrases win.

    Three scans, whatever the number of tokens: raw substrings, phrases at word boundaries, and glued group names."""
    every = (*(CORE_TOKENS if tokens is None else tokens), *soft)
    raw = [t.lower() for t in every if is_raw(t)]
    words = [n for t in every if not is_raw(t) and (n := py_norm(t))]
    found = F.lit(False)
    if raw:
        found = found | F.lower(_joined("title", "release_group", "source_tracker")).rlike("|".join(map(re.escape, raw)))
    if words:
        glued = F.replace(norm(_joined("release_group", "source_tracker")), F.lit(" "), F.lit(""))
        found = found | has_any_token(norm(_joined("title", "title_text", "release_group", "source_tracker")), words) | glued.rlike("|".join(w.replace(" ", "") for w in words))
    return found & ~allowed(allow)


#: Fixed value: what a reason says of a token that was found in a glued group or tracker name.
GLUED_MARK = " (grupo/tracker)"


def block_reason(soft: bool = False, extra_blocked: tuple[str, ...] = (), extra_allow: tuple[str, ...] = (), title: str | None = "title") -> Column:
    """Why: "allow:phrase", "blocked:token", "soft:token", or "": the first that matches, in list order.

    Looks at the name in the column ``title`` (None: the effective title), the release group and the tracker; a token that stands only in the glued names of the latter two is marked so.
    Each text is normalized once."""
    name = effective_title(F.col("title"), F.col("title_text")) if title is None else F.col(title)
    both = _joined("release_group", "source_tracker")
    raw = F.concat_ws(" ", F.coalesce(name, F.lit("")), both)
    texts = F.struct(norm(name).alias("name"), F.lower(raw).alias("raw"), norm(raw).alias("every"), F.replace(norm(both), F.lit(" "), F.lit("")).alias("glued"))

    def told(x: Column) -> Column:
        out = F.when(F.lit(False), "")
        for p in (*ALLOWED, *extra_allow):
            if n := py_norm(p):
                out = out.when(x["name"].contains(n), f"allow:{p}")
        for t in (*CORE_TOKENS, *extra_blocked, *(SOFT_TOKENS if soft else ())):
            kind, n = "soft" if t in SOFT_TOKENS else "blocked", py_norm(t)
            if is_raw(t):
                out = out.when(x["raw"].contains(t.lower()), f"{kind}:{t}")
            elif n:
                out = out.when(has_any_token(x["every"], [n]), f"{kind}:{t}").when(x["glued"].contains(n.replace(" ", "")), f"{kind}:{t}{GLUED_MARK}")
        return out.otherwise("")

    return once(texts, told)


def is_spanish(text: Column, extra: str | None = None) -> Column:
    """Whether a text has a token of the wanted language; ``extra``: more of them, comma-separated."""
    more = [py_norm(x) for x in (extra or "").split(",")]
    return has_any_token(norm(text), [*SPANISH_TOKENS, *more])


def any_spanish(texts: Column, extra: str | None = None) -> Column:
    return F.coalesce(F.exists(texts, lambda x: is_spanish(x, extra)), F.lit(False))
