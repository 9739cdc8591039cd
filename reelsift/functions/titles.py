"""Release names as columns: what a name says, and which of two names says more."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

#: Patterns of release names.
QUALITY = r"(?i)\b(2160p|1440p|1080p|720p|480p|360p|240p|4k|uhd)\b"
CODEC = r"(?i)\b(x264|x265|h\.?264|h\.?265|hevc|xvid|av1|vp9|aac|ac3|dts)\b"
AUDIO_CODEC = r"(?i)\b(ddp?5.1|dd5.1|dts.hd|truehd|eac3|flac|atmos)\b"
HDR = r"(?i)\b(hdr10|hdr|dolby.?vision|\bdv\b|hlg|sdr)\b"
YEAR = r"\b(19\d{2}|20\d{2})\b"
SEASON_EPISODE = r"\b[Ss](\d{1,2})[ ._-]*[Ee](\d{1,3})\b"
CROSS = r"\b(\d{1,2})x(\d{1,3})\b"
SEASON_WORD = r"\b[Ss]eason\.?\s*0?(\d{1,2})\b|\b[Tt]emporada\.?\s*0?(\d{1,2})\b"
EPISODE_WORD = r"\b(?:[Ee]p?(?:isode)?|[Cc]ap(?:itulo|ítulo)?\.?)\s*0?(\d{1,3})\b"
DASH_NUMBER = r"[-–]\s*0?(\d{1,3})\s*[\(\[]"
SOURCE = r"(?i)\b(web[ .-]?dl|webrip|bluray|bdrip|brrip|hdtv|dvdrip|dvd|vhs)\b"
AUDIO_TAG = r"(?i)\b(latino|castellano|dual|subs?|subtitulad[oa]|vose?)\b"
GROUP_FIRST = r"^\s*[\(\[]([^()\[\]]{1,32})[\)\]]\s*"
GROUP_LAST = r"[-_]([A-Za-z0-9]{2,20})\s*$"
EXTENSION = r"(?i)\.(mkv|mp4|avi|m4v|ts|m2ts|torrent|nzb)$"
BRACKETS = r"[\[\](){}]"

MOST_SEASON, MOST_ABSOLUTE = 60, 300


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    """What ``group`` of a pattern's first match holds, "" without one."""
    return F.regexp_extract(text, pattern, group)


def _squeeze(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def parse_release(name: Column) -> Column:
    """struct(title, year, season, episode, absolute, quality, codec, hdr, release_group) of a release name; a null name counts as empty.

    Numbers: SxxEyy, else NxM up to season 60, else season and episode words, where an episode without a season is an absolute one up to 300,
    else a number between a dash and a bracket.  The title is what is left once everything known is taken out, or the whole name if nothing is."""
    plain = F.trim(F.coalesce(name, F.lit("")))
    # each pattern is looked for once; a mark that isn't there is "" (a null test inside a lambda would evaluate what it tests twice)
    found = lambda w: {
        "s1": _first(w, SEASON_EPISODE), "s2": _first(w, SEASON_EPISODE, 2), "c1": _first(w, CROSS), "c2": _first(w, CROSS, 2), "w1": _first(w, SEASON_WORD), "w2": _first(w, SEASON_WORD, 2),
        "e": _first(w, EPISODE_WORD), "d": _first(w, DASH_NUMBER), "y": _first(w, YEAR), "q": _first(w, QUALITY), "k": _first(w, CODEC), "h": _first(w, HDR), "g1": _first(w, GROUP_FIRST), "g2": _first(w, GROUP_LAST),
    }
    marks = lambda w: F.struct(w.alias("work"), *(x.alias(k) for k, x in found(w).items()))
    return once(plain, lambda original: once(once(F.trim(F.regexp_replace(original, EXTENSION, "")), marks), lambda m: _told(original, m)))


def _told(original: Column, m: Column) -> Column:
    """The struct of :func:`parse_release` from the trimmed name and the marks found in it."""
    mark = lambda k: F.when(m[k] != "", m[k])
    # a cast of "" would throw, and catch, an exception
    number = lambda k: mark(k).try_cast("int")
    both = m["s1"] != ""
    cross = ~both & F.coalesce(number("c1") <= MOST_SEASON, F.lit(False))
    words = ~both & ~cross
    word_season, word_number, dash = F.coalesce(number("w1"), number("w2")), number("e"), number("d")
    lone = word_season.isNull() & (word_number <= MOST_ABSOLUTE)
    season = F.when(both, number("s1")).when(cross, number("c1")).when(words, word_season)
    episode = F.when(both, number("s2")).when(cross, number("c2")).when(words & word_number.isNotNull() & ~lone, word_number)
    absolute = F.when(words & word_number.isNotNull() & lone, word_number).when(words & word_number.isNull() & word_season.isNull() & (dash <= MOST_ABSOLUTE), dash)
    group = F.when(m["g1"] != "", F.nullif(F.trim(m["g1"]), F.lit(""))).otherwise(mark("g2"))

    title = m["work"]
    for p in (QUALITY, CODEC, AUDIO_CODEC, HDR, SEASON_EPISODE, CROSS, SEASON_WORD, EPISODE_WORD, DASH_NUMBER, SOURCE, AUDIO_TAG):
        title = F.regexp_replace(title, p, " ")
    # without a year the pattern is one that nothing matches
    title = F.regexp_replace(title, F.coalesce(F.concat(F.lit(r"\b"), mark("y"), F.lit(r"\b")), F.lit(r"[^\s\S]")), F.lit(" "))
    for p, to in ((GROUP_FIRST, " "), (GROUP_LAST, " "), (BRACKETS, " "), (r"[._]+", " "), (r"\s*-\s*", " "), (r"\s+", " "), (r"^[ -]+|[ -]+$", "")):
        title = F.regexp_replace(title, p, to)
    title = once(title, lambda left: F.when(left != "", left).otherwise(F.coalesce(F.nullif(F.trim(_squeeze(original)), F.lit("")), original)))
    return F.struct(
        title.alias("title"), number("y").alias("year"), season.alias("season"), episode.alias("episode"), absolute.alias("absolute"),
        F.lower(mark("q")).alias("quality"), F.lower(mark("k")).alias("codec"), F.lower(mark("h")).alias("hdr"), group.alias("release_group"),
    )


def release_signals(name: Column) -> Column:
    """How many of nine marks of a release name a text has; 0 for null."""
    s = F.coalesce(name, F.lit(""))
    tests = [s.rlike(QUALITY), s.rlike(CODEC), s.rlike(HDR), s.rlike("|".join((SEASON_EPISODE, CROSS, EPISODE_WORD, DASH_NUMBER))), s.rlike(YEAR), s.rlike(SOURCE), F.length(s) - F.length(F.replace(s, F.lit("."), F.lit(""))) >= 4, s.rlike(r"[\[(]"), F.regexp_replace(s, EXTENSION, "").rlike(GROUP_LAST)]
    return sum((t.cast("int") for t in tests), F.lit(0))


def looks_like_release(name: Column) -> Column:
    return release_signals(name) >= 2


def pick_name(title: Column, other: Column) -> Column:
    """struct(main, other) of two names, blanks as null: swapped only where the second has strictly more marks."""
    names = F.struct(F.nullif(F.trim(title), F.lit("")).alias("a"), F.nullif(F.trim(other), F.lit("")).alias("b"))

    def picked(x: Column) -> Column:
        swap = F.coalesce(x["a"].isNotNull() & x["b"].isNotNull() & (release_signals(x["b"]) > release_signals(x["a"])), F.lit(False))
        return once(swap, lambda s: F.struct(F.when(s, x["b"]).otherwise(x["a"]).alias("main"), F.when(s, x["a"]).otherwise(x["b"]).alias("other")))

    return once(names, picked)
