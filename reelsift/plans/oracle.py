"""DuckDB SQL of the registered queries, composed from expressions over a ``releases`` relation."""

from __future__ import annotations

from ..functions import matching, titles
from ..functions.lexicon import ALLOWED, CORE_TOKENS, GLUED_MARK, JUNK_NAMES, SOFT_TOKENS, SPANISH_TOKENS, is_raw
from ..functions.text import ACCENTED, PLAIN, py_norm
from ..operators.apply import NO_SOURCE
from ..operators.resolve import PROVIDERS
from ..schema import ID_FIELDS
from ..sources.releases import AS_OF

RELEASES = """
releases AS (
  SELECT k AS id,
    CASE WHEN k % 41 = 0 THEN '' WHEN k % 43 = 0 THEN 'README' ELSE substring(d.text, 1, 18) || CASE k % 5 WHEN 0 THEN ' 1080p Latino' WHEN 1 THEN ' XXX 720p' WHEN 2 THEN ' S01E02 SUBS ES' ELSE ' 2160p' END END AS title,
    CASE WHEN k % 3 = 0 THEN 'Nombre interno ' || c END AS title_text,
    CASE WHEN k % 7 IN (0, 1) THEN 'movie' WHEN k % 7 IN (2, 3) THEN 'series' WHEN k % 7 IN (4, 5) THEN 'anime' END AS type,
    CAST(CASE WHEN k % 4 <> 0 THEN c % 3 + 1 END AS INT) AS season, CAST(CASE WHEN k % 6 <> 0 THEN k % 2 + 1 END AS INT) AS episode, CAST(CASE WHEN k % 5 = 0 THEN k % 24 + 1 END AS INT) AS absolute_episode,
    CASE k % 6 WHEN 0 THEN '2160p' WHEN 1 THEN '1080p' WHEN 2 THEN '720p' WHEN 3 THEN '480p' WHEN 4 THEN 'UHD' END AS quality,
    CASE WHEN k % 2 = 0 THEN 'x264' ELSE 'x265' END AS codec, CASE WHEN k % 3 = 0 THEN 'HDR10' END AS hdr,
    CASE WHEN k % 9 <> 0 THEN CAST(floor(o_totalprice * 100) AS BIGINT) END AS size_bytes, CAST(k % 97 AS INT) AS seeders,
    CASE k % 4 WHEN 0 THEN ['Latino'] WHEN 1 THEN ['English', 'Castellano'] WHEN 2 THEN ['Japanese'] END AS audio, CASE k % 3 WHEN 0 THEN ['SUBS [ES]'] WHEN 1 THEN ['Estonian'] END AS subtitles,
    CASE k % 8 WHEN 0 THEN 'xXxTorrents' WHEN 1 THEN 'LAT' ELSE 'GRP' END AS release_group, CASE k % 11 WHEN 0 THEN 'tracker 18+' WHEN 1 THEN 'pub' END AS source_tracker,
    CAST(CASE WHEN k % 3 = 1 THEN c % 300 + 1 END AS INT) AS tmdb_id, CASE k % 5 WHEN 2 THEN 'tt' || (1000000 + c % 200) WHEN 3 THEN ' ' END AS imdb_id,
    CAST(CASE WHEN k % 7 = 4 THEN c % 150 + 1 END AS INT) AS anilist_id, CAST(CASE WHEN k % 7 = 5 THEN c % 120 + 1 END AS INT) AS kitsu_id, CAST(CASE WHEN k % 14 = 4 THEN c % 90 + 1 END AS INT) AS mal_id,
    CASE k % 4 WHEN 0 THEN 'tmdb' WHEN 1 THEN 'manual' WHEN 2 THEN 'imdb:suggest+tvmaze' END AS ids_source,
    CAST(CASE k % 5 WHEN 0 THEN 0.5 WHEN 1 THEN 0.91 WHEN 2 THEN 0.92 WHEN 3 THEN 0.95 END AS DOUBLE) AS ids_confidence, CAST(k % 6 AS INT) AS ids_attempts,
    CASE WHEN k % 3 <> 2 THEN o_orderdate END AS ids_checked_at, o_orderdate AS created_at
  FROM (SELECT *, o_orderkey AS k, o_custkey AS c FROM orders) o JOIN documents d ON d.doc_id = k % 200)"""

AT = f"TIMESTAMP '{AS_OF}'"


def norm(x: str) -> str:
    return f"trim(regexp_replace(translate(lower(coalesce({x}, '')), '{ACCENTED}', '{PLAIN}'), '[^a-z0-9]+', ' ', 'g'))"


def blankless(x: str) -> str:
    return f"nullif(trim({x}), '')"


NAME = f"coalesce({blankless('title')}, {blankless('title_text')})"
RANK = "CASE WHEN q LIKE '%2160%' OR q LIKE '%4k%' OR q LIKE '%uhd%' THEN 60 WHEN q LIKE '%1440%' THEN 50 WHEN q LIKE '%1080%' THEN 40 WHEN q LIKE '%720%' THEN 30 WHEN q LIKE '%480%' THEN 20 WHEN q LIKE '%360%' OR q LIKE '%240%' THEN 10 ELSE 0 END"
TRUST = "(ids_source IS NULL OR lower(ids_source) IN ('manual', 'externo', 'externa', 'tabla', 'preexistente') OR coalesce(ids_confidence, 0) >= 0.92)"
IMDB = blankless("imdb_id")
HAS_ID = f"({IMDB} IS NOT NULL OR tmdb_id IS NOT NULL OR anilist_id IS NOT NULL OR kitsu_id IS NOT NULL OR mal_id IS NOT NULL)"
LACKS = f"({IMDB} IS NULL OR tmdb_id IS NULL OR anilist_id IS NULL OR kitsu_id IS NULL OR mal_id IS NULL)"
WORK = f"CASE WHEN {TRUST} AND {HAS_ID} THEN coalesce('imdb:' || {IMDB}, 'tmdb:' || tmdb_id, 'anilist:' || anilist_id, 'kitsu:' || kitsu_id, 'mal:' || mal_id) ELSE 't:' || nullif({norm(NAME)}, '') END"


def spanish(x: str) -> str:
    return f"regexp_matches({norm(x)}, '(^| )({'|'.join(SPANISH_TOKENS)})( |$)')"


def any_spanish(x: str) -> str:
    return f"coalesce(len(list_filter({x}, lambda v: {spanish('v')})) > 0, false)"


SCOPED = f"""
scoped AS (SELECT *, CASE WHEN audio_es THEN 3 WHEN subs_es THEN 2 WHEN hint_es THEN 1 ELSE 0 END AS es_score FROM (
  SELECT id, {WORK} AS work, CASE WHEN type = 'movie' THEN NULL ELSE season END AS gseason, CASE WHEN type = 'movie' THEN NULL ELSE coalesce(episode, absolute_episode) END AS gep,
    coalesce(seeders, 0) AS seeders, {RANK.replace('q LIKE', "lower(coalesce(quality, '')) LIKE")} AS qrank, size_bytes, {NAME} AS titulo, quality, codec, hdr, release_group,
    type IN ('series', 'anime') AND season IS NULL AND episode IS NULL AND absolute_episode IS NULL AS pack,
    {any_spanish('audio')} AS audio_es, {any_spanish('subtitles')} AS subs_es, coalesce({spanish(NAME)}, false) AS hint_es
  FROM releases) WHERE work IS NOT NULL AND NOT pack)"""

BEST = "(seeders >= 0) DESC, seeders DESC, qrank DESC, size_bytes ASC NULLS LAST, id DESC"
IN_ORDER = "work, gseason NULLS FIRST, gep NULLS FIRST, rn"
RANKED = f"ranked AS (SELECT *, row_number() OVER (PARTITION BY work, gseason, gep ORDER BY {BEST}) AS rn FROM scoped)"
DUPES = """dupes AS (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY work, gseason, gep, lower(coalesce(quality, '')), lower(coalesce(codec, '')), lower(coalesce(hdr, '')),
  CASE WHEN size_bytes IS NULL OR size_bytes <= 0 THEN 0 WHEN size_bytes < 100 THEN size_bytes ELSE 100 END, lower(coalesce(release_group, '')) ORDER BY id) AS copy FROM scoped) WHERE copy > 1)"""
ES_RANKED = f"""placed AS (SELECT *, row_number() OVER (PARTITION BY work, gseason, gep ORDER BY es_score DESC, {BEST}) AS rn, count(CASE WHEN es_score >= 1 THEN 1 END) OVER (PARTITION BY work, gseason, gep) AS n_es
  FROM scoped WHERE id NOT IN (SELECT id FROM dupes))"""


def over(*ctes: str) -> str:
    return "WITH " + ",\n".join((RELEASES, *ctes)) + "\n"


def blocked_test() -> str:
    raw = " OR ".join(f"contains(lower(coalesce(title, '') || ' ' || coalesce(release_group, '') || ' ' || coalesce(source_tracker, '')), '{t.lower()}')" for t in CORE_TOKENS if is_raw(t))
    words = [py_norm(t) for t in CORE_TOKENS if not is_raw(t)]
    every = norm("coalesce(title, '') || ' ' || coalesce(title_text, '') || ' ' || coalesce(release_group, '') || ' ' || coalesce(source_tracker, '')")
    glued = f"replace({norm("coalesce(release_group, '') || ' ' || coalesce(source_tracker, '')")}, ' ', '')"
    allow = " OR ".join(f"contains({norm(NAME)}, '{py_norm(p)}')" for p in ALLOWED)
    phrase = " OR ".join(f"contains(' ' || every || ' ', ' {w} ')" for w in words)
    stuck = " OR ".join(f"contains(glued, '{w.replace(' ', '')}')" for w in words)
    return f"SELECT * FROM (SELECT *, {every} AS every, {glued} AS glued, ({raw}) AS raw, ({allow}) AS ok FROM releases) WHERE (raw OR {phrase} OR {stuck}) AND NOT coalesce(ok, false)"


JUNK = f"({norm(NAME)} IN ({', '.join(repr(x) for x in JUNK_NAMES)}) OR contains(' ' || {norm(NAME)} || ' ', ' readme '))"
DEAD = f"(coalesce(seeders, 0) < 1 AND created_at < {AT} - INTERVAL 60 DAY)"
ABSOLUTE = "(type IN ('series', 'anime') AND absolute_episode IS NOT NULL AND episode IS NULL AND season IS NULL)"
QUEUED = f"{LACKS} AND (ids_checked_at IS NULL OR ids_checked_at < {AT} - INTERVAL 45 DAY)"
RETRY = f"NOT {HAS_ID} AND coalesce(ids_attempts, 0) < 4 AND (ids_checked_at IS NULL OR ids_checked_at < {AT} - INTERVAL 60 MINUTE)"


def queue(title: str, other: str, where: str = "") -> str:
    return over() + f"SELECT id, {title} AS title, title_text, {other} AS title_alt, type, season, episode, absolute_episode FROM releases WHERE {QUEUED} {where} ORDER BY ids_checked_at ASC NULLS FIRST, id LIMIT 400"


def purge_metrics(test: str, cap: int | None = None, rows: str = "releases") -> str:
    capped = f"least(matched, {cap})" if cap else "matched"
    return f"SELECT matched, {capped} AS deleted, matched - {capped} AS skipped, matched - {capped} AS skipped_limit FROM (SELECT count(*) AS matched FROM {rows} WHERE {test})"


ES_METRICS = """SELECT (SELECT count(*) FROM (SELECT DISTINCT work, gseason, gep FROM scoped)) AS groups, (SELECT count(*) FROM scoped) AS matched,
  (SELECT count(*) FROM dupes) + (SELECT count(*) FROM placed WHERE {over}) AS deleted, (SELECT count(*) FROM kept) AS kept,
  (SELECT count(*) FROM per WHERE a >= 2) AS groups_ok_audio, (SELECT count(*) FROM per WHERE e >= 2) AS groups_ok_spanish,
  (SELECT count(*) FROM (SELECT DISTINCT work, gseason, gep FROM scoped)) - (SELECT count(*) FROM per WHERE e >= 2) AS groups_low_spanish,
  (SELECT count(*) FROM kept WHERE NOT audio_es AND subs_es) AS kept_with_subs, (SELECT count(*) FROM dupes) AS duplicates,
  (SELECT count(*) FROM releases) - (SELECT count(*) FROM scoped) AS skipped, CAST(0 AS BIGINT) AS skipped_limit"""


def capped_es(cap: int) -> tuple[str, ...]:
    """CTEs ``gone`` (the duplicates that a cap reaches), ``placed`` and ``over_ids`` (what else it reaches)."""
    placed = ES_RANKED.replace("(SELECT id FROM dupes)", "(SELECT id FROM gone)")
    return f"gone AS (SELECT id FROM dupes ORDER BY id LIMIT {cap})", placed, f"over_ids AS (SELECT id FROM (SELECT id, row_number() OVER (ORDER BY {IN_ORDER}) AS k FROM placed WHERE rn > 3) WHERE k <= {cap} - (SELECT count(*) FROM gone))"


def es_metrics(strict: bool) -> str:
    low = "n_es < 2" if strict else "false"
    kept = f"kept AS (SELECT * FROM placed WHERE NOT ({low}) AND rn <= 3)"
    per = "per AS (SELECT count(CASE WHEN audio_es THEN 1 END) AS a, count(CASE WHEN es_score >= 1 THEN 1 END) AS e FROM kept GROUP BY work, gseason, gep)"
    return over(SCOPED, DUPES, ES_RANKED, kept, per) + ES_METRICS.format(over=f"{low} OR rn > 3")


def replaced(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def found(x: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({x}, '{pattern}', {group}), '')"


def parsed(name: str) -> str:
    """CTEs ending in ``parsed``: what a release name says, as the columns of parse_release."""
    t = titles
    marks = {"s1": (t.SEASON_EPISODE, 1), "s2": (t.SEASON_EPISODE, 2), "c1": (t.CROSS, 1), "c2": (t.CROSS, 2), "w1": (t.SEASON_WORD, 1), "w2": (t.SEASON_WORD, 2), "e": (t.EPISODE_WORD, 1), "d": (t.DASH_NUMBER, 1), "y": (t.YEAR, 1), "q": (t.QUALITY, 1), "k": (t.CODEC, 1), "h": (t.HDR, 1), "g1": (t.GROUP_FIRST, 1), "g2": (t.GROUP_LAST, 1)}
    title = "w"
    for p in (t.QUALITY, t.CODEC, t.AUDIO_CODEC, t.HDR, t.SEASON_EPISODE, t.CROSS, t.SEASON_WORD, t.EPISODE_WORD, t.DASH_NUMBER, t.SOURCE, t.AUDIO_TAG):
        title = replaced(title, p, " ")
    rest = "CASE WHEN y IS NULL THEN x ELSE regexp_replace(x, '\\b' || y || '\\b', ' ', 'g') END"
    for p, to in ((t.GROUP_FIRST, " "), (t.GROUP_LAST, " "), (t.BRACKETS, " "), (r"[._]+", " "), (r"\s*-\s*", " "), (r"\s+", " "), (r"^[ -]+|[ -]+$", "")):
        rest = replaced(rest, p, to)
    numbers = ", ".join(f"TRY_CAST({k} AS INT) AS {k}" for k in ("s1", "s2", "c1", "c2", "e", "d"))
    return f"""named AS (SELECT id, trim(coalesce({name}, '')) AS n FROM releases),
worked AS (SELECT id, n, trim({replaced("n", t.EXTENSION, "")}) AS w FROM named),
marked AS (SELECT id, n, w, {title} AS x, {", ".join(f"{found('w', p, g)} AS {k}" for k, (p, g) in marks.items())} FROM worked),
numbered AS (SELECT * REPLACE ({numbers}), coalesce(TRY_CAST(w1 AS INT), TRY_CAST(w2 AS INT)) AS ws FROM marked),
kinds AS (SELECT *, s1 IS NOT NULL AS b, s1 IS NULL AND coalesce(c1 <= {t.MOST_SEASON}, false) AS c, ws IS NULL AND e <= {t.MOST_ABSOLUTE} AS lone FROM numbered),
parsed AS (SELECT id, coalesce(nullif({rest}, ''), nullif(trim({replaced("n", chr(92) + "s+", " ")}), ''), n) AS title, TRY_CAST(y AS INT) AS year,
  CASE WHEN b THEN s1 WHEN c THEN c1 ELSE ws END AS season, CASE WHEN b THEN s2 WHEN c THEN c2 WHEN e IS NOT NULL AND NOT lone THEN e END AS episode,
  CASE WHEN NOT b AND NOT c THEN CASE WHEN e IS NOT NULL AND lone THEN e WHEN e IS NULL AND ws IS NULL AND d <= {t.MOST_ABSOLUTE} THEN d END END AS absolute,
  lower(q) AS quality, lower(k) AS codec, lower(h) AS hdr, CASE WHEN g1 IS NOT NULL THEN nullif(trim(g1), '') ELSE g2 END AS release_group FROM kinds)"""


def signals(x: str) -> str:
    t, s = titles, f"coalesce({x}, '')"
    tests = [f"regexp_matches({s}, '{p}')" for p in (t.QUALITY, t.CODEC, t.HDR, "|".join((t.SEASON_EPISODE, t.CROSS, t.EPISODE_WORD, t.DASH_NUMBER)), t.YEAR, t.SOURCE, r"[\[(]")]
    tests += [f"length({s}) - length(replace({s}, '.', '')) >= 4", f"regexp_matches({replaced(s, t.EXTENSION, '')}, '{t.GROUP_LAST}')"]
    return "(" + " + ".join(f"CAST({x} AS BIGINT)" for x in tests) + ")"


def _tidy(x: str) -> str:
    return replaced(replaced(x, "^[ :-]+|[ :-]+$", ""), r"\s+", " ")


def _leading(n: int) -> str:
    return f"CASE WHEN len(string_split(t, ' ')) > {n} THEN array_to_string(list_slice(string_split(t, ' '), 1, {n}), ' ') END"


def _distinct_names(items: list[tuple[str, str]]) -> str:
    """CTE ``tried``: (id, t, text, lax) of items (text, lax) over ``title``, in order, without blanks and repeats."""
    rows = " UNION ALL ".join(f"SELECT id, t, {k} AS k, {x} AS text, {lax} AS lax FROM tidy" for k, (x, lax) in enumerate(items))
    return f"""tidy AS (SELECT id, {replaced("trim(coalesce(title, ''))", chr(92) + "s+", " ")} AS t FROM releases),
tried AS (SELECT id, t, text, lax, n FROM (SELECT *, {norm("text")} AS n FROM ({rows}) WHERE text IS NOT NULL) WHERE n <> '' QUALIFY row_number() OVER (PARTITION BY id, n ORDER BY k) = 1)"""


def variant_names() -> str:
    bare = "CASE " + " ".join(f"WHEN starts_with(lower(t), '{a}') THEN substring(t, {len(a) + 1})" for a in matching.ARTICLES) + " END"
    return _distinct_names([("t", "false"), (_tidy("CASE WHEN contains(t, ':') THEN split_part(t, ':', 1) END"), "false"), (_tidy(bare), "false"), *((_tidy(_leading(n)), "true") for n in (4, 3, 2))])


def aggressive_names() -> str:
    arabic = "t"
    for k, v in matching.ROMAN.items():
        arabic = replaced(arabic, rf"\b{k}\b", v)
    return _distinct_names([("t", "true"), *((_tidy(x), "true") for x in (replaced("t", matching.SEASON_TAIL, ""), arabic, replaced("t", r"\b(19\d{2}|20\d{2})\b", ""), *(_leading(n) for n in (5, 4, 3, 2))))])


def block_reasons() -> str:
    """(id, reason) by the name, the release group and the tracker, with soft tokens."""
    both = "coalesce(release_group, '') || ' ' || coalesce(source_tracker, '')"
    raw = f"coalesce(title, '') || ' ' || {both}"
    when = [f"WHEN contains(name, '{py_norm(p)}') THEN 'allow:{p}'" for p in ALLOWED]
    for t in (*CORE_TOKENS, *SOFT_TOKENS):
        kind, n = "soft" if t in SOFT_TOKENS else "blocked", py_norm(t)
        if is_raw(t):
            when.append(f"WHEN contains(raw, '{t.lower()}') THEN '{kind}:{t}'")
        else:
            when += [f"WHEN contains(' ' || every || ' ', ' {n} ') THEN '{kind}:{t}'", f"WHEN contains(glued, '{n.replace(' ', '')}') THEN '{kind}:{t}{GLUED_MARK}'"]
    return f"SELECT id, CASE {' '.join(when)} END AS reason FROM (SELECT id, {norm('title')} AS name, lower({raw}) AS raw, {norm(raw)} AS every, replace({norm(both)}, ' ', '') AS glued FROM releases)"


def apply_rows() -> str:
    """What a batch makes of the releases that it names: the last item that filled a place gives source and confidence."""
    own = {f: (IMDB if f == "imdb_id" else f) for f in ID_FIELDS}
    firsts = ", ".join(f"min(pos) FILTER (WHERE {f} IS NOT NULL) AS p_{f}, arg_min({f}, pos) FILTER (WHERE {f} IS NOT NULL) AS v_{f}" for f in ID_FIELDS)
    wrote = ", ".join(f"CASE WHEN {x} IS NULL THEN p_{f} END" for f, x in own.items())
    return f"""SELECT m.id, {", ".join(f"m.{f}" for f in ID_FIELDS)}, CASE WHEN w IS NULL THEN m.ids_source ELSE coalesce(k.source, '{NO_SOURCE}') END AS ids_source, CASE WHEN w IS NULL THEN m.ids_confidence ELSE k.confidence END AS ids_confidence,
  CAST(CASE WHEN {" OR ".join(f"m.{f} IS NOT NULL" for f in ID_FIELDS)} THEN 0 ELSE coalesce(m.ids_attempts, 0) + m.items END AS INT) AS ids_attempts, {AT} AS ids_checked_at
FROM (SELECT r.id, ids_source, ids_confidence, ids_attempts, items, {", ".join(f"coalesce({x}, v_{f}) AS {f}" for f, x in own.items())}, greatest({wrote}) AS w
  FROM releases r JOIN (SELECT id, count(*) AS items, {firsts} FROM known GROUP BY id) g USING (id)) m LEFT JOIN known k ON k.id = m.id AND k.pos = m.w"""


def noted_cache() -> str:
    """CTE ``noted``: the cache after the batch; a hit over nothing or over a miss takes its own source and confidence."""
    hit = "(" + " OR ".join(f"{f} IS NOT NULL" for f in ID_FIELDS) + ")"
    firsts = ", ".join(f"arg_min({f}, pos) FILTER (WHERE {f} IS NOT NULL) AS v_{f}" for f in ID_FIELDS)
    return f"""remembered AS ({REMEMBERED}),
entries AS (SELECT cache_key, bool_or{hit} AS hit, min(pos) FILTER (WHERE {hit}) AS h, {firsts} FROM known WHERE cache_key IS NOT NULL GROUP BY cache_key),
noted AS (SELECT coalesce(c.cache_key, e.cache_key) AS cache_key, {", ".join(f"coalesce(c.{f}, e.v_{f}) AS {f}" for f in ID_FIELDS)}, coalesce(c.found, false) OR coalesce(e.hit, false) AS found,
  CASE WHEN c.found OR e.cache_key IS NULL THEN c.source WHEN e.hit THEN coalesce(k.source, '{NO_SOURCE}') ELSE coalesce(c.source, 'none') END AS source,
  CASE WHEN c.found OR e.cache_key IS NULL THEN c.confidence WHEN e.hit THEN k.confidence ELSE coalesce(c.confidence, 0) END AS confidence
FROM remembered c FULL JOIN entries e ON c.cache_key = e.cache_key LEFT JOIN known k ON k.pos = e.h)"""


#: A cache to apply a batch to: hits and misses, and keys that the batch doesn't name.
REMEMBERED = "SELECT 'key|' || i AS cache_key, CAST(CASE WHEN i % 3 = 0 THEN i + 1 END AS INT) AS tmdb_id, CAST(NULL AS VARCHAR) AS imdb_id, CAST(NULL AS INT) AS anilist_id, CAST(NULL AS INT) AS kitsu_id, CAST(NULL AS INT) AS mal_id, i % 3 = 0 AS found, CASE WHEN i % 3 = 0 THEN 'old' ELSE 'none' END AS source, CAST(CASE WHEN i % 3 = 0 THEN 0.3 ELSE 0 END AS DOUBLE) AS confidence FROM range(30, 70) t(i)"


def apply_ctes() -> str:
    """The derived batch, cleaned."""
    number = lambda f: f"CASE WHEN regexp_full_match(trim({f}), '[0-9]+') AND try_cast(trim({f}) AS HUGEINT) BETWEEN 1 AND 2147483647 THEN try_cast(trim({f}) AS INT) END"
    return f"""batch AS (SELECT event_id AS pos, CAST(user_id * 7 % 16000 AS VARCHAR) AS rid, CASE event_id % 5 WHEN 0 THEN CAST(event_id % 900 AS VARCHAR) WHEN 1 THEN ' 42 ' WHEN 2 THEN '12 34' WHEN 3 THEN '' END AS tmdb_id,
  CASE event_id % 4 WHEN 0 THEN 'TT' || (event_id % 1000) WHEN 1 THEN 'ttx' END AS imdb_id, CASE WHEN event_id % 3 = 0 THEN '99999999999' WHEN event_id % 3 = 1 THEN CAST(event_id AS VARCHAR) END AS anilist_id,
  CASE WHEN event_id % 6 = 0 THEN '0' END AS kitsu_id, CASE WHEN event_id % 9 = 0 THEN 'mal!' END AS mal_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS source,
  CASE event_id % 3 WHEN 0 THEN CAST(event_id % 7 AS VARCHAR) WHEN 1 THEN 'high' END AS confidence, CASE WHEN event_id % 4 <> 3 THEN 'key|' || (user_id % 50) END AS cache_key FROM events),
clean AS (SELECT pos, CAST(rid AS BIGINT) AS id, {number('tmdb_id')} AS tmdb_id, CASE WHEN regexp_full_match(lower(trim(imdb_id)), 'tt[0-9]{{1,10}}') THEN lower(trim(imdb_id)) END AS imdb_id, {number('anilist_id')} AS anilist_id, {number('kitsu_id')} AS kitsu_id, {number('mal_id')} AS mal_id,
  nullif(trim(source), '') AS source, least(greatest(coalesce(try_cast(confidence AS DOUBLE), 0.5), 0), 1) AS confidence, cache_key,
  CAST(nullif(trim(tmdb_id), '') IS NOT NULL AND {number('tmdb_id')} IS NULL AS INT) + CAST(nullif(trim(imdb_id), '') IS NOT NULL AND NOT regexp_full_match(lower(trim(imdb_id)), 'tt[0-9]{{1,10}}') AS INT)
  + CAST(nullif(trim(anilist_id), '') IS NOT NULL AND {number('anilist_id')} IS NULL AS INT) + CAST(nullif(trim(kitsu_id), '') IS NOT NULL AND {number('kitsu_id')} IS NULL AS INT) + CAST(nullif(trim(mal_id), '') IS NOT NULL AND {number('mal_id')} IS NULL AS INT) AS bad FROM batch),
known AS (SELECT c.* FROM clean c WHERE id IN (SELECT id FROM releases))"""


#: Works as connected identifiers: sources, edges, classes, and how many identifiers of a site each has.
WORKS = """
WITH RECURSIVE sighted AS (
  SELECT c_custkey AS id, CASE WHEN c % 2 = 0 THEN c END AS tmdb_id, CASE WHEN c % 3 < 2 THEN 'tt' || (c + 1000000) END AS imdb_id, CASE WHEN c % 11 < 6 THEN CASE WHEN c % 40 = 0 THEN c + 1 ELSE c END END AS anilist_id,
    CASE WHEN c % 5 < 3 THEN c END AS kitsu_id, CASE WHEN c % 7 < 5 THEN c END AS mal_id
  FROM (SELECT c_custkey, CAST(c_custkey AS INT) AS c FROM customer)),
mapped AS (SELECT NULL AS tmdb_id, NULL AS imdb_id, c AS anilist_id, c AS kitsu_id, c AS mal_id FROM (SELECT CAST(c_custkey AS INT) AS c FROM customer) WHERE c % 4 = 0),
lists AS (SELECT list_filter(['tmdb:' || tmdb_id, 'imdb:' || imdb_id, 'anilist:' || anilist_id, 'kitsu:' || kitsu_id, 'mal:' || mal_id], lambda x: x IS NOT NULL) AS n
  FROM (SELECT tmdb_id, imdb_id, anilist_id, kitsu_id, mal_id FROM sighted UNION ALL SELECT * FROM mapped)),
links AS (SELECT n[1] AS a, unnest(n[2:]) AS b FROM lists WHERE len(n) > 1),
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, far) AS (SELECT a, a FROM sides UNION SELECT r.node, e.b FROM reach r JOIN sides e ON e.a = r.far),
classes AS (SELECT node, min(far) AS root FROM reach GROUP BY node),
sites AS (SELECT root, site, count(*) AS n, min(value) AS low, max(value) AS high FROM (SELECT root, split_part(node, ':', 1) AS site, substring(node, instr(node, ':') + 1) AS value FROM classes) GROUP BY ALL)
"""
FILLED = """,
works AS (SELECT root, max(CASE WHEN site = 'tmdb' THEN low END) AS tmdb, max(CASE WHEN site = 'imdb' THEN low END) AS imdb, max(CASE WHEN site = 'anilist' THEN low END) AS anilist, max(CASE WHEN site = 'kitsu' THEN low END) AS kitsu,
  max(CASE WHEN site = 'mal' THEN low END) AS mal FROM sites GROUP BY root HAVING max(n) = 1),
asked AS (SELECT id, tmdb_id, CASE WHEN tmdb_id IS NULL THEN imdb_id END AS imdb_id FROM sighted)
SELECT id, coalesce(tmdb_id, CAST(tmdb AS INT)) AS tmdb_id, coalesce(imdb_id, imdb) AS imdb_id, CAST(anilist AS INT) AS anilist_id, CAST(kitsu AS INT) AS kitsu_id, CAST(mal AS INT) AS mal_id
FROM asked LEFT JOIN classes ON node = coalesce('tmdb:' || tmdb_id, 'imdb:' || imdb_id) LEFT JOIN works USING (root)
"""

LEXICON = f"""
listed AS (SELECT kind, token, min(ord) AS ord FROM (
  SELECT doc_id AS ord, 'blocked' AS kind, CASE WHEN doc_id % 4 < 3 THEN array_to_string(w[1:doc_id % 4 + 1], ' ') ELSE substring(text, 2, 6) END AS token FROM (SELECT *, string_split({norm('text')}, ' ') AS w FROM documents)
  UNION ALL SELECT doc_id, 'allow', array_to_string((string_split({norm('text')}, ' '))[1:2], ' ') FROM documents WHERE doc_id % 9 = 0) WHERE trim(token) <> '' GROUP BY ALL),
tokens AS (SELECT *, {norm('token')} AS n, kind <> 'allow' AND regexp_matches(token, '[^a-zA-Z0-9 ]') AS raw FROM listed),
names AS (SELECT id, lower(coalesce(title, '') || ' ' || coalesce(release_group, '') || ' ' || coalesce(source_tracker, '')) AS plain,
  ' ' || {norm("coalesce(title, '') || ' ' || coalesce(title_text, '') || ' ' || coalesce(release_group, '') || ' ' || coalesce(source_tracker, '')")} || ' ' AS every,
  replace({norm("coalesce(release_group, '') || ' ' || coalesce(source_tracker, '')")}, ' ', '') AS glued, {norm(NAME)} AS name FROM releases)"""
#: Which token blocks a release, and how it was found; allowed phrases win.
BLOCKED_BY = """,
hits AS (
  SELECT id, ord, 0 AS h, kind, token FROM names JOIN tokens ON raw AND contains(plain, lower(token))
  UNION ALL SELECT id, ord, 1, kind, token FROM names JOIN tokens ON NOT raw AND kind <> 'allow' AND n <> '' AND contains(every, ' ' || n || ' ')
  UNION ALL SELECT id, ord, 2, kind, token FROM names JOIN tokens ON NOT raw AND kind <> 'allow' AND n <> '' AND contains(glued, replace(n, ' ', '')))
SELECT id, kind, token, CASE h WHEN 0 THEN 'raw' WHEN 1 THEN 'phrase' ELSE 'glued' END AS how FROM hits
WHERE id NOT IN (SELECT id FROM names JOIN tokens ON kind = 'allow' AND n <> '' AND contains(name, n)) QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord, h, kind, token) = 1
"""

#: Candidates that the derived answers hold.
CANDIDATES = f"""
SELECT key, provider, t AS title, year, CASE WHEN provider = 'tmdb' THEN n END AS tmdb_id, CASE WHEN provider IN ('imdb', 'tvmaze', 'omdb') THEN 'tt' || (n + 1000000) END AS imdb_id,
  CASE WHEN provider = 'anilist' THEN n END AS anilist_id, CASE WHEN provider = 'kitsu' THEN n END AS kitsu_id, CASE provider WHEN 'anilist' THEN n + 1 WHEN 'jikan' THEN n END AS mal_id
FROM (SELECT CAST(id AS VARCHAR) AS key, CAST(id AS INT) AS n, CAST(id % 70 + 1950 AS INT) AS year, provider, unnest(CASE WHEN provider = 'anilist' THEN list_distinct([title, title_text]) ELSE [title] END) AS t
  FROM (SELECT *, ({list(PROVIDERS)})[id % {len(PROVIDERS)} + 1] AS provider FROM releases)) WHERE provider <> 'omdb' OR n % 2 = 0
"""
