"""Queries of the training-data operators, with the parameters of production, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=512)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"), words=3, max_bits=2)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=4096, end_id=2)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import LOWEST, keys_of, read_documents, scratch_path, write_token_files

    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark)
    write_token_files(docs, vocabulary("byte_bpe_50k.json"), path, end_id=2)
    found = read_documents(keys_of(docs), path)
    return found.select(F.nullif(F.col("key"), F.lit(LOWEST)).alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .katz import katz_scores

    return katz_scores(table(spark, sf_dir, "documents"), fold=10)


def op3_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each part: its text's characters and sha256, its turns, and its trained spans."""
    from .preference import format_marked, reply_pairs

    parts = format_marked(reply_pairs(table(spark, sf_dir, "conversations")))
    spans = F.array_join(F.transform("trained_spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return parts.select(F.col("pair").alias("conv_id"), "side", "part", "n_turns", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), spans.alias("trained_spans"))


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import merkle_fingerprints

    return merkle_fingerprints(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's ids, and whether decoding them gives its text."""
    from .sentence_pieces import decode, encode

    docs, model = table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")
    carried = docs.select(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text")).alias("key"), "text")
    back = decode(encode(carried, model, id_col="key"), model)
    return back.select("key.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), (F.col("text") == F.col("key.text")).alias("exact"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op11_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .languages import languages

    return languages(table(spark, sf_dir, "documents"), folds=4, held=2)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import compress

    return compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import cluster

    return cluster(table(spark, sf_dir, "embeddings"), number=40, rounds=5, scale=256, size=64)


def queries() -> dict:
    return {
        "op1_simhash": op1_simhash,
        "op2_packing": op2_packing,
        "op3_preference": op3_preference,
        "op7_merkle": op7_merkle,
        "op6_katz": op6_katz,
        "op8_toxicity": op8_toxicity,
        "op9_sentence_pieces": op9_sentence_pieces,
        "op10_quality": op10_quality,
        "op5_token_files": op5_token_files,
        "op4_token_counts": op4_token_counts,
        "op11_languages": op11_languages,
        "op12_vector_codes": op12_vector_codes,
        "op13_centroids": op13_centroids,
    }


_OP3_SQL = """
WITH convs AS (SELECT conv_id AS pair, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
lasts AS (SELECT pair, turn AS last, role, text FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY turn DESC, role DESC, text DESC) AS k FROM convs) WHERE k = 1),
rejected AS (
  SELECT c.* FROM convs c JOIN lasts l USING (pair) WHERE c.turn < l.last
  UNION ALL SELECT l.pair, l.last, o.role, o.text FROM lasts l JOIN lasts o ON o.pair = xor(l.pair, 1)),
both_sides AS (SELECT DISTINCT 'chosen' AS side, * FROM convs UNION ALL SELECT DISTINCT 'rejected' AS side, * FROM rejected),
places AS (SELECT pair, turn, min(n) AS sides FROM (SELECT pair, turn, role, text, count(*) AS n FROM both_sides GROUP BY ALL) GROUP BY ALL),
firsts AS (SELECT pair, min(CASE WHEN sides < 2 THEN turn END) AS first FROM places GROUP BY pair),
marked AS (SELECT b.*, coalesce(b.turn < f.first, true) AS common FROM both_sides b JOIN firsts f USING (pair)),
kept AS (
  SELECT pair, CASE WHEN common THEN 'prompt' ELSE side END AS side, turn, role, turn // 256 AS part, '<|' || role || '|>' || chr(10) AS header, text || '<|end|>' || chr(10) AS rest, NOT common AND role = 'assistant' AS trained
  FROM marked WHERE NOT common OR side = 'chosen'),
placed AS (SELECT *, row_number() OVER w AS k, sum(length(header) + length(rest)) OVER w AS upto FROM kept WINDOW w AS (PARTITION BY pair, side, part ORDER BY turn, role, header, rest ROWS UNBOUNDED PRECEDING))
SELECT pair AS conv_id, side, part, count(*) AS n_turns, CAST(sum(length(header) + length(rest)) AS BIGINT) AS n_chars, sha256(string_agg(header || rest, '' ORDER BY k)) AS text_sha256,
  coalesce(string_agg(CAST(upto - length(rest) AS VARCHAR) || '-' || CAST(upto AS VARCHAR), ',' ORDER BY k) FILTER (WHERE trained), '') AS trained_spans
FROM placed GROUP BY pair, side, part
"""

_OP7_SQL = """
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, -9223372036854775808) AS key, coalesce(text, '') AS t FROM documents),
ids AS (SELECT DISTINCT key FROM base),
following AS (SELECT key, coalesce(lead(key) OVER (ORDER BY key), (SELECT min(key) FROM ids)) AS next_key FROM ids),
least AS (SELECT key AS next_key, min(t) AS next_t FROM base GROUP BY key),
parts AS (SELECT rid, doc_id, t, next_t, CAST(length(t) AS BIGINT) AS n, CAST(length(t) // 4 AS BIGINT) AS q FROM base JOIN following USING (key) JOIN least USING (next_key)),
edits AS (SELECT *, substring(t, 1, n - q) || substring(next_t, 1, q) AS e FROM parts),
texts AS (SELECT rid, 0 AS k, t AS x FROM edits UNION ALL SELECT rid, 1, e FROM edits UNION ALL SELECT rid, 2, next_t FROM edits),
leaves AS (SELECT rid, k, list_transform(string_split(x, chr(10)), lambda l: list_transform(regexp_extract_all(l, '(?:[^ ]*[a-zA-Z0-9] ){0,7}(?:[^ ]+ ?| )'), lambda y: substring(sha256(y), 1, 16))) AS leaves FROM texts),
paragraphs AS (SELECT *, list_transform(leaves, lambda l: substring(sha256(array_to_string(l, '')), 1, 16)) AS paragraphs FROM leaves),
sections AS (SELECT rid, k, flatten(leaves) AS leaves, list_transform(string_split(regexp_replace(array_to_string(paragraphs, ' '), '\\b(0[0-9a-f]{15}) ', '\\1' || chr(10), 'g'), chr(10)), lambda s: substring(sha256(s), 1, 16)) AS sections FROM paragraphs),
trees AS (SELECT rid, k, leaves, substring(sha256(array_to_string(sections, '')), 1, 16) AS root, sections FROM sections),
shown AS (SELECT *, root || ':' || array_to_string(list_transform(sections, lambda d: substring(d, 1, 8)), '') || ':' || array_to_string(list_transform(leaves, lambda d: substring(d, 1, 8)), '') AS f FROM trees)
SELECT d.doc_id, d.n AS n_chars, sha256(d.e) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
  CASE WHEN a.root = b.root THEN 1.0::DOUBLE ELSE (2 * len(list_intersect(a.leaves, b.leaves)))::DOUBLE / greatest(len(list_distinct(a.leaves)) + len(list_distinct(b.leaves)), 1)::DOUBLE END AS near_edited,
  CASE WHEN a.root = c.root THEN 1.0::DOUBLE ELSE (2 * len(list_intersect(a.leaves, c.leaves)))::DOUBLE / greatest(len(list_distinct(a.leaves)) + len(list_distinct(c.leaves)), 1)::DOUBLE END AS near_next
FROM edits d JOIN shown a ON a.rid = d.rid AND a.k = 0 JOIN shown b ON b.rid = d.rid AND b.k = 1 JOIN shown c ON c.rid = d.rid AND c.k = 2
"""



def _whole(scale: int) -> str:
    """The vector as whole numbers."""
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"
#: The squared distance of two lists of whole numbers below 2^53.
_SQUARED = "CAST(list_inner_product(v::DOUBLE[], v::DOUBLE[]) - 2 * list_inner_product(v::DOUBLE[], w::DOUBLE[]) + list_inner_product(w::DOUBLE[], w::DOUBLE[]) AS BIGINT)"


def _rounds(rounds: int) -> str:
    """Tables m1 to m<rounds> of the parts (r, p, v) and entries e0 to e<rounds> of (p, c, w): assignments before each round, entries after it; the last assignment is m<rounds>."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"m{i} AS MATERIALIZED (SELECT r, p, v, c, d FROM (SELECT r, p, v, c, {_SQUARED} AS d FROM parts JOIN e{i} USING (p)) QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, c) = 1)")
        if i < rounds:
            steps.append(f"s{i} AS (SELECT p, c, k, CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS x FROM (SELECT p, c, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM m{i}) GROUP BY ALL)")
            steps.append(f"u{i} AS (SELECT p, c, list(x ORDER BY k) AS w FROM s{i} GROUP BY ALL)")
            steps.append(f"e{i + 1} AS MATERIALIZED (SELECT e.p, e.c, coalesce(u.w, e.w) AS w FROM e{i} e LEFT JOIN u{i} u ON u.p = e.p AND u.c = e.c)")
    return ",\n".join(steps)


_OP12_SQL = f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, {_whole(1024)} AS a FROM embeddings WHERE {_FINITE} AND len(embedding) > 0),
parts AS MATERIALIZED (SELECT r, p, a[p * len(a) // 4 + 1 : (p + 1) * len(a) // 4] AS v FROM kept, range(4) AS t(p)),
e0 AS MATERIALIZED (SELECT p, r - 1 AS c, v AS w FROM parts WHERE r <= 256),
{_rounds(4)},
sums AS (SELECT r, string_agg(printf('%02x', c), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM m4 GROUP BY r),
rows AS (SELECT vec_id, label, code, error FROM kept JOIN sums USING (r))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY p, c)) FROM e4) AS codebooks_sha256
FROM rows
"""

_OP13_SQL = f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), embedding) AS r, vec_id, {_whole(256)} AS v FROM embeddings WHERE {_FINITE} AND len(embedding) = 64),
parts AS MATERIALIZED (SELECT r, 0 AS p, v FROM kept),
e0 AS MATERIALIZED (SELECT p, r - 1 AS c, v AS w FROM parts WHERE r <= 40),
{_rounds(5)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(w, ',')) AS centroid_sha256
FROM m5 m JOIN kept USING (r) JOIN e5 e ON e.c = m.c
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_preference": _OP3_SQL, "op7_merkle": _OP7_SQL, "op12_vector_codes": _OP12_SQL, "op13_centroids": _OP13_SQL}
