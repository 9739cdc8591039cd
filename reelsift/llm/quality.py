"""Quality rules from tokeniser fertility.

A public vocabulary says how ordinary a text is for its language: characters per token, the share
of byte-fallback tokens, and the entropy of the text's tokens.  For each language and length
class, the quartiles of each measure over all documents give a band, median plus or minus ``reach`` robust deviations (a
quarter's distance over 0.6745); a text outside a band is rejected.  Repetition and few distinct
words lower entropy, symbol runs and capitals lower characters per token, foreign scripts raise byte fallback.

The quartiles come from exact counts of rounded measures, so they don't depend on partitions or order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import checkpoint, resident, written

#: Distinct words whose ids a Python worker remembers.
CACHE_WORDS = 250_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MEASURES = ("chars_per_token", "byte_share", "entropy")
#: Measures are counted in these steps.
STEP = 0.005
#: Robust deviations are at least so wide.
FLOOR = {"chars_per_token": 0.04, "byte_share": 0.01, "entropy": 0.15}
#: Bands that are broadcast at most; more are joined by shuffle.
MOST_BANDS = 50_000
#: Documents of a class that a band needs; else that of the wider class holds. The band of all documents needs none.
LEAST = 100


class WordTokens:
    """Ids of words under a sentencepiece model, remembered for words that repeat."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.known: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        found = list(map(self.known.get, words))
        if None in found:
            missing = list({w for w, v in zip(words, found, strict=True) if v is None})
            encoded = self.model.encode([w.decode("utf-8", "replace") for w in missing], num_threads=1)
            fresh = {w: np.array(x, dtype="<u4").tobytes() for w, x in zip(missing, encoded, strict=True)}
            if len(self.known) + len(fresh) > CACHE_WORDS:
                self.known.clear()
            if len(fresh) <= CACHE_WORDS:
                self.known.update((w, x) for w, x in fresh.items() if len(w) <= 64)
            found = [fresh[w] if v is None else v for w, v in zip(words, found, strict=True)]
        return np.frombuffer(b"".join(found), dtype="<u4")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more, the first one included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    once, again = set(), set()
    if len(set(windows)) == len(windows):
        return 0
    for w in windows:
        (again if w in once else once).add(w)
    end = total = 0
    for i, w in enumerate(windows):
        if w in again:
            total += i + 3 - max(end, i)
            end = i + 3
    return total


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, total = set(), 0
    for line in lines:
        if line in seen:
            total += bool(line.strip(SPACES))
        else:
            seen.add(line)
    return total


def measures(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: bool = False) -> DataFrame:
    """(id, lang, base counts, n_tokens and the three measures) of each row; null texts count as empty, with measures null."""
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")

    def measure(batches):
        tokens = resident(("words", model), lambda: WordTokens(model))
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                text = text or ""
                words = text.encode().split()
                ids = tokens.ids(words)
                chars = len(text) - sum(text.count(c) for c in SPACES)
                counts = np.bincount(ids)
                share = counts[counts > 0] / max(1, len(ids))
                rows.append((len(words), chars, sum(text.count(c) for c in SYMBOLS), repeated_lines(text), repeated_words(words), len(ids), *((chars / len(ids), float(tokens.is_byte[ids].mean()), float(-(share * np.log2(share)).sum())) if len(ids) else (None,) * 3)))
            columns = list(zip(*rows, strict=True)) or [()] * 9
            kinds = [pa.int64()] * 6 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), *batch.columns[3:]], names=["id", "lang", *fields, *MEASURES, *batch.schema.names[3:]])

    given = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("t"), *([F.struct("*").alias("row")] if carry else []))
    kinds = [StructField(x, LongType()) for x in fields] + [StructField(x, DoubleType()) for x in MEASURES]
    return given.mapInArrow(measure, StructType([given.schema["id"], StructField("lang", StringType()), *kinds, *([given.schema["row"]] if carry else [])]))


def bands(rows: DataFrame, reach: float) -> DataFrame:
    """(lang, size, measure, low, high): of each language and length class, of each length class (lang null), of each language (size null), and of all (both null).

    All but the last have ``LEAST`` documents at least."""
    long = rows.where("n_tokens > 0").select("lang", "size", F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.round(F.col(m) / STEP).cast("long").alias("q")) for m in MEASURES))).alias("m")).select("lang", "size", "m.*")
    counted = long.groupBy("lang", "size", "measure", "q").agg(F.count("*").alias("n"))
    all_sizes = counted.unionByName(counted.withColumn("size", F.lit(None).cast("int")))
    wider = all_sizes.unionByName(all_sizes.withColumn("lang", F.lit(None).cast("string"))).groupBy("lang", "size", "measure", "q").agg(F.sum("n").alias("n"))
    group = ["lang", "size", "measure"]
    order = Window.partitionBy(*group).orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    ranked = wider.withColumn("below", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy(*group)))
    at = lambda p: F.min(F.when(F.col("below") >= F.col("all") * p, F.col("q"))) * STEP
    found = ranked.groupBy(*group).agg(at(0.25).alias("low_q"), at(0.5).alias("mid"), at(0.75).alias("high_q"), F.max("all").alias("docs")).where((F.col("docs") >= LEAST) | (F.col("lang").isNull() & F.col("size").isNull()))
    floor = F.create_map(*(x for m, v in FLOOR.items() for x in (F.lit(m), F.lit(v))))[F.col("measure")]
    wide = lambda side: F.greatest(F.abs(side - F.col("mid")) / 0.6745, floor) * reach
    return found.select(*group, (F.col("mid") - wide(F.col("low_q"))).alias("low"), (F.col("mid") + wide(F.col("high_q"))).alias("high"))


def quality_rules(docs: DataFrame, model: str, *, reach: float = 4.0, min_words: int = 50, max_repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: bool = False) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_tokens, measures, base_failed, in_band, kept).

    With ``carry``, the whole row comes along as the struct ``row``.  model: a sentencepiece file with byte fallback.  Base rule: too few words, or too many words in repeated
    windows.  A null language is its own class ("und").  A class with fewer than ``LEAST`` documents takes its language's
    band, a language with fewer that of all languages' texts of its length class, and where that is small too, that of all documents.  A text without tokens has null
    measures and fails the base rule.  Repeated rows each give a row and count each; null ids stay null; other columns
    are ignored.  An empty table gives an empty one.
    """
    size = F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")
    rows = written(measures(docs, model, id_col=id_col, text_col=text_col, lang_col=lang_col, carry=carry).withColumn("size", size), "measures")
    limits = bands(rows, reach)
    pivot = checkpoint(limits.groupBy("lang", "size").agg(*(F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}") for m in MEASURES for side in ("low", "high"))))
    # as many rows as languages and length classes: few, unless languages are free text
    near = F.broadcast if pivot.count() <= MOST_BANDS else lambda df: df
    names = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    renamed = lambda kind: [F.col(x).alias(f"{kind}_{x}") for x in names]
    own = pivot.where("size is not null and lang is not null")
    whole = pivot.where("size is null and lang is not null").select("lang", *renamed("lang"))
    # a row of each power of two, and one
    sized = F.broadcast(pivot.where("size is not null and lang is null").select("size", *renamed("size")))
    every = F.broadcast(pivot.where("size is null and lang is null").select(*renamed("all")))
    joined = rows.join(near(own), ["lang", "size"], "left").join(near(whole), "lang", "left").join(sized, "size", "left").join(every, F.lit(True), "left")
    inside = F.lit(True)
    for m in MEASURES:
        for side in ("low", "high"):
            limit = F.coalesce(*(f"{kind}{m}_{side}" for kind in ("", "lang_", "size_", "all_")))
            inside = inside & F.coalesce(F.col(m) >= limit if side == "low" else F.col(m) <= limit, F.lit(True))
    failed = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeat_percent) * F.col("n_words"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return joined.select(*(["row"] if carry else []), F.col("id").alias(id_col), *base, "n_tokens", *MEASURES, failed.alias("base_failed"), inside.alias("in_band"), (~failed & inside).alias("kept"))
