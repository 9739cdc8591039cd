"""A corpus pipeline over ``documents``: toxicity, quality rules, SimHash near-dedup, packing.

Each stage takes what the one before it kept, as a Parquet table in the shared folder.  All but the last
return the columns of documents.  Rows are told apart by their place in the stage's table, so repeated or null ids lose nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.llm.common import checkpoint, few, written
from reelsift.llm.packing import pack
from reelsift.llm.quality import quality_rules
from reelsift.llm.queries import vocabulary
from reelsift.llm.simhash import near_copies
from reelsift.llm.toxicity import toxicity

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go.

    Null, empty and wordless texts get the score of a text without words; without labels of both classes every document has the share of toxic labels as its score.
    Repeated rows are judged alike, an empty table stays empty, and other columns come along whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(docs, labels, threshold=0.3, carry=True).where("predicted = 0").select("row.*")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null, empty and wordless texts fail the base rule; a null language is a language of its own.  Repeated rows are judged alike and count each in
    the bands, an empty table stays empty, and other columns come along whatever their names.
    """
    return quality_rules(docs, vocabulary("piece_bpe_32k.model"), carry=True).where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more), the first row stays.

    Null, empty and wordless texts are one group, so one of them stays; so it is with repeated rows, whatever their ids.  Rows are told apart by numbers
    that are written before they are used, under a name that no column has, so null and repeated ids lose nothing.  An empty table stays empty.
    """
    row = "row"
    while row in {c.lower() for c in docs.columns}:
        row += "_"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    copies = near_copies(numbered, words=5, similarity=0.8, id_col=row)
    return numbered.join(few(checkpoint(copies.select(row))), row, "left_anti").select(*(f"`{c}`" for c in docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows of 4096 tokens, one row each.

    Null and empty texts have one piece, the end id alone; repeated rows are packed as often as they come; other columns are left out; an empty table gives an empty one.
    """
    return pack(docs, vocabulary("word_bpe_49k.json"), capacity=4096, end_id=2)


STAGES = [("toxicity", drop_toxic), ("quality rules", drop_poor), ("SimHash near-dedup", drop_near_copies), ("packing", pack_windows)]

#: Sub-word encoding and the models can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return docs
