"""Document fingerprints: Merkle trees over sections, paragraphs and sentences.

A text's paragraphs are its lines; sections are runs of paragraphs that end where a paragraph's digest
begins with the digit 0 (about one in 16), so an edit moves no section border but its own.  Leaves are the stretches of a paragraph
that end with a word with a mark at its end, or after eight words.  A node's digest is that of its children's; the root's is the document's.

A fingerprint is text: ``root:sections:leaves``, digests of 16, 8 and 8 hex digits (16 within the tree).  Roots test equality; sections that
differ locate the branches, and leaves that differ locate the edits.  Likeness is the share of leaves that two trees have in common
(Dice, of the different ones).  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

#: A leaf: up to seven words that end with a plain letter or digit, and one more word of any kind, with the spaces after them.
LEAF = "(?:[^ ]*[a-zA-Z0-9] ){0,7}(?:[^ ]+ ?| )"
#: Hex digits of inner digests, and of those in a fingerprint's lists.
DIGITS, SHOWN = 16, 8
#: The key of null ids: before all others.
LOWEST = -(1 << 63)


def _digest(x: Column) -> Column:
    return F.substring(F.sha2(x.cast("binary"), 256), 1, DIGITS)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def leaves_of(text: Column) -> Column:
    """Digests of each line's leaves; a line without text has none."""
    return F.transform(F.split(text, "\n", -1), lambda line: F.transform(F.regexp_extract_all(line, F.lit(LEAF), F.lit(0)), _digest))


def tree_of(lines: Column) -> Column:
    """struct(root string, sections array<string>, leaves array<string>) over the leaves of a text's lines."""
    # borders after paragraphs whose digest begins with 0; split drops them into sections in one pass
    paragraphs = F.array_join(F.transform(lines, lambda inner: _digest(F.array_join(inner, ""))), " ")
    sections = F.transform(F.split(F.regexp_replace(paragraphs, r"\b(0[0-9a-f]{15}) ", "$1\n"), "\n", -1), _digest)
    return _once(sections, lambda found: F.struct(_digest(F.array_join(found, "")).alias("root"), found.alias("sections"), F.flatten(lines).alias("leaves")))


def tree(text: Column) -> Column:
    """The tree of a text; a null text's is that of the empty one."""
    return _once(leaves_of(F.coalesce(text, F.lit(""))), tree_of)


def fingerprint_of(nodes: Column) -> Column:
    shown = lambda x: F.array_join(F.transform(x, lambda d: F.substring(d, 1, SHOWN)), "")
    return F.concat_ws(":", nodes["root"], shown(nodes["sections"]), shown(nodes["leaves"]))


def likeness(a: Column, b: Column) -> Column:
    """Share of their different leaves that two trees (structs) have in common (Dice); 1 for equal roots."""
    common = F.size(F.array_intersect(a["leaves"], b["leaves"]))
    both = F.size(F.array_distinct(a["leaves"])) + F.size(F.array_distinct(b["leaves"]))
    return F.when(a["root"] == b["root"], 1.0).when(both == 0, 0.0).otherwise(2 * common / F.greatest(both, F.lit(1)))


def differing_sections(a: Column, b: Column) -> Column:
    """Positions (from 0) of sections of ``a`` whose digests aren't in ``b``: the branches to descend into."""
    return F.filter(F.sequence(F.lit(0), F.size(a["sections"]) - 1), lambda i: ~F.array_contains(b["sections"], a["sections"][i]))


def next_ids(ids: DataFrame) -> DataFrame:
    """(key, next_key): the next greater key of each different one of ``ids`` (key long); the first key follows the last.

    Keys are dealt by range; in a range the next row is the next key, and the borders of ranges, one row each, are joined.
    """
    dealt = checkpoint(ids.distinct().repartitionByRange("key").select("key", F.spark_partition_id().alias("p")))
    # one row for each range, so this window sees as many rows as there are tasks
    firsts = dealt.groupBy("p").agg(F.min("key").alias("first"))
    all_ = Window.partitionBy(F.lit(0))
    after = firsts.withColumn("after", F.lead("first").over(all_.orderBy("p"))).withColumn("least", F.min("first").over(all_))
    inner = dealt.withColumn("follows", F.lead("key").over(Window.partitionBy("p").orderBy("key")))
    return inner.join(F.broadcast(after.select("p", F.coalesce("after", "least").alias("after"))), "p").select("key", F.coalesce("follows", "after").alias("next_key"))


def merkle_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The edited text has its last quarter (floor of its code points) replaced by as many of the first code points of the next document's text, or all.
    The next document is that with the next greater id (the first one after the last); of repeated ids its least text counts.
    Null texts count as empty; null ids are before all others and count as one id (the least bigint, which so reads as null).  Repeated rows each give a row; other columns are ignored.  An
    empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST))
    order = next_ids(docs.select(key.alias("key")))
    # texts are dealt by key once; the aggregation and the join below both reuse that exchange
    base = docs.select(key.alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).repartition("key")
    least = base.groupBy("key").agg(F.min("t").alias("next_t"))
    after = least.join(order.select(F.col("next_key").alias("key"), F.col("key").alias("of")), "key").select(F.col("of").alias("key"), "next_t")
    both = base.join(after, "key")
    n = F.char_length("t")
    quarter = F.floor(n / 4).cast("int")
    kept, tail = F.substring(F.col("t"), F.lit(1), n - quarter), F.substring(F.col("next_t"), F.lit(1), quarter)
    parts = both.select("key", n.cast("long").alias("n_chars"), kept.alias("kept"), tail.alias("tail"), leaves_of(F.col("t")).alias("lines"), tree(F.col("next_t")).alias("follower"))
    # lines before the one that the edit begins in keep their leaves
    same = F.size(F.split("kept", "\n", -1)) - 1
    changed = leaves_of(F.concat(F.substring_index("kept", "\n", -1), "tail"))
    trees = parts.select("key", "n_chars", F.sha2(F.concat("kept", "tail").cast("binary"), 256).alias("edited_sha256"), tree_of(F.col("lines")).alias("own"), _once(F.concat(F.slice("lines", F.lit(1), same), changed), tree_of).alias("other"), "follower")
    own, other, follower = F.col("own"), F.col("other"), F.col("follower")
    return trees.select(F.nullif(F.col("key"), F.lit(LOWEST)).cast(kind).alias(id_col), "n_chars", "edited_sha256", fingerprint_of(own).alias("fingerprint"), fingerprint_of(other).alias("edited_fingerprint"), likeness(own, other).alias("near_edited"), likeness(own, follower).alias("near_next"))
