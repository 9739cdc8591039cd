"""Identity closure: identifiers that sources name side by side, joined into the works they stand for.

Nodes are texts such as ``imdb:tt0000001``.  Edges come from candidates, releases and mapping answers.  Labels propagate along edges, each node taking the least
label around it and then its label's label, so a chain of n nodes settles in some log n rounds.  A work that would have two identifiers of one site is
a conflict: it is reported, and nothing is filled from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import not_blank
from ..schema import ID_FIELDS
from ..sources.scratch import settled

_SITE = {f: f.removesuffix("_id") for f in ID_FIELDS}
KIND = {f: "string" if f == "imdb_id" else "int" for f in ID_FIELDS}


def _node(field: str) -> Column:
    value = not_blank(F.col(field)) if field == "imdb_id" else F.col(field).cast("string")
    return F.concat(F.lit(f"{_SITE[field]}:"), value)


def nodes() -> Column:
    """The nodes of a row's identifiers."""
    return F.array_compact(F.array(*(_node(f) for f in ID_FIELDS)))


def edges_of(rows: DataFrame) -> DataFrame:
    """(a, b): the first identifier of each row with its others; absent fields count as null."""
    have = set(rows.columns)
    given = rows.select(*((F.col(f) if f in have else F.lit(None).cast(KIND[f])).alias(f) for f in ID_FIELDS)).select(nodes().alias("n")).where(F.size("n") > 1)
    return given.select(F.col("n")[0].alias("a"), F.explode(F.slice("n", 2, len(ID_FIELDS))).alias("b"))


def mapping_ids(rows: DataFrame, column: str = "payload") -> DataFrame:
    """(kitsu_id, mal_id, anilist_id) of mapping answers given as rows (key, payload), key the decimal identifier; of several numbers for a site the first counts, and what is no number is passed over."""
    kind = "struct<data:array<struct<attributes:struct<externalSite:string,externalId:string>>>>"
    items = F.transform(F.from_json(column, kind)["data"], lambda d: F.struct(F.replace(F.lower(d["attributes"]["externalSite"]), F.lit(" "), F.lit("")).alias("site"), F.trim(d["attributes"]["externalId"]).try_cast("int").alias("id")))
    first = lambda test: F.get(F.filter("items", lambda x: test(x["site"]) & x["id"].isNotNull()), F.lit(0))["id"]
    mal = lambda site: site.contains("myanimelist")
    found = rows.select(F.col("key").try_cast("int").alias("kitsu_id"), items.alias("items"))
    return found.select("kitsu_id", first(mal).alias("mal_id"), first(lambda site: ~mal(site) & site.contains("anilist")).alias("anilist_id")).where("kitsu_id is not null")


def classes(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges``: root is the least node that it reaches.

    Edges with a null end are ignored, one from a node to itself makes it a class of its own.  The largest of a round's tables is as long as the edges; an end that
    many edges share is joined with one row, and minima are partly aggregated before they are dealt, so no task holds its edges."""
    given = edges.where("a is not null and b is not null").select("a", "b")
    both = settled(given.unionByName(given.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")))
    for _ in range(max_rounds):
        around = both.join(labels.select(F.col("node").alias("b"), "root"), "b").select(F.col("a").alias("node"), "root")
        least = labels.unionByName(around).groupBy("node").agg(F.min("root").alias("root"))
        # each node takes its label's label
        jumped = least.join(labels.select(F.col("node").alias("root"), F.col("root").alias("far")), "root").select("node", F.least("root", "far").alias("root"))
        now = settled(jumped.join(labels.select("node", F.col("root").alias("was")), "node"))
        labels = now.select("node", "root")
        if now.where("root <> was").isEmpty():
            return labels
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def sites(members: DataFrame) -> DataFrame:
    """(root, site, n, low, high): how many different identifiers of a site a class has, the least and the greatest."""
    parts = members.select("root", F.substring_index("node", ":", 1).alias("site"), F.col("node").substr(F.instr("node", ":") + 1, F.length("node")).alias("value"))
    return parts.groupBy("root", "site").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


def conflicts(members: DataFrame) -> DataFrame:
    """(root, site, n, low, high) of each class and site with more than one identifier."""
    return sites(members).where("n > 1")


def identities(members: DataFrame) -> DataFrame:
    """(root, identifiers) of the classes without a conflict."""
    value = lambda f: F.max(F.when(F.col("site") == _SITE[f], F.col("low"))).try_cast(KIND[f]).alias(f)
    return sites(members).groupBy("root").agg(F.max("n").alias("most"), *(value(f) for f in ID_FIELDS)).where("most = 1").drop("most")


def closure(*edges: DataFrame) -> DataFrame:
    """(node, root, identifiers) of each node whose class has no conflict; settled once, for any number of rows."""
    every = edges[0]
    for more in edges[1:]:
        every = every.unionByName(more)
    members = classes(every)
    return settled(members.join(identities(members), "root"))


def fill(rows: DataFrame, known: DataFrame, *, id_col: str = "id") -> DataFrame:
    """``rows`` with identifiers that they lack filled from the class of those that they have, ``known`` from :func:`closure`; what is there stays.

    A row whose identifiers belong to more than one class, or to a class that has another identifier of a site than the row, is left as it is.  Ids are the rows' keys: unique, not null."""
    asked = rows.select(id_col, F.explode(nodes()).alias("node"))
    met = asked.join(known.select("node", "root"), "node").groupBy(id_col).agg(F.min("root").alias("_root"), F.max("root").alias("_other")).where("_root = _other").drop("_other")
    of = known.select(F.col("root").alias("_root"), *(F.col(f).alias(f"_{f}") for f in ID_FIELDS)).distinct()
    joined = rows.join(met.join(of, "_root"), id_col, "left")
    have = {f: not_blank(F.col(f)) if f == "imdb_id" else F.col(f) for f in ID_FIELDS}
    agrees = F.lit(True)
    for f in ID_FIELDS:
        agrees = agrees & F.coalesce(have[f] == F.col(f"_{f}"), F.lit(True))
    filled = joined.withColumn("_agrees", agrees)
    return filled.select(*(F.coalesce(have[c], F.when(F.col("_agrees"), F.col(f"_{c}"))).alias(c) if c in ID_FIELDS else F.col(c) for c in rows.columns))
