"""Audit of a declarative access policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Who may do what with which kind of object.
OPEN_ROLES = ("public", "anon", "authenticated")


#: The commands of a rule that lets its role change a table.
CHANGES = ("insert", "update", "delete", "all")


def security_audit(policy: DataFrame, rules: DataFrame | None = None, expected: tuple[str, ...] = ()) -> DataFrame:
    """(level, finding) rows for a policy (kind, object, role, privilege, row_security): CRITICAL where an open role may call a
    function or write to a table, WARNING where a table has no row security; one OK row where nothing is found.

    rules: row policies (:mod:`operators.policy`); CRITICAL where one lets an open role change its table.  expected: tables that must be there; WARNING for one that the policy doesn't name."""
    open_ = F.col("role").isin(*OPEN_ROLES)
    calls = policy.where((F.col("kind") == "function") & open_ & (F.col("privilege") == "execute")).select(F.lit("CRITICAL").alias("level"), F.concat_ws(" ", F.col("role"), F.lit("may execute"), F.col("object")).alias("finding"))
    writes = policy.where((F.col("kind") == "table") & open_ & F.col("privilege").isin("insert", "update", "delete", "truncate")).select(F.lit("CRITICAL").alias("level"), F.concat_ws(" ", F.col("role"), F.lit("may"), F.col("privilege"), F.col("object")).alias("finding"))
    bare = policy.where((F.col("kind") == "table") & ~F.coalesce("row_security", F.lit(False))).select(F.lit("WARNING").alias("level"), F.concat_ws(" ", F.lit("no row security on"), F.col("object")).alias("finding"))
    found = calls.unionByName(writes).unionByName(bare)
    if rules is not None:
        loose = rules.where(F.col("role").isin(*OPEN_ROLES) & F.col("command").isin(*CHANGES))
        found = found.unionByName(loose.select(F.lit("CRITICAL").alias("level"), F.concat_ws(" ", F.lit("policy"), F.col("policy"), F.lit("lets"), F.col("role"), F.col("command"), F.col("object")).alias("finding")))
    if expected:
        wanted = policy.sparkSession.createDataFrame([(x,) for x in expected], "object string")
        gone = wanted.join(policy.where("kind = 'table'").select("object").distinct(), "object", "left_anti")
        found = found.unionByName(gone.select(F.lit("WARNING").alias("level"), F.concat_ws(" ", F.lit("there is no table"), F.col("object")).alias("finding")))
    found = found.distinct()
    fine = found.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("OK").alias("level"), F.lit("nothing found").alias("finding"))
    return found.unionByName(fine)
