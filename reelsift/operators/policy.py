"""Row policies: who sees which rows and columns of a table, and who may change it.

A policy is a table of rules (policy, object, role, command, predicate, field, mask).  Rules for "select" or "all" with a predicate (SQL over the table's columns; null: every row) let their
role see the rows that one of them allows; rules with a field replace that column by the SQL expression ``mask`` for their role.  The role "public" stands for everybody.  As with row security
in databases, a role without a rule sees nothing, and the owning roles bypass all rules.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

RULES = "policy string, object string, role string, command string, predicate string, field string, mask string"
#: The role that stands for everybody, and those that no rule binds.
EVERYBODY, OWNERS = "public", ("service_role", "postgres")
#: Rules of a policy at most; they are compiled into one expression.
MOST_RULES = 1000


def rules_of(policies: DataFrame, name: str) -> list[Row]:
    """The rules for the table ``name``, in order of policy; an error beyond MOST_RULES."""
    found = policies.where(F.col("object") == name).orderBy("policy", "role", "command", "predicate", "field", "mask").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"{name}: over {MOST_RULES} rules")
    return found


def _binding(rules: list[Row], role: str, command: str) -> list[Row]:
    return [r for r in rules if r["role"] in (role, EVERYBODY) and r["command"] in (command, "all")]


def visible(df: DataFrame, rules: list[Row], role: str) -> DataFrame:
    """``df`` as ``role`` sees it: the rows that a rule allows, with masked columns replaced, in the same order of columns.

    Predicates and masks read the columns as they are, not as they are masked.  A predicate that is null for a row doesn't allow it.  Of several masks of a column the first by policy counts."""
    if role in OWNERS:
        return df
    bound = _binding(rules, role, "select")
    allow: Callable[[Row], Column] = lambda r: F.lit(True) if r["predicate"] is None else F.coalesce(F.expr(r["predicate"]), F.lit(False))
    rows = df.where(reduce(lambda a, b: a | b, [allow(r) for r in bound if r["field"] is None], F.lit(False)))
    masks: dict[str, str] = {}
    for r in bound:
        if r["field"] is not None:
            masks.setdefault(r["field"].lower(), r["mask"])
    kept = lambda f: F.col(f"`{f.name}`") if f.name.lower() not in masks else F.expr(masks[f.name.lower()] or "null").cast(f.dataType).alias(f.name)
    return rows.select(*(kept(f) for f in df.schema.fields))


def may(rules: list[Row], role: str, command: str) -> bool:
    """Whether ``role`` may insert, update or delete."""
    return role in OWNERS or bool(_binding(rules, role, command))


def checked_change(before: DataFrame, after: DataFrame, rules: list[Row], role: str, *, id_col: str = "id") -> None:
    """Raises PermissionError where the step from ``before`` to ``after`` inserts, updates or deletes rows and ``role`` may not; ids are the table's key."""
    if role in OWNERS:
        return
    digest = F.xxhash64(*(F.col(f"`{c}`") for c in before.columns))
    sides = before.select(F.col(id_col).alias("k"), digest.alias("x")).join(after.select(F.col(id_col).alias("k"), digest.alias("y")), "k", "full")
    counts = sides.agg(F.count_if(F.col("x").isNull()).alias("insert"), F.count_if(F.col("y").isNull()).alias("delete"), F.count_if(F.col("x") != F.col("y")).alias("update")).first()
    refused = [c for c in ("insert", "update", "delete") if counts[c] and not may(rules, role, c)]
    if refused:
        raise PermissionError(f"{role} may not {', '.join(refused)}")
