"""A lexicon as a table: the same rows as the compiled list, whatever its size."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelsift.functions import lexicon
from reelsift.operators import lexicon_join

RELEASE = "id long, title string, title_text string, release_group string, source_tracker string"


def releases(spark, n=400, seed=0):
    rng = random.Random(seed)
    words = ["milf", "sex", "education", "Analytics", "anal", "Night", "de", "la", "Adult", "swim", "tushy", "raw", "18+", "x-x", "jav", "Playboy", "", "State of the Union", "real", "kings", "PornHub"]
    pick = lambda k, p=0.0: None if rng.random() < p else rng.choice([" ", ".", "-", ""]).join(rng.choices(words, k=k))
    rows = [(i, pick(3, 0.1), pick(2, 0.4), pick(1, 0.3), pick(1, 0.5)) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, None, None, None), (n + 1, "", " ", "", "")], RELEASE).repartition(4)


def table(spark, core, soft=(), allow=()):
    rows = [(i, k, t) for i, (k, t) in enumerate([("allow", t) for t in allow] + [("blocked", t) for t in core] + [("soft", t) for t in soft])]
    return lexicon_join.lexicon_of(spark.createDataFrame(rows, "ord long, kind string, token string"))


@pytest.mark.parametrize("cut", [1 << 20, 40])
def test_same_rows_as_the_list(spark, monkeypatch, cut):
    monkeypatch.setattr(lexicon_join, "AUTOMATON", cut)
    monkeypatch.setattr(lexicon_join, "MOST_BROADCAST", 100 if cut > 100 else 0)
    rows = releases(spark)
    core = (*lexicon.CORE_TOKENS, "real kings", "x-x", " ", "Milf")
    want = {r["id"] for r in rows.where(lexicon.blocked(core, lexicon.SOFT_TOKENS, ("night de",))).select("id").collect()}
    got = lexicon_join.blocked_by(rows, table(spark, core, lexicon.SOFT_TOKENS, (*lexicon.ALLOWED, "night de"))).collect()
    assert {r["id"] for r in got} == want and len(got) == len(want) > 100
    # the first token in the lexicon's order is the reason
    reason = {r["id"]: r["why"] for r in rows.select("id", lexicon.block_reason(title=None).alias("why")).collect()}
    core = lexicon_join.blocked_by(rows.withColumn("title_text", F.lit(None).cast("string")).withColumn("title", F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit(""))), table(spark, lexicon.CORE_TOKENS, (), lexicon.ALLOWED))
    plain = {r["id"]: r["why"] for r in rows.withColumn("title_text", F.lit(None).cast("string")).select("id", lexicon.block_reason(title=None).alias("why")).collect()}
    assert reason and {r["id"]: r["token"] for r in core.collect()} == {i: w.removeprefix("blocked:").removesuffix(lexicon.GLUED_MARK) for i, w in plain.items() if w.startswith("blocked:")}


def test_a_hundred_thousand_tokens(spark):
    """Tokens that stand nowhere change nothing, and those that do are found among them."""
    rows = releases(spark, 300, seed=1)
    want = {r["id"] for r in rows.where(lexicon.blocked(lexicon.CORE_TOKENS[:50])).select("id").collect()}
    small = [(i, "blocked", t) for i, t in enumerate(lexicon.CORE_TOKENS[:50])] + [(100 + i, "allow", t) for i, t in enumerate(lexicon.ALLOWED)]
    many = spark.range(100_000).selectExpr("id + 1000 as ord", "'blocked' as kind", "concat(case id % 3 when 0 then 'de ' when 1 then 'zq~' else 'milfzz' end, md5(cast(id as string))) as token")
    made = lexicon_join.lexicon_of(spark.createDataFrame(small, "ord long, kind string, token string").unionByName(many))
    assert made.count() > 100_000
    got = lexicon_join.blocked_by(rows, made).collect()
    assert {r["id"] for r in got} == want and len(want) > 50


def test_empty_lexicon_and_table(spark):
    rows = releases(spark, 10)
    none = table(spark, ("sex",)).limit(0)
    assert lexicon_join.blocked_by(rows, none).count() == 0
    assert lexicon_join.blocked_by(rows.limit(0), table(spark, ("sex", "18+"), (), ("x",))).count() == 0
    odd = spark.createDataFrame([(1, "blocked", None), (2, "blocked", "  "), (3, "allow", "!!"), (4, "blocked", "sex"), (2, "blocked", "sex")], "ord long, kind string, token string")
    assert [(r["ord"], r["n"]) for r in lexicon_join.lexicon_of(odd).collect()] == [(2, "sex")]


@pytest.mark.parametrize("base", [int(lexicon_join.BASE), 1])
def test_first_pieces_against_brute_force(monkeypatch, base):
    """Hashes that are equal by chance (base 1: all texts of the same characters) don't change what is found."""
    monkeypatch.setattr(lexicon_join, "BASE", np.uint64(base))
    rng = random.Random(3)
    finds = list(dict.fromkeys("".join(rng.choices("ab é𝄞", k=rng.randint(1, 5))) for _ in range(200)))[:90]
    rows = [(0, x, rng.choice([None, 1, 2, 3, 50, 60]), rng.choice(["soft", "blocked"]), f"t{i}") for i, x in enumerate(finds)]
    entries = pa.table(dict(zip(("how", "find", "ord", "kind", "token"), map(list, zip(*rows, strict=True)), strict=True)))
    tokens = lexicon_join.Tokens(entries)
    texts = ["".join(rng.choices("abcé𝄞 ", k=rng.randint(0, 12))) for _ in range(500)] + ["", " ", "zzz"]
    order = sorted(rows, key=lambda r: (-1 if r[2] is None else r[2], r[3], r[4]))
    for words in (False, True):
        got = [tokens.entries["token"][e].as_py() if e >= 0 else None for e in tokens.first(texts, words).tolist()]
        want = [next((r[4] for r in order if r[1] in x and (not words or r[1][0] == " ")), None) for x in texts]
        assert got == want and len(set(got)) > 5


def test_many_tokens_are_met_in_one_pass(spark):
    """Releases are read once for megabytes of tokens."""
    rows = releases(spark, 50, seed=2)
    many = spark.range(60_000).selectExpr("id as ord", "'blocked' as kind", "concat('zq~', md5(cast(id as string))) as token")
    few = spark.createDataFrame([(100_000, "blocked", "milf")], "ord long, kind string, token string")
    got = lexicon_join.blocked_by(rows, lexicon_join.lexicon_of(few.unionByName(many)))
    want = lexicon_join.blocked_by(rows, lexicon_join.lexicon_of(few))
    assert sorted(got.collect()) == sorted(want.collect()) != []
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
