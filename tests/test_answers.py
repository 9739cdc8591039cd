"""Stored answers as a data source: layout, push-down, and the way from payloads to the resolver."""

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from reelsift.operators import resolve
from reelsift.sources import answers

ROWS = [("tmdb", f"k{i}", '{"results":[{"id":%d,"title":"Pale Orchard %d","release_date":"1987-01-01"}]}' % (i, i)) for i in range(1, 150)]
ROWS += [("imdb", "k1", '{"d":[{"id":"tt0000071","l":"Pale Orchard 1","y":1987}]}'), ("imdb", "ñ/=%", None), ("omdb", "k1", '{"Response":"False"}')]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("answers") / "store")
    answers.write_answers(spark.createDataFrame([*ROWS, (None, "k", "x"), ("tmdb", None, "x"), ROWS[0]], "provider string, key string, payload string"), path)
    return path


def test_all_answers_come_back(spark, stored):
    got = [tuple(r) for r in answers.read_answers(spark, stored).collect()]
    assert sorted(got, key=str) == sorted([*ROWS, ROWS[0]], key=str)


def test_filters_reach_the_source(spark, stored):
    asked = answers.read_answers(spark, stored, provider="tmdb", keys=["k3", "k77", "nobody"]).where("payload is not null")
    assert {r["key"] for r in asked.collect()} == {"k3", "k77"}
    plan = asked._jdf.queryExecution().executedPlan().toString()
    # Spark leaves what it doesn't push in a filter above the scan: the null tests alone
    assert "tmdb" not in plan and "k77" not in plan and "isnotnull(payload" in plan
    reader = answers.AnswerReader(stored)
    every = len(reader.partitions())
    assert list(reader.pushFilters([EqualTo(("provider",), "tmdb"), In(("key",), ("k3", "k77")), GreaterThan(("key",), "a")])) == [GreaterThan(("key",), "a")]
    files = reader.partitions()
    assert 0 < len(files) <= 2 * 4 < every and {f.provider for f in files} == {"tmdb"}
    assert {k for f in files for b in reader.read(f) for k in b.column("key").to_pylist()} == {"k3", "k77"}
    none = answers.AnswerReader(stored)
    list(none.pushFilters([EqualTo(("provider",), "tmdb"), EqualTo(("provider",), "imdb")]))
    assert none.partitions() == []
    assert answers.read_answers(spark, stored, provider="nobody").count() == 0 and answers.read_answers(spark, stored).count() == len(ROWS) + 1


def test_from_payloads_to_the_resolver(spark, stored):
    offered = resolve.candidates_of(lambda p: answers.read_answers(spark, stored, provider=p))
    assert offered.where("provider = 'tmdb'").count() == 150 and offered.where("provider = 'omdb'").count() == 0
    queue = spark.createDataFrame([(1, "Pale.Orchard.1.1987.1080p", None, None, "movie")], "id long, title string, title_text string, title_alt string, type string")
    row = resolve.resolve(queue, offered.drop("key")).first()
    assert (row["tmdb_id"], row["imdb_id"], row["outcome"]) == (1, "tt0000071", "resolved")
