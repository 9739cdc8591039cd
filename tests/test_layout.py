"""Snapshots dealt by work key: rankings without a shuffle, lookups of one file."""

from reelsift.functions.ids import work_key
from reelsift.operators import rank
from reelsift.sources.releases import derived_releases
from reelsift.sources.snapshot import Snapshots

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """The files that the scan below a filter is planned to open."""
    scan = df._jdf.queryExecution().sparkPlan().collectLeaves().head()
    return {f.urlEncodedPath() for p in scan.inputRDDs().head().partitions() for f in p.files()}


def test_rankings_by_work_shuffle_nothing(spark, tmp_path):
    rows = derived_releases(spark, FOLDER)
    store = Snapshots(spark, str(tmp_path / "s"))
    store.publish(rows.limit(0))
    assert store.publish(rows, by_work=8) == 2
    plain, laid = store.read(), store.read_by_work()
    assert sorted(map(str, plain.collect())) == sorted(map(str, laid.drop("work").collect())) and plain.count() == rows.count()
    best = rank.keepers(laid)
    gaps = rank.spanish_scoped(laid).groupBy(*rank.GROUP).count()
    quota = rank.keep_best_spanish(laid).ranked
    for df in (best, gaps, rank.ranked(laid)):
        assert "Exchange hashpartitioning" not in plan_of(df), plan_of(df)
    assert "Exchange hashpartitioning" in plan_of(rank.keepers(plain))
    for got, want in ((best, rank.keepers(plain)), (quota, rank.keep_best_spanish(plain).ranked)):
        assert sorted(map(str, got.select("id", "rn").collect())) == sorted(map(str, want.select("id", "rn").collect()))
    # one key's rows lie in one bucket
    key = rows.select(work_key().alias("w")).where("w is not null").orderBy("w").first()["w"]
    found = laid.where(laid.work == key)
    assert len(files_read(found)) == 1 and len(files_read(laid)) == 8
    assert found.count() == rows.where(work_key() == key).count() > 0
    # an earlier version, published in no order, is read the same way
    assert store.read_by_work(1).count() == 0 and "work" in store.read_by_work(1).columns
