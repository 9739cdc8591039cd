"""Command line: ``python -m reelsift.plans.cli MODE --snapshots DIR``."""

from __future__ import annotations

import argparse
import dataclasses
import logging
import sys

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RELEASES, TITLE_CACHE
from ..sources.scratch import shared_dir
from ..sources.snapshot import Snapshots
from . import stages
from .budget import of_setting
from .report import Report
from .settings import load

MODES = ("all", "purge", "enrich", "retry", "best", "renumber", "stats", "doctor", "selftest")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Curate a catalog of releases.")
    p.add_argument("mode", choices=MODES)
    p.add_argument("--snapshots", help="folder of release snapshots; the title cache is in its subfolder cache")
    p.add_argument("--candidates", help="Parquet of lookup candidates (provider, title, year, identifiers)")
    p.add_argument("--as-of", help="clock of age rules; now by default")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--limit", type=int, help="batch size")
    p.add_argument("--rounds", type=int)
    p.add_argument("--max-deletes", type=int)
    p.add_argument("--renumber", action="store_true")
    p.add_argument("-v", "--verbose", action="store_true", help="log every stage's figures in full")
    p.add_argument("-q", "--quiet", action="store_true", help="log warnings alone")
    return p


def doctor(spark: SparkSession, store: Snapshots, remembered: Snapshots, candidates: str | None) -> list[str]:
    """What is wrong, if anything: each table that a run needs is probed by one row, none is counted."""
    found = []

    def probe(what: str, read, columns) -> None:
        try:
            df: DataFrame = read()
            if lacks := [c for c in columns if c not in df.columns]:
                found.append(f"{what}: no column {', '.join(lacks)}")
            df.limit(1).collect()
        except (PySparkException, OSError) as problem:
            found.append(f"{what}: {str(problem).splitlines()[0]}")

    if not store.version():
        found.append("releases: nothing is published yet")
    probe("releases", store.read, RELEASES.fieldNames())
    probe("title cache", remembered.read, TITLE_CACHE.fieldNames())
    if candidates:
        probe("candidates", lambda: spark.read.parquet(candidates), ("provider", "title", "year"))
    try:
        shared_dir(spark)
    except RuntimeError as problem:
        found.append(f"scratch: {problem}")
    return found


def main(argv: list[str] | None = None) -> int:
    """0: done; 1: the doctor or the self-test found something; 2: tables could not be read or written, or another run published first; 130: interrupted."""
    a = parser().parse_args(argv)
    logging.basicConfig(format="%(asctime)s %(levelname)s %(name)s %(message)s", stream=sys.stderr)
    logging.getLogger("reelsift").setLevel(logging.DEBUG if a.verbose else logging.WARNING if a.quiet else getattr(logging, load().log_level.upper(), logging.INFO))
    try:
        return _run(a)
    except (OSError, PySparkException) as problem:
        logging.getLogger("reelsift").error("%s", str(problem).splitlines()[0])
        print(problem, file=sys.stderr)
        return 2
    except KeyboardInterrupt:
        logging.getLogger("reelsift").warning("interrupted; nothing was published")
        return 130


def _run(a: argparse.Namespace) -> int:
    change = {"dry_run": a.dry_run or None, "batch_size": a.limit, "enrich_rounds": a.rounds, "retry_rounds": a.rounds, "max_deletes_per_run": a.max_deletes, "renumber_ids": a.renumber or None}
    s = dataclasses.replace(load(), **{k: v for k, v in change.items() if v is not None})
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    as_of = F.lit(a.as_of).cast("timestamp_ntz") if a.as_of else F.lit(spark.sql("select current_timestamp() as t").first()[0]).cast("timestamp_ntz")
    if a.mode == "selftest":
        from .selftest import run as selftest

        failed = selftest(spark)
        print("\n".join(f"failed: {x}" for x in failed) or "all checks hold")
        return int(bool(failed))
    if not a.snapshots:
        parser().error("--snapshots is needed")
    store, remembered = Snapshots(spark, a.snapshots), Snapshots(spark, f"{a.snapshots}/cache", TITLE_CACHE)
    if a.mode == "doctor":
        problems = doctor(spark, store, remembered, a.candidates)
        print("\n".join(problems) or f"snapshot {store.version()} and all that a run needs can be read")
        return int(bool(problems))
    releases, cache = store.read(), remembered.read()
    offered = spark.read.parquet(a.candidates) if a.candidates else spark.createDataFrame([], "provider string, title string, year int, tmdb_id int, imdb_id string, anilist_id int, kitsu_id int, mal_id int")
    report = Report("Catalog curation")
    state = stages.State(releases, cache, of_setting(s.max_deletes_per_run))
    run = {
        "purge": lambda: stages.run_purge(state, s, as_of, report),
        "enrich": lambda: stages.run_enrich(state, s, as_of, report, offered),
        "retry": lambda: stages.run_enrich(state, s, as_of, report, offered, retry=True),
        "best": lambda: stages.run_best(state, s, report),
        "renumber": lambda: stages.run_renumber(state, s, report),
        "stats": lambda: stages.run_stats(state, report),
    }
    if a.mode == "all":
        done, report = stages.run_all(releases, cache, offered, s, as_of)
    else:
        done = run[a.mode]()
    if not s.dry_run and a.mode != "stats":
        store.publish(done.releases)
        remembered.publish(done.cache)
    report.write(s.summary_file, s.summary_json)
    return 0


if __name__ == "__main__":
    sys.exit(main())
