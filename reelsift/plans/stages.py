"""The stages of a run over a snapshot, under one budget of deletes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import CORE_TOKENS, SOFT_TOKENS
from ..operators import apply, identity, purge, queue, rank, renumber, resolve, stats
from ..sources.scratch import settled
from .budget import Budget, of_setting
from .report import Report
from .settings import Settings, words


@dataclass(frozen=True)
class State:
    releases: DataFrame
    cache: DataFrame
    budget: Budget


def run_purge(state: State, s: Settings, as_of: Column, report: Report) -> State:
    """Junk, blocked, absolute-only, dead: each may delete what the budget has left."""
    tokens = (*CORE_TOKENS, *words(s.blocked_tokens_extra))
    steps = (
        ("junk", s.purge_junk, lambda df, n: purge.purge_junk(df, purge_empty=s.purge_empty_title, limit=n, dry_run=s.dry_run)),
        ("blocked", s.purge_blocked, lambda df, n: purge.purge_blocked(df, tokens=tokens, soft=SOFT_TOKENS if s.purge_soft_adult else (), allow=words(s.allow_tokens_extra), limit=n, dry_run=s.dry_run)),
        ("absolute", s.purge_absolute_only, lambda df, n: purge.purge_absolute_only(df, as_of, action=s.absolute_only_action, require_season_null=s.absolute_require_season_null, limit=n, dry_run=s.dry_run)),
        ("dead", s.purge_dead, lambda df, n: purge.purge_dead(df, as_of, min_seeders=s.dead_min_seeders, older_days=s.dead_older_days, limit=n, dry_run=s.dry_run)),
    )
    df, budget = state.releases, state.budget
    for name, wanted, step in steps:
        if not wanted:
            continue
        if budget.exhausted:
            report.metrics(f"purge {name}", {"skipped": "the budget of deletes is spent"})
            continue
        done = step(df, budget.remaining)
        row = done.metrics.first().asDict()
        report.metrics(f"purge {name}", row)
        budget = budget.spend(row["deleted"])
        df = settled(done.survivors)
    return State(df, state.cache, budget)


def run_enrich(state: State, s: Settings, as_of: Column, report: Report, candidates: DataFrame, retry: bool = False) -> State:
    """Pull batches, resolve them over ``candidates``, and apply what was found, until the queue is empty; a dry run looks at one batch."""
    name = "retry" if retry else "enrich"
    df, cache = state.releases, state.cache
    if retry:
        df, counts = queue.reset_for_retry(df, as_of, max_attempts=s.retry_max_attempts, min_age_minutes=s.retry_min_age_minutes, dry_run=s.dry_run)
        report.metrics("retry queue", counts.first().asDict())
    total: dict[str, int] = {}
    known = identity.closure(identity.edges_of(candidates))
    for _ in range(1 if s.dry_run else s.retry_rounds if retry else s.enrich_rounds):
        batch = queue.missing_ids_queue(df, as_of, batch=s.batch_size, min_age_minutes=s.retry_min_age_minutes, max_attempts=s.retry_max_attempts) if retry else queue.enrich_queue(df, as_of, batch=s.batch_size, recheck_days=s.recheck_days, only_types=s.only_types, column=s.title_column)
        found = settled(resolve.resolve_with_cache(batch, cache, candidates, as_of, fill_all=s.fill_all_ids, aggressive=s.aggressive_fallback, known=known))
        counts = {r["outcome"]: r["count"] for r in found.groupBy("outcome").count().collect()}
        if not counts:
            break
        for k, v in counts.items():
            total[k] = total.get(k, 0) + v
        if s.dry_run:
            break
        as_batch = found.select(F.monotonically_increasing_id().alias("pos"), *(F.col(c).cast("string").alias(c) for c in ("id", "tmdb_id", "imdb_id", "anilist_id", "kitsu_id", "mal_id", "source", "confidence", "cache_key")))
        done = apply.apply_ids(df, cache, as_batch, as_of)
        df, cache = settled(done.rows), settled(done.cache)
    report.metrics(name, total or {"queue": "empty"})
    return State(df, cache, state.budget)


def run_best(state: State, s: Settings, report: Report) -> State:
    df, budget = state.releases, state.budget
    if s.keep_best and not budget.exhausted:
        done = rank.keep_best(df, limit=s.keep_best_limit, min_seeders=s.keep_best_min_seeders, only_types=s.keep_best_only_types, max_deletes=budget.remaining, dry_run=s.dry_run)
        row = done.metrics.first().asDict()
        report.metrics("keep best", row)
        budget, df = budget.spend(row["deleted"]), settled(done.survivors)
    if s.keep_best_es and not budget.exhausted:
        done = rank.keep_best_spanish(df, limit=s.keep_best_es_limit, min_spanish=s.keep_best_es_min_spanish, min_seeders=s.keep_best_min_seeders, only_types=s.keep_best_only_types, dedupe=s.keep_best_es_dedupe, strict=s.keep_best_es_strict, title_hint=s.keep_best_es_use_title_hint, subs_fallback=s.keep_best_es_allow_subs_fallback, tokens=s.spanish_tokens_extra, max_deletes=budget.remaining, dry_run=s.dry_run)
        row = done.metrics.first().asDict()
        report.metrics("keep best of the language", row)
        budget, df = budget.spend(row["deleted"]), settled(done.survivors)
    gaps = rank.spanish_gaps(df, limit=s.spanish_report_limit, tokens=s.spanish_tokens_extra)
    report.heading("language gaps")
    report.table(gaps.columns, [list(r) for r in gaps.collect()])
    return State(df, state.cache, budget)


def run_renumber(state: State, s: Settings, report: Report) -> State:
    done = renumber.renumber(state.releases, dry_run=s.dry_run or not s.renumber_ids, max_rows=s.renumber_max_rows, force=s.renumber_ids_force)
    report.metrics("renumber", {"status": done.status, "note": done.note, "next_id": done.next_id})
    return State(done.rows, state.cache, state.budget)


def run_stats(state: State, report: Report) -> State:
    for name, fn in (("identifiers", stats.ids_stats), ("quality", stats.quality_stats), ("language", stats.spanish_stats), ("ids", stats.id_report)):
        report.metrics(name, fn(state.releases).first().asDict())
    return state


def run_all(releases: DataFrame, cache: DataFrame, candidates: DataFrame, s: Settings, as_of: Column) -> tuple[State, Report]:
    """Purge, enrich, retry, best, renumber, statistics; deletes stop where the budget does."""
    report = Report("Catalog curation")
    state = State(releases, cache, of_setting(s.max_deletes_per_run))
    state = run_purge(state, s, as_of, report)
    state = run_enrich(state, s, as_of, report, candidates)
    if s.retry_missing:
        state = run_enrich(state, s, as_of, report, candidates, retry=True)
    state = run_best(state, s, report)
    state = run_renumber(state, s, report)
    return run_stats(state, report), report
