"""Settings of a run, from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Names and defaults of all settings."""

    title_column: str = "auto"
    dry_run: bool = False
    batch_size: int = 400
    enrich_rounds: int = 25
    recheck_days: int = 45
    fill_all_ids: bool = True
    aggressive_fallback: bool = True
    only_types: str = ""
    max_deletes_per_run: int = 0
    renumber_ids: bool = False
    renumber_ids_force: bool = False
    renumber_max_rows: int = 200_000
    purge_junk: bool = True
    purge_blocked: bool = True
    purge_absolute_only: bool = True
    purge_dead: bool = False
    purge_soft_adult: bool = False
    purge_empty_title: bool = False
    absolute_only_action: str = "delete"
    absolute_require_season_null: bool = True
    dead_min_seeders: int = 1
    dead_older_days: int = 60
    keep_best: bool = False
    keep_best_limit: int = 3
    keep_best_min_seeders: int = 0
    keep_best_only_types: str = ""
    keep_best_es: bool = True
    keep_best_es_limit: int = 3
    keep_best_es_min_spanish: int = 2
    keep_best_es_allow_subs_fallback: bool = True
    keep_best_es_dedupe: bool = True
    keep_best_es_strict: bool = False
    keep_best_es_use_title_hint: bool = True
    spanish_tokens_extra: str = ""
    spanish_report_limit: int = 15
    retry_missing: bool = True
    retry_max_attempts: int = 4
    retry_min_age_minutes: int = 60
    retry_rounds: int = 10
    blocked_tokens_extra: str = ""
    allow_tokens_extra: str = ""
    summary_file: str = "summary.md"
    summary_json: str = "summary.json"
    log_level: str = "INFO"


def load(env=None) -> Settings:
    """Settings from upper-cased names; blanks and numbers that don't parse mean the default."""
    env = os.environ if env is None else env
    found = {}
    for f in fields(Settings):
        text = (env.get(f.name.upper()) or "").strip()
        if not text:
            continue
        if f.type == "bool":
            found[f.name] = text.lower() in ("1", "true", "yes", "on", "si", "sí")
        elif f.type == "int":
            try:
                found[f.name] = int(text)
            except ValueError:
                continue
        else:
            found[f.name] = text
    return Settings(**found)


def words(csv: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in csv.split(",") if x.strip())
