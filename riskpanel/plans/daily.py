"""The daily run: stage, restrict, complete, measure. The only module that writes results.

Every step ends in a stored table and the next one reads it, so no lineage outlives a
step, a lost executor costs one stage, and shared inputs are computed once.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel import schemas
from riskpanel.config import RiskConfig
from riskpanel.operators.history import active_keys, active_universe, real_history, require_universe
from riskpanel.operators.imputation import complete_history
from riskpanel.operators.quality import qc_summary, require_quality
from riskpanel.operators.returns import base_returns
from riskpanel.operators.staging import incremental_stage
from riskpanel.plans.results import result_tables
from riskpanel.sources import (
    SourceConfig,
    audit_counts,
    read_alt_params,
    read_calendar,
    read_panel,
    read_snapshot,
    write_snapshot,
)


@dataclass(frozen=True)
class DailyPaths:
    """Folders of a run, all below one root on shared storage."""

    root: str
    calendar: str
    alt_params: str | None = None

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def store_real_history(spark: SparkSession, paths: DailyPaths, cfg: RiskConfig) -> DataFrame:
    """All staged dates up to the cutoff of the instruments active then. Nothing is replaced if there are none."""
    panel = read_panel(spark, paths.table("staging"), end=cfg.cutoff)
    active = active_keys(read_panel(spark, paths.table("staging"), start=cfg.cutoff, end=cfg.cutoff), cfg.cutoff)
    require_universe(active, cfg.cutoff)
    write_snapshot(active, paths.table("output_active"), cfg.cutoff)
    active = read_snapshot(spark, paths.table("output_active"), cfg.cutoff).drop("corte")
    write_snapshot(real_history(panel, cfg.cutoff, active), paths.table("output_real"), cfg.cutoff, ["fecha"])
    return read_snapshot(spark, paths.table("output_real"), cfg.cutoff, schemas.REAL_HISTORY)


def store_completed(spark: SparkSession, paths: DailyPaths, cfg: RiskConfig) -> DataFrame:
    real = read_snapshot(spark, paths.table("output_real"), cfg.cutoff, schemas.REAL_HISTORY)
    write_snapshot(active_universe(real, cfg.cutoff), paths.table("output_universe"), cfg.cutoff)
    universe = read_snapshot(spark, paths.table("output_universe"), cfg.cutoff).drop("corte")
    completed = complete_history(
        real, read_calendar(spark, paths.calendar), cfg.cutoff, cfg.history_days, universe
    )
    # Always read whole, so its rows need no clustering.
    write_snapshot(completed, paths.table("output_final"), cfg.cutoff, dealt=True)
    return read_snapshot(spark, paths.table("output_final"), cfg.cutoff, schemas.COMPLETED)


def store_results(spark: SparkSession, paths: DailyPaths, cfg: RiskConfig) -> dict[str, DataFrame]:
    completed = read_snapshot(spark, paths.table("output_final"), cfg.cutoff, schemas.COMPLETED)
    params = read_alt_params(spark, paths.alt_params) if paths.alt_params else None

    def stored(name: str, df: DataFrame) -> DataFrame:
        write_snapshot(df, paths.table(name), cfg.cutoff, ["fecha"] if "fecha" in df.columns else ["fund_type"])
        return read_snapshot(spark, paths.table(name), cfg.cutoff, schemas.TABLES[name])

    return result_tables(base_returns(completed, cfg, params), cfg, stored)


def run_daily(
    spark: SparkSession,
    cfg: RiskConfig,
    paths: DailyPaths,
    source: SourceConfig | None = None,
    strict_quality: bool = False,
    **staging,
) -> dict[str, DataFrame]:
    """All steps for one cutoff. Returns the stored tables, the audit and the quality summary.

    On a day that is no business day nothing is due: no step runs and nothing is returned. Without a source the
    staged panel is used as it is. ``strict_quality`` raises on a failed check, after everything is stored.
    """
    if not is_business_day(read_calendar(spark, paths.calendar), cfg):
        return {}
    if source is not None:
        incremental_stage(spark, source, paths.table("staging"), **staging)
    store_real_history(spark, paths, cfg)
    store_completed(spark, paths, cfg)
    tables = store_results(spark, paths, cfg)
    if strict_quality:
        require_quality(tables, cfg)
    return tables | {
        "audit": audit_counts(tables, cfg.cutoff),
        "quality": qc_summary(tables, cfg),
    }


def is_business_day(calendar: DataFrame, cfg: RiskConfig) -> bool:
    """Whether a run is due at the cutoff."""
    due = calendar.filter(F.col("es_habil") & (F.col("fecha") == F.lit(cfg.cutoff)))
    return not due.isEmpty()
