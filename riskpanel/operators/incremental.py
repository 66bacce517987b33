"""Completion of the history by what changed since the run before.

A run leaves its completed rows, its universe, the sums of returns per day and full classification, and a digest of
each day of the panel. The next run completes anew only

* days that are new in the window or whose digest differs, from the panel rows of those days;
* instruments that became active, on the other days;
* imputed rows whose answer may differ: instruments that became active or left change the sums of their
  classifications, and a request is asked again only if one of the prefixes it tried, up to the level it
  was answered at, holds such a sum.

Everything else is handed on. If no instrument came or left, the panel is read on the changed days only.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import schemas
from riskpanel.config import HISTORY_DAYS
from riskpanel.functions import splittable_join
from riskpanel.operators.changes import changed_days
from riskpanel.operators.history import active_universe, exclude_non_modelable
from riskpanel.operators.imputation import (
    _day_array, _gap_units, _marked, _observed, _row_units, business_days, complete_days, day_values, finest_sums, finished, rolled_up,
)

_KEY, _CHAIN = schemas.INSTRUMENT_KEY, schemas.HIERARCHY
_SIZE = len(_CHAIN)
_USABLE = "CASE " + " ".join(f"WHEN path[{i}] IS NULL THEN {i}" for i in range(_SIZE)) + f" ELSE {_SIZE} END"


@dataclass(frozen=True)
class PreviousRun:
    """What a run leaves for the next one; all of it stored tables.

    ``sums`` as ``finest_sums`` gives them for the rows of ``universe``, ``digests`` as ``day_digests`` does for the panel.
    """

    completed: DataFrame
    universe: DataFrame
    sums: DataFrame
    digests: DataFrame


@dataclass(frozen=True)
class IncrementalRun:
    """``fresh`` days were completed anew; ``kept`` days were handed on but for what instruments changed."""

    completed: DataFrame
    sums: DataFrame
    fresh: list[date]
    kept: list[date]


def _on(df: DataFrame, days: list[date]) -> DataFrame:
    """Rows of the days; as values, so that scans of partitions by day open no others."""
    return df.filter(F.col("fecha").isin(days)) if days else df.filter(F.lit(False))


def _same_rows(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Join on columns of which any may be null."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") for c in columns]).distinct()
    return left.join(renamed, [left[c].eqNullSafe(renamed[f"_{c}"]) for c in columns], how)


def _prefixes(df: DataFrame, shortest: str = "1") -> DataFrame:
    """(fecha, path, prefix) for the prefixes before the first null, from the ``shortest`` on."""
    usable = df.withColumn("usable", F.expr(_USABLE)).filter(f"usable >= {shortest}")
    return usable.withColumn("length", F.explode(F.expr(f"sequence({shortest}, usable)"))).select(
        "fecha", "path", F.slice("path", F.lit(1), F.col("length")).alias("prefix")
    )


def complete_history_incremental(
    panel: DataFrame, calendar: DataFrame, corte: date | str, previous: PreviousRun, digests: DataFrame,
    n: int = HISTORY_DAYS, universe: DataFrame | None = None,
) -> IncrementalRun:
    """The rows that ``complete_history`` gives for the real history of ``panel``, from those of an earlier run.

    ``digests`` are those of ``panel`` now. Give the universe as a stored table where there is one. The previous run may have
    been for any cutoff; days it lacks are completed anew.
    """
    rows = exclude_non_modelable(panel)
    universe = active_universe(rows, corte) if universe is None else universe
    days = day_values(business_days(calendar, corte, n))
    held = set(day_values(_on(previous.completed, days)))
    changed = set(changed_days(_on(previous.digests, days), _on(digests, days)))
    fresh = [d for d in days if d in changed or d not in held]
    kept = [d for d in days if d not in set(fresh)]

    keys, earlier = universe.select(*_KEY).distinct(), previous.universe.select(*_KEY).distinct()

    def active(some: list[date]) -> DataFrame:
        return _on(rows, some).join(keys, _KEY, "left_semi")

    on_fresh = complete_days(active(fresh), fresh, universe) if fresh else previous.completed.filter(F.lit(False))
    on_fresh = on_fresh.select(*schemas.COMPLETED.fieldNames())
    old = _on(previous.completed, kept).select(*schemas.COMPLETED.fieldNames())
    old_sums = _on(previous.sums, kept).select("fecha", "path", "total", "n")
    fresh_sums = finest_sums(active(fresh))
    moved = keys.subtract(earlier).union(earlier.subtract(keys))
    arrived = universe.select(*schemas.UNIVERSE).subtract(previous.universe.select(*schemas.UNIVERSE))
    if moved.isEmpty() and arrived.isEmpty():
        return IncrementalRun(old.unionByName(on_fresh), old_sums.unionByName(fresh_sums), fresh, kept)

    # the sums that instruments change by coming or leaving, formed again from all rows of their groups
    touched = _on(rows, kept).join(moved, _KEY, "left_semi").filter("retorno IS NOT NULL")
    touched = touched.select("fecha", F.array(*_CHAIN).alias("path")).distinct()
    again = splittable_join(
        active(kept).filter("retorno IS NOT NULL").withColumn("path", F.array(*_CHAIN)), touched, ["fecha", "path"], "left_semi"
    )
    kept_sums = splittable_join(old_sums, touched, ["fecha", "path"], "left_anti").unionByName(finest_sums(again))

    staying = _same_rows(old, universe, schemas.UNIVERSE, "left_semi").withColumn("path", F.array(*_CHAIN))
    observed, imputed = staying.filter("origen_completado = 'REAL'"), staying.filter("origen_completado <> 'REAL'")
    tried = _prefixes(imputed.select("fecha", "path", "jerarquia_usada").distinct(), f"coalesce({_SIZE + 1} - jerarquia_usada, 1)")
    open_ = splittable_join(tried, _prefixes(touched).select("fecha", "prefix").distinct(), ["fecha", "prefix"], "left_semi")
    open_ = open_.select("fecha", "path").distinct()
    same = splittable_join(imputed, open_, ["fecha", "path"], "left_anti")
    asked = splittable_join(imputed, open_, ["fecha", "path"], "left_semi").withColumn("retorno", F.lit(None).cast("double"))

    own = active(kept).join(arrived.select(*_KEY).distinct(), _KEY, "left_semi")
    missing = _gap_units(arrived, kept, own)
    for rows_without in (_observed(arrived, kept, own.filter("retorno IS NULL")), asked):
        missing = missing.unionByName(_row_units(rows_without, kept))
    # all days of the paths that came, and the rows asked again; one aggregation over both
    paths = arrived.select(F.array(*_CHAIN).alias("path")).distinct().withColumn("fecha", F.explode(_day_array(kept)))
    requests = paths.select("fecha", "path").union(asked.select("fecha", "path")).distinct()
    filled = finished(
        _marked(_observed(arrived, kept, own.filter("retorno IS NOT NULL"))), missing, requests, rolled_up(kept_sums), kept
    )
    completed = observed.drop("path").unionByName(same.drop("path")).unionByName(filled).unionByName(on_fresh)
    return IncrementalRun(completed, kept_sums.unionByName(fresh_sums), fresh, kept)
