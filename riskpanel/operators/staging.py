"""Incremental, repeatable staging of the source panel."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskpanel import schemas
from riskpanel.config import BOOTSTRAP_DAYS, as_date
from riskpanel.operators.changes import changed_days, day_digests
from riskpanel.sources import SourceConfig, read_panel, read_source, source_max_date, staging_watermark, write_partitions

#: Staging is partitioned by day, so a load replaces the days it carries and no others.
PARTITIONS = ["year", "month", "fecha"]


@dataclass(frozen=True)
class StagedRange:
    """What a load covered, and how many values it could not read (0 unless the source allows any)."""

    start: date
    end: date
    rows: int
    unreadable: int = 0


def incremental_range(
    source_max: date, staged_max: date | None, bootstrap_days: int = BOOTSTRAP_DAYS, lookback_days: int = 0
) -> tuple[date, date] | None:
    """First and last date to load, or None when staging is up to date."""
    if staged_max is None:
        start = source_max - timedelta(days=bootstrap_days)
    else:
        start = staged_max + timedelta(days=1) - timedelta(days=lookback_days)
    return None if start > source_max else (start, source_max)


def with_partitions(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("fecha")).withColumn("month", F.month("fecha"))


def extract_increment(
    spark: SparkSession, source: SourceConfig, start: date, end: date, unreadable: Observation | None = None
) -> DataFrame:
    """Source rows of the new days only. What staging holds of earlier days stays, also if the source has dropped it."""
    return with_partitions(read_source(spark, source, start, end, unreadable))


def incremental_stage(
    spark: SparkSession,
    source: SourceConfig,
    staging_path: str,
    bootstrap_days: int = BOOTSTRAP_DAYS,
    lookback_days: int = 0,
) -> StagedRange | None:
    """Load what is new since the last staged date; None, and no write, when nothing is."""
    span = incremental_range(
        source_max_date(spark, source), staging_watermark(spark, staging_path), bootstrap_days, lookback_days
    )
    if span is None:
        return None
    # The counts ride on the write instead of scanning the source a second time.
    loaded, unreadable = Observation(), Observation()
    rows = extract_increment(spark, source, *span, unreadable).observe(loaded, F.count(F.lit(1)).alias("rows"))
    write_partitions(rows, staging_path, PARTITIONS)
    return StagedRange(*span, loaded.get["rows"], (unreadable.get["values"] or 0) if source.allow_unreadable else 0)


@dataclass(frozen=True)
class Reconciled:
    """The days that a reconciliation replaced, and those that it emptied because the source has dropped them."""

    replaced: tuple[date, ...]
    emptied: tuple[date, ...]


def staging_reconcile(
    spark: SparkSession, source: SourceConfig, staging_path: str, start: date | str, end: date | str
) -> Reconciled:
    """Bring staged days of [start, end] to what the source holds now: late, corrected and removed rows.

    Both sides are reduced to a digest per day, and only days that differ are read again and replaced; files of other
    days are not touched. At most MAX_HISTORY_DAYS days may differ. Nothing staged yet: every day differs.
    """
    start, end = as_date(start), as_date(end)
    rows = read_source(spark, source, start, end)
    now = day_digests(rows)
    if staging_watermark(spark, staging_path) is None:
        held = now.limit(0)
    else:
        held = day_digests(read_panel(spark, staging_path, start, end))
    changed = changed_days(held, now)
    if not changed:
        return Reconciled((), ())
    current = rows.filter(F.col("fecha").isin(changed))
    there = sorted(row["fecha"] for row in current.select("fecha").distinct().collect())  # some of the changed days
    if there:
        write_partitions(with_partitions(current), staging_path, PARTITIONS)
    gone = tuple(d for d in changed if d not in set(there))
    # an empty result replaces no partition, so the folder of a day without rows is overwritten by itself
    nothing = spark.createDataFrame([], schemas.PANEL).drop("fecha")
    for d in gone:
        nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{staging_path.rstrip('/')}/year={d.year}/month={d.month}/fecha={d.isoformat()}"
        )
    return Reconciled(tuple(there), gone)
