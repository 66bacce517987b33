"""Restriction of the panel to modelable instruments that are active at the cutoff."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import schemas
from riskpanel.config import as_date
from riskpanel.functions import is_excluded


def exclude_non_modelable(panel: DataFrame) -> DataFrame:
    return panel.filter(~is_excluded())


def at_cutoff(df: DataFrame, corte: date | str) -> DataFrame:
    return df.filter(F.col("fecha") == F.lit(as_date(corte)))


def up_to_cutoff(df: DataFrame, corte: date | str) -> DataFrame:
    return df.filter(F.col("fecha") <= F.lit(as_date(corte)))


def with_corte(df: DataFrame, corte: date | str) -> DataFrame:
    return df.withColumn("corte", F.lit(as_date(corte)))


def active_universe(panel: DataFrame, corte: date | str) -> DataFrame:
    """Instruments observed on the cutoff date, with their classification."""
    return at_cutoff(panel, corte).select(*schemas.UNIVERSE).distinct()


def require_universe(universe: DataFrame, corte: date | str) -> None:
    if universe.isEmpty():
        raise ValueError(f"no instrument has data at the cutoff {as_date(corte)}")


def active_keys(panel: DataFrame, corte: date | str) -> DataFrame:
    """Keys of the modelable rows at the cutoff, one per row. Stored, their size is known before the panel moves."""
    return at_cutoff(exclude_non_modelable(panel), corte).select(*schemas.INSTRUMENT_KEY)


def real_history(panel: DataFrame, corte: date | str, active: DataFrame | None = None) -> DataFrame:
    """All modelable rows of the instruments active at the cutoff, with their own-date class.

    A semi join, so an instrument with two classifications at the cutoff keeps one row per
    date, and the universe needs no duplicate removal, which would keep adaptive execution
    from splitting an instrument that dominates the panel. The universe grows with the
    panel, so it carries no broadcast hint; its measured size decides. Give the ``active_keys`` as a stored table
    where there is one: their size is then measured before the panel is shuffled for the join.
    """
    kept = exclude_non_modelable(panel)
    active = active_keys(panel, corte) if active is None else active
    return with_corte(kept.join(active, schemas.INSTRUMENT_KEY, "left_semi"), corte).select(
        *schemas.REAL_HISTORY.fieldNames()
    )
