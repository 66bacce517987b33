"""Column expressions shared by the operators. All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskpanel.config import EPS

# Instruments without a market return of their own.
EXCLUDED_CLASSES = ("FWD", "MTM", "FWD - MTM")
EXCLUDED_SHARES = ("CAJA", "MTM", "CC2", "CC3")


def norm(c: Column | str) -> Column:
    """Text key: trimmed, upper case, null as the empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(F.coalesce(c.cast("string"), F.lit(""))))


def safe_ratio(num: Column, den: Column, default: float | None = None) -> Column:
    """``num / den``, or ``default`` where the denominator is practically zero."""
    return F.when(F.abs(den) < EPS, F.lit(default).cast("double")).otherwise(num / den)


def winsorize(c: Column, cap: float) -> Column:
    """Limit to [-cap, cap]; null stays null."""
    return F.when(c > cap, F.lit(cap)).when(c < -cap, F.lit(-cap)).otherwise(c)


def tenor_bucket(c: Column | str) -> Column:
    """Tenor text without a zero decimal part, then without an upper-case year mark."""
    c = F.col(c) if isinstance(c, str) else c
    without_decimals = F.regexp_replace(F.trim(c), r"\.0+$", "")
    return F.regexp_replace(without_decimals, r"Y$", "")


def is_excluded() -> Column:
    """True for rows outside the model; never null, so its negation keeps unclassified rows."""
    cash_like = (norm("clase") == "ACT") & norm("C1").isin(*EXCLUDED_SHARES)
    return norm("clase").isin(*EXCLUDED_CLASSES) | cash_like
