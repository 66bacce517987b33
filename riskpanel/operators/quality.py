"""Quality checks over the result tables. Each returns the violating rows; none means passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.config import RiskConfig
from riskpanel.functions import norm, tenor_bucket

_FUND = ["corte", "fund_type"]
Tables = Mapping[str, DataFrame]


def _side_sum(tables: Tables, side: str) -> DataFrame:
    sums = (
        tables["te_pesos_consolidados"].filter(F.col("side") == side).groupBy(*_FUND).agg(F.sum("side_weight").alias("s"))
    )
    return sums.filter(F.abs(F.col("s") - 1.0) > 0.001).select(*_FUND, F.round("s", 6).alias("sum_weight"))


def check_weights_portfolio(tables: Tables, cfg: RiskConfig) -> DataFrame:
    return _side_sum(tables, "PORTFOLIO")


def check_weights_benchmark(tables: Tables, cfg: RiskConfig) -> DataFrame:
    return _side_sum(tables, "BENCHMARK")


def check_delta_sum(tables: Tables, cfg: RiskConfig) -> DataFrame:
    sums = tables["te_pesos_comparables"].groupBy(*_FUND).agg(F.sum("delta_weight").alias("s"))
    return sums.filter(F.abs("s") > 0.01).select(*_FUND, F.round("s", 8).alias("sum_delta"))


def check_swp_zero(tables: Tables, cfg: RiskConfig) -> DataFrame:
    zero_tenor = (F.col("asset_class") == "SWP") & (norm("c2") == "TASA") & (tenor_bucket("c5") == "0")
    return tables["te_retornos_base"].filter(zero_tenor & (F.col("return_calc") != 0))


def check_cap(tables: Tables, cfg: RiskConfig) -> DataFrame:
    """Always one row: the number of comparable returns beyond the cap."""
    beyond = F.abs("return_calc") > cfg.ret_cap
    return tables["te_retornos_comparables"].agg(F.count_if(beyond).alias("violations"))


def check_window_days(tables: Tables, cfg: RiskConfig) -> DataFrame:
    days = tables["te_exante_diario"].groupBy(*_FUND).agg(F.count_distinct("fecha").alias("days"))
    return days.filter(F.col("days") != cfg.window_days)


def _outside(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    value = F.col(column)
    return df.filter((value < low) | (value > high)).select(*_FUND, column)


def check_te_range(tables: Tables, cfg: RiskConfig) -> DataFrame:
    return _outside(tables["te_exante_resumen"], "te_ex_ante", 0.0, 0.05)


def check_beta_range(tables: Tables, cfg: RiskConfig) -> DataFrame:
    return _outside(tables["te_beta_exante_resumen"], "beta_ex_ante", 0.0, 2.0)


def check_var_positive(tables: Tables, cfg: RiskConfig) -> DataFrame:
    return tables["te_var_exante_resumen"].filter(F.col("var_95_1d") <= 0).select(*_FUND, "var_95_1d")


CHECKS: dict[str, Callable[[Tables, RiskConfig], DataFrame]] = {
    "weights_portfolio": check_weights_portfolio,
    "weights_benchmark": check_weights_benchmark,
    "delta_sum": check_delta_sum,
    "swp_zero": check_swp_zero,
    "cap": check_cap,
    "window_days": check_window_days,
    "te_range": check_te_range,
    "beta_range": check_beta_range,
    "var_positive": check_var_positive,
}


def qc_summary(tables: Tables, cfg: RiskConfig) -> DataFrame:
    """One row per rule with its number of violations."""
    counts = []
    for rule, check in CHECKS.items():
        rows = check(tables, cfg)
        violations = F.max("violations") if rule == "cap" else F.count(F.lit(1))
        counts.append(rows.agg(violations.alias("violations")).select(F.lit(rule).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, counts)


def require_quality(tables: Tables, cfg: RiskConfig) -> None:
    """Raise when a check fails. The summary has one row per rule, so it is safe to collect."""
    failed = {r["rule"]: r["violations"] for r in qc_summary(tables, cfg).filter("violations > 0").collect()}
    if failed:
        raise ValueError(f"quality checks failed: {failed}")
