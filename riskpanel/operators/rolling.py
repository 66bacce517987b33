"""Tracking error, beta and VaR of every cutoff of a panel in one plan.

Each day is a cutoff with its own weights. What is daily per fund and cutoff is summed once, over assets, before
the shuffle; the moments of the latest days are then formed from the daily rows, which are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.config import ANNUAL_DAYS, VAR_ALPHA, RiskConfig
from riskpanel.functions import safe_ratio, splittable_join
from riskpanel.operators.metrics import side_series, tracking_error
from riskpanel.operators.returns import active_rows, comparable_returns


def daily_delta_weights(base: DataFrame, cfg: RiskConfig) -> DataFrame:
    """(corte, fund_type, asset_key, delta_weight) with every date of ``base`` as a cutoff, portfolio less benchmark.

    One aggregation per asset and date; the totals of the sides are joined back, not gathered by a window.
    """
    if cfg.benchmark_mode != "ID":
        raise ValueError("weights of every cutoff need one benchmark manager")
    own, other = F.col("manager") == cfg.portfolio_id, F.col("manager") == cfg.benchmark_id
    rows = active_rows(base, cfg).filter(own | other).select(F.col("fecha").alias("corte"), "fund_type", "manager", "asset_key", "weight_calc")
    totals = rows.groupBy("corte", "fund_type", "manager").agg(F.sum("weight_calc").alias("total"))
    scaled = splittable_join(rows, totals, ["corte", "fund_type", "manager"]).withColumn(
        "w", safe_ratio(F.col("weight_calc"), F.col("total"), 0.0)
    )
    sides = [F.coalesce(F.sum(F.when(side, F.col("w"))), F.lit(0.0)) for side in (own, other)]
    return scaled.groupBy("corte", "fund_type", "asset_key").agg((sides[0] - sides[1]).alias("delta_weight"))


def rolling_active_return(base: DataFrame, cfg: RiskConfig) -> DataFrame:
    """(corte, fund_type, fecha, r_diff): for every cutoff its active weights times the returns of all dates up to it."""
    returns = comparable_returns(base, cfg).select("fund_type", "asset_key", "fecha", "return_calc")
    both = splittable_join(daily_delta_weights(base, cfg), returns, ["fund_type", "asset_key"]).filter("fecha <= corte")
    return both.groupBy("corte", "fund_type", "fecha").agg(F.sum(F.col("delta_weight") * F.col("return_calc")).alias("r_diff"))


def rolling_beta(base: DataFrame, cfg: RiskConfig) -> DataFrame:
    """(corte, fund_type, beta_days, beta_ex_ante): beta over the latest dates up to every date on which a fund has both sides.

    The sides' daily sums do not depend on the cutoff, so one frame over the few daily rows of a fund gives all of them.
    """
    if cfg.beta_weighting != "sum" or cfg.beta_nulls != "pairwise":
        raise ValueError("beta of every cutoff is formed from unweighted sums, pairwise")
    latest = Window.partitionBy("fund_type").orderBy("fecha").rowsBetween(1 - cfg.window_days, 0)
    sxy, sxx = (f("r_portfolio", "r_benchmark").over(latest) for f in (F.regr_sxy, F.regr_sxx))
    return side_series(base, cfg).select(
        F.col("fecha").alias("corte"), "fund_type", F.count(F.lit(1)).over(latest).cast("int").alias("beta_days"),
        safe_ratio(sxy, sxx).alias("beta_ex_ante"),
    )


def risk_history(base: DataFrame, cfg: RiskConfig) -> DataFrame:
    """One row per fund and cutoff: tracking error, VaR and beta as the daily run would give them on that date.

    ``base`` holds the base returns of all dates; its cutoff column is not used. A fund has a row for the cutoffs with an
    active return; its beta is that of the latest date on which both its sides have rows.
    """
    window = tracking_error(rolling_active_return(base, cfg), cfg)
    daily = F.col("daily_tracking_error")
    metrics = window.withColumns({"var_95_1d": F.lit(VAR_ALPHA) * daily, "var_95_252d": F.lit(VAR_ALPHA) * F.sqrt(F.lit(ANNUAL_DAYS)) * daily})
    slopes = rolling_beta(base, cfg).select("corte", "fund_type", F.struct("beta_days", "beta_ex_ante").alias("slope"))
    # one row per fund and date on both sides; the latest slope is carried along the few dates of a fund
    so_far = Window.partitionBy("fund_type").orderBy("corte").rowsBetween(Window.unboundedPreceding, 0)
    both = metrics.withColumn("due", F.lit(True)).join(slopes, ["corte", "fund_type"], "full")
    carried = both.withColumn("slope", F.last("slope", ignorenulls=True).over(so_far)).filter("due")
    return carried.select(*metrics.columns, "slope.beta_days", "slope.beta_ex_ante")
