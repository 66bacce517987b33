"""Weights at the cutoff: gross, normalised per side, and portfolio against benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.config import RiskConfig
from riskpanel.functions import safe_ratio, splittable_join
from riskpanel.operators.returns import active_rows, kind_code, kind_names

_SIDE = ["corte", "fund_type", "manager"]


def base_weights(base: DataFrame) -> DataFrame:
    """Gross weight per asset, manager and fund on the cutoff date."""
    return base.filter(F.col("fecha") == F.col("corte")).select(
        "corte",
        "manager",
        "fund_type",
        "asset_key",
        "key_type",
        "asset_class",
        F.col("weight_calc").alias("base_weight"),
        "c1",
        "c2",
        "c3",
        "c4",
        "c5",
    )


def _totals(weights: DataFrame) -> DataFrame:
    return weights.groupBy(*_SIDE).agg(F.sum("base_weight").alias("total_weight"))


def normalized_weights(weights: DataFrame) -> DataFrame:
    """Weights of each manager and fund scaled to sum 1; 0 where the total is practically 0.

    The total is a partial aggregate joined back, not a window over the side: a side may
    hold most of the rows and must not end up in one task.
    """
    scaled = safe_ratio(F.col("base_weight"), F.col("total_weight"), 0.0)
    return splittable_join(weights, _totals(weights), _SIDE).withColumn("normalized_weight", scaled)


def _side_rows(df: DataFrame, side: str) -> DataFrame:
    return df.select(
        "corte",
        "fund_type",
        "asset_key",
        "key_type",
        "asset_class",
        F.lit(side).alias("side"),
        F.col("normalized_weight").alias("side_weight"),
    )


def _mean_over_managers(normalized: DataFrame, totals: DataFrame) -> DataFrame:
    """Mean weight per asset over all managers of a fund; an asset a manager lacks counts 0."""
    managers = totals.groupBy("corte", "fund_type").agg(F.count(F.lit(1)).alias("managers"))
    summed = normalized.groupBy("corte", "fund_type", "asset_key").agg(
        F.sum("normalized_weight").alias("total"), F.min(kind_code()).alias("kind")
    )
    return splittable_join(summed, managers, ["corte", "fund_type"]).select(
        "corte",
        "fund_type",
        "asset_key",
        *kind_names("kind"),
        (F.col("total") / F.col("managers")).alias("normalized_weight"),
    )


def benchmark_weights(base: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Benchmark side: one manager, or the mean of every manager but the portfolio's."""
    weights = base_weights(active_rows(base, cfg))
    if cfg.benchmark_mode == "ID":
        return _side_rows(normalized_weights(weights.filter(F.col("manager") == cfg.benchmark_id)), "BENCHMARK")
    others = weights.filter(F.col("manager") != cfg.portfolio_id)
    return _side_rows(_mean_over_managers(normalized_weights(others), _totals(others)), "BENCHMARK")


def side_weights(base: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Normalised weights of both sides, one row per asset and side."""
    if cfg.benchmark_mode == "ID":
        # Both sides are single managers: one aggregation covers them.
        weights = base_weights(active_rows(base, cfg)).filter(
            F.col("manager").isin(cfg.portfolio_id, cfg.benchmark_id)
        )
        side = F.when(F.col("manager") == cfg.portfolio_id, F.lit("PORTFOLIO")).otherwise(F.lit("BENCHMARK"))
        return normalized_weights(weights).select(
            "corte",
            "fund_type",
            "asset_key",
            "key_type",
            "asset_class",
            side.alias("side"),
            F.col("normalized_weight").alias("side_weight"),
        )
    portfolio = base_weights(active_rows(base, cfg)).filter(F.col("manager") == cfg.portfolio_id)
    return _side_rows(normalized_weights(portfolio), "PORTFOLIO").unionByName(benchmark_weights(base, cfg))


def delta_weights(side_weights: DataFrame, cfg: RiskConfig | None = None) -> DataFrame:
    """Portfolio minus benchmark weight per asset, 0 where a side lacks the asset.

    A full outer match of the two sides, expressed as one aggregation over both.
    """
    on_portfolio = F.col("side") == "PORTFOLIO"
    on_benchmark = F.col("side") == "BENCHMARK"
    matched = side_weights.groupBy("corte", "fund_type", "asset_key").agg(
        F.min(kind_code()).alias("kind"),
        F.sum(F.when(on_portfolio, F.col("side_weight"))).alias("portfolio"),
        F.sum(F.when(on_benchmark, F.col("side_weight"))).alias("benchmark"),
        F.max(on_portfolio.cast("int")).alias("exists_portfolio"),
        F.max(on_benchmark.cast("int")).alias("exists_benchmark"),
    )
    portfolio = F.coalesce("portfolio", F.lit(0.0))
    benchmark = F.coalesce("benchmark", F.lit(0.0))
    return matched.select(
        "corte",
        "fund_type",
        F.col("asset_key").alias("comparable_key"),
        *kind_names("kind"),
        portfolio.alias("portfolio_weight"),
        benchmark.alias("benchmark_weight"),
        (portfolio - benchmark).alias("delta_weight"),
        "exists_portfolio",
        "exists_benchmark",
        F.col("portfolio").isNull().cast("int").alias("zero_filled_portfolio"),
    )
