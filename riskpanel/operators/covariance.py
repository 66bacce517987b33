"""The covariance matrix of a fund's assets in factor form.

Over D days the matrix has rank D - 1 at most, however many assets there are. It is kept as one vector of centred
returns per asset, of D numbers, and as the D x D Gram matrix of these vectors. Covariances of asked-for pairs are products
of two vectors; variance in total, norm and leading components follow from the Gram matrix. Nothing has a
row per pair of assets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.config import RiskConfig
from riskpanel.functions import splittable_join
from riskpanel.operators.metrics import latest_dates

_FUND = ["corte", "fund_type"]


def centred_returns(comparables: DataFrame, cfg: RiskConfig) -> DataFrame:
    """(corte, fund_type, asset_key, days, vector): each asset's returns over the fund's latest dates, less their mean.

    ``vector`` has one number per date, in order of the dates; a missing return counts as 0, as in the active return.
    """
    dates = latest_dates(comparables.select(*_FUND, "fecha").distinct(), cfg.window_days)
    listed = dates.groupBy(*_FUND).agg(F.array_sort(F.collect_list("fecha")).alias("dates"))  # window_days at most
    recent = splittable_join(comparables, listed, _FUND).filter(F.array_contains("dates", F.col("fecha")))
    # an asset has one return per date, so its map is bounded by the dates
    by_asset = splittable_join(comparables.select(*_FUND, "asset_key").distinct(), listed, _FUND).join(
        recent.groupBy(*_FUND, "asset_key").agg(
            F.map_from_entries(F.collect_list(F.struct("fecha", F.coalesce("return_calc", F.lit(0.0))))).alias("returns")
        ),
        [*_FUND, "asset_key"], "left",
    )
    raw = F.transform("dates", lambda d: F.coalesce(F.try_element_at("returns", d), F.lit(0.0)))
    mean = F.aggregate("raw", F.lit(0.0), lambda a, x: a + x) / F.size("dates")
    return (
        by_asset.withColumn("raw", raw).withColumn("mean", mean)
        .select(*_FUND, "asset_key", F.size("dates").alias("days"), F.transform("raw", lambda x: x - F.col("mean")).alias("vector"))
    )


def covariance_pairs(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` (corte, fund_type, asset_i, asset_j) with ``cov``, null for fewer than two dates. Unknown assets give no row."""
    sides = [
        vectors.select(*_FUND, F.col("asset_key").alias(f"asset_{s}"), "days", F.col("vector").alias(f"vector_{s}")) for s in "ij"
    ]
    both = splittable_join(splittable_join(pairs, sides[0], [*_FUND, "asset_i"]), sides[1].drop("days"), [*_FUND, "asset_j"])
    product = F.aggregate(F.zip_with("vector_i", "vector_j", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return both.select(
        *pairs.columns, F.when(F.col("days") > 1, product / (F.col("days") - 1)).alias("cov")
    )


def gram_matrix(vectors: DataFrame) -> DataFrame:
    """(corte, fund_type, days, i, j, g) for i <= j: sums over all assets of the products of two dates, over days - 1.

    The products are summed before the shuffle, so a task sends days^2 / 2 rows per fund, however many assets it has.
    """
    first = vectors.select(*_FUND, "days", "vector", F.posexplode("vector").alias("i", "x"))
    rest = F.slice("vector", F.col("i") + 1, F.size("vector") - F.col("i"))
    products = first.select(*_FUND, "days", "i", "x", F.posexplode(rest).alias("k", "y"))
    return products.groupBy(*_FUND, "days", "i", (F.col("i") + F.col("k")).alias("j")).agg(
        F.when(F.col("days") > 1, F.sum(F.col("x") * F.col("y")) / (F.col("days") - 1)).alias("g")
    )


def covariance_size(gram: DataFrame) -> DataFrame:
    """(corte, fund_type, total_variance, squared_norm) of the covariance matrix: its trace and the sum of its squares."""
    twice = F.when(F.col("i") == F.col("j"), 1).otherwise(2)
    return gram.groupBy(*_FUND).agg(
        F.sum(F.when(F.col("i") == F.col("j"), F.col("g"))).alias("total_variance"), F.sum(twice * F.col("g") * F.col("g")).alias("squared_norm")
    )


def leading_components(gram: DataFrame, k: int = 5) -> dict[tuple, list[tuple[float, np.ndarray]]]:
    """Per (corte, fund_type) the ``k`` largest variances along one direction, each with its weight of every date.

    The eigenvectors of the Gram matrix, days^2 / 2 numbers per fund, are taken in the driver.
    """
    found: dict[tuple, dict] = {}
    for row in gram.collect():  # bounded by the dates, not by the assets
        found.setdefault((row["corte"], row["fund_type"]), {})[row["i"], row["j"]] = row["g"] or 0.0
    out = {}
    for fund, cells in found.items():
        matrix = np.zeros((1 + max(j for _, j in cells),) * 2)
        for (i, j), g in cells.items():
            matrix[i, j] = matrix[j, i] = g
        values, directions = np.linalg.eigh(matrix)
        out[fund] = [(max(0.0, float(values[-n])), directions[:, -n]) for n in range(1, min(k, len(values)) + 1)]
    return out


def component_loadings(vectors: DataFrame, components: dict[tuple, list[tuple[float, np.ndarray]]]) -> DataFrame:
    """(corte, fund_type, asset_key, component, loading): an asset's covariance is the sum of products of its loadings.

    Exact with all components, the best approximation of its rank with the leading ones. Components from 1.
    """
    rows = [
        (*fund, n, [float(x) for x in direction])
        for fund, found in components.items() for n, (value, direction) in enumerate(found, 1)
    ]
    table = vectors.sparkSession.createDataFrame(rows, "corte date, fund_type string, component int, direction array<double>")
    product = F.aggregate(F.zip_with("vector", "direction", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return splittable_join(vectors, table, _FUND).select(
        *_FUND, "asset_key", "component", F.when(F.col("days") > 1, product / F.sqrt(F.col("days") - 1)).alias("loading")
    )
