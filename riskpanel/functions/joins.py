"""Joins whose larger side may be dominated by one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that adaptive execution can split by key, whatever ``right`` is made of.

    A side that was aggregated by the join keys is joined without another exchange, and a
    join is only split between two exchanges. The hash of the keys as one more join key asks
    for that exchange; it also leads the sort order, so text keys are hardly compared.
    """
    hashed = F.xxhash64(*keys).alias("_hash")
    joined = left.select("*", hashed).join(right.select("*", hashed), ["_hash", *keys], how)
    return joined.drop("_hash")
