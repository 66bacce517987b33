"""Which days of a panel differ from what was processed before: order-independent digests per day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel import schemas
from riskpanel.config import MAX_HISTORY_DAYS


def day_digests(panel: DataFrame) -> DataFrame:
    """(fecha, rows, digest, total): digests of each day's rows, whatever their order and files.

    Two digests of 64 bits, one by exclusive or and one by sum, so that pairs of equal rows leave a trace as well. Combined
    before the shuffle: a day costs one row per task.
    """
    row = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in schemas.PANEL.fieldNames()])
    return panel.groupBy("fecha").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(row).alias("digest"),
        F.sum(F.shiftrightunsigned(row, 40)).alias("total"),
    )


def changed_days(before: DataFrame, now: DataFrame) -> list[date]:
    """The days on which two tables of digests differ, in order; also days that only one of them has.

    At most MAX_HISTORY_DAYS; more are an error.
    """
    both = before.select("fecha", F.lit(1).alias("side"), "rows", "digest", "total").unionByName(
        now.select("fecha", F.lit(2).alias("side"), "rows", "digest", "total")
    )
    seen = both.groupBy("fecha").agg(
        F.sum("side").alias("sides"), F.count_distinct("rows", "digest", "total").alias("states")
    )
    found = seen.filter("sides <> 3 OR states > 1").select("fecha").limit(MAX_HISTORY_DAYS + 1).collect()
    if len(found) > MAX_HISTORY_DAYS:
        raise ValueError(f"more than {MAX_HISTORY_DAYS} days changed")
    return sorted(row["fecha"] for row in found)
