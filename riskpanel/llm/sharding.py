"""Shards by jump consistent hashing: a key's jumps over shard counts follow from the key alone.

A key jumps to ever higher shards as shards are appended; its shard is the last jump below
the number of shards. Appending a shard therefore moves only the keys that jump into it,
about one in (shards + 1), and no ring or table of shards exists anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import stored


def jumps(key: str, shards: int) -> Column:
    """struct(at, next): the last jump of ``key`` below ``shards`` and the one after it.

    The random stream of the jumps is the 64-bit hash of key and current shard, so it depends on the key only.
    Jumps strictly grow, so as many steps as shards always suffice; further steps change nothing.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    jump = f"CAST(floor((s.next + 1) * 2147483648D / (shiftrightunsigned(xxhash64({key}, s.next), 33) + 1)) AS BIGINT)"
    return F.expr(
        f"aggregate(sequence(1, {shards}), struct(0L AS at, 0L AS next), (s, i) -> "
        f"struct(CASE WHEN s.next < {shards} THEN s.next ELSE s.at END AS at, "
        f"CASE WHEN s.next < {shards} THEN {jump} ELSE s.next END AS next))"
    )


def assign_shards(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` with ``shard`` and ``grown_shard``, the shard if one more were appended. Narrow: no shuffle.

    A null key is a key like any other; equal keys share a shard.
    """
    return (
        docs.withColumn("_jump", jumps("doc_id", shards))
        .withColumn("shard", F.col("_jump.at").cast("int"))
        .withColumn("grown_shard", F.when(F.col("_jump.next") == shards, shards).otherwise(F.col("shard")).cast("int"))
        .drop("_jump")
    )


def shard_documents(docs: DataFrame, shards: int = 16, rows_per_task: int = 250_000) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots follow (doc_id, text_crc32, size) within a shard, null ids first. Rows are sorted by range into
    tasks of bounded size, numbered within the task, and shifted by what earlier tasks hold of the shard, so
    neither a shard nor a repeated row has to fit one task. Null text: size 1, checksum 0. No row: no row.
    Only doc_id and text are read, so other columns cannot clash.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = assign_shards(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("_row"),  # deals even equal rows to different tasks
        ),
        shards,
    )
    keyed = stored(keyed, "keyed")
    tasks = max(1, -(-keyed.count() // rows_per_task))
    order = ["shard", "doc_id", "text_crc32", "size", "_row"]
    numbered = stored(
        keyed.repartitionByRange(max(tasks, keyed.sparkSession.sparkContext.defaultParallelism), *order)
        .sortWithinPartitions(*order)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "numbered",
    )
    held = numbered.groupBy("shard", "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = held.select(
        "shard", "_task", (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    return numbered.join(shift, ["shard", "_task"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_at") + F.col("_shift")).alias("slot"), "grown_shard",
    )
