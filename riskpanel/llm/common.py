"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

from riskpanel.session import shared_folder

# Fixed value: what separates words, as a Java class. Everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]"

#: A side whose rows take at most so many bytes may be broadcast.
BROADCAST_BYTES = 64_000_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor repeats tasks, not earlier steps."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Null ids rank last.
LAST_ID = (1 << 63) - 1


def document_keys(*also: Column) -> tuple[Column, Column]:
    """(id, twin) of a row with doc_id and text, never null: null ids differ from all others by the lowest bit of ``twin``.

    ``twin`` tells texts of one id apart, and what else is given.
    """
    unnamed = F.col("doc_id").isNull()
    twin = F.xxhash64(F.col("text"), *also).bitwiseAND(F.lit(-2)).bitwiseOR(unnamed.cast("bigint"))
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)), twin


def release() -> None:
    """Give memory that was freed back to the system, where the C library can: a worker outlives its tasks and the stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """``run`` for mapInArrow, without what earlier tasks of the worker left, and without leaving anything itself."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def text_slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose texts have about ``size`` bytes; a longer text has one to itself or ends one."""
    length = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = (np.cumsum(length) - length) // size
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def value_bytes(column: Column, kind: DataType) -> Column:
    """About what a value takes in memory."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, ArrayType):
        one = F.transform(column, lambda x: value_bytes(x, kind.elementType))
        return F.coalesce(F.aggregate(one, F.lit(16).cast("bigint"), lambda a, b: a + b), F.lit(16).cast("bigint"))
    if isinstance(kind, StructType):
        return sum((value_bytes(column.getField(f.name), f.dataType) for f in kind.fields), F.lit(16).cast("bigint"))
    return F.lit(8).cast("bigint")


def join_small(large: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which ``small`` (stored, so cheap to measure) is broadcast if its rows take little enough memory.

    Beyond that bound both sides are shuffled; adaptive execution splits hot keys.
    """
    row = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in small.schema.fields), F.lit(16).cast("bigint"))
    if (small.agg(F.sum(row)).first()[0] or 0) <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return large.join(small, keys, how)
