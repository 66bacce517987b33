"""Sinks. Every write replaces what it covers, so a repeated run leaves the same table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskpanel.config import as_date


def _clustered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a key near each other, in files of an even size.

    A rebalance lets adaptive execution split a hot key over several tasks and merge
    small ones; the sort gives each row group a narrow range of the key, which later
    filters on it skip by.
    """
    return df.hint("rebalance", *by).sortWithinPartitions(*by)


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df``."""
    (
        _clustered(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def replace_by_key(
    df: DataFrame, table: str, key: str, value: date | str, cluster_by: Sequence[str] = (), dealt: bool = False
) -> None:
    """Replace the rows of one key value: the directory ``table/key=value``.

    ``dealt``: the rows lie evenly over tasks already and are written, sorted, by the tasks that hold them.

    Written as a partition that is exchanged when the job commits: until then, and after a failed job, the old
    rows stay. An exchange with no rows would keep the old ones too, so an empty result, known
    only once it is written, is followed by clearing the directory.
    """
    rows = df.drop(key)
    schema = rows.schema
    written = Observation()
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    if dealt:
        rows = rows.sortWithinPartitions(*cluster_by) if cluster_by else rows
    else:
        rows = _clustered(rows, cluster_by) if cluster_by else rows.hint("rebalance")
    (
        rows.withColumn(key, F.lit(str(value)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(table.rstrip("/"))
    )
    if not _observed_rows(written):
        nothing = df.sparkSession.createDataFrame([], schema)
        nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
            f"{table.rstrip('/')}/{key}={value}"
        )


def _observed_rows(written: Observation) -> int:
    """Rows counted on the way; none where the optimiser saw an empty result and dropped the count with it."""
    try:
        return written.get["rows"]
    except Py4JJavaError:
        return 0


def delete_statement(table: str, keys: Mapping[str, date | str]) -> str:
    """SQL that clears the rows of the given key values in a warehouse table before they are appended again."""
    conditions = [
        f"{name} = DATE '{value.isoformat()}'" if isinstance(value, date) else f"{name} = '" + value.replace("'", "''") + "'"
        for name, value in keys.items()
    ]
    return f"DELETE FROM {table} WHERE {' AND '.join(conditions)}"


def warehouse_options(
    url: str, table: str, driver: str | None = None, user: str | None = None, password: str | None = None,
    batchsize: int = 50_000, num_partitions: int = 16,
) -> dict[str, str]:
    """Options of the JDBC writer that appends the new rows, with at most ``num_partitions`` connections."""
    options = {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password,
               "batchsize": str(batchsize), "numPartitions": str(num_partitions)}
    return {name: value for name, value in options.items() if value is not None}


def write_snapshot(
    df: DataFrame, root: str, corte: date | str, cluster_by: Sequence[str] = (), dealt: bool = False
) -> None:
    """Replace one cutoff of a snapshot table."""
    replace_by_key(df, root, "corte", as_date(corte).isoformat(), cluster_by, dealt)


def audit_counts(tables: Mapping[str, DataFrame], corte: date | str) -> DataFrame:
    """Rows per table at a cutoff, as (table, total)."""
    counts = [
        df.filter(F.col("corte") == F.lit(as_date(corte))).agg(F.count("*").alias("total"))
        .select(F.lit(name).alias("table"), "total")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
