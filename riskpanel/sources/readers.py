"""Sources: the panel (JDBC or Parquet), staging, snapshots by cutoff, calendar, parameters."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel import schemas
from riskpanel.config import as_date


@dataclass(frozen=True)
class SourceConfig:
    """Where the source panel lives: either a Parquet ``path`` or a JDBC ``url``."""

    path: str | None = None
    url: str | None = None
    table: str = "consolidated_returns"
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetchsize: int = 50_000
    num_partitions: int = 64
    # SQL of the database for a bucket number from 0 of a row, with {n} for the number of buckets, for
    # example "MOD(ABS(HASHTEXT(nemotecnico)), {n})". Splits each day over several connections.
    bucket_sql: str | None = None
    buckets: int = 8
    allow_unreadable: bool = False  # read values of the wrong type as null, and count them in the load

    def __post_init__(self) -> None:
        if (self.path is None) == (self.url is None):
            raise ValueError("give either path or url")


def _connection(source: SourceConfig) -> dict[str, str]:
    options = {
        "url": source.url,
        "user": source.user,
        "password": source.password,
        "driver": source.driver,
        "fetchsize": str(source.fetchsize),
    }
    return {name: value for name, value in options.items() if value is not None}


def jdbc_options(source: SourceConfig, start: date, end: date) -> dict[str, str]:
    """Parallel range scan over the observation date, at most one partition per day."""
    days = (end - start).days + 1
    return {
        **_connection(source),
        "dbtable": source.table,
        "partitionColumn": "fecha",
        "lowerBound": start.isoformat(),
        "upperBound": (end + timedelta(days=1)).isoformat(),
        "numPartitions": str(max(1, min(source.num_partitions, days))),
    }


def jdbc_predicates(source: SourceConfig, start: date, end: date) -> list[str]:
    """One condition per day and bucket of instruments: each is a task and a connection of its own."""
    buckets = [f"{source.bucket_sql.format(n=source.buckets)} = {b}" for b in range(source.buckets)]
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    return [f"fecha = DATE '{day.isoformat()}' AND {bucket}" for day in days for bucket in buckets]


def max_date(df: DataFrame, column: str) -> date:
    """Latest date of a column; an error when there is none."""
    latest = df.agg(F.max(F.to_date(column)).alias("latest")).first()["latest"]
    if latest is None:
        raise ValueError(f"no data: {column} has no value")
    return as_date(latest)


def source_max_date(spark: SparkSession, source: SourceConfig) -> date:
    if source.path is not None:
        return max_date(spark.read.parquet(source.path), "fecha")
    # The maximum is taken by the database, so one row crosses the wire.
    query = f"SELECT MAX(fecha) AS fecha FROM {source.table}"
    return max_date(spark.read.format("jdbc").options(**_connection(source), query=query).load(), "fecha")


def read_source(
    spark: SparkSession, source: SourceConfig, start: date, end: date, unreadable: Observation | None = None
) -> DataFrame:
    """The panel columns of the closed interval [start, end]; both filters reach the source.

    Where the source allows unreadable values, ``unreadable`` counts them as the rows pass.
    """
    start, end = as_date(start), as_date(end)
    if source.path is not None:
        rows = spark.read.parquet(source.path)
    elif source.bucket_sql is not None:
        connection = _connection(source)
        rows = spark.read.jdbc(
            connection.pop("url"), source.table, predicates=jdbc_predicates(source, start, end), properties=connection
        )
    else:
        rows = spark.read.format("jdbc").options(**jdbc_options(source, start, end)).load()
    rows = rows.filter(F.col("fecha").between(F.lit(start), F.lit(end)))
    if source.allow_unreadable and unreadable is not None:
        rows = rows.observe(unreadable, F.sum(schemas.unreadable_values(rows, schemas.PANEL)).alias("values"))
    return schemas.conform(rows, schemas.PANEL, source.allow_unreadable)


def read_panel(
    spark: SparkSession, path: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Staged panel, reading only the day partitions of [start, end]."""
    df = spark.read.schema(schemas.STAGING).parquet(path)
    month = F.col("year") * 12 + F.col("month")
    if start is not None:
        start = as_date(start)
        df = df.filter((month >= start.year * 12 + start.month) & (F.col("fecha") >= F.lit(start)))
    if end is not None:
        end = as_date(end)
        df = df.filter((month <= end.year * 12 + end.month) & (F.col("fecha") <= F.lit(end)))
    return df.select(*schemas.PANEL.fieldNames())


def staging_watermark(spark: SparkSession, path: str) -> date | None:
    """Latest staged date. None only when nothing is staged; any other failure is raised."""
    try:
        staged = spark.read.schema(schemas.STAGING).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # Partition values come first and need no column data; then one month is read.
    newest = staged.agg(F.max(F.col("year") * 12 + F.col("month")).alias("month")).first()["month"]
    if newest is None:
        return None
    in_newest = staged.filter(F.col("year") * 12 + F.col("month") == newest)
    return in_newest.agg(F.max("fecha").alias("latest")).first()["latest"]


def read_snapshot(
    spark: SparkSession, root: str, corte: date | str, schema: T.StructType | None = None
) -> DataFrame:
    """One cutoff of a snapshot table; the partition filter prunes every other cutoff."""
    reader = spark.read
    if schema is not None:
        fields = [f for f in schema.fields if f.name != "corte"]
        reader = reader.schema(T.StructType([*fields, T.StructField("corte", T.DateType())]))
    return reader.parquet(root).filter(F.col("corte") == F.lit(as_date(corte)))


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CALENDAR).parquet(path)


def read_alt_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ALT_PARAMS).parquet(path)
