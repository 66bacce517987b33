"""Spark session for local runs. A cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that driver and executors share: the one the session names.

    Where it names none, the warehouse, which they share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def local_session(name: str, cores: int | None = None, scratch: str | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
