"""Small frames with every awkward case, and helpers."""

from __future__ import annotations

import os
import random

import duckdb
from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ", size string, n_words string, twin string, component string, shared string, copies string, doc string"


def prose(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def text(seed: int, n: int) -> str:
    return " ".join(prose(seed, n))


LONG = text(99, 30_000)
REPEATED = text(1, 80) + "\n" + text(2, 30)

EDGES = [
    (1, REPEATED, "en", "a", 10),
    (1, REPEATED, "en", "a", 10),  # a repeated row
    (2, REPEATED, None, "a", None),  # a copy
    (3, text(1, 80).upper() + "\n" + text(3, 90), "de", "b", 10),  # shares a line, in upper case
    (4, None, "en", None, None),
    (5, "", "en", "b", 0),
    (6, " \n\t\x0b", None, None, 4),
    (7, "one two", "fr", "b", 7),
    (8, LONG, "en", "c", len(LONG)),
    (None, text(1, 80), "en", "c", 5),  # no id
    (None, None, None, None, None),
    (9, "é日本 #$ |x| \n" * 20, "xx", "ß", 10),
]


def edge_docs(spark: SparkSession) -> DataFrame:
    """The awkward documents with extra columns whose names the operators use themselves."""
    rows = [(*row, *["clash"] * 7) for row in EDGES]
    return spark.createDataFrame(rows, COLUMNS + CLASHES).repartition(3)


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], COLUMNS + CLASHES)


def docs_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text[, source[, lang]])"""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, COLUMNS)


def labels_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, quality int, toxic int")


def rows_of(sf_dir: str, sql: str) -> list[tuple]:
    with duckdb.connect() as connection:
        for name in os.listdir(sf_dir):
            connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
        return connection.execute(sql).fetchall()
