"""The return panel derived from the benchmark tables, and its stored snapshots.

Each (application, data folder) pair derives the panel once and keeps it as a table on the
shared folder of the session, the way a daily run keeps its staging and its snapshots.
"""

from __future__ import annotations

from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel import schemas
from riskpanel.config import RiskConfig
from riskpanel.functions import norm
from riskpanel.operators.history import active_keys, active_universe, exclude_non_modelable, real_history, with_corte
from riskpanel.operators.imputation import complete_history
from riskpanel.operators.returns import base_returns, select_class
from riskpanel.plans import result_tables
from riskpanel.session import shared_folder
from riskpanel.sources import read_snapshot, write_snapshot

CUTOFF = "2001-09-17"
CONFIG = RiskConfig(CUTOFF)

# Fixed values of the panel mapping.
SESSIONS = 260
FIRST_SESSION = "DATE'2001-01-01'"
ROWS_PER_TASK = 400_000  # of the panel, where it is formed and written
SESSION_DATE = f"date_add({FIRST_SESSION}, datediff(to_date(l_shipdate), DATE'1995-01-01') % {SESSIONS})"


def derive_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return panel at grain (fecha, nemotecnico, tipo_fondo, afp) from the order lines."""

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    line = read("lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.expr(SESSION_DATE).alias("fecha"),
        F.expr("CASE l_returnflag WHEN 'N' THEN 'PORTFOLIO' WHEN 'A' THEN 'BENCHMARK' ELSE 'PEER' END").alias("afp"),
        F.expr("CASE WHEN l_linenumber < 7 THEN (l_discount - 0.05D) * 5 END").alias("r"),
        (F.col("l_quantity") / 50).alias("pv"),
        (F.col("l_extendedprice") / 100000).alias("pe"),
    )
    part = read("part").select(
        F.col("p_partkey").alias("l_partkey"),
        "p_type",
        F.expr("cast(replace(p_brand, 'Brand#', '') AS INT) % 8").alias("b"),
    )
    supplier = (
        read("supplier")
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), F.expr("concat('F', n_regionkey)").alias("tipo_fondo"))
    )
    # dealt out once, by two of the grouping keys and in tasks of bounded size, which also write the rows
    tasks = max(spark.sparkContext.defaultParallelism, -(-read("lineitem").count() // ROWS_PER_TASK))
    grouped = (
        line.join(part, "l_partkey")
        .join(supplier, "l_suppkey")
        .repartition(tasks, "l_partkey", "fecha")
        .groupBy("l_partkey", "p_type", "b", "fecha", "tipo_fondo", "afp")
        .agg(
            F.avg("r").alias("retorno"),
            F.sum(F.col("r") * F.col("pv")).alias("aporte_retorno"),
            F.sum("pv").alias("peso_valorizacion_economica_sub"),
            F.sum("pe").alias("peso_exposicion_economica"),
        )
    )
    currency = "CASE WHEN p_type = 'LARGE' AND b = 2 THEN 'EUR' WHEN (b % 5) % 2 = 0 THEN 'USD' ELSE 'CLP' END"
    classified = grouped.selectExpr(
        "*",
        "concat(p_type, '-', l_partkey) AS nemotecnico",
        "CASE WHEN p_type IN ('MEDIUM', 'LARGE', 'SMALL') THEN 'DER' ELSE 'NAC' END AS tipo_instr",
        "CASE p_type WHEN 'MEDIUM' THEN 'MON' WHEN 'LARGE' THEN 'SWP' WHEN 'SMALL' THEN 'FWD' "
        "WHEN 'ECONOMY' THEN 'BON' ELSE 'ACT' END AS clase",
        "CASE p_type WHEN 'MEDIUM' THEN CASE b % 3 WHEN 0 THEN 'CLP' WHEN 1 THEN 'USD' ELSE 'EUR' END "
        "WHEN 'PROMO' THEN 'ALT' WHEN 'STANDARD' THEN CASE WHEN b % 7 = 0 THEN 'CAJA' ELSE 'ACC' END "
        "ELSE 'GEN' END AS C1",
        "CASE p_type WHEN 'LARGE' THEN CASE WHEN b % 4 = 0 THEN 'INFL' ELSE 'TASA' END "
        "ELSE concat('G', least(b % 5, 3)) END AS C2",
        f"{currency} AS C3",
        "CASE b WHEN 5 THEN 'B9' WHEN 3 THEN NULL ELSE concat('B', b % 5) END AS C4",
        "CASE WHEN b = 7 OR l_partkey % 4 = 0 THEN '3Y' WHEN b % 5 = 0 THEN '0.0' WHEN b % 5 = 1 THEN '0Y' WHEN b % 5 = 2 THEN '2Y' "
        "WHEN b % 5 = 3 THEN '5.0' ELSE '10' END AS C5",
        f"{currency} AS moneda",
    )
    return schemas.conform(classified, schemas.PANEL)


def derive_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per session of the order lines; every fortieth is a holiday."""
    sessions = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.expr(SESSION_DATE).alias("fecha")).distinct()
    return sessions.withColumn("es_habil", F.expr(f"datediff(fecha, {FIRST_SESSION}) % 40 <> 0"))


def derive_alt_params(panel: DataFrame) -> DataFrame:
    """One parameter per manager, fund, region and type of alternatives; one group is left out."""
    groups = (
        select_class(panel, "ALT")
        .select(norm("afp").alias("manager"), F.col("tipo_fondo").alias("fund_type"),
                F.col("C2").alias("region"), F.col("C3").alias("asset_type"))
        .distinct()
        .filter("NOT (manager = 'PEER' AND fund_type = 'F0' AND region = 'G0')")
    )
    param = F.expr("CAST(0.0001 * (1 + CAST(substr(fund_type, 2) AS INT)) AS DECIMAL(10,6))")
    return groups.withColumn("return_param", param)


class Inputs:
    """Stored inputs of the queries for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = f"{shared_folder(spark)}/riskpanel-{uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _stored(self, name: str, df: DataFrame, schema, cluster_by=("fecha",), dealt=False) -> DataFrame:
        write_snapshot(df, self.path(name), CUTOFF, cluster_by, dealt)
        return read_snapshot(self.spark, self.path(name), CUTOFF, schema)

    def _stored_tables(self, base: DataFrame, folder: str) -> dict[str, DataFrame]:
        def keep(name: str, df: DataFrame) -> DataFrame:
            return self._stored(f"{folder}/{name}", df, schemas.TABLES[name], [])

        return result_tables(base, CONFIG, keep)

    @cached_property
    def panel(self) -> DataFrame:
        return self._stored("panel", derive_panel(self.spark, self.sf_dir), schemas.PANEL, dealt=True)

    @cached_property
    def calendar(self) -> DataFrame:
        return self._stored("calendar", derive_calendar(self.spark, self.sf_dir), schemas.CALENDAR)

    @cached_property
    def real(self) -> DataFrame:
        fields = [f for f in schemas.PANEL.fields if f.name in schemas.INSTRUMENT_KEY]
        active = self._stored("output_active", active_keys(self.panel, CUTOFF), T.StructType(fields), []).drop("corte")
        return self._stored("output_real", real_history(self.panel, CUTOFF, active), schemas.REAL_HISTORY)

    @cached_property
    def universe(self) -> DataFrame:
        fields = [f for f in schemas.PANEL.fields if f.name in schemas.UNIVERSE]
        universe = active_universe(self.real, CUTOFF)
        return self._stored("output_universe", universe, T.StructType(fields), []).drop("corte")

    @cached_property
    def completed(self) -> DataFrame:
        completed = complete_history(self.real, self.calendar, CUTOFF, universe=self.universe)
        return self._stored("output_final", completed, schemas.COMPLETED, [], dealt=True)

    @cached_property
    def base(self) -> DataFrame:
        """Base returns of the completed history."""
        base = base_returns(self.completed, CONFIG)
        return self._stored("te_retornos_base", base, schemas.TABLES["te_retornos_base"])

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        """The result tables of the completed history."""
        return self._stored_tables(self.base, "results")

    @cached_property
    def observed_tables(self) -> dict[str, DataFrame]:
        """The result tables of the observed returns alone."""
        return self._stored_tables(base_returns(self.panel, CONFIG), "observed_results")

    @property
    def alt_params(self) -> DataFrame:
        return derive_alt_params(self.panel)

    @property
    def modelable(self) -> DataFrame:
        """Observed rows with their cutoff, before any completion."""
        return with_corte(exclude_non_modelable(self.panel), CUTOFF)


_inputs: dict[tuple[str, str], Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    if key not in _inputs:
        _inputs[key] = Inputs(spark, key[1])
    return _inputs[key]
