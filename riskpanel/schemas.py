"""Explicit schemas of every table, and projection of a frame onto one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INSTRUMENT_KEY = ["nemotecnico", "tipo_fondo", "afp"]
PANEL_KEY = ["fecha", *INSTRUMENT_KEY]
MEASURES = [
    "retorno",
    "aporte_retorno",
    "peso_valorizacion_economica_sub",
    "peso_exposicion_economica",
]

# Classification path of an instrument, most general column first. Level 1 of the
# equivalence hierarchy uses all nine, level 9 only the first.
HIERARCHY = ["tipo_instr", "tipo_fondo", "clase", "afp", "C1", "C2", "C3", "C4", "C5"]
UNIVERSE = ["nemotecnico", *HIERARCHY]


_TYPES = {
    "DATE": T.DateType(),
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
    "PARAMETER": T.DecimalType(10, 6),
}


def _schema(spec: str) -> T.StructType:
    """Schema from "name TYPE, ..." (the DDL parser of Spark would need a running session)."""
    columns = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


PANEL = _schema(
    "fecha DATE, nemotecnico STRING, tipo_fondo STRING, tipo_instr STRING, afp STRING, clase STRING, "
    "C1 STRING, C2 STRING, C3 STRING, C4 STRING, C5 STRING, moneda STRING, aporte_retorno DOUBLE, "
    "retorno DOUBLE, peso_valorizacion_economica_sub DOUBLE, peso_exposicion_economica DOUBLE"
)
STAGING = T.StructType([*PANEL.fields, *_schema("year INT, month INT").fields])
REAL_HISTORY = T.StructType([*PANEL.fields, *_schema("corte DATE").fields])
CALENDAR = _schema("fecha DATE, es_habil BOOLEAN")
ALT_PARAMS = _schema(
    "manager STRING, fund_type STRING, region STRING, asset_type STRING, return_param PARAMETER"
)
COMPLETED = _schema(
    "fecha DATE, nemotecnico STRING, tipo_instr STRING, tipo_fondo STRING, clase STRING, afp STRING, "
    "C1 STRING, C2 STRING, C3 STRING, C4 STRING, C5 STRING, retorno DOUBLE, aporte_retorno DOUBLE, "
    "peso_valorizacion_economica_sub DOUBLE, peso_exposicion_economica DOUBLE, "
    "origen_completado STRING, jerarquia_usada INT"
)

_BASE_RETURNS = (
    "corte DATE, fecha DATE, manager STRING, fund_type STRING, asset_key STRING, key_type STRING, "
    "asset_class STRING, c1 STRING, c2 STRING, c3 STRING, c4 STRING, c5 STRING, instrument_type STRING, "
    "return_calc DOUBLE, weight_calc DOUBLE, contribution_calc DOUBLE, source_record_count BIGINT, "
    "observation_status STRING, imputation_method STRING"
)
_COMPARABLES = (
    "corte DATE, fecha DATE, fund_type STRING, asset_key STRING, key_type STRING, asset_class STRING, "
    "return_calc DOUBLE, observation_status STRING, imputation_method STRING"
)
_DELTA = (
    "corte DATE, fund_type STRING, comparable_key STRING, key_type STRING, asset_class STRING, "
    "portfolio_weight DOUBLE, benchmark_weight DOUBLE, delta_weight DOUBLE, exists_portfolio INT, "
    "exists_benchmark INT, zero_filled_portfolio INT"
)
_VAR = (
    "corte DATE, fund_type STRING, portfolio_variance DOUBLE, sigma_p DOUBLE, var_95_1d DOUBLE, "
    "var_95_252d DOUBLE"
)

# The twelve result tables.
TABLES: dict[str, T.StructType] = {
    "te_retornos_base": _schema(_BASE_RETURNS),
    "te_retornos_comparables": _schema(_COMPARABLES),
    "te_retornos_comparables_sin_derivados": _schema(_COMPARABLES),
    "te_pesos_base": _schema(
        "corte DATE, manager STRING, fund_type STRING, asset_key STRING, key_type STRING, asset_class STRING, "
        "base_weight DOUBLE, c1 STRING, c2 STRING, c3 STRING, c4 STRING, c5 STRING"
    ),
    "te_pesos_consolidados": _schema(
        "corte DATE, fund_type STRING, asset_key STRING, key_type STRING, asset_class STRING, side STRING, "
        "side_weight DOUBLE"
    ),
    "te_pesos_comparables": _schema(_DELTA),
    "te_pesos_comparables_sin_derivados": _schema(_DELTA),
    "te_exante_diario": _schema("corte DATE, fund_type STRING, fecha DATE, r_diff DOUBLE"),
    "te_exante_resumen": _schema(
        "corte DATE, fund_type STRING, days INT, avg_active_return DOUBLE, daily_tracking_error DOUBLE, "
        "te_ex_ante DOUBLE"
    ),
    "te_beta_exante_resumen": _schema(
        "corte DATE, fund_type STRING, days INT, avg_r_portfolio DOUBLE, avg_r_benchmark DOUBLE, "
        "vol_portfolio_approx DOUBLE, vol_benchmark_approx DOUBLE, beta_ex_ante DOUBLE"
    ),
    "te_var_exante_resumen": _schema(_VAR),
    "te_var_exante_resumen_sin_derivados": _schema(_VAR),
}


def _unreadable(df: DataFrame, field: T.StructField) -> Column:
    """Whether a value is there but cannot be read as the target type."""
    return F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()


def unreadable_values(df: DataFrame, schema: T.StructType) -> Column:
    """Number of values of a row that ``conform`` cannot read."""
    return sum((_unreadable(df, f).cast("int") for f in schema.fields), F.lit(0))


def conform(df: DataFrame, schema: T.StructType, allow_unreadable: bool = False) -> DataFrame:
    """Keep exactly the columns of ``schema``, in its order and types.

    A missing column is an error, and so is a value that cannot be read as the target type, once its row is
    read. With ``allow_unreadable`` such a value becomes null; it is then up to the caller to count them.
    """
    missing = [name for name in schema.fieldNames() if name.lower() not in {c.lower() for c in df.columns}]
    if missing:
        raise ValueError(f"columns not found: {missing}")

    def read(field: T.StructField) -> Column:
        given = F.col(field.name)
        if df.select(given).schema[0].dataType == field.dataType:
            return given
        value = given.try_cast(field.dataType)
        if allow_unreadable:
            return value
        message = F.concat(F.lit(f"unreadable value in {field.name}: "), given.cast("string"))
        return F.when(_unreadable(df, field), F.raise_error(message)).otherwise(value)

    return df.select(*[read(f).alias(f.name) for f in schema.fields])
