"""The twelve result tables and four views, as lazy frames over stored base returns."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from riskpanel import schemas
from riskpanel.config import RiskConfig
from riskpanel.operators import metrics, returns, weights


def result_tables(
    base: DataFrame, cfg: RiskConfig, keep: Callable[[str, DataFrame], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Every result table of a run, in the order they build on each other.

    ``keep(name, df)`` may store a table and return it as read back; what follows then
    starts from the stored table instead of computing it again.
    """
    plain, bare = cfg.with_(derivatives=True), cfg.with_(derivatives=False)
    tables: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        df = schemas.conform(df, schemas.TABLES[name])
        tables[name] = keep(name, df) if keep else df
        return tables[name]

    base = add("te_retornos_base", base)
    add("te_pesos_base", weights.base_weights(base))
    comparables = add("te_retornos_comparables", returns.comparable_returns(base, plain))
    sides = add("te_pesos_consolidados", weights.side_weights(base, plain))
    delta = add("te_pesos_comparables", weights.delta_weights(sides, plain))
    daily = metrics.te_daily(metrics.te_breakdown(delta, comparables))
    daily = add("te_exante_diario", metrics.latest_dates(daily, cfg.window_days))
    summary = add("te_exante_resumen", metrics.tracking_error(daily, plain))
    add("te_var_exante_resumen", metrics.var_from_te(summary))
    add("te_beta_exante_resumen", metrics.beta(metrics.side_series(base, plain), plain))

    comparables = add("te_retornos_comparables_sin_derivados", returns.comparable_returns(base, bare))
    delta = add(
        "te_pesos_comparables_sin_derivados", weights.delta_weights(weights.side_weights(base, bare), bare)
    )
    daily = metrics.te_daily(metrics.te_breakdown(delta, comparables))
    add("te_var_exante_resumen_sin_derivados", metrics.var_from_te(metrics.tracking_error(daily, bare)))
    return tables


def result_views(tables: Mapping[str, DataFrame], cfg: RiskConfig) -> dict[str, DataFrame]:
    """Views over stored result tables; each keeps the cutoffs apart."""
    bare = cfg.with_(derivatives=False)
    daily_bare = metrics.te_daily(
        metrics.te_breakdown(
            tables["te_pesos_comparables_sin_derivados"], tables["te_retornos_comparables_sin_derivados"]
        )
    )
    return {
        "v_te_exante_resumen_sin_derivados": metrics.tracking_error(daily_bare, bare),
        "v_te_exante_diario_sin_derivados": metrics.latest_dates(daily_bare, cfg.window_days),
        "v_te_beta_exante_resumen_sin_derivados": metrics.beta(
            metrics.side_series(tables["te_retornos_base"], bare), bare
        ),
        "v_te_desglose": metrics.te_breakdown(tables["te_pesos_comparables"], tables["te_retornos_comparables"]),
    }


def register_views(tables: Mapping[str, DataFrame], cfg: RiskConfig) -> list[str]:
    """Make result tables and views available to SQL under their names."""
    frames = {**tables, **result_views(tables, cfg)}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
