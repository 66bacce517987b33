"""Result columns of every registered query, for both engines.

One letter per column: d date, s text, i whole number, f decimal number. Dates become text
and decimals are rounded to nine significant digits, or to 15 places where that is coarser, so
that two engines can be compared value by value at any magnitude. Before rounding, a fraction of
the last digit is added: sums of cents over power-of-two quantities often lie exactly between
two roundings, where summation order would decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHIFTED = "({0} * CAST(1.00000000012345678 AS DOUBLE))"
POWER = "pow(10, least(15, 8 - floor(log10(abs({0})))))"

_KEY = "corte:d fund_type:s"
_CLASSIFICATION = "tipo_instr:s tipo_fondo:s clase:s afp:s C1:s C2:s C3:s C4:s C5:s"
_UNIVERSE = f"nemotecnico:s {_CLASSIFICATION}"
_MEASURES = "retorno:f aporte_retorno:f peso_valorizacion_economica_sub:f peso_exposicion_economica:f"
_PANEL = f"fecha:d {_UNIVERSE} moneda:s {_MEASURES}"
_BASE = (
    "corte:d fecha:d manager:s fund_type:s asset_key:s key_type:s asset_class:s c1:s c2:s c3:s c5:s return_calc:f "
    "weight_calc:f contribution_calc:f source_record_count:i observation_status:s imputation_method:s"
)
_COMPARABLE = (
    f"{_KEY} fecha:d asset_key:s key_type:s asset_class:s return_calc:f observation_status:s imputation_method:s"
)
_BASE_WEIGHT = (
    "corte:d manager:s fund_type:s asset_key:s key_type:s asset_class:s base_weight:f c1:s c2:s c3:s c5:s"
)
_SIDE_WEIGHT = f"{_KEY} asset_key:s key_type:s asset_class:s side:s side_weight:f"
_DELTA = (
    f"{_KEY} comparable_key:s key_type:s asset_class:s portfolio_weight:f benchmark_weight:f delta_weight:f "
    "exists_portfolio:i exists_benchmark:i zero_filled_portfolio:i"
)
_DAILY = f"{_KEY} fecha:d r_diff:f"
_BREAKDOWN = f"{_KEY} fecha:d asset_key:s delta_weight:f return_calc:f contribution:f"
_TE = f"{_KEY} days:i avg_active_return:f daily_tracking_error:f te_ex_ante:f"
_SERIES = f"{_KEY} fecha:d r_portfolio:f r_benchmark:f"
_BETA = (
    f"{_KEY} days:i avg_r_portfolio:f avg_r_benchmark:f vol_portfolio_approx:f vol_benchmark_approx:f beta_ex_ante:f"
)
_VAR = f"{_KEY} portfolio_variance:f sigma_p:f var_95_1d:f var_95_252d:f"

COLUMNS: dict[str, str] = {
    # sources and sinks
    "incremental_extract": f"{_PANEL} year:i month:i",
    "staging_idempotent": "year:i month:i total:i dates:i sum_exposure:f",
    "staging_reconcile": "fecha:d total:i sum_size:f sum_exposure:f",
    "snapshot_read": f"corte:d {_PANEL}",
    "snapshot_replace": "corte:d tipo_fondo:s total:i",
    "audit_counts": "table:s total:i",
    # history
    "exclude_non_modelable": _PANEL,
    "active_universe": _UNIVERSE,
    "real_history": f"corte:d {_PANEL}",
    "business_days": "fecha:d",
    "history_matrix": f"fecha:d {_UNIVERSE}",
    # completion
    "match_real": f"fecha:d {_UNIVERSE} {_MEASURES} tiene_real:i",
    "hierarchy_means": f"fecha:d {_CLASSIFICATION} level:i mean_return:f",
    "impute_hierarchy": f"fecha:d {_UNIVERSE} {_MEASURES} retorno_imputado:f jerarquia_usada:i",
    "return_origin": f"fecha:d {_UNIVERSE} retorno:f origen_completado:s",
    "special_rules": f"{_PANEL}",
    "complete_history": f"fecha:d {_UNIVERSE} {_MEASURES} origen_completado:s jerarquia_usada:i",
    "complete_history_incremental": f"fecha:d {_UNIVERSE} {_MEASURES} origen_completado:s jerarquia_usada:i",
    "imputation_support": f"fecha:d {_UNIVERSE} retorno:f jerarquia_usada:i peers:i lowest:f highest:f",
    "imputation_coverage": "origen_completado:s jerarquia_usada:i total:i",
    # base returns
    "returns_mon": _BASE,
    "returns_swp": _BASE,
    "returns_act": _BASE,
    "returns_alt": _BASE,
    "returns_swp_other": _BASE,
    "returns_other": _BASE,
    "base_returns": _BASE,
    "base_returns_spec": _BASE,
    "base_returns_completed": _BASE,
    "base_returns_imputed": _BASE,
    # comparables and weights
    "comparable_returns": _COMPARABLE,
    "comparable_returns_market": _COMPARABLE,
    "comparable_returns_no_deriv": _COMPARABLE,
    "base_weights": _BASE_WEIGHT,
    "normalized_weights": _SIDE_WEIGHT,
    "benchmark_avg_weights": _SIDE_WEIGHT,
    "delta_weights": _DELTA,
    "delta_weights_no_deriv": _DELTA,
    "delta_weights_avg": _DELTA,
    # tracking error
    "te_breakdown": _BREAKDOWN,
    "te_daily": _DAILY,
    "te_daily_no_deriv": _DAILY,
    "rolling_window_te": _DAILY,
    "te_summary": _TE,
    "te_summary_no_deriv": _TE,
    "te_summary_real": _TE,
    "te_summary_spec": _TE,
    "te_summary_market_avg": _TE,
    "te_summary_market_no_deriv": _TE,
    # beta
    "side_series": _SERIES,
    "beta_summary": _BETA,
    "beta_summary_no_deriv": _BETA,
    "beta_summary_normalized": _BETA,
    "beta_summary_avg": _BETA,
    "beta_summary_real": _BETA,
    "beta_summary_separate": _BETA,
    # value at risk
    "var_summary": _VAR,
    "var_summary_no_deriv": _VAR,
    "var_covariance": _VAR,
    "var_covariance_no_deriv": _VAR,
    "covariance_product": f"{_KEY} asset_key:s gross_weight:f cov_with_portfolio:f variance_share:f",
    "covariance_pairs": f"{_KEY} asset_i:s asset_j:s cov:f",
    "covariance_size": f"{_KEY} total_variance:f squared_norm:f",
    # every date as a cutoff
    "risk_history": (
        f"{_KEY} days:i avg_active_return:f daily_tracking_error:f te_ex_ante:f var_95_1d:f var_95_252d:f beta_days:i "
        "beta_ex_ante:f"
    ),
    # report and quality
    "risk_report": (
        f"{_KEY} te_with_derivatives:f te_without_derivatives:f var_95_1d:f var_95_1d_covariance:f beta_ex_ante:f"
    ),
    "qc_weights_portfolio": f"{_KEY} sum_weight:f",
    "qc_weights_benchmark": f"{_KEY} sum_weight:f",
    "qc_delta_sum": f"{_KEY} sum_delta:f",
    "qc_swp_zero": "corte:d fecha:d manager:s fund_type:s asset_key:s return_calc:f",
    "qc_cap": "violations:i",
    "qc_window_days": f"{_KEY} days:i",
    "qc_te_range": f"{_KEY} te_ex_ante:f",
    "qc_beta_range": f"{_KEY} beta_ex_ante:f",
    "qc_var_positive": f"{_KEY} var_95_1d:f",
    "qc_summary": "rule:s violations:i",
}
# Each check over disturbed tables, where it must find something.
FOUND = [key for key in COLUMNS if key.startswith("qc_") and key not in ("qc_te_range", "qc_beta_range")]
COLUMNS |= {f"{key}_found": COLUMNS[key] for key in FOUND}
# The stored daily run and its views.
COLUMNS |= {
    "daily_run": "table:s total:i checksum:f",
    "daily_run_spec": "table:s total:i checksum:f",
    "view_te_no_deriv": _TE,
    "view_te_daily_no_deriv": _DAILY,
    "view_beta_no_deriv": _BETA,
    "view_breakdown": _BREAKDOWN,
}


def _parsed(key: str) -> list[tuple[str, str]]:
    return [tuple(column.split(":")) for column in COLUMNS[key].split()]


def _significant(value: str, round_name: str) -> str:
    """SQL of either engine for ``value`` at nine significant digits."""
    x = SHIFTED.format(value)
    power = POWER.format(x)
    return f"CASE WHEN abs({x}) < 5e-16 THEN CAST(0 AS DOUBLE) ELSE {round_name}({x} * {power}) / {power} END"


def present(key: str, df: DataFrame) -> DataFrame:
    """The registered columns of ``df`` in comparable form."""

    def shown(name: str, kind: str) -> Column:
        if kind == "f":
            return F.expr(_significant(f"CAST(`{name}` AS DOUBLE)", "rint")).alias(name)
        return F.col(name).cast("bigint" if kind == "i" else "string").alias(name)

    return df.select(*[shown(name, kind) for name, kind in _parsed(key)])


def present_sql(key: str, body: str) -> str:
    """The same columns over the SQL relation ``body``."""

    def shown(name: str, kind: str) -> str:
        if kind == "f":
            return f'{_significant(f'CAST("{name}" AS DOUBLE)', "round")} AS "{name}"'
        return f'CAST("{name}" AS {"BIGINT" if kind == "i" else "VARCHAR"}) AS "{name}"'

    columns = ",\n       ".join(shown(name, kind) for name, kind in _parsed(key))
    return f"SELECT {columns}\nFROM ({body}) AS result"
