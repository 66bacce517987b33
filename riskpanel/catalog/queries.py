"""Registered queries: each runs one operator over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.catalog.columns import COLUMNS, present
from riskpanel.catalog.inputs import CONFIG, CUTOFF, Inputs, inputs
from riskpanel.operators import changes, covariance, history, imputation, incremental, metrics, quality, returns, rolling, staging, weights
from riskpanel.plans import DailyPaths, result_views, run_daily
from riskpanel.sources import SourceConfig, audit_counts, read_panel, read_snapshot, write_partitions, write_snapshot

BARE = CONFIG.with_(derivatives=False)
MARKET = CONFIG.with_(comparable_scope="market")
AVG = CONFIG.with_(benchmark_mode="AVG")
MARKET_AVG = MARKET.with_(benchmark_mode="AVG")
MARKET_BARE = MARKET.with_(derivatives=False)
SPEC = CONFIG.with_(classes="spec")
IMPUTED = CONFIG.with_(use_imputed=True)
SEPARATE = CONFIG.with_(beta_nulls="separate")
NORMALIZED = CONFIG.with_(beta_weighting="normalized")

# Settings of the staging and snapshot queries.
FIRST_LOAD_END = date(2001, 8, 14)
OTHER_CUTOFF = "2001-09-14"

# Days on which the panel of an earlier run lacked rows, had other returns, and had rows that are gone; and a day that is gone.
LATE_DAY, CORRECTED_DAY, REMOVED_DAY, DROPPED_DAY = "2001-06-15", "2001-07-03", "2001-08-02", "2001-11-30"

# One number per result table that the daily run is compared by.
CHECKSUMS = {
    "te_retornos_base": "contribution_calc",
    "te_retornos_comparables": "return_calc",
    "te_retornos_comparables_sin_derivados": "return_calc",
    "te_pesos_base": "base_weight",
    "te_pesos_consolidados": "side_weight",
    "te_pesos_comparables": "delta_weight * delta_weight",
    "te_pesos_comparables_sin_derivados": "delta_weight * delta_weight",
    "te_exante_diario": "r_diff",
    "te_exante_resumen": "te_ex_ante",
    "te_beta_exante_resumen": "beta_ex_ante",
    "te_var_exante_resumen": "var_95_1d",
    "te_var_exante_resumen_sin_derivados": "var_95_252d",
}


def _incremental_extract(i: Inputs) -> DataFrame:
    source = SourceConfig(path=_source_path(i))
    staged = i.path(f"staging-{uuid4().hex}")
    loaded = history.up_to_cutoff(i.panel, FIRST_LOAD_END).drop("corte")
    write_partitions(staging.with_partitions(loaded), staged, staging.PARTITIONS)
    start, end = staging.incremental_range(
        staging.source_max_date(i.spark, source), staging.staging_watermark(i.spark, staged)
    )
    return staging.extract_increment(i.spark, source, start, end)


def _source_path(i: Inputs) -> str:
    i.panel  # noqa: B018 - stores the panel
    return i.path("panel")


def _staging_idempotent(i: Inputs) -> DataFrame:
    """A first load, an increment from the middle of a month, and a repeat of late days."""
    first = i.path(f"first-{uuid4().hex}")
    staged = i.path(f"staging-{uuid4().hex}")
    write_snapshot(history.up_to_cutoff(i.panel, FIRST_LOAD_END), first, CUTOFF, ["fecha"])
    whole = SourceConfig(path=_source_path(i))
    staging.incremental_stage(i.spark, SourceConfig(path=first), staged, bootstrap_days=365)
    staging.incremental_stage(i.spark, whole, staged)
    staging.incremental_stage(i.spark, whole, staged, lookback_days=5)
    return (
        staging.with_partitions(read_panel(i.spark, staged))
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("total"),
            F.count_distinct("fecha").alias("dates"),
            F.sum("peso_exposicion_economica").alias("sum_exposure"),
        )
    )


def _snapshot_read(i: Inputs) -> DataFrame:
    root = i.path(f"snapshots-{uuid4().hex}")
    for corte in (OTHER_CUTOFF, CUTOFF):
        write_snapshot(history.real_history(i.panel, corte), root, corte, ["fecha"])
    return read_snapshot(i.spark, root, OTHER_CUTOFF)


def _snapshot_replace(i: Inputs) -> DataFrame:
    root = i.path(f"snapshots-{uuid4().hex}")
    for corte in (OTHER_CUTOFF, CUTOFF):
        write_snapshot(i.real, root, corte, ["fecha"])
    write_snapshot(i.real.filter("tipo_fondo = 'F3'"), root, CUTOFF, ["fecha"])
    return i.spark.read.parquet(root).groupBy("corte", "tipo_fondo").agg(F.count("*").alias("total"))


def _kept(i: Inputs, name: str, df: DataFrame) -> DataFrame:
    path = i.path(f"{name}-{uuid4().hex}")
    df.write.parquet(path)
    return i.spark.read.schema(df.schema).parquet(path)


def _panel_before(i: Inputs) -> DataFrame:
    """The panel before late rows and a correction came in, and with rows and a day that the source has dropped since."""
    now = i.panel.drop("corte")
    corrected = f"fecha = DATE'{CORRECTED_DAY}'"
    then = now.filter(f"NOT (fecha = DATE'{LATE_DAY}' AND tipo_fondo = 'F1')").withColumn(
        "retorno", F.expr(f"CASE WHEN {corrected} THEN retorno * 2 ELSE retorno END")
    )
    dropped = now.filter(f"fecha = DATE'{REMOVED_DAY}'").withColumn("nemotecnico", F.concat("nemotecnico", F.lit("-X")))
    day = dropped.withColumn("fecha", F.lit(DROPPED_DAY).cast("date"))
    return then.unionByName(dropped).unionByName(day)


def _staging_reconcile(i: Inputs) -> DataFrame:
    staged = i.path(f"staging-{uuid4().hex}")
    write_partitions(staging.with_partitions(_panel_before(i)), staged, staging.PARTITIONS)
    staging.staging_reconcile(i.spark, SourceConfig(path=_source_path(i)), staged, "2001-01-01", "2001-12-31")
    return read_panel(i.spark, staged).groupBy("fecha").agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.abs("retorno")).alias("sum_size"), F.sum("peso_exposicion_economica").alias("sum_exposure")
    )


def _completed_incrementally(i: Inputs) -> DataFrame:
    """The completed history from a run for an earlier cutoff, over the panel as it was then."""
    before = _kept(i, "panel-before", _panel_before(i))
    real = _kept(i, "real-before", history.real_history(before, OTHER_CUTOFF))
    universe = _kept(i, "universe-before", history.active_universe(real, OTHER_CUTOFF))
    completed = imputation.complete_history(real, i.calendar, OTHER_CUTOFF, universe=universe)
    previous = incremental.PreviousRun(
        _kept(i, "completed-before", completed), universe, _kept(i, "sums-before", imputation.finest_sums(real)),
        _kept(i, "digests-before", changes.day_digests(before)),
    )
    digests = _kept(i, "digests", changes.day_digests(i.panel))
    return incremental.complete_history_incremental(
        i.panel, i.calendar, CUTOFF, previous, digests, universe=i.universe
    ).completed


def _matched(i: Inputs) -> DataFrame:
    return imputation.match_real(i.universe, imputation.business_days(i.calendar, CUTOFF), i.real)


def _imputed(i: Inputs) -> DataFrame:
    return imputation.impute_hierarchy(_matched(i), imputation.hierarchy_means(i.real))


def _observed_base(i: Inputs, cfg=CONFIG) -> DataFrame:
    return returns.base_returns(i.panel, cfg, i.alt_params if cfg.classes == "spec" else None)


def _delta(base: DataFrame, cfg) -> DataFrame:
    return weights.delta_weights(weights.side_weights(base, cfg), cfg)


def _te(base: DataFrame, cfg) -> DataFrame:
    return metrics.tracking_error(metrics.active_return(base, cfg), cfg)


def _breakdown(base: DataFrame, cfg) -> DataFrame:
    return metrics.te_breakdown(_delta(base, cfg), returns.comparable_returns(base, cfg))


def _covariance(operator, base: DataFrame, cfg) -> DataFrame:
    return operator(returns.comparable_returns(base, cfg), metrics.gross_weights(base, cfg), cfg)


def _centred(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """Centred returns of the assets that the portfolio holds at the cutoff, and their weights."""
    held = metrics.gross_weights(i.base, CONFIG)
    own = returns.comparable_returns(i.base, CONFIG).join(held.select("corte", "fund_type", "asset_key"), ["corte", "fund_type", "asset_key"], "left_semi")
    return _kept(i, "vectors", covariance.centred_returns(own, CONFIG)), held


def _covariance_pairs(i: Inputs) -> DataFrame:
    """Every held asset with the heaviest one of its fund."""
    vectors, held = _centred(i)
    known = held.join(vectors.select("corte", "fund_type", "asset_key"), ["corte", "fund_type", "asset_key"], "left_semi")
    heaviest = known.groupBy("corte", "fund_type").agg(
        F.min(F.struct((-F.col("gross_weight")).alias("w"), "asset_key"))["asset_key"].alias("asset_j")
    )
    pairs = known.join(heaviest, ["corte", "fund_type"]).select("corte", "fund_type", F.col("asset_key").alias("asset_i"), "asset_j")
    return covariance.covariance_pairs(vectors, pairs)


def _check(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda i: quality.CHECKS[name](i.observed_tables, CONFIG)


def _disturbed(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same tables, each off in one documented way, so that every check has something to find."""

    def off(name: str, column: str, value: str, where: str) -> DataFrame:
        return tables[name].withColumn(column, F.expr(f"CASE WHEN {where} THEN {value} ELSE {column} END"))

    zero_tenor = "asset_class = 'SWP' AND c2 = 'TASA' AND c5 = '0' AND manager = 'PEER'"
    return tables | {
        "te_pesos_consolidados": off("te_pesos_consolidados", "side_weight", "side_weight * 1.01D", "fund_type <> 'F0'"),
        "te_pesos_comparables": off("te_pesos_comparables", "delta_weight", "delta_weight + 0.02D", "fund_type <> 'F1'"),
        "te_retornos_base": off("te_retornos_base", "return_calc", "0.005D", zero_tenor),
        "te_retornos_comparables": off("te_retornos_comparables", "return_calc", "return_calc * 4", "true"),
        "te_exante_diario": tables["te_exante_diario"].filter("day(fecha) <> 15"),
        "te_var_exante_resumen": off("te_var_exante_resumen", "var_95_1d", "-var_95_1d", "fund_type <> 'F2'"),
    }


def _daily_run(i: Inputs, cfg=CONFIG) -> DataFrame:
    """The stored daily run over staged inputs: rows and a sum per result table."""
    root = i.path(f"run-{uuid4().hex}")
    staged = staging.with_partitions(i.panel.drop("corte"))
    write_partitions(staged, f"{root}/staging", staging.PARTITIONS)
    i.calendar.drop("corte").write.parquet(f"{root}/calendar")
    i.alt_params.write.parquet(f"{root}/alt_params")
    paths = DailyPaths(root, f"{root}/calendar", f"{root}/alt_params" if cfg.classes == "spec" else None)
    tables = run_daily(i.spark, cfg, paths)
    sums = [
        tables[name].agg(F.count(F.lit(1)).alias("total"), F.expr(f"sum({column})").alias("checksum"))
        .select(F.lit(name).alias("table"), "total", "checksum")
        for name, column in CHECKSUMS.items()
    ]
    return reduce(DataFrame.unionByName, sums)


def _view(i: Inputs, name: str) -> DataFrame:
    return result_views(i.tables, CONFIG)[name]


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "incremental_extract": _incremental_extract,
    "staging_idempotent": _staging_idempotent,
    "staging_reconcile": _staging_reconcile,
    "snapshot_read": _snapshot_read,
    "snapshot_replace": _snapshot_replace,
    "audit_counts": lambda i: audit_counts({n: i.tables[n] for n in ("te_pesos_base", "te_exante_resumen")}, CUTOFF),
    "exclude_non_modelable": lambda i: history.exclude_non_modelable(i.panel),
    "active_universe": lambda i: history.active_universe(history.exclude_non_modelable(i.panel), CUTOFF),
    "real_history": lambda i: history.real_history(i.panel, CUTOFF),
    "business_days": lambda i: imputation.business_days(i.calendar, CUTOFF),
    "history_matrix": lambda i: imputation.history_matrix(
        i.universe, imputation.business_days(i.calendar, CUTOFF)
    ),
    "match_real": _matched,
    "hierarchy_means": lambda i: imputation.hierarchy_means(i.real),
    "impute_hierarchy": _imputed,
    "return_origin": lambda i: imputation.return_origin(_imputed(i)),
    "special_rules": lambda i: imputation.special_rules(i.panel),
    "complete_history": lambda i: imputation.complete_history(i.real, i.calendar, CUTOFF, universe=i.universe),
    "complete_history_incremental": _completed_incrementally,
    "imputation_support": lambda i: imputation.imputation_support(i.completed, i.real),
    "imputation_coverage": lambda i: imputation.imputation_coverage(i.completed),
    "returns_mon": lambda i: returns.returns_mon(i.modelable),
    "returns_swp": lambda i: returns.returns_swp(i.modelable),
    "returns_act": lambda i: returns.returns_act(i.modelable),
    "returns_alt": lambda i: returns.returns_alt(i.modelable, i.alt_params),
    "returns_swp_other": lambda i: returns.returns_swp_other(i.modelable),
    "returns_other": lambda i: returns.returns_other(i.modelable),
    "base_returns": _observed_base,
    "base_returns_spec": lambda i: _observed_base(i, SPEC),
    "base_returns_completed": lambda i: returns.base_returns(i.completed, CONFIG),
    "base_returns_imputed": lambda i: returns.base_returns(i.completed, IMPUTED),
    "comparable_returns": lambda i: returns.comparable_returns(i.base, CONFIG),
    "comparable_returns_market": lambda i: returns.comparable_returns(i.base, MARKET),
    "comparable_returns_no_deriv": lambda i: returns.comparable_returns(i.base, BARE),
    "base_weights": lambda i: weights.base_weights(i.base),
    "normalized_weights": lambda i: weights.side_weights(i.base, CONFIG),
    "benchmark_avg_weights": lambda i: weights.benchmark_weights(i.base, AVG),
    "delta_weights": lambda i: _delta(i.base, CONFIG),
    "delta_weights_no_deriv": lambda i: _delta(i.base, BARE),
    "delta_weights_avg": lambda i: _delta(i.base, AVG),
    "te_breakdown": lambda i: _breakdown(i.base, CONFIG),
    "te_daily": lambda i: metrics.te_daily(_breakdown(i.base, CONFIG)),
    "te_daily_no_deriv": lambda i: metrics.te_daily(_breakdown(i.base, BARE)),
    "rolling_window_te": lambda i: metrics.latest_dates(metrics.active_return(i.base, CONFIG), CONFIG.window_days),
    "te_summary": lambda i: _te(i.base, CONFIG),
    "te_summary_no_deriv": lambda i: _te(i.base, BARE),
    "te_summary_real": lambda i: _te(_observed_base(i), CONFIG),
    "te_summary_spec": lambda i: _te(_observed_base(i, SPEC), SPEC),
    "te_summary_market_avg": lambda i: _te(i.base, MARKET_AVG),
    "te_summary_market_no_deriv": lambda i: _te(i.base, MARKET_BARE),
    "side_series": lambda i: metrics.side_series(i.base, CONFIG),
    "beta_summary": lambda i: metrics.beta(metrics.side_series(i.base, CONFIG), CONFIG),
    "beta_summary_no_deriv": lambda i: metrics.beta(metrics.side_series(i.base, BARE), BARE),
    "beta_summary_normalized": lambda i: metrics.beta(metrics.side_series(i.base, NORMALIZED), NORMALIZED),
    "beta_summary_avg": lambda i: metrics.beta(metrics.side_series(i.base, AVG), AVG),
    "beta_summary_real": lambda i: metrics.beta(metrics.side_series(_observed_base(i), CONFIG), CONFIG),
    "beta_summary_separate": lambda i: metrics.beta(metrics.side_series(_observed_base(i), CONFIG), SEPARATE),
    "var_summary": lambda i: metrics.var_from_te(_te(i.base, CONFIG)),
    "var_summary_no_deriv": lambda i: metrics.var_from_te(_te(i.base, BARE)),
    "var_covariance": lambda i: _covariance(metrics.var_covariance, i.base, CONFIG),
    "var_covariance_no_deriv": lambda i: _covariance(metrics.var_covariance, i.base, BARE),
    "covariance_product": lambda i: _covariance(metrics.covariance_product, i.base, CONFIG),
    "covariance_pairs": _covariance_pairs,
    "covariance_size": lambda i: covariance.covariance_size(covariance.gram_matrix(_centred(i)[0])),
    "risk_history": lambda i: rolling.risk_history(_observed_base(i), CONFIG),
    "risk_report": lambda i: metrics.risk_report(i.base, CONFIG),
    **{f"qc_{name}": _check(name) for name in quality.CHECKS},
    "qc_summary": lambda i: quality.qc_summary(i.tables, CONFIG),
}

_QUERIES |= {
    **{key: (lambda i, name=key[3:-6]: quality.CHECKS[name](_disturbed(i.observed_tables), CONFIG))
       for key in COLUMNS if key.startswith("qc_") and key.endswith("_found") and key != "qc_summary_found"},
    "qc_summary_found": lambda i: quality.qc_summary(_disturbed(i.tables), CONFIG),
    "daily_run": _daily_run,
    "daily_run_spec": lambda i: _daily_run(i, SPEC),
    "view_te_no_deriv": lambda i: _view(i, "v_te_exante_resumen_sin_derivados"),
    "view_te_daily_no_deriv": lambda i: _view(i, "v_te_exante_diario_sin_derivados"),
    "view_beta_no_deriv": lambda i: _view(i, "v_te_beta_exante_resumen_sin_derivados"),
    "view_breakdown": lambda i: _view(i, "v_te_desglose"),
}

assert set(_QUERIES) == set(COLUMNS)


def _bound(key: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(key, _QUERIES[key](inputs(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _bound(key) for key in _QUERIES}
