import random

import pytest

from riskpanel import RiskConfig, schemas
from riskpanel.operators import returns
from riskpanel.operators.history import real_history
from riskpanel.operators.imputation import complete_history
from riskpanel.plans import DailyPaths, register_views, result_tables, run_daily
from riskpanel.plans.daily import is_business_day
from riskpanel.sources import SourceConfig, read_calendar, read_panel, read_snapshot, write_snapshot

from tests.frames import CORTE, collect, day, panel

CFG = RiskConfig(CORTE, window_days=20, history_days=30)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Forty days of two funds and three managers, with gaps."""
    rng = random.Random(11)
    kinds = {
        "ACC1": {}, "ACC2": {}, "USD": {"clase": "MON", "C1": "USD", "tipo_instr": "DER"},
        "SWAP": {"clase": "SWP", "C2": "TASA", "C3": "USD", "C5": "5Y", "tipo_instr": "DER"}, "FWD1": {"clase": "FWD"},
    }
    rows = []
    for i in range(40):
        for fund in "AB":
            for manager in ("PORTFOLIO", "BENCHMARK", "PEER"):
                for name, kind in kinds.items():
                    if i and rng.random() < 0.2:
                        continue
                    weight = rng.uniform(0.5, 2)
                    value = rng.gauss(0, 0.01)
                    rows.append({"fecha": day(-i), "nemotecnico": name, "tipo_fondo": fund, "afp": manager, "retorno": value,
                                 "aporte_retorno": value * weight, "peso_valorizacion_economica_sub": weight,
                                 "peso_exposicion_economica": weight} | kind)
    root = tmp_path_factory.mktemp("daily")
    panel(spark, rows).write.parquet(str(root / "source"))
    spark.createDataFrame([(day(-i), i % 7 != 3) for i in range(-5, 60)], schemas.CALENDAR).write.parquet(str(root / "calendar"))
    return root


@pytest.fixture(scope="module")
def stored(spark, source):
    paths = DailyPaths(str(source / "out"), str(source / "calendar"))
    return run_daily(spark, CFG, paths, SourceConfig(path=str(source / "source")), bootstrap_days=60)


def rounded(df):
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in collect(df, *sorted(df.columns))]


def test_every_table_is_stored_with_its_schema(stored):
    for name, schema in schemas.TABLES.items():
        df = stored[name]
        assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in schema}
        assert not df.isEmpty(), name
    assert set(schemas.TABLES) <= set(stored)


def test_stored_results_equal_the_lazy_plan(spark, source, stored):
    staged = read_panel(spark, str(source / "out" / "staging"))
    history = complete_history(real_history(staged, CORTE), read_calendar(spark, str(source / "calendar")), CORTE, 30)
    lazy = result_tables(returns.base_returns(history, CFG), CFG)
    for name in ("te_exante_resumen", "te_beta_exante_resumen", "te_var_exante_resumen_sin_derivados", "te_pesos_comparables"):
        assert rounded(stored[name]) == rounded(lazy[name]), name


def test_audit_and_quality_come_with_the_run(stored):
    audit = dict(collect(stored["audit"]))
    assert audit["te_exante_resumen"] == 2 and audit["te_exante_diario"] == 40
    assert len(collect(stored["quality"])) == 9


def test_views_are_available_to_sql(spark, stored):
    names = register_views({n: stored[n] for n in schemas.TABLES}, CFG)
    assert len(names) == 16
    bare = spark.sql("SELECT r.fund_type, 1.6449D * v.daily_tracking_error AS a, r.var_95_1d AS b FROM v_te_exante_resumen_sin_derivados v "
                     "JOIN te_var_exante_resumen_sin_derivados r USING (corte, fund_type)").collect()
    assert len(bare) == 2 and all(r.a == pytest.approx(r.b) for r in bare)
    total = spark.sql("SELECT d.fund_type, d.fecha, d.r_diff, sum(b.contribution) AS s FROM te_exante_diario d "
                      "JOIN v_te_desglose b USING (corte, fund_type, fecha) GROUP BY ALL").collect()
    assert len(total) == 40 and all(r.r_diff == pytest.approx(r.s) for r in total)
    assert spark.table("v_te_beta_exante_resumen_sin_derivados").count() == 2
    assert spark.table("v_te_exante_diario_sin_derivados").count() == 40


def test_empty_cutoff_stops_the_run(spark, source, stored):
    paths = DailyPaths(str(source / "out"), str(source / "calendar"))
    root = str(source / "out" / "output_real")
    write_snapshot(stored["te_pesos_base"].sparkSession.read.parquet(root).limit(2), root, day(3))
    with pytest.raises(ValueError, match="no instrument"):
        run_daily(spark, CFG.with_(cutoff=day(3)), paths)
    assert read_snapshot(spark, root, day(3)).count() == 2  # what was stored for that cutoff is still there


def test_nothing_runs_on_a_holiday(spark, source):
    holiday = next(day(-i) for i in range(10) if i % 7 == 3)
    paths = DailyPaths(str(source / "nowhere"), str(source / "calendar"))
    assert run_daily(spark, CFG.with_(cutoff=holiday), paths) == {}


def test_strict_quality_raises(spark, source, stored):
    paths = DailyPaths(str(source / "out"), str(source / "calendar"))
    with pytest.raises(ValueError, match="quality checks failed"):
        run_daily(spark, CFG.with_(cutoff=day(-1)), paths, strict_quality=True)


def test_stored_history_is_whole(spark, source, stored):
    root = str(source / "out")
    staged = real_history(read_panel(spark, f"{root}/staging"), CORTE)
    assert read_snapshot(spark, f"{root}/output_real", CORTE).count() == staged.count()


def test_business_day_check(spark, source):
    calendar = read_calendar(spark, str(source / "calendar"))
    assert is_business_day(calendar, CFG)
    assert not is_business_day(calendar, CFG.with_(cutoff=day(-3)))


# Last, because it replaces the files that the frames above read.
def test_repeating_a_run_replaces_its_results(spark, source, stored):
    before = {name: rounded(stored[name]) for name in ("te_exante_resumen", "te_retornos_base")}
    paths = DailyPaths(str(source / "out"), str(source / "calendar"))
    again = run_daily(spark, CFG, paths)
    assert {name: rounded(again[name]) for name in before} == before
