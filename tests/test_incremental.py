"""Incremental completion and reconciliation against the plain forms."""

import random
import re

import pytest

from riskpanel import schemas
from riskpanel.operators.changes import changed_days, day_digests
from riskpanel.operators.history import active_universe, real_history
from riskpanel.operators.imputation import complete_history, finest_sums
from riskpanel.operators.incremental import PreviousRun, complete_history_incremental
from riskpanel.operators.staging import PARTITIONS, staging_reconcile, with_partitions
from riskpanel.sources import SourceConfig, read_panel, write_partitions

from tests.frames import CORTE, collect, day, panel

DAYS = [day(-i) for i in range(12)]


def some_panel(seed: int, days, instruments: int = 14) -> list[dict]:
    rng, rows = random.Random(seed), []
    for k in range(instruments):
        own = {
            "nemotecnico": f"N{k}", "tipo_fondo": "AB"[k % 2], "afp": ["PORTFOLIO", "PEER"][k % 3 == 0], "clase": ["ACT", "MON", "SWP"][k % 3],
            "C1": ["ACC", "CLP", "GEN"][k % 3], "C2": f"G{k % 2}", "C3": "USD", "C4": None if k % 5 == 0 else f"B{k % 4}", "C5": ["1", "0.0"][k % 2],
        }
        for d in days:
            if rng.random() < 0.6 or d == CORTE and k < 10:
                rows.append(own | {"fecha": d, "retorno": None if rng.random() < 0.2 else round(rng.uniform(-0.1, 0.1), 6)})
    return rows


def calendar(spark, days):
    return spark.createDataFrame([(d, True) for d in days], schemas.CALENDAR)


def rounded(df):
    columns = schemas.COMPLETED.fieldNames()
    return collect(df.selectExpr(*[f"round({c}, 9) AS {c}" if c == "retorno" else c for c in columns]))


def run_of(spark, rows, corte, days, n):
    frame = panel(spark, rows)
    real = real_history(frame, corte)
    universe = active_universe(real, corte)
    return PreviousRun(
        complete_history(real, calendar(spark, days), corte, n, universe=universe).cache(), universe.cache(), finest_sums(real).cache(),
        day_digests(frame).cache(),
    )


def whole(spark, rows, corte, days, n):
    return complete_history(real_history(panel(spark, rows), corte), calendar(spark, days), corte, n)


def check(spark, before, now, corte_before, corte, days, n=10):
    previous = run_of(spark, before, corte_before, days, n)
    frame = panel(spark, now)
    run = complete_history_incremental(frame, calendar(spark, days), corte, previous, day_digests(frame), n)
    assert rounded(run.completed) == rounded(whole(spark, now, corte, days, n))
    sums = finest_sums(real_history(frame, corte)).filter(f"fecha >= DATE'{min(run.fresh + run.kept)}'").filter(f"fecha <= DATE'{corte}'")
    assert collect(run.sums.selectExpr("fecha", "path", "round(total, 9)", "n")) == collect(sums.selectExpr("fecha", "path", "round(total, 9)", "n"))
    return run


def test_a_new_day_a_late_row_and_a_changed_universe(spark):
    now = some_panel(1, DAYS)
    late, gone = day(-5), day(-7)
    before = [r for r in now if not (r["fecha"] == late and r["nemotecnico"] in ("N1", "N2"))] + [now[0] | {"fecha": gone, "nemotecnico": "N99"}]
    run = check(spark, before, now, day(-1), CORTE, DAYS)
    assert {late, gone, CORTE} <= set(run.fresh) and run.kept


def test_an_instrument_that_changes_its_class_and_one_under_two(spark):
    now = some_panel(2, DAYS)
    now = [r | ({"C4": "B9"} if r["nemotecnico"] == "N3" and r["fecha"] == CORTE else {}) for r in now]
    now.append([r for r in now if r["nemotecnico"] == "N4" and r["fecha"] == CORTE][0] | {"C5": "7"})
    check(spark, now, now, day(-1), CORTE, DAYS)


def test_nothing_changed_and_everything_changed(spark):
    now = some_panel(3, DAYS)
    run = check(spark, now, now, CORTE, CORTE, DAYS)
    assert run.fresh == []
    run = check(spark, some_panel(4, DAYS), now, CORTE, CORTE, DAYS)
    assert run.kept == []


def test_only_changed_days_are_read_if_the_universe_stays(spark, tmp_path):
    now = some_panel(5, DAYS)
    path = str(tmp_path / "staging")
    write_partitions(with_partitions(panel(spark, now)), path, PARTITIONS)
    before = [r for r in now if not (r["fecha"] == day(-4) and r["nemotecnico"] == "N1")]
    if len(before) == len(now):
        before = [r for r in now if r["fecha"] != day(-4)]
    previous = run_of(spark, before, CORTE, DAYS, 10)
    staged = read_panel(spark, path)
    active_universe(staged, CORTE).write.parquet(str(tmp_path / "universe"))
    universe = spark.read.parquet(str(tmp_path / "universe"))
    run = complete_history_incremental(staged, calendar(spark, DAYS), CORTE, previous, day_digests(staged).cache(), 10, universe)
    assert run.fresh == [day(-4)] and len(run.kept) == 9
    assert rounded(run.completed) == rounded(whole(spark, now, CORTE, DAYS, 10))
    scans = re.findall(r"PartitionFilters: \[[^\]]*\]", run.completed._jdf.queryExecution().executedPlan().toString())
    staged_scans = [s for s in scans if "fecha" in s]
    assert staged_scans and all(f"(fecha#" in s and str(day(-4)) in s for s in staged_scans)
    plan = run.completed._jdf.queryExecution().executedPlan().toString()
    assert str(day(-3)) not in " ".join(staged_scans) and "CartesianProduct" not in plan


def test_digests_do_not_depend_on_order_and_see_every_change(spark):
    rows = some_panel(6, DAYS[:3])
    frame = panel(spark, rows)
    digests = day_digests(frame).cache()
    assert changed_days(digests, day_digests(panel(spark, rows[::-1]).repartition(5))) == []
    changed = [rows[0] | {"C4": "other"}, *rows[1:]]
    assert changed_days(digests, day_digests(panel(spark, changed))) == [rows[0]["fecha"]]
    twice = rows + [rows[-1], rows[-1]]  # an exclusive or alone would not see a row added twice
    assert changed_days(digests, day_digests(panel(spark, twice))) == [rows[-1]["fecha"]]
    swapped = [rows[0] | {"C1": rows[0]["C2"], "C2": rows[0]["C1"]}, *rows[1:]]
    assert changed_days(digests, day_digests(panel(spark, swapped))) == [rows[0]["fecha"]]
    assert changed_days(digests, digests.limit(0)) == sorted(DAYS[:3])


def test_reconciliation_replaces_the_days_that_differ_and_no_others(spark, tmp_path):
    rows = some_panel(7, DAYS[:6])
    staged, source = str(tmp_path / "staged"), str(tmp_path / "source")
    late, corrected, gone = day(-1), day(-2), day(-4)
    now = [r for r in rows if r["fecha"] != gone]
    before = [r for r in rows if r["fecha"] != late or r["nemotecnico"] != rows[0]["nemotecnico"]]
    before = [r | ({"retorno": 0.5} if r["fecha"] == corrected else {}) for r in before]
    before += [r | {"nemotecnico": "LATE"} for r in rows if r["fecha"] == late]
    write_partitions(with_partitions(panel(spark, before)), staged, PARTITIONS)
    panel(spark, now).write.parquet(source)

    def files(d):
        return {p.name: p.stat().st_mtime_ns for p in (tmp_path / "staged").glob(f"year=*/month=*/fecha={d}/*.parquet")}

    untouched = {d: files(d) for d in (day(0), day(-3), day(-5))}
    done = staging_reconcile(spark, SourceConfig(path=source), staged, DAYS[5], DAYS[0])
    assert set(done.replaced) == {late, corrected} and done.emptied == (gone,)
    assert collect(read_panel(spark, staged)) == collect(panel(spark, now))
    assert {d: files(d) for d in untouched} == untouched and all(untouched.values())
    again = staging_reconcile(spark, SourceConfig(path=source), staged, DAYS[5], DAYS[0])
    assert again.replaced == again.emptied == ()


def test_reconciliation_of_nothing_staged(spark, tmp_path):
    rows = some_panel(8, DAYS[:3])
    panel(spark, rows).write.parquet(str(tmp_path / "source"))
    done = staging_reconcile(spark, SourceConfig(path=str(tmp_path / "source")), str(tmp_path / "staged"), DAYS[2], DAYS[0])
    assert set(done.replaced) == set(DAYS[:3])
    assert collect(read_panel(spark, str(tmp_path / "staged"))) == collect(panel(spark, rows))


def test_more_changed_days_than_a_history_may_have_are_an_error(spark):
    many = panel(spark, [{"fecha": day(-i)} for i in range(1010)])
    with pytest.raises(ValueError):
        changed_days(day_digests(many).limit(0), day_digests(many))
