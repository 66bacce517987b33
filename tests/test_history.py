import pytest

from riskpanel.operators import history

from tests.frames import CORTE, collect, day, panel


def test_only_instruments_active_at_the_cutoff(spark):
    rows = [
        {"nemotecnico": "ACTIVE"}, {"nemotecnico": "ACTIVE", "fecha": day(-1)},
        {"nemotecnico": "GONE", "fecha": day(-1)},
        {"nemotecnico": "ACTIVE", "afp": "PEER", "fecha": day(-1)},
        {"nemotecnico": "CASH", "C1": "CAJA"},
    ]
    got = collect(history.real_history(panel(spark, rows), CORTE), "nemotecnico", "afp", "fecha", "corte")
    assert got == [("ACTIVE", "PORTFOLIO", day(-1), CORTE), ("ACTIVE", "PORTFOLIO", CORTE, CORTE)]


def test_two_classifications_do_not_multiply_history(spark):
    rows = [{"C5": "1"}, {"C5": "2"}, {"C5": "1", "fecha": day(-1)}]
    df = panel(spark, rows)
    assert history.active_universe(df, CORTE).count() == 2
    assert history.real_history(df, CORTE).count() == 3


def test_empty_cutoff_is_an_error(spark):
    df = panel(spark, [{"fecha": day(-1)}])
    with pytest.raises(ValueError):
        history.require_universe(history.active_universe(df, CORTE), CORTE)


def test_date_helpers(spark):
    df = panel(spark, [{"fecha": day(-1)}, {}, {"fecha": day(1)}])
    assert history.at_cutoff(df, CORTE).count() == 1
    assert history.up_to_cutoff(df, str(CORTE)).count() == 2
    assert history.with_corte(df, "2024-03-15").schema["corte"].dataType.simpleString() == "date"
