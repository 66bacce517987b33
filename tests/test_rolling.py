"""Metrics of every cutoff against one run per cutoff."""

import random

import pytest
from pyspark.sql import functions as F

from riskpanel.config import RiskConfig
from riskpanel.operators.metrics import active_return, beta, side_series, tracking_error, var_from_te
from riskpanel.operators.rolling import daily_delta_weights, risk_history

from tests.frames import CORTE, base, day


def some_base(spark, seed=1, days=40, window=None):
    rng, rows = random.Random(seed), []
    for fund in ("A", "B"):
        for d in range(days):
            for k in range(8):
                for manager in ("PORTFOLIO", "BENCHMARK", "PEER"):
                    if rng.random() < 0.5 and not (fund == "B" and manager == "BENCHMARK" and d % 4 == 0):
                        rows.append({
                            "fecha": day(-d), "manager": manager, "fund_type": fund, "asset_key": f"K{k}", "asset_class": "SWP" if k == 7 else "ACT",
                            "return_calc": None if rng.random() < 0.1 else rng.uniform(-0.3, 0.3), "weight_calc": rng.uniform(0, 5),
                        })
    return base(spark, rows).cache()


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(a)))


@pytest.mark.parametrize("changes", [{}, {"derivatives": False}, {"comparable_scope": "market"}])
def test_every_cutoff_equals_its_own_run(spark, changes):
    frame = some_base(spark)
    cfg = RiskConfig(CORTE, window_days=20, **changes)
    rows = {(r.corte, r.fund_type): r for r in risk_history(frame, cfg).collect()}
    assert len(rows) > 60
    for d in (0, 3, 17, 39):
        corte = day(-d)
        upto = frame.filter(F.col("fecha") <= F.lit(corte)).withColumn("corte", F.lit(corte))
        own = cfg.with_(cutoff=corte)
        te = tracking_error(active_return(upto, own), own)
        slopes = {r.fund_type: r for r in beta(side_series(upto, own), own).collect()}
        risks = {r.fund_type: r for r in var_from_te(te).collect()}
        expected = te.collect()
        assert {r.fund_type for r in expected} == {f for c, f in rows if c == corte}
        for r in expected:
            got = rows[corte, r.fund_type]
            assert got.days == r.days
            for name in ("avg_active_return", "daily_tracking_error", "te_ex_ante"):
                assert close(got[name], r[name])
            assert close(got.var_95_1d, risks[r.fund_type].var_95_1d) and close(got.var_95_252d, risks[r.fund_type].var_95_252d)
            slope = slopes.get(r.fund_type)
            assert got.beta_days == (slope and slope.days) and close(got.beta_ex_ante, slope and slope.beta_ex_ante)


def test_a_portfolio_that_is_its_benchmark_has_no_error_and_beta_one(spark):
    rng = random.Random(2)
    rows = []
    for d in range(30):
        for k in range(3):
            r, w = rng.uniform(-0.1, 0.1), 1.0 + k
            rows += [{"fecha": day(-d), "manager": m, "asset_key": f"K{k}", "return_calc": r, "weight_calc": w} for m in ("PORTFOLIO", "BENCHMARK")]
    for r in risk_history(base(spark, rows), RiskConfig(CORTE, window_days=20)).collect():
        if r.days > 1:
            assert r.te_ex_ante < 1e-12 and abs(r.beta_ex_ante - 1) < 1e-9


def test_one_side_without_weight_and_empty_input(spark):
    rows = [{"weight_calc": 0.0}, {"manager": "BENCHMARK", "asset_key": "BBB", "weight_calc": 2.0}]
    weights = {r.asset_key: r.delta_weight for r in daily_delta_weights(base(spark, rows), RiskConfig(CORTE)).collect()}
    assert weights == {"AAA": 0.0, "BBB": -1.0}
    assert risk_history(base(spark, []), RiskConfig(CORTE)).count() == 0


def test_settings_that_need_other_plans_are_refused(spark):
    with pytest.raises(ValueError):
        risk_history(base(spark, []), RiskConfig(CORTE, benchmark_mode="AVG"))
    with pytest.raises(ValueError):
        risk_history(base(spark, []), RiskConfig(CORTE, beta_weighting="normalized"))
