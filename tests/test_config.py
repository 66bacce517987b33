from datetime import date

import pytest

from riskpanel import RiskConfig


def test_defaults_and_normalisation():
    cfg = RiskConfig("2024-03-15", portfolio_id=" portfolio ", benchmark_id="bench")
    assert cfg.cutoff == date(2024, 3, 15)
    assert (cfg.portfolio_id, cfg.benchmark_id) == ("PORTFOLIO", "BENCH")
    assert (cfg.ret_cap, cfg.window_days, cfg.history_days) == (0.20, 120, 252)


@pytest.mark.parametrize(
    "values",
    [
        {"ret_cap": 0.001}, {"ret_cap": 1.5}, {"window_days": 19}, {"window_days": 505}, {"history_days": 0},
        {"benchmark_id": "portfolio"}, {"benchmark_mode": "MAX"}, {"classes": "all"}, {"comparable_scope": "x"},
        {"beta_weighting": "x"}, {"beta_nulls": "x"},
    ],
)
def test_values_out_of_range_are_refused(values):
    with pytest.raises(ValueError):
        RiskConfig("2024-03-15", **values)


def test_cutoff_must_be_a_date():
    with pytest.raises(ValueError):
        RiskConfig("15/03/2024")
