import pytest

from riskpanel import RiskConfig
from riskpanel.operators import quality
from riskpanel.plans import result_tables

from tests.frames import CORTE, base, collect, day

CFG = RiskConfig(CORTE, window_days=20)


def healthy(spark, cortes=(CORTE,)):
    """Two assets over the whole window, sides slightly apart."""
    rows = []
    for corte in cortes:
        for i in range(CFG.window_days):
            fecha = corte - (CORTE - day(-i))
            for manager, tilt in (("PORTFOLIO", 1.1), ("BENCHMARK", 1.0)):
                for asset, sign in (("A", 1), ("B", -0.5)):
                    rows.append({"corte": corte, "fecha": fecha, "manager": manager, "asset_key": asset,
                                 "return_calc": sign * 0.001 * ((i % 5) + 1), "weight_calc": tilt if asset == "A" else 1.0})
    return base(spark, rows)


@pytest.fixture(scope="module")
def tables(spark):
    return result_tables(healthy(spark), CFG)


def test_healthy_results_pass(tables):
    assert collect(quality.qc_summary(tables, CFG)) == sorted((rule, 0) for rule in quality.CHECKS)
    quality.require_quality(tables, CFG)


def test_two_stored_cutoffs_stay_apart(spark):
    both = result_tables(healthy(spark, (CORTE, day(-400))), CFG)
    for rule in ("weights_portfolio", "weights_benchmark", "delta_sum", "window_days"):
        assert quality.CHECKS[rule](both, CFG).isEmpty(), rule


@pytest.mark.parametrize(
    "rule, table, column, value",
    [
        ("weights_portfolio", "te_pesos_consolidados", "side_weight", "side_weight * 1.1"),
        ("weights_benchmark", "te_pesos_consolidados", "side_weight", "side_weight * 1.1"),
        ("delta_sum", "te_pesos_comparables", "delta_weight", "delta_weight + 0.1"),
        ("cap", "te_retornos_comparables", "return_calc", "return_calc + 1"),
        ("window_days", "te_exante_diario", "fecha", "DATE'2024-03-15'"),
        ("te_range", "te_exante_resumen", "te_ex_ante", "0.06D"),
        ("te_range", "te_exante_resumen", "te_ex_ante", "-0.01D"),
        ("beta_range", "te_beta_exante_resumen", "beta_ex_ante", "2.5D"),
        ("var_positive", "te_var_exante_resumen", "var_95_1d", "0D"),
    ],
)
def test_each_rule_finds_its_violation(tables, rule, table, column, value):
    bad = tables | {table: tables[table].selectExpr(*[f"{value} AS {c}" if c == column else c for c in tables[table].columns])}
    found = {r.rule: r.violations for r in quality.qc_summary(bad, CFG).collect()}
    assert found[rule] > 0
    with pytest.raises(ValueError):
        quality.require_quality(bad, CFG)


def test_zero_tenor_swaps_in_every_spelling(spark):
    swap = {"asset_class": "SWP", "key_type": "SWP", "c2": "TASA", "return_calc": 0.1}
    rows = [swap | {"c5": "0", "asset_key": "1"}, swap | {"c5": "0.0", "asset_key": "2"}, swap | {"c5": "5", "asset_key": "3"},
            swap | {"c5": "0", "return_calc": 0.0, "asset_key": "4"}]
    got = quality.check_swp_zero({"te_retornos_base": base(spark, rows)}, CFG)
    assert collect(got, "asset_key") == [("1",), ("2",)]
