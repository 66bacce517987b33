"""The factor form against the full matrix."""

import random
import statistics

import pytest

from riskpanel.config import RiskConfig
from riskpanel.operators.covariance import (
    centred_returns, component_loadings, covariance_pairs, covariance_size, gram_matrix, leading_components,
)
from riskpanel.operators.returns import comparable_returns

from tests.frames import CORTE, base, collect, day

CFG = RiskConfig(CORTE, window_days=20)
ASSETS = [f"K{k}" for k in range(30)]  # more assets than days


def some_returns(seed=1, days=25):
    rng = random.Random(seed)
    return {
        (f, a, d): rng.gauss(0, 0.03) for f in "AB" for a in ASSETS for d in range(days)
        if rng.random() < 0.8 or (a == "K0" and d < 20)
    }


def vectors_of(spark, table):
    rows = [{"fund_type": f, "asset_key": a, "fecha": day(-d), "return_calc": r} for (f, a, d), r in table.items()]
    return centred_returns(comparable_returns(base(spark, rows), CFG), CFG).cache()


def full_matrix(table, fund, days=20):
    cells = {a: [table.get((fund, a, d), 0.0) for d in range(days)] for a in ASSETS}
    return {(a, b): statistics.covariance(cells[a], cells[b]) for a in ASSETS for b in ASSETS}


@pytest.fixture(scope="module")
def made(spark):
    table = some_returns()
    return table, vectors_of(spark, table)


def test_pairs_equal_the_full_matrix(spark, made):
    table, vectors = made
    asked = [(CORTE, f, a, b) for f in "AB" for a, b in (("K0", "K1"), ("K1", "K0"), ("K7", "K7"), ("K29", "K3"), ("K1", "nobody"))]
    pairs = spark.createDataFrame(asked, "corte date, fund_type string, asset_i string, asset_j string")
    got = {(r.fund_type, r.asset_i, r.asset_j): r["cov"] for r in covariance_pairs(vectors, pairs).collect()}
    assert len(got) == 8
    for (f, a, b), cov in got.items():
        assert cov == pytest.approx(full_matrix(table, f)[a, b], abs=1e-15)


def test_trace_and_norm_equal_those_of_the_full_matrix(made):
    table, vectors = made
    gram = gram_matrix(vectors).cache()
    assert gram.count() == 2 * 20 * 21 / 2  # bounded by the dates
    for row in covariance_size(gram).collect():
        matrix = full_matrix(table, row.fund_type)
        assert row.total_variance == pytest.approx(sum(matrix[a, a] for a in ASSETS))
        assert row.squared_norm == pytest.approx(sum(c * c for c in matrix.values()))


def test_all_components_give_the_matrix_back_and_the_first_is_the_largest(made):
    table, vectors = made
    gram = gram_matrix(vectors)
    components = leading_components(gram, 20)
    assert set(components) == {(CORTE, "A"), (CORTE, "B")}
    loadings = {(r.fund_type, r.asset_key, r.component): r.loading for r in component_loadings(vectors, components).collect()}
    for fund in "AB":
        values = [v for v, _ in components[CORTE, fund]]
        assert values == sorted(values, reverse=True) and values[-1] == pytest.approx(0, abs=1e-12)  # rank: one less than the dates
        matrix = full_matrix(table, fund)
        for a, b in (("K0", "K0"), ("K2", "K9"), ("K28", "K5")):
            back = sum(loadings[fund, a, n] * loadings[fund, b, n] for n in range(1, 21))
            assert back == pytest.approx(matrix[a, b], abs=1e-12)


def test_one_date_and_no_rows(spark):
    one = vectors_of(spark, {("A", "K0", 0): 0.1, ("A", "K1", 0): 0.2})
    pairs = spark.createDataFrame([(CORTE, "A", "K0", "K1")], "corte date, fund_type string, asset_i string, asset_j string")
    assert collect(covariance_pairs(one, pairs), "cov") == [(None,)]
    assert [r.total_variance for r in covariance_size(gram_matrix(one)).collect()] == [None]
    none = vectors_of(spark, {})
    assert none.count() == 0 and covariance_size(gram_matrix(none)).count() == 0 and leading_components(gram_matrix(none)) == {}


def test_an_asset_without_a_recent_return_has_no_variance(spark):
    table = some_returns(3) | {("A", "OLD", 24): 0.1}
    table = {k: v for k, v in table.items()}
    vectors = vectors_of(spark, table)
    assert {r.asset_key: set(r.vector) for r in vectors.filter("asset_key = 'OLD'").collect()} == {"OLD": {0.0}}
