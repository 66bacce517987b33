from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from riskpanel.llm import topk_blocks
from riskpanel.llm.topk_blocks import Range, SearchConfig, bounds_of, cut_ranges, reached, search_range, top_k
from tests.llm import brute
from tests.llm.frames import SMALL, rows_of

SCHEMA = "vec_id bigint, embedding array<double>, score string, n string, range string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


SMALL_TASKS = SearchConfig(block=4, range_vectors=37, queries_per_group=3, centres=3, sample=50)


def test_smallest_tables(spark):
    vectors = rows_of(SMALL, "SELECT vec_id, embedding FROM embeddings")
    assert found(top_k(spark.read.parquet(f"{SMALL}/embeddings.parquet"))) == sorted(brute.top_k(vectors))


@pytest.mark.parametrize("config", [SearchConfig(), SMALL_TASKS])
@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_ties_and_small_tasks(spark, config, spread):
    rng = random.Random(8)
    rows = [(i, [round(rng.gauss(0, spread), 2) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(50)]
    assert found(top_k(frame(spark, rows), config)) == sorted(brute.top_k(rows))


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (20, [0.5, 0.5]), (40, None), (60, [1.0, None]), (80, [nan, 1.0]), (3, [inf, 0.0]), (4, [-0.001, 0.001]), (5, [])]
    got = found(top_k(frame(spark, [*rows, (None, [1.0, 1.0])])))
    padded = [(i, v if v is None or len(v) == 2 else [0.0, 0.0]) for i, v in rows]
    assert got == sorted(brute.top_k(padded))


def test_large_components_stay_exact(spark):
    rows = [(i, [1e7 + i, -1e7 + 0.5 * i, 3.0 * i]) for i in range(30)]  # scores beyond what doubles hold
    assert found(top_k(frame(spark, rows), SMALL_TASKS)) == sorted(brute.top_k(rows))


def test_finite_components_beyond_64_bits_take_part(spark):
    rows = [(i, [(i - 3) * 2.0**60, 1.0]) for i in range(1, 8)] + [(20, [1.0, 2.0**70]), (40, [-1.0, 0.0])]
    most = 2**63 - 1
    expected = [(q, r, v, max(-most - 1, min(most, s))) for q, r, v, s in brute.top_k(rows)]
    got = found(top_k(frame(spark, rows)))
    assert {(q, v, s) for q, _, v, s in got} == {(q, v, s) for q, _, v, s in expected}
    near = [(i, [i * 2.0**56, -(2.0**56) + i]) for i in range(30)]  # exact sums far beyond doubles, clipped alike
    assert {r[0] for r in found(top_k(frame(spark, near), SMALL_TASKS))} == {0, 20}


def test_a_range_returns_nothing_below_the_floor():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-9, 9, (50, 4)).astype(float)
    index = Range(np.arange(50), vectors, 8)
    query = vectors[7]
    scores, ids = index.search(7, query, bounds_of(query[None], index)[0], 20, 100.0)
    whole = {int(i): float(vectors[i] @ query) for i in range(50) if i != 7 and vectors[i] @ query >= 100}
    assert dict(zip(ids.tolist(), scores.tolist())) == whole


def test_repeated_ids_are_no_candidates_of_each_other(spark):
    rows = [(20, [1.0, 0.0]), (20, [2.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])]
    assert found(top_k(frame(spark, rows))) == [(20, 1, 1, 4096), (20, 2, 2, 0)]


def test_empty(spark):
    assert top_k(frame(spark, [])).count() == 0
    assert top_k(frame(spark, [(1, [1.0])])).count() == 0
    assert top_k(frame(spark, [(20, [1.0])])).count() == 0


def test_ranges_of_many_partitions_have_names_of_their_own():
    rows = [(1024 << 33) + i for i in range(5)]
    batch = pa.RecordBatch.from_pydict({"vec_id": [1] * 5, "components": [[1.0]] * 5, "row": rows})
    names = [n for b in cut_ranges(SearchConfig(range_vectors=2))(iter([batch])) for n in b.column("range").to_pylist()]
    assert names == rows[::2]


def test_many_queries_share_one_product(monkeypatch):
    rng = np.random.default_rng(5)
    vectors, queries = (rng.integers(-9, 9, (n, 6)).astype(float) for n in (200, 300))
    ids = np.arange(1000, 1300)
    ranges = pa.table({
        "range": [0], "n": [200], "width": [6], "ids": [np.arange(200).tobytes()], "vectors": [vectors.tobytes()],
    })
    asked = pa.table({
        "query_id": ids, "floor": np.full(300, -np.inf), "floor_id": np.full(300, 2**63 - 1),
        "components": pa.array(queries.tolist(), pa.list_(pa.float64())),
    })
    calls, dots = [], topk_blocks.dots
    monkeypatch.setattr(topk_blocks, "dots", lambda *given: calls.append(1) or dots(*given))
    got = search_range(SearchConfig(k=5, block=8))(ranges, asked)
    expected = {
        (int(q), i, int(vectors[i] @ row)) for q, row in zip(ids, queries)
        for i in sorted(range(200), key=lambda i: (-(vectors[i] @ row), i))[:5]
    }
    assert set(zip(*(got.column(c).to_pylist() for c in got.column_names))) == expected and got.num_rows == 1500
    assert len(calls) < 20


def test_ranges_that_only_tie_with_larger_ids_are_not_reached():
    ranges = pa.table({"range": [1, 2, 3], "lowest": [5, 60, 70], "most": [[2.0, 1.0], [2.0, 1.0], [3.0, 1.0]], "least": [[0.0, 0.0]] * 3})
    queries = pa.table({"query_id": [20], "floor": [6.0], "floor_id": [50], "components": [[3.0, 0.0]]})
    assert reached(ranges, queries).column("range").to_pylist() == [1, 3]


@pytest.mark.parametrize("copied", [False, True])
def test_copies_and_near_copies(spark, copied):
    rng = random.Random(11)
    base = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(40)]
    rows = [(i, base[0] if copied and i % 3 < 2 else [x + rng.gauss(0, 0.01) for x in base[i % 40]]) for i in range(300)]
    assert found(top_k(frame(spark, rows), SMALL_TASKS)) == sorted(brute.top_k(rows))


def test_a_batch_is_cut_into_ranges_of_like_size():
    batch = pa.RecordBatch.from_pydict({"vec_id": list(range(10)), "components": [[1.0], [1.0, 2.0]] * 5, "row": list(range(10))})
    cut = list(cut_ranges(SearchConfig(range_vectors=8))(iter([batch])))
    assert [b.column("n")[0].as_py() for b in cut] == [5, 5]
    assert np.frombuffer(cut[0].column("vectors")[0].as_py()).reshape(5, 2)[:2].tolist() == [[1.0, 0.0], [1.0, 2.0]]


def test_a_huge_query_beside_small_ones_stays_exact(spark):
    rows = [(i, [i - 30.0, 1.0 + i % 4]) for i in range(60)] + [(60, [2.0**55 + 2.0**10, 1.0]), (80, [2.0**55, -3.0])]
    expected = [(q, r, v, max(-(2**63), min(2**63 - 1, s))) for q, r, v, s in brute.top_k(rows) if q < 60]
    assert [r for r in found(top_k(frame(spark, rows), SMALL_TASKS)) if r[0] < 60] == sorted(expected)
