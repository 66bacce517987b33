from __future__ import annotations

import zlib

import numpy as np

from riskpanel.llm.language_gru import PAD, Network, NetworkConfig, fit, identify, softmax, training_windows
from riskpanel.llm.queries import queries
from tests.llm.frames import EDGES, SMALL, docs_of, edge_docs, empty_docs, rows_of

QUICK = NetworkConfig(sample=300, rounds=4)


def plain_probabilities(network: Network, text: bytes) -> np.ndarray:
    """Mean over all positions, one position and one number at a time."""
    k, w = network.config.states, network.config.window

    def read(direction, symbols):
        h, out = np.zeros(k), []
        for s in symbols:
            own, given = direction.recur.astype(float) @ h, direction.table[:, s].astype(float)
            z, r = (1 / (1 + np.exp(-(given[a : a + k] + own[a : a + k]))) for a in (0, k))
            n = np.tanh(given[2 * k :] + r * own[2 * k :])
            h = h + z * (n - h)
            out.append(h)
        return out

    rows = []
    for start in range(0, len(text), w):
        window = list(text[start : start + w])
        ahead, behind = read(network.forward, window), read(network.backward, window[::-1])[::-1]
        for a, b in zip(ahead, behind):
            rows.append(softmax((network.out.astype(float) @ np.concatenate((a, b)) + network.bias.ravel())[:, None]).ravel())
    return np.mean(rows, axis=0)


def test_pooling_equals_the_plain_version():
    network = Network(["a", "b", "c"], NetworkConfig(states=5, window=7, batch=3, seed=2))
    texts = [b"", b"x", b"seven b", b"eight by", "é日本".encode() * 9, bytes(range(256))]
    pooled = network.pool(texts)
    assert (pooled[0] == 0).all()
    for text, row in zip(texts[1:], pooled[1:]):
        assert np.allclose(row, plain_probabilities(network, text), atol=1e-5) and abs(row.sum() - 1) < 1e-5


def test_padding_is_not_the_zero_byte():
    network = Network(["a", "b", "c"], NetworkConfig(states=5, window=7, batch=3, seed=2))
    before = network.pool([b"x", b"eight by"])
    for direction in (network.forward, network.backward):
        direction.table[:, 0] += 5
    assert (network.pool([b"x", b"eight by"]) == before).all()


def test_gradients_equal_differences():
    network = Network(["a", "b", "c"], NetworkConfig(states=4, window=9, seed=3))
    for direction in (network.forward, network.backward):
        direction.table, direction.recur = direction.table.astype(np.float64), direction.recur.astype(np.float64)
    network.out, network.bias = network.out.astype(np.float64), network.bias.astype(np.float64)
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 6, (9, 5))
    symbols[6:, 1] = PAD
    labels, weight = np.array([0, 1, 2, 1, 0]), np.array([1.0, 2.0, 0.5, 2.0, 1.0])

    def loss() -> float:
        there = symbols != PAD
        total = 0.0
        for t, p in network.label(symbols):
            total -= (np.log(p[labels, np.arange(5)]) * weight * there[t]).sum()
        return total / (there * weight).sum()

    parameters = [network.forward.table, network.forward.recur, network.backward.table, network.backward.recur, network.out, network.bias]
    for p, g in zip(parameters, network.gradients(symbols, labels, weight)):
        for at in [tuple(rng.integers(0, s) for s in p.shape) for _ in range(12)] + [(0, 1)] * (p.shape[1] > 1):
            kept, step = p[at], 1e-5
            p[at] = kept + step
            up = loss()
            p[at] = kept - step
            down = loss()
            p[at] = kept
            assert abs((up - down) / (2 * step) - g[at]) < 2e-4


def test_held_out_documents_get_their_language(spark):
    sf_dir = SMALL.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in queries()["op11_language_gru"](spark, sf_dir).collect()}
    documents = rows_of(sf_dir, "SELECT doc_id, text, lang FROM documents")
    assert len(rows) == len(documents)
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= rows[i].score <= 1 for i, _, _ in documents)
    held = [(rows[i].lang_pred, lang) for i, _, lang in documents if rows[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) > 100


def test_training_sees_no_held_out_row_and_is_bounded(spark):
    docs = docs_of(spark, [(i, f"text number {i} " * 20, "s", f"l{zlib.crc32(str(i).encode()) % 4}") for i in range(200)] + [(None, "no id", "s", "l9")])
    seen = training_windows(docs, QUICK)
    assert {lang for lang, _ in seen} == {"l0", "l1", "l3"} and all(len(w) <= QUICK.window for _, ws in seen for w in ws)
    assert len(training_windows(docs, NetworkConfig(sample=10))) == 10
    assert training_windows(docs.repartition(7), QUICK) == seen


def test_awkward_rows(spark):
    rows = identify(edge_docs(spark), QUICK).collect()
    assert len(rows) == len(EDGES)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert by_id[4] == by_id[5] == by_id[6] == [("und", 0.0)]
    assert len(by_id[1]) == 2 and by_id[1][0] == by_id[1][1]  # a repeated row
    assert ("und", 0.0) in by_id[None] and all(r.held_out for r in rows if r.doc_id is None)
    learned = set(fit(edge_docs(spark), QUICK).languages)
    assert {r.lang_pred for r in rows} - {"und"} <= learned
    signs = docs_of(spark, [(1, "123 #$% ..."), (2, "ǆ ª 日"), (8, "word word word word")])
    assert {r.doc_id: r.lang_pred == "und" for r in identify(signs, QUICK).collect()} == {1: True, 2: False, 8: False}


def test_nothing_to_learn_from(spark):
    assert identify(empty_docs(spark), QUICK).collect() == []
    nameless = docs_of(spark, [(1, "some text"), (3, "more text")]).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {(r.lang_pred, r.score) for r in identify(nameless, QUICK).collect()} == {("und", 0.0)}


def test_reruns_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    a, b = ({(r.doc_id, r.lang_pred, r.score) for r in identify(d, QUICK).collect()} for d in (docs, docs.repartition(5)))
    assert a == b
