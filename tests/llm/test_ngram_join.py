from __future__ import annotations

import random

import pytest

from riskpanel.llm.components import components
from riskpanel.llm.ngram_join import JoinConfig, keep_first_of_each, ngram_join, shingle_set
from tests.llm import brute
from tests.llm.frames import EDGES, SMALL, docs_of, edge_docs, empty_docs, prose, rows_of, text


def found(df) -> dict:
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_smallest_tables(spark):
    docs = rows_of(SMALL, "SELECT doc_id, text FROM documents")
    assert found(ngram_join(spark.read.parquet(f"{SMALL}/documents.parquet"))) == brute.ngram_join(docs)


def near_copies(seed: int, base: list[str], n: int, edits: int) -> list[list[str]]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(10**6)}"
        out.append(copy)
    return out


def corpus(seed: int) -> list[tuple[int, str]]:
    """Groups around the threshold, chains, a passage in many texts, short and empty texts, copies."""
    rng, texts = random.Random(seed), []
    for g in range(6):
        texts += near_copies(g + seed, prose(100 * seed + g, rng.randint(20, 120)), 12, 4)
    chain = prose(seed + 7, 90)
    for _ in range(15):
        chain = chain[3:] + prose(rng.randrange(10**6), 3)  # each like the next, ends unlike
        texts.append(chain)
    passage = prose(seed + 8, 60)
    texts += [passage + prose(rng.randrange(10**6), rng.randint(5, 60)) for _ in range(40)]
    texts += [["a"], ["A"], ["a", "b"], [], [], ["a", "b", "c", "d", "e"], ["x"] * 50]
    texts += texts[:5]
    rng.shuffle(texts)
    return [(3 * i + 1, rng.choice([" ", "\n", " \t "]).join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("config", [JoinConfig(), JoinConfig(chunk_shingles=500, fragment_shingles=300, segments=3, pairs_per_bucket=10, sketches=1)])
def test_links_and_chains_with_small_and_large_tasks(spark, seed, config):
    docs = corpus(seed)
    assert found(ngram_join(docs_of(spark, docs), config)) == brute.ngram_join(docs)


def test_links_that_no_leader_finds(spark):
    """With a single sketch many links are left to the prefix filter."""
    docs = [(i, " ".join(c)) for i, c in enumerate(near_copies(5, prose(5, 80), 60, 3))]
    assert found(ngram_join(docs_of(spark, docs), JoinConfig(sketches=1))) == brute.ngram_join(docs)


def test_only_ascii_letters_are_lowered_and_only_ascii_space_separates(spark):
    docs = [(1, "A b c d e"), (2, "a B C D E"), (3, "É b c d e"), (4, "é b c d e"), (5, "a b c d e"), (6, "a\x1cb c d e f")]
    assert found(ngram_join(docs_of(spark, docs))) == brute.ngram_join(docs)
    assert len(shingle_set("a b c d e f".encode(), 5)) == 2


def test_awkward_rows(spark):
    got = ngram_join(edge_docs(spark)).collect()
    assert len(got) == len(EDGES)
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None}
    assert by_id == brute.ngram_join([(i, t) for i, t, *_ in EDGES if i is not None])
    assert all(r.component_id is None for r in got if r.doc_id is None)
    docs = edge_docs(spark)
    kept = keep_first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, c in by_id.values()})
    assert kept.filter("doc_id IS NULL").count() == 2
    assert ngram_join(empty_docs(spark)).count() == 0 and keep_first_of_each(empty_docs(spark)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 150), (150, 300)]
    links += [(400, 400 + i) for i in range(1, 30)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    expected = {i: 0 for i in range(61)} | {100: 100, 101: 100, 150: 150, 200: 150, 300: 150} | {400 + i: 400 for i in range(30)}
    assert got == expected
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_equal_texts_and_no_others(spark):
    docs = [(i, text(i % 3, 50)) for i in range(12)]
    assert found(ngram_join(docs_of(spark, docs))) == {i: (46, i % 3) for i in range(12)}


def test_only_the_linked_row_of_an_id_goes(spark):
    a, b, c = text(60, 60), text(61, 60), text(62, 60)
    docs = [(1, a), (2, a), (2, b), (3, b), (4, c), (4, c), (4, None), (None, c), (None, text(63, 60)), (None, text(63, 60))]
    kept = sorted(((r.doc_id, r.text) for r in keep_first_of_each(docs_of(spark, docs)).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (4, c), (4, None), (None, text(63, 60))], key=str)
