from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from riskpanel.llm.collocations import Automaton, PhraseConfig, summed, top_phrases
from tests.llm import brute
from tests.llm.frames import COLUMNS, EDGES, SMALL, docs_of, edge_docs, empty_docs, rows_of

ORDER = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def got(df):
    return sorted(tuple(r[c] for c in ORDER) for r in df.collect())


def small_config(**how):
    return PhraseConfig(**{"least": 3, "top": 50, "least_ranges": 5, "shard_words": 300, "rows_per_task": 20} | how)


def mixture(seed, n, words="abcdefgh"):
    rng = random.Random(seed)
    return [
        (i, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", " ,"]) for _ in range(rng.randint(0, 40))), "s", rng.choice(["en", "de"]))
        for i in range(n)
    ]


def test_equals_the_plain_version(spark):
    rows = mixture(1, 150)
    expected = brute.collocations([(r[3], r[1]) for r in rows], 3, 50)
    assert got(top_phrases(docs_of(spark, rows), small_config())) == expected
    # cut in several steps, with a filter so small that most passes
    assert got(top_phrases(docs_of(spark, rows), small_config(least_ranges=30, fan=3, filter_bits=64))) == expected


def test_smallest_tables(spark):
    docs = rows_of(SMALL, "SELECT lang, text FROM documents")
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert got(top_phrases(frame, PhraseConfig(least=5, top=100))) == brute.collocations(docs, 5, 100)


def test_phrases_of_one_word_repeated_and_of_other_lengths(spark):
    rows = [(1, "Na na NA na na na batman"), (2, "na na; na na\nna"), (3, "new york city. new york city"), (4, "new york"), (5, "the city")]
    for longest in (2, 5):
        expected = brute.collocations([("en", t) for _, t in rows], 2, 50, longest)
        assert expected and got(top_phrases(docs_of(spark, rows), small_config(least=2, longest=longest))) == expected


def test_only_the_longest_phrase_with_as_many_occurrences_stays(spark):
    rows = [(i, f"x{i} one two three four five y{i}") for i in range(4)] + [(9, "two three")]
    found = got(top_phrases(docs_of(spark, rows), small_config()))
    assert [r[2] for r in found] == ["one two three four five", "two three"]


def test_awkward_rows(spark):
    nameless = [(70 + i, "no language here", None, None, 1) for i in range(3)]
    expected = brute.collocations([(lang, t) for _, t, lang, *_ in EDGES + nameless], 2, 50)
    docs = edge_docs(spark)
    both = docs.unionByName(spark.createDataFrame(nameless, COLUMNS), allowMissingColumns=True)
    assert got(top_phrases(both, small_config(least=2))) == expected
    assert any(r[0] == "und" for r in expected)
    assert top_phrases(empty_docs(spark), small_config()).collect() == []
    assert top_phrases(docs_of(spark, [(1, None), (2, ""), (3, " .,;\n")]), small_config()).collect() == []


def test_a_hot_pair_and_many_languages(spark):
    rng = random.Random(5)
    rows = [(i, f"hot pair w{rng.randint(0, 30)} hot pair", "s", f"l{i % 40}") for i in range(400)]
    expected = brute.collocations([(r[3], r[1]) for r in rows], 3, 50)
    assert got(top_phrases(docs_of(spark, rows), small_config())) == expected


def test_products_beyond_64_bits_are_exact():
    from riskpanel.llm.collocations import best_cuts
    import pyarrow as pa

    a, n = 10**9 + 7, 10**13 + 1
    parts = [{"k": 1, "side": 0, "f": 10**12 + 3}, {"k": 1, "side": 1, "f": 10**10 + 9}]
    batch = pa.RecordBatch.from_pylist([{"lang": "en", "phrase": "a b", "a": a, "parts": parts, "n": n}])
    row = next(best_cuts(iter([batch]))).to_pylist()[0]
    assert row["score"] == 1000 * a * n // ((10**12 + 3) * (10**10 + 9)) and (row["l"], row["r"]) == (10**12 + 3, 10**10 + 9)


def test_automata_hold_what_they_were_built_from():
    rng = random.Random(2)
    words = [f"w{i}".encode() for i in range(12)]
    every = Counter()
    for _ in range(400):
        m = rng.randint(1, 4)
        every[tuple([rng.randrange(12) for _ in range(m)] + [-1] * (4 - m))] += rng.randint(1, 3)
    grams, counts = summed(np.array(list(every), np.int32), np.array(list(every.values()), np.int64))
    one = Automaton.unpacked(*Automaton.build(words, grams, counts).packed())
    found, weights = one.grams()
    names = [words.index(w) for w in one.words]
    assert {tuple(names[i] if i >= 0 else -1 for i in g): w for g, w in zip(found.tolist(), weights.tolist())} == every
    back = {n: i for i, n in enumerate(names)}
    for g, n in every.items():
        assert one.weight([back[x] for x in g if x >= 0]) == n
    assert one.weight([0, 0, 0, 0, 0]) == 0


def test_equal_ends_are_one_state():
    words = [b"a", b"b", b"c", b"x", b"y"]
    grams = np.array([[i, 3, 4] for i in range(3)], np.int32)
    one = Automaton.build(words, grams, np.array([7, 7, 7]))
    assert [len(sizes) for sizes, *_ in one.levels] == [2, 2, 2]  # the empty state and one other in each level
    assert sum(len(label) for _, label, *_ in one.levels) == 3 + 1 + 1


def test_sizes_are_checked():
    with pytest.raises(ValueError):
        PhraseConfig(longest=1)
