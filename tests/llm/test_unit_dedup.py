from __future__ import annotations

import random

import pytest

from riskpanel.llm.unit_dedup import UnitConfig, cut_words, remove_repeats, repeated_units
from tests.llm import brute
from tests.llm.frames import COLUMNS as DOCUMENTS
from tests.llm.frames import EDGES, SMALL, docs_of, edge_docs, empty_docs, rows_of, text

COLUMNS = ["doc_id", "start", "end", "words", "kept_doc_id", "kept_start"]


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def kept(df):
    return {r.doc_id: r.text for r in df.collect()}


def sentences(seed: int, n: int, words: int = 9) -> str:
    return " ".join(text(seed * 1000 + i, words) + random.Random(seed + i).choice([".", ",", "!", ";"]) for i in range(n))


def test_smallest_tables(spark):
    docs = rows_of(SMALL, "SELECT doc_id, text FROM documents")
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found(repeated_units(frame)) == sorted(brute.removed_passages(docs), key=str)
    plain = brute.without_passages(docs)
    assert {(r.doc_id, " ".join(brute.words(r.text))) for r in remove_repeats(frame).collect()} == {(i, t) for (i, _), t in plain.items()}


def test_offsets_point_at_the_removed_text(spark):
    shared = sentences(5, 8)
    docs = [(1, f"first é\n{shared}\nlast"), (2, f"日本 other\n\n  {shared.upper()}\t\nend"), (3, f"{shared}\n{shared}\nmine {text(6, 30)}")]
    rows = repeated_units(docs_of(spark, docs)).collect()
    by_id = dict(docs)
    for r in rows:
        removed = " ".join(by_id[r.doc_id][r.start : r.end].lower().split())
        assert removed in (shared, f"{shared} {shared}") and r.words == len(removed.split())
        assert by_id[r.kept_doc_id][r.kept_start :].startswith(shared)
    assert {(r.doc_id, r.kept_doc_id) for r in rows} == {(2, 1), (3, 1)}
    got = {r.doc_id: (r.text, r.n_chars) for r in remove_repeats(docs_of(spark, docs)).collect()}
    assert got[1] == (docs[0][1], len(docs[0][1]))
    assert got[2] == ("日本 other\n\n  end", 15)
    assert got[3][0] == f"mine {text(6, 30)}"


def test_a_passage_inside_a_line_across_lines_and_of_short_lines(spark):
    inside = f"{text(40, 7)} {sentences(41, 5)} {text(42, 8)}"  # begins and ends inside a sentence
    across = f"{text(43, 4)}\n{sentences(44, 3)}\n{sentences(45, 3)} {text(46, 3)}"
    short = "\n".join(text(600 + i, 2 + i % 3) for i in range(20))  # no line has five words
    docs = [
        (1, f"{text(50, 30)} {inside} {text(51, 9)}\n{text(52, 5)} {across} {text(53, 8)}\n{short}\n{text(54, 10)}"),
        (2, f"own words {inside.upper()} more of it\nlast"),
        (3, f"first\nown {across} end"),
        (4, f"head\n{short}\ntail"),
        (5, f"quite another {sentences(41, 5)} text"),  # 45 words of it stay
    ]
    assert found(repeated_units(docs_of(spark, docs))) == sorted(brute.removed_passages(docs), key=str)
    got = kept(remove_repeats(docs_of(spark, docs)))
    assert got[1] == docs[0][1] and got[5] == docs[4][1]
    assert got[2].split() == "own words more of it last".split()
    assert got[3].split() == "first own end".split() and got[4].split() == ["head", "tail"]


def test_runs_that_grow_far_and_texts_that_repeat_themselves(spark):
    flat = text(70, 700)  # no unit but the line: it is found by the sentence in it and grows to both ends
    middle = f"{text(71, 300)} {sentences(72, 1)} {text(73, 400)}"
    docs = [
        (1, f"{middle} x1"), (2, f"{text(74, 40)} {middle} x2"), (3, flat), (4, flat),
        (5, ("junk " * 200).strip()), (6, "junk.\n" * 200), (7, f"{sentences(75, 6)} " * 3),
    ]
    for config in (UnitConfig(), UnitConfig(edge_words=1), UnitConfig(least_words=30, seed_words=2)):
        plain = brute.removed_passages(docs, least=config.least_words, seed=config.seed_words)
        assert found(repeated_units(docs_of(spark, docs), config)) == sorted(plain, key=str)


def test_pieces_of_one_text_in_several(spark):
    rng = random.Random(9)
    parts = [sentences(80 + i, 3, 6) for i in range(12)]
    docs = [(i, " ".join(rng.sample(parts, 5)) + f" own{i}") for i in range(25)]
    assert found(repeated_units(docs_of(spark, docs))) == sorted(brute.removed_passages(docs), key=str)


def test_short_runs_stay(spark):
    shared = sentences(7, 5)
    docs = [(i, f"{shared} {text(i + 50, 40)}") for i in range(4)]
    assert repeated_units(docs_of(spark, docs)).count() == 0
    assert repeated_units(docs_of(spark, docs), UnitConfig(least_words=45)).count() == 3
    with pytest.raises(ValueError):
        UnitConfig(least_words=0)


def test_awkward_rows(spark):
    more = [(-1, LONG_COPY, None, None, None), (None, LONG_COPY, None, None, None), (-2, LONG_COPY, "en", "b", 3)]
    docs = edge_docs(spark).unionByName(spark.createDataFrame(more, DOCUMENTS), allowMissingColumns=True)
    rows = [(i, t) for i, t, *_ in EDGES + more]
    assert found(repeated_units(docs)) == sorted(brute.removed_passages(rows), key=str)
    cut = remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    plain = brute.without_passages(rows)
    got = sorted(((r.doc_id, None if r.text is None else " ".join(brute.words(r.text))) for r in cut.collect()), key=str)
    assert got == sorted(((i, plain.get((i, t))) for i, t in rows), key=str)
    assert (2, "") in got and (-2, " ".join(brute.words(LONG_COPY))) in got and (-1, "") in got


LONG_COPY = sentences(60, 3000)


def test_one_text_under_negative_and_null_ids(spark):
    same = sentences(61, 10)
    docs = spark.createDataFrame([(-2, same), (-1, same), (None, same), (5, "other")], "doc_id bigint, text string")
    assert sorted(map(tuple, remove_repeats(docs).collect()), key=str) == sorted([(-2, same), (-1, ""), (None, ""), (5, "other")], key=str)


def test_empty(spark):
    assert repeated_units(empty_docs(spark)).count() == 0 and remove_repeats(empty_docs(spark)).count() == 0


def test_a_gap_stays_between_what_remains():
    assert cut_words("a b\nc d e", [(1, 1), (2, 2)]) == "a e"
    assert cut_words("  a b", [(0, 2)]) == "" and cut_words("a b c", [(0, 1), (2, 1)]) == "b"


def test_no_passage_of_another_document_is_left_in_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")

    def repeats(df):
        seen, n = {}, 0
        for r in sorted(df.collect(), key=lambda r: r.doc_id):
            found = [w.lower() for w in brute.words(r.text)]
            for key in {tuple(found[i : i + 50]) for i in range(len(found) - 49)}:
                n += seen.setdefault(key, r.doc_id) != r.doc_id
        return n

    before, after = repeats(docs), repeats(remove_repeats(docs))
    assert before > 0 and after <= 0.02 * before
