"""The pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from riskpanel.llm.queries import oracle_sql, queries
from tests.llm import brute
from tests.llm.frames import SMALL, edge_docs, empty_docs, rows_of

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
STAGES = dict(corpus_pipeline.STAGES)


def test_stages_are_the_given_ones_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "substring dedup", "mixing sources", "BPE encoding and decoding",
    ]
    assert len(queries()) == 13 and set(oracle_sql()) <= set(queries())


def as_rows(df) -> list[tuple]:
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def plain_cut(docs: list[tuple]) -> list[tuple]:
    """The words that stay, joined by blanks."""
    left = brute.without_passages([(i, t) for i, t, _ in docs])
    return [(i, left[i, text], source) for i, text, source in docs]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_every_stage_on_what_the_one_before_kept(staged):
    documents = rows_of(SMALL, "SELECT doc_id, text, source FROM documents")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(df.columns == columns for df in staged[:-1])

    def failed(text: str) -> bool:
        s = brute.rule_statistics(text)
        return s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]

    good = as_rows(staged[0])  # too few labels here for any cutoff
    assert Counter(good) == Counter(d for d in documents if not failed(d[1]))

    joined = brute.ngram_join([(i, t) for i, t, _ in good])
    unique = as_rows(staged[1])
    assert Counter(unique) == Counter(d for d in good if joined[d[0]][1] == d[0])

    cut = as_rows(staged[2])
    assert Counter((i, " ".join(brute.words(text)), source) for i, text, source in cut) == Counter(
        (i, " ".join(text.split()), source) for i, text, source in plain_cut(unique)
    )
    assert all(r.n_chars == len(r.text) for r in staged[2].collect())

    mixed, sizes = as_rows(staged[3]), Counter()
    for _, text, source in cut:
        sizes[source] += len(brute.words(text))
    assert set(mixed) <= set(cut) and max(Counter(mixed).values()) <= 2
    targets, copies = brute.targets(sizes), Counter(mixed)
    for source, target in targets.items():
        own = [(len(brute.words(d[1])), copies[d]) for d in cut if d[2] == source]
        taken, whole = sum(n * c for n, c in own), int(target / sizes[source] + 1e-9)
        left_out = [n for n, c in own if n and c == whole < 2]
        assert taken <= target + 1e-6 and (not left_out or min(left_out) > int(target) - taken)  # nothing left fits

    def digests(text: str) -> tuple:
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    last = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in staged[4].collect())
    assert last == Counter((i, *digests(t)) for i, t, _ in mixed)


def test_run_gives_the_last_stage(spark, staged):
    assert Counter(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == Counter(map(tuple, staged[4].collect()))


@pytest.mark.parametrize("name", STAGES)
def test_each_stage_takes_awkward_and_empty_input(spark, name):
    for docs in (edge_docs(spark), empty_docs(spark)):
        out = STAGES[name](spark, docs, SMALL)
        rows = out.count()
        if name != "BPE encoding and decoding":
            assert out.columns == docs.columns
        assert rows <= 2 * docs.count()
