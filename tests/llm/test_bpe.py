from __future__ import annotations

import gc
import hashlib
import random
import weakref
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from riskpanel.llm import bpe
from riskpanel.llm.common import text_slices
from riskpanel.llm.token_counts import CountConfig, count_tokens, frequent_lengths
from tests.llm.frames import EDGES, SMALL, docs_of, edge_docs, empty_docs, rows_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
LETTERS = [chr(c) for c in [*range(0x250), 0x1680, 0x180E, 0x200B, 0x2028, 0x3000, 0x4E00, 0x416, 0x1F600, 0x200D, 0x661, 0xBD, 0xFEFF, 0x10FFFF]]


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Encoder(file.read())


def ids_of(raw: bytes) -> list[int]:
    return np.frombuffer(raw, np.uint32).tolist()


def hard_texts() -> list[str]:
    rng = random.Random(11)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "", " " * 500 + "x", "\n" * 700]
    return texts + ["a" * 5000, "ab" * 20_000, "é" * 3000, "I'll can't 'S's 'd", "x\x1c \x85y", "日本" * 900]


def test_ids_and_texts_equal_the_library(own):
    texts = hard_texts()
    expected = LIBRARY.encode_batch(texts, add_special_tokens=False)
    for text, raw, ref in zip(texts, own.encode(texts), expected):
        assert ids_of(raw) == ref.ids, text[:50]
        assert own.decode(raw) == LIBRARY.decode(ref.ids, skip_special_tokens=False)


def test_rows_and_lists_build_the_same_tree(own):
    rng = random.Random(4)
    for n in (2, 3, 4, 5, 8, 9, 16, 31, 64):
        tokens = ["".join(rng.choice("etaoinsh ") for _ in range(n)) for _ in range(50)]
        many = own.encode_tokens(tokens)
        assert all(many[t] == own._merge_long(t.encode()) for t in tokens)


def test_decoding_ids_that_are_no_text(own):
    ids = LIBRARY.encode("日本é", add_special_tokens=False).ids
    for cut in range(len(ids)):
        part = ids[cut:] + [50256]
        assert own.decode(np.array(part, np.uint32).tobytes()) == LIBRARY.decode(part, skip_special_tokens=False)


def test_a_full_cache_changes_nothing(own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 0)
    fresh = bpe.Encoder(open(PATH, encoding="utf-8").read())
    texts = ["some words and more words"] * 3 + hard_texts()[:50]
    assert list(fresh.encode(texts)) == list(own.encode(texts)) and not fresh.cache


def digest(values: bytes) -> str:
    return hashlib.sha256(values).hexdigest()


def expected_digests(text: str | None) -> tuple:
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    return len(ids), digest(np.array(ids, "<u4").tobytes()), digest(decoded.encode()), decoded == (text or "")


def test_digests_of_the_smallest_tables(spark):
    got = {r[0]: tuple(r)[1:] for r in bpe.encoding_digests(spark.read.parquet(f"{SMALL}/documents.parquet"), PATH).collect()}
    assert got == {i: expected_digests(t) for i, t in rows_of(SMALL, "SELECT doc_id, text FROM documents")}


def test_awkward_rows(spark):
    got = sorted(map(tuple, bpe.encoding_digests(edge_docs(spark), PATH).collect()), key=str)
    assert got == sorted(((row[0], *expected_digests(row[1])) for row in EDGES), key=str)
    full = bpe.encode_documents(docs_of(spark, [(1, "a b<|endoftext|>"), (2, None)]), PATH).collect()
    assert {r.doc_id: (r.ids, r.decoded) for r in full} == {1: (LIBRARY.encode("a b<|endoftext|>").ids, "a b<|endoftext|>"), 2: ([], "")}
    assert bpe.encoding_digests(empty_docs(spark), PATH).count() == 0


@pytest.mark.parametrize("config", [CountConfig(), CountConfig(entries=3, sample_documents=2, limit=3), CountConfig(entries=0)])
def test_counts(spark, config):
    rows = [(i, t) for i, t in enumerate([*hard_texts()[:200], "<|endoftext|>" * 4, None])]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs_of(spark, rows), PATH, config).collect()}
    for i, text in rows:
        n = len(LIBRARY.encode(text or "", add_special_tokens=False).ids)
        assert got[i] == (len((text or "").encode()), n, n > config.limit)


def test_counts_of_awkward_rows(spark):
    got = sorted(((r.doc_id, r.n_tokens) for r in count_tokens(edge_docs(spark), PATH).collect()), key=str)
    assert got == sorted(((row[0], expected_digests(row[1])[0]) for row in EDGES), key=str)
    assert count_tokens(empty_docs(spark), PATH).count() == 0


def test_the_frequent_table_is_of_all_rows_not_of_the_first(spark):
    """Rows sorted by language: the words of the last one are in the table as well."""
    rows = [(i, " ".join([f"{lang}word"] * 30)) for lang in ("aa", "bb", "cc") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    vocab = bpe.vocabulary(spark, PATH)
    names, _ = frequent_lengths(docs, vocab, CountConfig(sample_documents=60))
    assert all(word in names.decode() for word in ("aaword", "bbword", "ccword"))
    long = spark.createDataFrame([(1, "head " * 10_000 + "tail " * 10_000)], "doc_id bigint, text string")
    assert frequent_lengths(long, vocab, CountConfig(sample_bytes=200))[0]
    assert frequent_lengths(long.limit(0), vocab, CountConfig()) == (b"", b"")


def test_nothing_stays_with_a_worker_and_a_batch_is_taken_in_slices(monkeypatch):
    """An encoder that outlived its task, and a whole batch as texts, took an executor's memory through later stages."""
    monkeypatch.setattr(bpe, "vocabulary", lambda spark, path: SimpleNamespace(value=open(path, encoding="utf-8").read()))
    encoders, at_once = weakref.WeakSet(), []
    build, encode = bpe.Encoder.__init__, bpe.Encoder.encode
    monkeypatch.setattr(bpe.Encoder, "__init__", lambda self, content: encoders.add(self) or build(self, content))
    monkeypatch.setattr(bpe.Encoder, "encode", lambda self, texts: at_once.append(sum(map(len, texts))) or encode(self, texts))
    docs = SimpleNamespace(sparkSession=None, schema=StructType([StructField("doc_id", LongType())]), mapInArrow=lambda run, schema: run)
    docs.select = lambda *columns: docs
    text = "some words of a text, " * 1000
    texts = [text, None, ""] * 100 + ["x" * 3 * bpe.GROUP] + [text] * 10
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})

    def batches():
        assert not encoders  # the JVM needs its buffers meanwhile
        yield batch
        yield batch.slice(0, 0)

    out = pa.Table.from_batches(bpe.encoding_digests(docs, PATH)(batches()))
    gc.collect()
    assert not encoders
    assert len(at_once) > 3 and sorted(at_once)[-2] <= bpe.GROUP + len(text)
    assert out.column("doc_id").to_pylist() == list(range(len(texts)))
    known = {t: expected_digests(t) for t in set(texts)}
    assert list(zip(*out.to_pydict().values())) == [(i, *known[t]) for i, t in enumerate(texts)]


def test_rows_merged_at_a_time_are_bounded_in_bytes(own, monkeypatch):
    sizes, merge = [], bpe.Encoder._merge_rows
    monkeypatch.setattr(bpe.Encoder, "_merge_rows", lambda self, tokens, bits: sizes.append(len(tokens) << bits) or merge(self, tokens, bits))
    tokens = [f"{i:060d}" for i in range(3000)]
    assert own.encode_tokens(tokens) == {t: np.array(LIBRARY.encode(t).ids, np.uint32).tobytes() for t in tokens}
    assert max(sizes) <= 1 << 16


def test_slices_of_a_batch():
    texts = ["ab", None, "é", "", "abcdefghij", "a", None]
    batch = pa.RecordBatch.from_pydict({"n": list(range(7)), "text": texts})
    slices = [s.column("text").to_pylist() for s in text_slices(batch, 4)]
    assert slices == [["ab", None, "é"], ["", "abcdefghij"], ["a", None]]
    nulls = pa.RecordBatch.from_arrays([pa.nulls(3, pa.string())], names=["text"])
    assert [s.num_rows for s in text_slices(nulls, 4)] == [3] and not list(text_slices(nulls.slice(0, 0), 4))
