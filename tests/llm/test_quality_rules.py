from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskpanel.llm import quality_rules as qr
from tests.llm import brute
from tests.llm.frames import EDGES, SMALL, docs_of, edge_docs, empty_docs, labels_of, rows_of

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_statistics_equal_the_plain_version_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in qr.with_statistics(docs).select("doc_id", *COUNTS).collect()}
    expected = {i: tuple(brute.rule_statistics(t)[c] for c in COUNTS) for i, t in rows_of(SMALL, "SELECT doc_id, text FROM documents")}
    assert got == expected


def test_statistics_of_awkward_texts(spark):
    got = sorted(tuple(r[c] for c in COUNTS) for r in qr.with_statistics(edge_docs(spark).drop("n_words")).collect())
    assert got == sorted(tuple(brute.rule_statistics(row[1])[c] for c in COUNTS) for row in EDGES)


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a", "a b a b a", "x", "", "a b c d\na b c d\n\na b c d", "a b c x a b c a b"])
def test_repeated_windows(spark, text):
    row = qr.with_statistics(docs_of(spark, [(1, text)])).first()
    assert {c: row[c] for c in COUNTS} == brute.rule_statistics(text)


@pytest.mark.parametrize("k, n, rate", [(0, 10, 0.1), (3, 100, 0.05), (40, 1000, 0.05), (4, 2000, 0.005), (1, 1, 0.5)])
def test_binomial_tail(spark, k, n, rate):
    frame = spark.createDataFrame([(k, n)], "k bigint, n bigint").select(qr.binomial_tail("k", "n", rate).alias("p"))
    expected = brute.binomial_tail(k, n, rate) if k <= rate * n else 1.0
    assert frame.first().p == pytest.approx(expected, rel=1e-9)


def measured(spark, rows):
    """(doc_id, symbols per 1000 words)"""
    full = [(i, "en", 1000, 5000, s, 0, 0, 10) for i, s in rows]
    names = "doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint"
    return spark.createDataFrame(full, names)


CONFIG = qr.RuleConfig(cutoffs={"symbols": (900, 500, 100)}, languages=("en",), alpha=0.05, delta=0.1)


def test_cutoffs_stop_at_the_first_failure(spark):
    # 400 good documents, 60 of them above 100 symbols: 500 is proven, 100 is not
    docs = measured(spark, [(i, 200 if i < 60 else 10) for i in range(400)])
    labels = labels_of(spark, [(i, 1) for i in range(400)])
    good = docs.withColumn("stratum", F.lit("en"))
    tested = {r.cutoff: (r.k, r.passes) for r in qr.tested_cutoffs(good, CONFIG).collect()}
    assert tested == {900: (0, True), 500: (0, True), 100: (60, False)}
    assert qr.select_cutoffs(good, CONFIG).first().cut_symbols == 500
    bad = measured(spark, [(1000, 600), (1001, 400)])
    kept = {r.doc_id: r.kept for r in qr.judge(docs.union(bad), labels, CONFIG).collect()}
    assert not kept[1000] and kept[1001] and all(kept[i] for i in range(400))


def test_too_few_labels_reject_nothing(spark):
    docs = measured(spark, [(i, 990) for i in range(20)])
    labels = labels_of(spark, [(i, 0) for i in range(10)] + [(10, 1)])
    assert all(r.kept for r in qr.judge(docs, labels, CONFIG).collect())


def test_false_rejections_are_limited_in_each_stratum(spark):
    got = qr.quality_rules(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").filter("quality = 1")
    shares = got.filter("NOT base_failed").join(labels, "doc_id").groupBy("stratum").agg(F.avg((~F.col("kept")).cast("int")).alias("lost"))
    assert all(r.lost <= qr.RuleConfig().alpha for r in shares.collect())


def test_awkward_rows_and_clashing_columns(spark):
    labels = labels_of(spark, [(1, 1), (1, 0), (None, 1), (8, None), (2, 1)])
    got = qr.quality_rules(edge_docs(spark), labels).collect()
    assert len(got) == len(EDGES)
    for row in got:
        assert row.base_failed == (row.n_words < 50 or 2 * row.n_repeat_words > row.n_words)
        assert row.kept != row.base_failed
    docs = edge_docs(spark)
    kept = qr.keep_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_empty_tables(spark):
    none = labels_of(spark, [])
    assert qr.quality_rules(empty_docs(spark), none).count() == 0
    assert qr.quality_rules(edge_docs(spark), none).count() == len(EDGES)
    assert qr.keep_documents(empty_docs(spark), none).count() == 0
