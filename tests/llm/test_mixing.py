from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskpanel.llm.mixing import MixConfig, mix_documents, mix_sources, sized, source_targets
from tests.llm import brute
from tests.llm.frames import EDGES, SMALL, docs_of, edge_docs, empty_docs, rows_of, text


def check_mix(got, docs: list[tuple]) -> None:
    """Targets as shared by hand, at most two copies, and no document left that fits under its source's target."""
    sizes = Counter()
    for _, body, source in docs:
        sizes[source] += len(brute.words(body))
    targets = brute.targets(sizes)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(brute.words(t))) for i, t, _ in docs)
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    assert len(set(sizes.values())) == len(sizes)  # so a size names its source
    for source, size in sizes.items():
        rows = [r for r in got if r.source_size == size]
        target, taken = targets[source], sum(r.taken for r in rows)
        assert all(r.target == pytest.approx(target) for r in rows) and taken <= target + 1e-6
        whole = int(target / size + 1e-9) if size else 0
        left_out = [r["size"] for r in rows if 0 < r["size"] and r.taken == whole * r["size"] and whole < 2]
        assert not left_out or min(left_out) > int(target) - taken


def test_smallest_tables(spark):
    got = mix_sources(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    check_mix(got, rows_of(SMALL, "SELECT doc_id, text, source FROM documents"))


def test_sources_at_their_cap_and_below(spark):
    docs = [(i, text(i, 5 + i % 60), f"s{i % 4 if i > 300 else 9}") for i in range(900)]
    got = mix_sources(docs_of(spark, docs)).collect()
    check_mix(got, docs)
    again = mix_sources(docs_of(spark, docs).repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_many_buckets_and_a_short_reach(spark):
    docs = [(i, text(i, 1 + i % 90), "one" if i % 3 else "two") for i in range(800)]
    config = MixConfig(weights=(1, 5), rows_per_bucket=5, reach=40, share=1.2)
    got = mix_sources(docs_of(spark, docs), config).collect()
    sizes = Counter()
    for _, body, source in docs:
        sizes[source] += len(brute.words(body))
    targets = brute.targets(sizes, share=1.2, cycle=(1, 5))
    taken = Counter()
    for (_, _, source), row in zip(docs, sorted(got, key=lambda r: r.doc_id)):
        taken[source] += row.taken
    assert all(targets[s] - 10 <= taken[s] <= targets[s] for s in sizes)


def test_a_document_above_the_quota_costs_nothing(spark):
    docs = [(i, text(i, 4), "a") for i in range(1, 5001)] + [(5003, text(0, 10_000), "a")]
    config = MixConfig(share=0.25)
    got = mix_sources(docs_of(spark, docs), config).collect()
    assert {r.target for r in got} == {7500.0} and sum(r.taken for r in got) == 7500
    assert Counter(map(tuple, got)) == Counter(map(tuple, mix_sources(docs_of(spark, docs), MixConfig(share=0.25, reach=1)).collect()))
    plain, left = {}, 7500  # the same order, one document after the other
    mean = 30_000 / 5001
    for i, body, _ in docs:
        u = (int(hashlib.md5(f"mix:{i}:{hashlib.md5(body.encode()).hexdigest()}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        plain[i] = u / (1 - u) / (0.25 / 0.75 * math.sqrt(len(brute.words(body)) / mean))
    taken = set()
    for i in sorted(plain, key=plain.get):
        size = 10_000 if i == 5003 else 4
        if size <= left:
            left -= size
            taken.add(i)
    assert {r.doc_id for r in got if r.taken} == taken


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "B", "é", "z", None]), st.integers(0, 1000), min_size=1))
def test_targets_equal_sharing_and_resharing(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r.target for r in source_targets(frame, MixConfig()).collect()}
    assert got == {s: pytest.approx(t, abs=1e-6) for s, t in brute.targets(sizes).items()}


def test_longer_documents_are_likelier(spark):
    docs = [(i, text(i, 100 if i % 2 else 10), "a") for i in range(600)]
    got = mix_sources(docs_of(spark, docs), MixConfig(share=0.5)).collect()
    share = {size: sum(r.taken > 0 for r in got if r["size"] == size) / 300 for size in (10, 100)}
    assert 0 < share[10] < share[100] < 1


def test_awkward_rows(spark):
    docs = edge_docs(spark)
    got = mix_sources(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(row[0] for row in EDGES)
    assert all(r.taken <= 2 * r["size"] and r.target <= 2 * r.source_size for r in got)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for row in mixed.collect():
        words[row.doc_id] += len(brute.words(row.text))
    taken = Counter()
    for row in got:
        taken[row.doc_id] += row.taken
    assert +words == +taken


def test_empty(spark):
    assert mix_sources(empty_docs(spark)).count() == 0
    assert mix_documents(empty_docs(spark)).count() == 0
    assert [r.taken for r in mix_sources(docs_of(spark, [(1, ""), (2, None)])).collect()] == [0, 0]


def test_one_text_under_negative_and_null_ids_keeps_its_rows_and_the_target(spark):
    docs = [(i, text(i, 10 + i % 13), "s") for i in range(1, 101)]
    same = [(None, text(500, 10 + i % 3), "s") for i in range(40)] + [(-1, text(500, 10 + i % 3), "s") for i in range(40)]
    frame = docs_of(spark, docs + same)
    config = MixConfig(share=0.2)
    rows = mix_sources(frame, config).collect()
    assert len(rows) == 180 and sum(r.taken for r in rows) <= int(0.2 * sum(r["size"] for r in rows))
    mixed = mix_documents(frame, config)
    assert mixed.columns == frame.columns and mixed.count() == sum(r.taken > 0 for r in rows)


def test_many_documents_without_an_id_draw_for_themselves(spark):
    frame = spark.range(20_000).selectExpr(
        "CAST(NULL AS BIGINT) AS doc_id", "concat_ws(' ', 'w', id, id * 7, id % 11) AS text", "'s' AS source"
    ).repartition(8)
    sizes = sized(frame, MixConfig())
    assert sizes.select("draw").distinct().count() == 20_000  # so no bucket of the rank order holds more than its share
    rows = mix_sources(frame, MixConfig(share=0.5)).agg({"taken": "sum", "target": "max"}).first()
    assert 0 <= rows["max(target)"] - rows["sum(taken)"] < 4


def test_equal_rows_go_together(spark):
    docs = [(7, text(1, 20), "s")] * 5 + [(i, text(i, 10), "s") for i in range(20, 40)]
    rows = mix_sources(docs_of(spark, docs), MixConfig(share=0.7)).collect()
    assert len({r.taken for r in rows if r.doc_id == 7}) == 1 and sum(r.taken for r in rows) <= 210
