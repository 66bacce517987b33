"""Exact Jaccard join of documents on word n-grams by vertical partitioning.

The n-grams of all documents have one global order, that of their 64-bit digests, and the
order is cut into fragments. Each fragment counts on its own, for the parts of the sets that
fall into it, and the counts are summed over the fragments:

1. *Shared n-grams per set.* A set can only link if at least 75 % of its n-grams occur in
   another set, so the sums leave few sets. Equal sets count as one from the start.
2. *Candidates.* The remaining sets meet by minimum digests; each meeting has one leader and
   only pairs with the leader are compared, so a group of copies costs one pair per copy.
3. *Partial overlaps.* For every candidate pair each fragment counts the common n-grams; the
   sum is the overlap, and the exact threshold decides. Linked sets form components.
4. *The rest.* Sets whose n-grams occur to 75 % in *other components* could still link across.
   They meet by their rarest n-grams (prefix filter), which misses no pair, and the same partial
   overlaps decide.

Digests are compared, not texts: two n-grams or two sets are taken for one another with a
probability of 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.functions import splittable_join
from riskpanel.llm.common import join_small, stored, tidy
from riskpanel.llm.components import components


@dataclass(frozen=True)
class JoinConfig:
    """Documents link if 100 * intersection >= percent * union of their sets of ``width`` words.

    The sizes bound what a task holds at once; larger ones suit larger executors and change no result.
    """

    width: int = 5
    percent: int = 75
    chunk_shingles: int = 750_000
    fragment_shingles: int = 1_500_000
    segments: int = 8
    pairs_per_bucket: int = 20_000
    sketches: int = 4


GOLDEN = 0x9E3779B97F4A7C15
FLAG = 0xFFFF  # owner of an n-gram that a chunk knows to be shared


def mixed(h: np.ndarray) -> np.ndarray:
    """Digests spread evenly over 64 bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct digests of the word n-grams; of the whole sequence if it has fewer words."""
    found = text.lower().split() if text else []  # on bytes both know ASCII only
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    span = min(width, len(w))
    h = w[: len(w) - span + 1].copy()
    for i in range(1, span):
        h = h * np.uint64(GOLDEN) + w[i : len(w) - span + 1 + i]
    return np.unique(mixed(h + np.uint64(span * 0x632BE59BD9B4E019 & (1 << 64) - 1)))


def set_id(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


PACKED = (
    "fragment bigint, chunk bigint, rest binary, owners binary, places binary, groups binary, "
    "docs array<bigint>, sets binary, sids binary, sizes binary"
)
ANSWERS = "chunk bigint, places binary, counts binary, docs array<bigint>, sets binary, sids binary, sizes binary"
COUNTED = "doc_id bigint, sid bigint, n bigint, shared bigint"


def pack_chunk(chunk: int, groups: list[int], sets: list[np.ndarray], fragments: int) -> tuple[list[dict], np.ndarray]:
    """Rows of the fragments for one chunk of different sets, and the shared n-grams per set that the chunk itself knows.

    An n-gram that the chunk holds in two groups is counted here and sent once, without its owners, so a
    frequent n-gram costs its fragment one entry per chunk.
    """
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    fragment = ((flat >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
    place = (fragment << np.uint64(32)) | (flat & np.uint64(0xFFFFFFFF))
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    first = starts(place)
    group = np.unique(np.array(groups, np.int64), return_inverse=True)[1][owner]
    shared = np.minimum.reduceat(group, first) != np.maximum.reduceat(group, first)
    in_shared = np.repeat(shared, np.diff(np.append(first, len(place))))
    counts = np.bincount(owner[in_shared], minlength=len(sets))
    owner[first[shared]] = FLAG
    kept = ~in_shared
    kept[first] = True
    place, owner = place[kept], owner[kept]
    all_groups, rows = np.array(groups, np.int64), []
    begin = starts(place >> np.uint64(32))
    for a, b in zip(begin, np.append(begin[1:], len(place))):
        owners, index = np.unique(owner[a:b], return_inverse=True)
        flagged = owners[-1] == FLAG
        real = owners[:-1] if flagged else owners
        index = index.astype(np.uint16)
        if flagged:
            index[owner[a:b] == FLAG] = FLAG
        rows.append({
            "fragment": int(place[a] >> np.uint64(32)), "chunk": chunk, "rest": place[a:b].astype(np.uint32).tobytes(),
            "owners": index.tobytes(), "places": real.tobytes(), "groups": all_groups[real].tobytes(),
        })
    return rows, counts


class Packer:
    """Gathers sets to chunks of bounded size and yields their rows.

    A chunk has a row of its own, under a fragment that no other row has: its documents, its sets and what it counted.
    """

    def __init__(self, fragments: int, chunk: int) -> None:
        self.fragments, self.chunk, self.schema = fragments, chunk, arrow_schema(PACKED)
        self.task, self.chunks = TaskContext.get().partitionId() if TaskContext.get() else 0, 0
        self.clear()

    def clear(self) -> None:
        self.sets, self.groups, self.size, self.docs = {}, [], 0, []

    def add(self, sid: int, group: int, shingles: np.ndarray) -> Iterator[pa.RecordBatch]:
        if sid not in self.sets:
            self.sets[sid] = shingles
            self.groups.append(group)
            self.size += len(shingles)
            if self.size >= self.chunk or len(self.sets) >= FLAG - 1:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.sets or self.docs:
            chunk = (self.task << 32) + self.chunks
            self.chunks += 1
            rows, counts = pack_chunk(chunk, self.groups, list(self.sets.values()), self.fragments) if self.sets else ([], np.empty(0))
            number = {sid: i for i, sid in enumerate(self.sets)}
            of = np.array([FLAG if sid is None else number[sid] for _, sid in self.docs], np.uint16)
            rows.append({
                "fragment": -1 - chunk, "chunk": chunk, "rest": counts.astype(np.int64).tobytes(), "docs": [d for d, _ in self.docs],
                "sets": of.tobytes(), "sids": np.array(list(self.sets), np.int64).tobytes(),
                "sizes": np.array([len(s) for s in self.sets.values()], np.int64).tobytes(),
            })
            yield pa.RecordBatch.from_pylist(rows, schema=self.schema)
        self.clear()


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def pack_documents(config: JoinConfig, fragments: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(fragments, config.chunk_shingles)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                shingles = shingle_set(text.as_py(), config.width)
                sid = set_id(shingles) if len(shingles) else None
                packer.docs.append((doc_id, sid))
                if sid is not None:
                    yield from packer.add(sid, sid, shingles)
                if len(packer.docs) >= FLAG:
                    yield from packer.flush()
        yield from packer.flush()

    return run


def pack_sets(config: JoinConfig, fragments: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(fragments, config.chunk_shingles)
        for batch in batches:
            for sid, group, shingles in zip(*(batch.column(c) for c in ("sid", "group", "shingles"))):
                yield from packer.add(sid.as_py(), group.as_py(), np.frombuffer(shingles.as_py(), np.uint64))
        yield from packer.flush()

    return run


def count_fragment(rows: pa.Table) -> pa.Table:
    """For each chunk, how many n-grams of this fragment its sets share with another group; a chunk's own row passes through.

    The answer is a place and a count for each set that shares something here, packed in one row per chunk.
    """
    schema = arrow_schema(ANSWERS)
    if rows.column("fragment")[0].as_py() < 0:
        return pa.table(
            [rows.column("chunk"), pa.nulls(rows.num_rows, pa.binary()), rows.column("rest"), *(rows.column(c) for c in schema.names[3:])],
            schema=schema,
        )

    def each(name: str, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(b, kind) for b in rows.column(name).to_pylist()]

    rest, owners, places, groups = each("rest", np.uint32), each("owners", np.uint16), each("places", np.uint16), each("groups", np.int64)
    flagged = np.concatenate(owners) == FLAG
    group = np.concatenate([np.append(g, 0)[np.minimum(o, len(g))] for o, g in zip(owners, groups)])
    every = np.concatenate(rest)
    order = np.argsort(every, kind="stable")
    first = starts(every[order])
    sorted_groups = group[order]
    shared = (np.minimum.reduceat(sorted_groups, first) != np.maximum.reduceat(sorted_groups, first)) | (
        np.maximum.reduceat(flagged[order], first)
    )
    hit = np.empty(len(every), bool)
    hit[order] = np.repeat(shared, np.diff(np.append(first, len(every))))
    hit &= ~flagged
    out, at = [], 0
    for chunk, o, p in zip(rows.column("chunk").to_pylist(), owners, places):
        counts = np.bincount(o[hit[at : at + len(o)]], minlength=len(p))
        at += len(o)
        some = np.flatnonzero(counts)
        if len(some):
            out.append({"chunk": chunk, "places": p[some].tobytes(), "counts": counts[some].astype(np.uint32).tobytes()})
    return pa.Table.from_pylist(out, schema=schema)


def sum_chunk(rows: pa.Table) -> pa.Table:
    """The counts of one chunk's sets over all fragments: a row per document, or per set if it has no documents."""
    schema = arrow_schema(COUNTED)
    head, shared = None, None
    for row in rows.to_pylist():
        if row["docs"] is not None:
            head, shared = row, np.frombuffer(row["counts"], np.int64).copy()
    for row in rows.to_pylist():
        if row["docs"] is None:
            shared[np.frombuffer(row["places"], np.uint16)] += np.frombuffer(row["counts"], np.uint32)
    sids, sizes = np.frombuffer(head["sids"], np.int64), np.frombuffer(head["sizes"], np.int64)
    if not head["docs"]:
        none = pa.nulls(len(sids), pa.int64())
        return pa.table([none, pa.array(sids), pa.array(sizes), pa.array(shared)], schema=schema)
    of = np.frombuffer(head["sets"], np.uint16).astype(np.int64)
    empty = of == FLAG
    of = np.where(empty, len(sids), of)
    columns = [pa.array(np.append(c, 0)[of], mask=m) for c, m in ((sids, empty), (sizes, None), (shared, None))]
    return pa.table([pa.array(head["docs"], pa.int64()), *columns], schema=schema)


def counted(packed: DataFrame) -> DataFrame:
    """(doc_id, sid, n, shared): per document of the packed chunks, or per set, the n-grams that another group holds as well."""
    return packed.groupBy("fragment").applyInArrow(count_fragment, ANSWERS).groupBy("chunk").applyInArrow(sum_chunk, COUNTED)


def build_sets(config: JoinConfig) -> Callable:
    """(sid, n, shingles, sketch): the set of each text and its minimum digests under several orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = [np.uint64(GOLDEN * (2 * k + 1) & (1 << 64) - 1) for k in range(config.sketches)]
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), config.width)
                if len(s):
                    sketch = [int(mixed(s * f).min().astype(np.int64)) for f in factors]
                    rows.append({"sid": set_id(s), "n": len(s), "shingles": s.tobytes(), "sketch": sketch})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema(SETS))

    return run


SETS = "sid bigint, n bigint, shingles binary, sketch array<bigint>"


def near_sizes(config: JoinConfig, a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= {config.percent} * greatest({a}, {b})"


def leader_pairs(sets: DataFrame, config: JoinConfig) -> DataFrame:
    """(a, b, na, nb): each set with the leaders of its meetings, one per order of the digests."""
    met = sets.select("sid", "n", F.posexplode("sketch").alias("order", "least"))
    leaders = met.groupBy("order", "least").agg(F.min(F.struct("sid", "n")).alias("leader"))
    return (
        splittable_join(met, leaders, ["order", "least"])
        .filter("sid <> leader.sid").filter(near_sizes(config, "n", "leader.n"))
        .select(F.col("sid").alias("a"), F.col("leader.sid").alias("b"), F.col("n").alias("na"), F.col("leader.n").alias("nb"))
        .distinct()
    )


def rare_digests(sets: DataFrame, config: JoinConfig) -> DataFrame:
    """(h, sid, n, group, s, rank, centrality): the digests by which every pair of different groups that can link must meet.

    Only digests that two groups hold can be common to a pair. With a set's s such digests in one order for all,
    rarest first, two sets that link share one of the first s - ceil(percent * n) + 1 of each. It stays true when
    groups are merged later.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sid, n, group, raw in zip(*(batch.column(c).to_pylist() for c in ("sid", "n", "group", "shingles"))):
                s = np.frombuffer(raw, np.int64)
                same = [np.full(len(s), x, np.int64) for x in (sid, n, group)]
                yield pa.RecordBatch.from_arrays([pa.array(s), *map(pa.array, same)], names=["h", "sid", "n", "group"])

    places = sets.select("sid", "n", "group", "shingles").mapInArrow(tidy(run), "h bigint, sid bigint, n bigint, group bigint")
    places = stored(places, "places")
    across = places.groupBy("h").agg(F.count(F.lit(1)).alias("held"), F.min("group").alias("low"), F.max("group").alias("high"))
    common = splittable_join(places, across.filter("low < high").select("h", "held"), ["h"])
    own = Window.partitionBy("sid")  # the digests of one set: bounded by its text
    ranked = common.withColumns(
        {
            "s": F.count(F.lit(1)).over(own),
            "centrality": F.sum("held").over(own),
            "rank": F.row_number().over(own.orderBy("held", "h")),
        }
    ).filter(f"rank <= s - ceil({config.percent} * n / 100) + 1")
    return ranked.select("h", "sid", "n", "group", "s", "rank", "centrality")


def meetings(rare: DataFrame, others: DataFrame, config: JoinConfig, once: bool) -> DataFrame:
    """(a, b, na, nb): pairs of sets of different groups that meet by a digest and could link.

    Two sets that link have at least o in common, so the first digest that both have is among the first s - o + 1 of
    each. ``once`` leaves out the pairs seen from their larger set.
    """
    b = others.withColumnsRenamed({c: f"b_{c}" for c in others.columns if c != "h"})
    alike = (
        f"{'sid < b_sid' if once else 'sid <> b_sid'} AND group <> b_group AND {near_sizes(config, 'n', 'b_n')} "
        f"AND greatest(rank - s, b_rank - b_s) <= 1 - ceil({config.percent} * (n + b_n) / {100 + config.percent})"
    )
    return rare.join(b, "h").filter(alike).selectExpr("sid AS a", "b_sid AS b", "n AS na", "b_n AS nb").distinct()


def hub_pairs(rare: DataFrame, config: JoinConfig) -> DataFrame:
    """Meetings with two members of each group of several: those with the most, and the most frequent, shared digests."""
    hubs = rare.groupBy("group").agg(
        F.array(F.max_by("sid", "s"), F.max_by("sid", F.struct("centrality", "sid"))).alias("hubs"),
        F.min("sid").alias("low"), F.max("sid").alias("high"),
    ).filter("low < high").select(F.explode("hubs").alias("sid")).distinct()
    return meetings(rare, rare.join(hubs, "sid", "left_semi"), config, once=False)


def cut_segments(config: JoinConfig) -> Callable:
    """(bucket, segment, sid, shingles): each set cut at the same places of the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.array([(i << 64) // config.segments for i in range(1, config.segments)], np.uint64)
        schema = pa.schema([("bucket", pa.int64()), ("segment", pa.int64()), ("sid", pa.int64()), ("part", pa.binary())])
        for batch in batches:
            rows = []
            for bucket, sid, raw in zip(*(batch.column(c).to_pylist() for c in ("bucket", "sid", "shingles"))):
                for i, part in enumerate(np.split(s := np.frombuffer(raw, np.uint64), np.searchsorted(s, cuts))):
                    if len(part):
                        rows.append({"bucket": bucket, "segment": i, "sid": sid, "part": part.tobytes()})
                if len(rows) >= 50_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def partial_overlaps(parts: pa.Table, pairs: pa.Table) -> pa.Table:
    """(a, b, na, nb, common) of one bucket and segment, for the pairs that have something in common there."""
    segments = dict(zip(parts.column("sid").to_pylist(), parts.column("part").to_pylist()))
    names = ["a", "b", "na", "nb"]
    place = {sid: i for i, sid in enumerate(segments)}
    a, b = (np.array([place.get(x, -1) for x in pairs.column(c).to_pylist()], np.int64) for c in ("a", "b"))
    both = np.flatnonzero((a >= 0) & (b >= 0))
    common = np.zeros(len(a), np.int64)
    if len(both):
        sets = [np.frombuffer(s, np.uint64) for s in segments.values()]
        sizes = np.array([len(s) for s in sets])
        flat, begin = np.concatenate(sets), np.concatenate(([0], np.cumsum(sizes)[:-1]))
        salt = mixed(np.arange(1, len(sets) + 1, dtype=np.uint64) * np.uint64(GOLDEN))
        held = np.sort(flat ^ np.repeat(salt, sizes))
        for some in np.array_split(both, 1 + int(sizes[a[both]].sum()) // 2_000_000):
            length = sizes[a[some]]
            at = np.repeat(begin[a[some]] - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(length.sum())
            wanted = flat[at] ^ np.repeat(salt[b[some]], length)
            hit = held[np.minimum(np.searchsorted(held, wanted), len(held) - 1)] == wanted
            common[some] = np.bincount(np.repeat(np.arange(len(some)), length), hit, len(some)).astype(np.int64)
    found = common > 0
    return pairs.select(names).filter(pa.array(found)).append_column("common", pa.array(common[found]))


def linked(pairs: DataFrame, sets: DataFrame, config: JoinConfig, by: tuple[str, ...] = ("a",)) -> DataFrame:
    """The pairs (a, b) over the threshold. ``pairs`` and ``sets`` are stored.

    Pairs are dealt to buckets by their first set, of which no set has more than a few, or ``by`` both sets where one may be
    first in many. A leader goes to as many buckets as its pairs need. Within a bucket each segment is counted apart.
    """
    buckets = max(1, -(-pairs.count() // config.pairs_per_bucket))
    dealt = pairs.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)))
    needed = dealt.select(F.col("a").alias("sid"), "bucket").union(dealt.select("b", "bucket")).distinct()
    parts = sets.select("sid", "shingles").join(needed, "sid").mapInArrow(
        tidy(cut_segments(config)), "bucket bigint, segment bigint, sid bigint, part binary"
    )
    asked = dealt.withColumn("segment", F.explode(F.expr(f"sequence(0L, {config.segments - 1}L)")))
    counts = (
        parts.groupBy("bucket", "segment")
        .cogroup(asked.groupBy("bucket", "segment"))
        .applyInArrow(partial_overlaps, "a bigint, b bigint, na bigint, nb bigint, common bigint")
    )
    summed = counts.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return summed.filter(f"100 * common >= {config.percent} * (na + nb - common)").select("a", "b")


def in_groups(df: DataFrame, groups: DataFrame) -> DataFrame:
    """``df`` with the group of its set: the component, or the set alone."""
    named = groups.select(F.col("node").alias("sid"), "component")
    return splittable_join(df, named, ["sid"], "left").withColumn("group", F.coalesce("component", "sid")).drop("component")


def ngram_join(docs: DataFrame, config: JoinConfig = JoinConfig()) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, the smallest id reachable by links.

    Null or empty texts, and texts without a word: 0 n-grams, linked with nothing. A null id links with nothing and
    gets a null component. Repeated rows stay and share a component. Only doc_id and text are read.
    """
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    letters = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = 1 + letters // (6 * config.fragment_shingles)  # about six letters to a word and so to an n-gram
    first = stored(counted(texts.mapInArrow(tidy(pack_documents(config, fragments)), PACKED)), "shared")
    ids = first.select("doc_id", "sid", "n")
    possible = f"100 * shared >= {config.percent} * n"

    # a set that several chunks hold has the same count in each
    representatives = first.filter("doc_id IS NOT NULL AND sid IS NOT NULL").filter(possible).groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    open_sets = stored(representatives.select("doc_id").distinct(), "open")
    built = join_small(texts, open_sets, ["doc_id"], "left_semi").mapInArrow(tidy(build_sets(config)), SETS)
    sets = stored(built.dropDuplicates(["sid"]), "sets")

    links = stored(linked(stored(leader_pairs(sets, config), "pairs"), sets, config), "links")
    groups = components(links)
    grouped = stored(in_groups(sets.drop("sketch"), groups), "grouped")
    fragments = 1 + (grouped.agg(F.sum("n")).first()[0] or 0) // config.fragment_shingles
    across = counted(grouped.select("sid", "group", "shingles").mapInArrow(tidy(pack_sets(config, fragments)), PACKED))
    across = across.filter(possible).select("sid")
    still = stored(splittable_join(grouped, across, ["sid"], "left_semi"), "still")
    rare = stored(rare_digests(still, config), "rare")
    more = stored(linked(stored(hub_pairs(rare, config), "hub_pairs"), still, config, by=("a", "b")), "hub_links")
    links = stored(links.union(more), "more_links")
    groups = components(links)
    rare = stored(in_groups(rare.drop("group"), groups), "regrouped")
    more = stored(linked(stored(meetings(rare, rare, config, once=True), "rest_pairs"), still, config, by=("a", "b")), "rest_links")
    if more.limit(1).count():
        groups = components(links.union(more))

    named = in_groups(ids, groups)
    least = named.groupBy("group").agg(F.min("doc_id").alias("least"))
    return splittable_join(named, least, ["group"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
    )


def keep_first_of_each(docs: DataFrame, config: JoinConfig = JoinConfig()) -> DataFrame:
    """``docs`` without the documents that are not the smallest id of their component.

    Of rows that repeat an id and its text, one stays. Other rows that repeat an id, and rows of null ids, which come
    last, are documents of their own, so only a row that is linked itself goes.
    """
    unnamed = docs.filter("doc_id IS NULL").limit(1).count()
    if unnamed or docs.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        return keep_first_rows(docs, config)
    joined = stored(ngram_join(docs, config), "joined")
    dropped = joined.filter("doc_id <> component_id").select("doc_id").distinct()
    return join_small(docs, stored(dropped, "dropped"), ["doc_id"], "left_anti")


def keep_first_rows(docs: DataFrame, config: JoinConfig) -> DataFrame:
    """The same by row: rows are numbered in order of id and joined by their numbers."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text", F.xxhash64("text").alias("twin")
    )
    once = rows.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "twin"]).unionAll(rows.filter("doc_id IS NULL"))
    ordered = once.orderBy(F.col("doc_id").asc_nulls_last(), "twin")
    placed = stored(ordered.withColumn("row", F.monotonically_increasing_id()), "placed")
    joined = stored(ngram_join(placed.select(F.col("row").alias("doc_id"), "text"), config), "joined")
    dropped = joined.filter("doc_id <> component_id").select(F.col("doc_id").alias("row"))
    return join_small(placed, stored(dropped, "dropped"), ["row"], "left_anti").select("doc.*")
