"""Exact top-k search by inner product, with blocks of documents ordered by upper bounds.

A vector's dimensions are its terms and its whole-number components their weights. The index
cuts the vectors, ordered so that similar ones are near, into ranges and these into blocks;
a block keeps the maximum and minimum of every term and the vectors themselves as its forward
index. For a query, a block's bound is the sum over terms of the most the block can add. The
blocks are scored in the order of their bounds until the bound falls below the k-th score, for
many queries at once: a few blocks by a batch of queries are one product of matrices.

Each query first searches the range it comes from and the sample that ordered the index; the better
of the k-th places found there, a score and an id, is its floor. A query goes to the other ranges, in
groups of bounded size, only where the sum of the range's own term maxima reaches its floor, and a
range returns no vector behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.functions import splittable_join
from riskpanel.llm.common import LAST_ID, stored


@dataclass(frozen=True)
class SearchConfig:
    """``sample`` vectors fit the centres that order the index; every vector is indexed and results are exact."""

    k: int = 20
    scale: int = 64
    block: int = 64
    range_vectors: int = 8192
    queries_per_group: int = 8192
    centres: int = 64
    sample: int = 4096
    ranges_per_block: int = 128


#: Below this no sum of products of doubles loses a unit.
EXACT = 2.0**53

#: So many queries and blocks are scored together; their products take 2 MB with blocks of 64.
QUERIES_AT_ONCE, BLOCKS_AT_ONCE = 256, 16


def whole_components(vectors: DataFrame, config: SearchConfig) -> DataFrame:
    """(vec_id, components): floor(scale * x), as whole doubles, of vectors whose components are all finite.

    A null vector, and one with a null or non-finite component, is left out; so is one whose product no double holds.
    """

    def whole(x: Column) -> Column:
        product = config.scale * x.cast("double")  # from 2**53 on a double is a whole number
        return F.when(F.abs(product) < F.lit(EXACT), F.floor(product).cast("double")).otherwise(product)

    scaled = F.transform(F.col("embedding"), whole)
    usable = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(config.scale * x.cast("double")) < F.lit(float("inf"))))
    chosen = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return chosen.filter(usable).select("vec_id", scaled.alias("components"))


def bounded_sample(vectors: DataFrame, config: SearchConfig) -> tuple[np.ndarray, np.ndarray]:
    """Ids and components of at most ``sample`` rows."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(config.sample).collect()  # bounded
    return np.array([r.vec_id for r in sample], np.int64), padded([r.components for r in sample])


def fit_centres(rows: np.ndarray, config: SearchConfig) -> np.ndarray:
    """Centres of the sample, fitted by a few rounds; they only order the index."""
    if not len(rows):
        return np.zeros((1, 1))
    centres = rows[:: max(1, len(rows) // config.centres)][: config.centres].copy()
    for _ in range(6):
        nearest = nearest_centre(rows, centres)
        for c in np.unique(nearest):
            centres[c] = rows[nearest == c].mean(axis=0)
    return centres


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)


def padded(rows: list, width: int = 0) -> np.ndarray:
    """Rows as one array; shorter ones end in zeros, which add nothing to a product."""
    width = max([width, 1, *map(len, rows)])
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def component_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of component lists, as ``padded`` gives them."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    width = max(1, lengths.max(initial=0))
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def near(centres: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, fixed = same_width(component_rows(batch.column("components")), centres)
                found = pa.array(nearest_centre(rows, fixed).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "centre"])

    return run


RANGE = "range bigint, n bigint, width bigint, ids binary, vectors binary"


def cut_ranges(config: SearchConfig) -> Callable:
    """Rows of at most ``range_vectors`` vectors in the order in which they come, about as many in each of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = max(1, -(-batch.num_rows // config.range_vectors))
            size = max(1, -(-batch.num_rows // parts))
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids = part.column("vec_id").to_numpy(zero_copy_only=False)
                rows = component_rows(part.column("components"))
                name = part.column("row")[0].as_py()  # unique, since a row is in one range
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([len(ids)]), pa.array([rows.shape[1]]), pa.array([ids.tobytes()]), pa.array([rows.tobytes()])],
                    names=["range", "n", "width", "ids", "vectors"],
                )

    return run


class Range:
    """Blocks of one range with their bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int) -> None:
        self.ids, self.vectors, self.block = ids, vectors, block
        first = np.arange(0, len(ids), block)
        self.most, self.least = np.maximum.reduceat(vectors, first), np.minimum.reduceat(vectors, first)
        self.lowest = np.minimum.reduceat(ids, first)

    def widened(self, width: int) -> Range:
        if width == self.vectors.shape[1]:
            return self
        return Range(self.ids, np.pad(self.vectors, ((0, 0), (0, width - self.vectors.shape[1]))), self.block)

    def search(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of up to k best vectors other than the query's own, none below ``floor``."""
        asked = np.array([query_id], np.int64), query[None], bounds[None], k, np.array([floor], float), np.array([LAST_ID])
        found = list(self.search_all(*asked))
        return found[0][1:] if found else (np.empty(0), np.empty(0, np.int64))

    def search_all(
        self, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int, floors: np.ndarray, floor_ids: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, score, id) of each query's up to k best vectors other than its own, none behind its floor and its id.

        Queries are given by their places, and each one's rows come in their order.
        """
        with np.errstate(over="ignore", invalid="ignore"):
            plain = np.abs(queries).sum(axis=1) * np.abs(self.vectors).max(initial=0) < EXACT
        for alike in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            for at in range(0, len(alike), QUERIES_AT_ONCE):
                some = alike[at : at + QUERIES_AT_ONCE]
                kth = floors[some] if plain[some[0]] else floors[some].astype(object)
                place, scores, ids = self._best(query_ids[some], queries[some], bounds[some], k, kth, floor_ids[some])
                yield some[place], scores, ids

    def _best(
        self, query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int, kth: np.ndarray, kth_id: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        reach = bounds.max(axis=0)
        order = np.argsort(-reach, kind="stable")
        place, scores, ids = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        step, at = 1, 0
        while at < len(order) and reach[order[at]] >= kth.min():
            some = order[at : at + step]
            at, step = at + step, min(2 * step, BLOCKS_AT_ONCE)
            most, last, last_id = bounds[:, some], kth[:, None], kth_id[:, None]
            open_to = (most > last) | ((most == last) & (self.lowest[some] <= last_id))
            asking, some = np.flatnonzero(open_to.any(axis=1)), some[open_to.any(axis=0)]
            rows = (some[:, None] * self.block + np.arange(self.block)).ravel()
            rows = rows[rows < len(self.ids)]
            scored = dots(queries[asking], self.vectors[rows])
            i, j = np.divmod(np.flatnonzero(scored >= kth[asking][:, None]), max(1, len(rows)))
            new, score, found = asking[i], scored[i, j], self.ids[rows[j]]
            fits = (found != query_ids[new]) & ((score > kth[new]) | (found <= kth_id[new]))
            if not fits.any():
                continue
            place = np.concatenate((place, new[fits]))
            scores, ids = np.concatenate((scores, score[fits])), np.concatenate((ids, found[fits]))
            best = np.lexsort((ids, -scores, place))
            rank = np.arange(len(best)) - np.searchsorted(place[best], place[best])
            full = best[rank == k - 1]
            kth[place[full]], kth_id[place[full]] = scores[full], ids[full]
            best = best[rank < k]
            place, scores, ids = place[best], scores[best], ids[best]
        return place, scores, ids


def dots(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles where they hold them, else in Python's integers."""
    with np.errstate(over="ignore", invalid="ignore"):
        held = np.abs(rows).max(axis=1, initial=0) * np.abs(queries).sum(axis=1).max(initial=0) < EXACT
    if held.all():
        return queries @ rows.T
    out = np.empty((len(queries), len(rows)), object)
    out[:, held] = queries @ rows[held].T
    out[:, ~held] = python_integers(queries) @ python_integers(rows[~held]).T
    return out


def python_integers(rows: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in rows], object).reshape(rows.shape)


def bounds_of(queries: np.ndarray, index: Range) -> np.ndarray:
    """Per query and block the sum of the most that each term can add, with room for rounding."""
    return summed_maxima(queries, index.most, index.least)


def summed_maxima(queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        bounds = up @ most.T + down @ least.T
        size = np.abs(queries).sum(axis=1).max(initial=0) * max(np.abs(most).max(initial=0), np.abs(least).max(initial=0))
    if not size < EXACT:
        bounds += np.abs(bounds) * 1e-9 + 1
        bounds[~np.isfinite(bounds)] = np.inf
    return bounds


def read_range(row: dict, block: int) -> Range:
    return Range(
        np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"]).reshape(row["n"], row["width"]), block
    )


FOUND = "query_id bigint, vec_id bigint, score bigint"
_FOUND = pa.schema([(c, pa.int64()) for c in ("query_id", "vec_id", "score")])


def best_in(
    index: Range, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, floor_ids: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``search_all`` finds, whatever the widths."""
    width = max(index.vectors.shape[1], queries.shape[1])
    index, queries = index.widened(width), np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    for at in range(0, len(ids), QUERIES_AT_ONCE):
        some = slice(at, at + QUERIES_AT_ONCE)
        bounds = bounds_of(queries[some], index)
        for place, scores, found in index.search_all(ids[some], queries[some], bounds, k, floors[some], floor_ids[some]):
            yield at + place, scores, found


def raise_floors(index: Range, ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, floor_ids: np.ndarray, k: int) -> None:
    """Puts the k-th score and id of an index, where they are better, in the place of the floors given."""
    for place, scores, found in best_in(index, ids, queries, floors, floor_ids, k):
        last = np.flatnonzero(np.arange(len(place)) - np.searchsorted(place, place) == k - 1)
        for q, score, vec_id in zip(place[last], scores[last], found[last]):
            if abs(score) < EXACT:
                floors[q], floor_ids[q] = score, vec_id


def search_own_range(config: SearchConfig, every: int, sample: tuple[np.ndarray, np.ndarray]) -> Callable:
    """The queries of each range with a place, score and id, behind which none of their k best can be.

    It is the k-th found in the range or in the sample.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Range(*sample, config.block) if len(sample[0]) else None
        for batch in batches:
            for row in batch.to_pylist():
                index = read_range(row, config.block)
                own = np.flatnonzero(index.ids % every == 0)
                ids, queries = index.ids[own], index.vectors[own]
                floors, floor_ids = np.full(len(own), -np.inf), np.full(len(own), LAST_ID)
                for known in filter(None, (index, seen)):
                    raise_floors(known, ids, queries, floors, floor_ids, config.k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(floors), pa.array(floor_ids), pa.array(list(queries), pa.list_(pa.float64()))],
                    names=["query_id", "floor", "floor_id", "components"],
                )

    return run


def range_maxima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(range, lowest, most, least): the smallest id, the term maxima and minima of each range."""
    for batch in batches:
        rows = [(r["range"], read_range(r, r["n"])) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name for name, _ in rows], pa.int64()), pa.array([int(x.lowest[0]) for _, x in rows], pa.int64()),
             pa.array([x.most[0].tolist() for _, x in rows], pa.list_(pa.float64())),
             pa.array([x.least[0].tolist() for _, x in rows], pa.list_(pa.float64()))],
            names=["range", "lowest", "most", "least"],
        )


def reached(ranges: pa.Table, queries: pa.Table) -> pa.Table:
    """(range, query_id) for the ranges of a block that could hold something at a query's floor or above."""
    kept = pa.schema([("range", pa.int64()), ("query_id", pa.int64())])
    if not ranges.num_rows or not queries.num_rows:
        return kept.empty_table()
    names, lowest = (ranges.column(c).to_numpy() for c in ("range", "lowest"))
    ids, floors, floor_ids = (queries.column(c).to_numpy() for c in ("query_id", "floor", "floor_id"))
    rows, most = same_width(component_rows(queries.column("components")), component_rows(ranges.column("most")))
    rows, least = same_width(rows, component_rows(ranges.column("least")))
    bounds = summed_maxima(rows, most, least)
    last, last_id = floors[:, None], floor_ids[:, None]
    i, j = np.nonzero((bounds > last) | ((bounds == last) & (lowest <= last_id)))
    return pa.table([pa.array(names[j]), pa.array(ids[i])], schema=kept)


def search_range(config: SearchConfig) -> Callable:
    def run(ranges: pa.Table, queries: pa.Table) -> pa.Table:
        ids, floors, floor_ids = (queries.column(c).to_numpy() for c in ("query_id", "floor", "floor_id"))
        rows = component_rows(queries.column("components"))
        out = []
        for row in ranges.to_pylist() if len(ids) else []:
            for place, scores, found in best_in(read_range(row, config.block), ids, rows, floors, floor_ids, config.k):
                if scores.dtype == object:
                    scores = [max(-(1 << 63), min(int(s), (1 << 63) - 1)) for s in scores]
                out.append((ids[place], found, np.array(scores, np.int64)))
        if not out:
            return _FOUND.empty_table()
        return pa.table([np.concatenate(c) for c in zip(*out)], schema=_FOUND)

    return run


def top_k(vectors: DataFrame, config: SearchConfig = SearchConfig(), every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row whose id is divisible by ``every``.

    Ties go to the smaller id. Fewer rows than k: all of them. Rows of one id are not each other's candidates, and
    a query that is repeated is answered once, for the row that comes first by its components. Shorter vectors
    count as ending in zeros; a score beyond 64 bits is the nearest such number, and ranks as that. Null ids and
    unusable vectors take no part. Only vec_id and embedding are read.
    """
    usable = whole_components(vectors, config)
    sample = bounded_sample(usable, config)
    centres = fit_centres(sample[1], config)
    placed = usable.mapInArrow(near(centres), "vec_id bigint, components array<double>, centre int")
    placed = stored(placed.withColumn("row", F.monotonically_increasing_id()), "placed")
    ranges = max(1, -(-placed.count() // config.range_vectors))
    order = ["centre", "vec_id", "row"]
    index = stored(
        placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(cut_ranges(config), RANGE), "index"
    )
    queries = index.mapInArrow(
        search_own_range(config, every, sample), "query_id bigint, floor double, floor_id bigint, components array<double>"
    )
    first = F.min_by(F.struct("floor", "floor_id", "components"), "components")
    queries = stored(queries.groupBy("query_id").agg(first.alias("q")), "queries")
    groups = max(1, -(-queries.count() // config.queries_per_group))
    maxima = stored(index.mapInArrow(range_maxima, "range bigint, lowest bigint, most array<double>, least array<double>"), "ranges")
    blocks = max(1, -(-ranges // config.ranges_per_block))
    maxima = maxima.withColumn("block", F.pmod(F.xxhash64("range"), F.lit(blocks)))
    grouped = queries.select("query_id", "q.*", F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("group"))

    def each_group(df: DataFrame) -> DataFrame:
        return df.withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))

    # every group of queries meets every block of maxima; only what passes is sent to the ranges themselves
    met = grouped.withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    pairs = stored(
        each_group(maxima).groupBy("block", "group").cogroup(met.groupBy("block", "group")).applyInArrow(reached, "range bigint, query_id bigint"),
        "pairs",
    )
    asked = splittable_join(pairs, grouped, ["query_id"]).select("group", "range", "query_id", "floor", "floor_id", "components")
    found = (
        each_group(index).groupBy("range", "group")
        .cogroup(asked.groupBy("range", "group"))
        .applyInArrow(search_range(config), FOUND)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= config.k).select(
        "query_id", "rank", "vec_id", "score"
    )
