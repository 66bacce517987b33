"""Substring deduplication by hashing units: lines cut further at the ends of sentences and clauses.

From every unit a seed is digested, the shortest run of whole units that has ``seed_words`` words; no unit is too short
to count. Equal digests are grouped over the whole corpus, and the occurrence that ranks first, by document and
place, stays. Repeated seeds that follow one another form a run. A passage may begin and end inside a unit, so both ends of a
run grow word by word as long as the words equal those beside the place that is kept. Runs of ``least_words`` words or
more are what is removed. Places are offsets in the original text, so a removal can be checked or undone.

Only digests travel: those of seeds once, then, for the few runs that can become long enough, the words beside their ends.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.functions import splittable_join
from riskpanel.llm.common import document_keys, join_small, release, stored, tidy


@dataclass(frozen=True)
class UnitConfig:
    """Repeated runs of fewer than ``least_words`` words stay: headings, notices and sentences repeat by nature.

    ``edge_words`` are looked up at once where a run grows, and 16 times as many each time that it goes on; no result
    depends on it.
    """

    least_words: int = 50
    seed_words: int = 5
    edge_words: int = 16

    def __post_init__(self) -> None:
        if min(self.least_words, self.seed_words, self.edge_words) < 1:
            raise ValueError("passages, seeds and edges have a word or more")

    @property
    def probe(self) -> int:
        """Words beside a seed that have a digest of their own: a short run must grow by as many on one side."""
        return max(1, self.least_words // 3)

    @property
    def long(self) -> int:
        """Runs of so many words may become long enough whatever the probes say."""
        return self.least_words - 2 * self.probe + 2


# A word that ends in one of these ends a unit, as does the last word of a line.
STOPS = b".!?,;:"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
GOLDEN = 0x9E3779B97F4A7C15
SEEDS = "id bigint, twin bigint, at int, n int, before int, after int, digest bigint"


class Words(dict):
    """Numbers of words and, by number, their digests, of which the lowest bit says whether the word ends a unit.

    Of bounded size: a full table starts anew.
    """

    ROOM = 200_000

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []
        self.table, self.used = np.empty(1 << 12, np.uint64), 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def digests(self, found: list[bytes]) -> np.ndarray:
        if len(self) > self.ROOM:
            self.clear()
            self.used = 0
        numbers = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        if self.new:
            end = self.used + len(self.new)
            if end > len(self.table):
                self.table = np.concatenate((self.table[: self.used], np.empty(2 * end - self.used, np.uint64)))
            fresh = ((xxhash.xxh3_64_intdigest(w) & ~1) | (w[-1] in STOPS) for w in self.new)
            self.table[self.used : end] = np.fromiter(fresh, np.uint64, len(self.new))
            self.used, self.new = end, []
        return self.table[numbers]


def spell(texts: list[str], words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digests of the words of some texts, A-Z as a-z, where units end, and where texts end."""
    found: list[bytes] = []
    lines, ends = [], []
    for text in texts:
        for line in text.encode("utf-8", "surrogatepass").lower().split(b"\n"):
            found += line.split()  # on bytes: at the blanks of ASCII
            lines.append(len(found))
        ends.append(len(found))
    w = words.digests(found)
    cut = np.zeros(len(w) + 1, bool)
    cut[1:] = w & np.uint64(1)
    cut[lines] = True
    return w, np.flatnonzero(cut[1:]) + 1, np.array(ends)


class Powers:
    """Digests of any run of words from sums over the words before it."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, w: np.ndarray) -> np.ndarray:
        if len(w) >= len(self.up):
            n = 2 * len(w) + 1
            for name, base in (("up", GOLDEN), ("down", pow(GOLDEN, -1, 1 << 64))):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(w * self.up[: len(w)])))

    def runs(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return (h ^ (h >> np.uint64(33))).view(np.int64)


def seeds_of(config: UnitConfig) -> Callable:
    """Rows of (id, twin, text) to seeds: place, number of words, digests of the words beside it, digest."""

    def seeds(ids: np.ndarray, twins: np.ndarray, texts: list[str], words: Words, powers: Powers) -> pa.RecordBatch:
        w, cut, ends = spell(texts, words)
        begins = np.concatenate(([0], ends[:-1]))
        start = np.concatenate(([0], cut[:-1])) if len(cut) else cut
        doc = np.searchsorted(ends, start, side="right")
        last = np.searchsorted(cut, start + config.seed_words)  # the first end with enough words, in the same text
        end = np.append(cut, len(w) + 1)[last]
        whole = end <= ends[np.minimum(doc, len(ends) - 1)] if len(start) else np.zeros(0, bool)
        start, end, doc = start[whole], end[whole], doc[whole]
        sums, probe, near = powers.sums(w), config.probe, []
        for a, b in ((start - probe, start), (end, end + probe)):
            inside = (a >= begins[doc]) & (b <= ends[doc])
            side = powers.runs(sums, np.where(inside, a, 0), np.where(inside, b, 0))
            near.append(pa.array((side >> 32).astype(np.int32), mask=~inside))
        columns = [
            pa.array(ids[doc]), pa.array(twins[doc]), pa.array((start - begins[doc]).astype(np.int32)), pa.array((end - start).astype(np.int32)),
            *near, pa.array(powers.runs(sums, start, end)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["id", "twin", "at", "n", "before", "after", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, powers = Words(), Powers()
        for batch in batches:
            ids, twins = (np.asarray(batch.column(c)) for c in ("id", "twin"))
            texts = batch.column("text")
            for at in range(0, batch.num_rows, 500):
                some = slice(at, at + 500)
                yield seeds(ids[some], twins[some], texts.slice(at, 500).to_pylist(), words, powers)

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """(id, twin, text): one row per id and text. ``twin`` tells texts of one id apart, and by its lowest bit null ids."""
    id_, twin = document_keys()
    return docs.filter(F.col("text").isNotNull()).select(id_.alias("id"), twin.alias("twin"), "text")


def named(id_: str, twin: str) -> Column:
    """The doc_id that stands behind a key."""
    return F.when(F.col(twin).bitwiseAND(F.lit(1)) == 0, F.col(id_))


REPEATS = "id bigint, twin bigint, at int, n int, kept_id bigint, kept_twin bigint, kept_at int, last_id bigint, last_twin bigint, last_at int"


def runs_of(config: UnitConfig) -> Callable:
    """The repeated seeds of each document to runs that may become long enough.

    A run has the place kept of its first seed (``kept``) and where the place kept of its last seed ends (``last``).
    """
    schema = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") and "big" not in c else pa.int64()) for c in REPEATS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = batch.column("seeds").flatten()
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("seeds")).to_numpy(zero_copy_only=False))

            def field(*path: str) -> np.ndarray:
                return pc.struct_field(seeds, list(path)).to_numpy(zero_copy_only=False)

            at = field("at")
            order = np.lexsort((at, row))
            row, at, n = row[order], at[order].astype(np.int64), field("n")[order]
            end = (row << 32) + at + n
            upto = np.maximum.accumulate(end)  # the end of the run so far; later documents have larger numbers
            new = np.ones(len(row), bool)
            new[1:] = (row << 32)[1:] + at[1:] > upto[:-1]
            first = np.flatnonzero(new)
            final = np.append(first[1:], len(row)) - 1
            last = np.maximum.accumulate(np.where(end == upto, np.arange(len(row)), 0))[final]  # the last seed that reaches the end
            words = upto[final] - end[first] + n[first]
            kept = (words >= config.long) | field("left")[order][first] | field("right")[order][last]
            first, last, words = first[kept], last[kept], words[kept]
            doc, by = row[first], {c: field("kept", c)[order] for c in ("id", "twin", "at")}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(doc)), batch.column("twin").take(pa.array(doc)), pa.array(at[first].astype(np.int32)),
                    pa.array(words.astype(np.int32)), *(pa.array(by[c][first]) for c in by),
                    pa.array(by["id"][last]), pa.array(by["twin"][last]), pa.array((by["at"][last] + n[last]).astype(np.int32)),
                ],
                schema=schema,
            )

    return run


def repeated_runs(texts: DataFrame, config: UnitConfig) -> DataFrame:
    """(run, *REPEATS): runs of repeated seeds that may reach ``least_words``."""
    found = stored(texts.mapInArrow(tidy(seeds_of(config)), SEEDS), "seeds")
    # digests alone first: most seeds occur once and travel no further
    twice = stored(found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"), "twice")
    found = stored(join_small(found, twice, ["digest"], "left_semi"), "again")
    place = F.struct("id", "twin", "at", "before", "after")
    kept = found.groupBy("digest").agg(F.min(place).alias("kept"))
    here = splittable_join(found, kept, ["digest"]).filter(
        ~((F.col("id") == F.col("kept.id")) & (F.col("twin") == F.col("kept.twin")) & (F.col("at") == F.col("kept.at")))
    )
    seed = F.struct(
        "at", "n", F.struct("kept.id", "kept.twin", "kept.at").alias("kept"),
        F.coalesce(F.col("before") == F.col("kept.before"), F.lit(False)).alias("left"),
        F.coalesce(F.col("after") == F.col("kept.after"), F.lit(False)).alias("right"),
    )
    by_doc = here.groupBy("id", "twin").agg(F.collect_set(seed).alias("seeds"))  # the units of one text
    runs = stored(by_doc.mapInArrow(tidy(runs_of(config)), REPEATS), "runs")
    return runs.withColumn("run", F.monotonically_increasing_id())


def look_up(texts: DataFrame, asked: DataFrame, answer: Callable, kind: str) -> DataFrame:
    """Answers to ``asked`` (id, twin, *what) from the texts: ``answer`` gives the rows of one text as dictionaries.

    What is asked of one text is distinct, and so bounded by the text.
    """
    what = [c for c in asked.columns if c not in ("id", "twin")]
    by_doc = stored(asked.distinct().groupBy("id", "twin").agg(F.collect_set(F.struct(*what)).alias("asked")), "asked")
    schema = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = pa.schema([(name, schema[type_]) for name, type_ in (c.split() for c in kind.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                rows = [
                    {"id": row["id"], "twin": row["twin"], **found}
                    for row in batch.slice(at, 100).to_pylist() for found in answer(row["text"], row["asked"])
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=fields)

    # rows that repeat an id and its text answer alike
    return join_small(texts, by_doc, ["id", "twin"], "inner").mapInArrow(tidy(run), kind).distinct()


EDGES = "id bigint, twin bigint, at int, side int, words binary"


def edges_of(most: int) -> Callable:
    """The digests of up to ``most`` words before (side 0) or from (side 1) a place, the nearest first."""
    cache: list[Words] = []

    def answer(text: str, asked: list[dict]) -> Iterator[dict]:
        words = cache[0] if cache else cache.append(Words()) or cache[0]
        w, _, _ = spell([text], words)
        for a in asked:
            at = a["at"]
            near = w[at : at + most] if a["side"] else w[max(0, at - most) : at][::-1]
            yield {**a, "words": near.tobytes()}

    return answer


def grow(runs: DataFrame, texts: DataFrame, config: UnitConfig) -> DataFrame:
    """``runs`` with ``left`` and ``right``, the words by which they grow at their ends."""
    sides = []
    for side in (0, 1):
        own = F.col("at") + F.col("n") if side else F.col("at")
        kept = [F.col(f"{'last' if side else 'kept'}_{c}").alias(c) for c in ("id", "twin", "at")]
        both = runs.select("run", F.lit(side).alias("side"), F.struct("id", "twin", own.alias("at")).alias("own"), F.struct(*kept).alias("kept"))
        sides.append(both.withColumn("grown", F.lit(0)))
    open_, done, most = stored(sides[0].unionAll(sides[1]), "ends"), [], config.edge_words
    while open_.limit(1).count():
        step = F.col("grown") * (2 * F.col("side") - 1)
        asked = [open_.select(f"{c}.id", f"{c}.twin", (F.col(f"{c}.at") + step).alias("at"), "side") for c in ("own", "kept")]
        edges = stored(look_up(texts, asked[0].unionAll(asked[1]), edges_of(most), EDGES), "edges")
        compared = open_.withColumns({
            "own_id": F.col("own.id"), "own_twin": F.col("own.twin"), "own_at": F.col("own.at") + step,
            "kept_id": F.col("kept.id"), "kept_twin": F.col("kept.twin"), "kept_at": F.col("kept.at") + step,
        })
        for c in ("own", "kept"):
            named_edges = edges.withColumnsRenamed({"id": f"{c}_id", "twin": f"{c}_twin", "at": f"{c}_at", "words": f"{c}_words"})
            compared = splittable_join(compared, named_edges, [f"{c}_id", f"{c}_twin", f"{c}_at", "side"])

        @F.pandas_udf("int")
        def alike(a: pd.Series, b: pd.Series) -> pd.Series:
            """How many words are equal from the first on."""
            out = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                n = min(len(x), len(y))
                unequal = np.flatnonzero(x[:n] != y[:n])
                out.append(int(unequal[0]) if len(unequal) else n)
            return pd.Series(out, dtype="int32")

        grown = stored(
            compared.withColumn("more", alike("own_words", "kept_words")).select(
                "run", "side", "own", "kept", (F.col("grown") + F.col("more")).alias("grown"), (F.col("more") == most).alias("open")
            ), "grown",
        )
        done.append(grown.filter(~F.col("open")).select("run", "side", "grown"))
        open_, most = grown.filter("open").drop("open"), 16 * most
    if not done:
        return runs.withColumns({"left": F.lit(0), "right": F.lit(0)})
    ends = done[0]
    for more in done[1:]:
        ends = ends.unionAll(more)
    by_run = ends.groupBy("run").agg(
        F.max(F.when(F.col("side") == 0, F.col("grown"))).alias("left"), F.max(F.when(F.col("side") == 1, F.col("grown"))).alias("right")
    )
    return runs.join(by_run, "run")


def passages(docs: DataFrame, config: UnitConfig) -> tuple[DataFrame, DataFrame]:
    """(id, twin, first, words, kept_id, kept_twin, kept_first) of what to remove, counted in words; and the keyed texts."""
    texts = keyed(docs.select("doc_id", "text"))
    grown = grow(repeated_runs(texts, config), texts, config)
    found = grown.select(
        "id", "twin", (F.col("at") - F.col("left")).alias("first"), (F.col("n") + F.col("left") + F.col("right")).alias("words"),
        "kept_id", "kept_twin", (F.col("kept_at") - F.col("left")).alias("kept_first"),
    ).filter(F.col("words") >= config.least_words)
    return stored(found, "passages"), texts


PLACES = "id bigint, twin bigint, word int, start int, end int"


def places(text: str, asked: list[dict]) -> Iterator[dict]:
    """Where words begin and end, in code points."""
    spans = [m.span() for m in WORD.finditer(text)]
    for a in asked:
        start, end = spans[a["word"]]
        yield {"word": a["word"], "start": start, "end": end}


def repeated_units(docs: DataFrame, config: UnitConfig = UnitConfig()) -> DataFrame:
    """One row per passage to remove: doc_id, start, end, words, kept_doc_id, kept_start.

    ``start``, ``end`` and ``kept_start`` count code points of the original texts; the passage kept begins at ``kept_start``. A
    passage put together from several places gives the first. Rank is by doc_id, null last, then the digest of the
    text, then the place, so of what repeats within a document the first stays. Rows that repeat an id and its
    text are one document. Words are compared with A-Z as a-z, white space does not matter, and digests of 64 bits stand for
    words. Null and empty texts have no units. Only doc_id and text are read.
    """
    found, texts = passages(docs, config)
    word = F.col("first") + F.col("words") - 1
    asked = [
        found.select("id", "twin", F.col("first").alias("word")), found.select("id", "twin", word.alias("word")),
        found.select(F.col("kept_id").alias("id"), F.col("kept_twin").alias("twin"), F.col("kept_first").alias("word")),
    ]
    placed = stored(look_up(texts, asked[0].unionAll(asked[1]).unionAll(asked[2]), places, PLACES), "places")

    def at(id_: str, twin: str, word: str, **out: str) -> DataFrame:
        return placed.select(F.col("id").alias(id_), F.col("twin").alias(twin), F.col("word").alias(word), *[F.col(a).alias(b) for a, b in out.items()])

    rows = splittable_join(found.withColumn("to", word), at("id", "twin", "first", start="start"), ["id", "twin", "first"])
    rows = splittable_join(rows, at("id", "twin", "to", end="end"), ["id", "twin", "to"])
    rows = splittable_join(rows, at("kept_id", "kept_twin", "kept_first", start="kept_start"), ["kept_id", "kept_twin", "kept_first"])
    return rows.select(
        named("id", "twin").alias("doc_id"), "start", "end", "words", named("kept_id", "kept_twin").alias("kept_doc_id"), "kept_start",
    )


def cut_words(text: str, passages: list[tuple[int, int]]) -> str:
    """``text`` without these (first, words); where words remain on both sides, one gap stays between them.

    That is the gap before a passage that begins its line, and the one after it otherwise. Without words nothing stays.
    """
    spans = [m.span() for m in WORD.finditer(text)]
    out, at, i, cuts = [], 0, 0, sorted((a, a + n) for a, n in passages)
    while i < len(cuts):
        a, b = cuts[i]
        while i < len(cuts) and cuts[i][0] <= b:
            b = max(b, cuts[i][1])
            i += 1
        before = spans[a - 1][1] if a else 0
        after = spans[b][0] if b < len(spans) else len(text)
        lead = a == 0 or "\n" in text[before : spans[a][0]]
        out.append(text[at : spans[a][0] if lead else before])
        at = after if lead else spans[b - 1][1]
    left = "".join(out) + text[at:]
    return left if WORD.search(left) else ""


def remove_repeats(docs: DataFrame, config: UnitConfig = UnitConfig()) -> DataFrame:
    """``docs`` with the repeated passages cut out and n_chars, where there is such a column, as the text is then.

    Every row stays: one that loses all its words has an empty text, null and empty texts stay as they are, and rows
    that repeat an id and its text lose the same words. Other columns are handed on, whatever their names.
    """
    found, _ = passages(docs, config)
    by_doc = stored(found.groupBy("id", "twin").agg(F.collect_set(F.struct("first", "words")).alias("_cut")), "by_doc")  # of one text
    id_, twin = document_keys()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), id_.alias("id"), twin.alias("twin"), F.col("text").alias("_text")
    )
    joined = join_small(rows, by_doc, ["id", "twin"], "left")

    @F.pandas_udf("string")
    def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, cuts in batches:
            yield pd.Series([t if c is None else cut_words(t, [(x["first"], x["words"]) for x in c]) for t, c in zip(texts, cuts)], dtype=object)
            texts = cuts = None
        release()

    joined = joined.withColumn("_new", without("_text", "_cut"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("_new").alias(name)
        if name == "n_chars":
            kind = docs.schema[name].dataType
            return F.when(F.col("_cut").isNull(), F.col("doc.n_chars")).otherwise(F.length("_new").cast(kind)).alias(name)
        return F.col(f"doc.`{name}`").alias(name)

    return joined.select(*[column(c) for c in docs.columns])
