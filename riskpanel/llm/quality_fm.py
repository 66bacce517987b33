"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score is logistic in a bias, a weight per feature and all pairwise interactions, where
the strength of a pair is the product of two short vectors. With the sum-of-squares identity,
sum over pairs = (square of the sum - sum of the squares) / 2 per factor, a text is scored in
time linear in its distinct words.

The machine is trained on a bounded sample of labelled documents; scoring is a map over all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MachineConfig:
    """``sample``: most labelled documents trained on. The model is (buckets + statistics) x (factors + 1) numbers."""

    buckets: int = 1 << 16
    factors: int = 8
    sample: int = 10_000
    rounds: int = 6
    batch: int = 64
    rate: float = 0.1
    decay: float = 1e-5
    threshold: float = 0.3
    seed: int = 7


STATISTICS = 12

_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_MARKS = np.isin(np.arange(256), list(b"#*$%&|<>@^~=+_\\/{}[]"))
_STOPS = np.isin(np.arange(256), list(b".,;:!?\"'()-"))


def features(text: str, size: int | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words, and the statistics of the whole text; ``size`` is its recorded length."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    found = text.split()
    distinct = set(found)
    lines = [line for line in text.split("\n") if line]
    letters, n, rows = max(1, int(raw.sum())), max(1, len(found)), max(1, len(lines))
    statistics = np.array(
        [
            raw[_UPPER].sum() / letters,
            raw[_DIGIT].sum() / letters,
            raw[_MARKS].sum() / letters,
            raw[_STOPS].sum() / letters,
            raw[ord("!")] / n,
            raw[ord("|")] / n,
            raw[_SPACE].sum() / letters,
            len(distinct) / n,
            len(set(lines)) / rows,
            np.log1p(len(found)),
            np.log1p(len(found) / rows),
            np.log1p(max(0, len(text) if size is None else size)),
        ]
    )
    words = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
    return np.unique(words & np.uint64(buckets - 1)).astype(np.int32), statistics


class Machine:
    """A trained machine. Word features share the length 1, so long texts do not outweigh their statistics."""

    def __init__(self, config: MachineConfig) -> None:
        rng = np.random.default_rng(config.seed)
        self.config = config
        size = config.buckets + STATISTICS
        self.bias, self.weight = 0.0, np.zeros(size)
        self.vector = rng.normal(0, 0.01, (size, config.factors))
        self.centre, self.spread = np.zeros(STATISTICS), np.ones(STATISTICS)

    def inputs(self, words: np.ndarray, statistics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scaled = np.clip((statistics - self.centre) / self.spread, -4, 4)
        value = np.full(len(words), 1 / np.sqrt(max(1, len(words))))
        return np.concatenate((words, np.arange(STATISTICS) + self.config.buckets)), np.concatenate((value, scaled))

    def margin(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        """The score before the logistic, and the sum of the weighted vectors."""
        weighted = self.vector[at] * x[:, None]
        total = weighted.sum(axis=0)
        return self.bias + float(self.weight[at] @ x) + 0.5 * float(total @ total - (weighted * weighted).sum()), total

    def score(self, words: np.ndarray, statistics: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*self.inputs(words, statistics))[0], -30, 30))))

    def train(self, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        """Adaptive gradient steps on (label, words, statistics); without rows the score is 0.5."""
        if not rows:
            self.vector[:] = 0
            return
        table = np.array([s for _, _, s in rows])
        self.centre, self.spread = table.mean(axis=0), table.std(axis=0) + 1e-3
        labels = np.array([y for y, _, _ in rows], float)
        share = (labels.sum() + 1) / (len(labels) + 2)
        self.bias = float(np.log(share / (1 - share)))
        prepared = [self.inputs(w, s) for _, w, s in rows]
        rng, config = np.random.default_rng(self.config.seed), self.config
        seen_w, seen_v, seen_b = np.full(len(self.weight), 1e-2), np.full(self.vector.shape, 1e-2), 1e-2
        for _ in range(config.rounds):
            order = rng.permutation(len(rows))
            for start in range(0, len(order), config.batch):
                some = order[start : start + config.batch]
                at = np.concatenate([prepared[i][0] for i in some])
                x = np.concatenate([prepared[i][1] for i in some])
                length = np.array([len(prepared[i][0]) for i in some])
                first = np.concatenate(([0], np.cumsum(length)[:-1]))
                weighted = self.vector[at] * x[:, None]
                total = np.add.reduceat(weighted, first, axis=0)
                pairs = (total * total - np.add.reduceat(weighted * weighted, first, axis=0)).sum(axis=1) / 2
                margin = self.bias + np.add.reduceat(self.weight[at] * x, first) + pairs
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]) / len(some)
                each = np.repeat(error, length) * x
                own, where = np.unique(at, return_inverse=True)
                step_w = np.bincount(where, each, len(own)) + config.decay * self.weight[own]
                pull = each[:, None] * (np.repeat(total, length, axis=0) - weighted)
                step_v = np.stack([np.bincount(where, pull[:, f], len(own)) for f in range(config.factors)], axis=1)
                step_v += config.decay * self.vector[own]
                seen_w[own] += step_w**2
                seen_v[own] += step_v**2
                self.weight[own] -= config.rate * step_w / np.sqrt(seen_w[own])
                self.vector[own] -= config.rate * step_v / np.sqrt(seen_v[own])
                seen_b += error.sum() ** 2
                self.bias -= config.rate * error.sum() / np.sqrt(seen_b)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: its checksum says so, or it has no id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def _inputs(docs: DataFrame) -> DataFrame:
    size = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.select("doc_id", "text", size.alias("size"))


def training_rows(docs: DataFrame, labels: DataFrame, config: MachineConfig) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Features of at most ``sample`` labelled documents outside the held-out part, chosen by hash of their id.

    Of rows that repeat an id, the one with the least text digest counts.
    """
    labelled = labels.select("doc_id", "quality").dropna().filter(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.sample)
    buckets = config.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, sizes, labels_ = (batch.column(c).to_pylist() for c in ("doc_id", "text", "size", "quality"))
            found = [features(t or "", s, buckets) for t, s in zip(texts, sizes)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(labels_, pa.int32()),
                    pa.array([w.tolist() for w, _ in found], pa.list_(pa.int32())),
                    pa.array([s.tolist() for _, s in found], pa.list_(pa.float64())),
                ],
                names=["doc_id", "quality", "words", "statistics"],
            )

    # of rows that repeat an id one, whatever their order, so the sample bounds what is collected
    row = F.struct(F.xxhash64("text", "size").alias("twin"), "text", "size", F.col("quality").cast("int").alias("quality"))
    once = _inputs(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(row).alias("row"))
    rows = (
        once.select("doc_id", "row.text", "row.size", "row.quality")
        .mapInArrow(run, "doc_id bigint, quality int, words array<int>, statistics array<double>").toArrow()
    )
    columns = (rows.column(c).to_pylist() for c in ("doc_id", "quality", "words", "statistics"))
    ordered = sorted(zip(*columns))
    return [(int(y > 0), np.array(w, np.int32), np.array(s)) for _, y, w, s in ordered]


def score_quality(docs: DataFrame, labels: DataFrame, config: MachineConfig = MachineConfig()) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    Null and empty texts have no words and zero statistics, and are scored like any other. Null n_chars: the length
    of the text. Null ids count as held out. Repeated rows stay. No labels: every score is 0.5. Labels, lang,
    source and doc_id are no inputs of a score; only doc_id, text and n_chars are read.
    """
    machine = Machine(config)
    machine.train(training_rows(docs, labels, config))
    model = docs.sparkSession.sparkContext.broadcast(machine)  # its size does not depend on the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            pairs = zip(batch.column("text"), batch.column("size").to_pylist())
            scores = [own.score(*features(t.as_py() or "", s, own.config.buckets)) for t, s in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = _inputs(docs).mapInArrow(run, f"doc_id {id_type}, score double")
    predicted = (F.col("score") >= config.threshold).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))
