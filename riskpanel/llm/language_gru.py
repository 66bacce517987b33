"""Language identification by a bidirectional gated recurrent network over bytes.

A text's bytes are cut into windows that follow one another; within a window one network reads
forwards and one backwards, and from both states every byte gets a probability for each language. A
document's probabilities are the mean over all its bytes, whatever its length.

The network is trained here, in numpy, by backpropagation through time on a bounded sample of windows of
labelled documents; scoring is a map over all documents with the network broadcast, whose size does not
depend on the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NetworkConfig:
    """Trained on ``windows`` windows each of at most ``sample`` documents, in the order of the hash of their ids.

    ``batch`` windows are scored at once, so a task holds a few MB beside its texts. ``fold`` of 4 is kept from training.
    """

    states: int = 6
    window: int = 64
    sample: int = 4000
    windows: int = 2
    rounds: int = 8
    training_batch: int = 256
    rate: float = 0.01
    batch: int = 2048
    fold: int = 2
    seed: int = 11

    def __post_init__(self) -> None:
        if min(self.states, self.window, self.windows, self.rounds, self.training_batch, self.batch) < 1 or self.sample < 0:
            raise ValueError("sizes of the network and of training start at 1")


PAD = 256  # a byte that is none; it leaves the state as it is
UNKNOWN = "und"


def logistic(x: np.ndarray, gain: float = 1.0) -> np.ndarray:
    """gain / (1 + e^(-gain x)), in one array; numpy's exponential is twice as fast as its tangent."""
    with np.errstate(over="ignore"):  # an infinite e^(-x) gives the right 0
        out = np.exp(x * np.float32(-gain))
    out += np.float32(1)
    return np.divide(np.float32(gain), out, out=out)


def tangent(x: np.ndarray) -> np.ndarray:
    """The hyperbolic tangent, 2 / (1 + e^(-2x)) - 1."""
    out = logistic(x, 2.0)
    out -= np.float32(1)
    return out


class Direction:
    """One gated recurrent network; arrays are states x windows.

    ``table`` gives every byte's input to the update gate z, the reset gate r and the candidate n, one above
    the other, biases included; ``recur`` does the same for the state: h' = h + z (n - h), n = tanh(table + r recur h).
    """

    def __init__(self, states: int, rng: np.random.Generator) -> None:
        self.states = states
        self.table = rng.normal(0, 0.3, (3 * states, 257)).astype(np.float32)
        self.recur = (rng.normal(0, 1, (3 * states, states)) / np.sqrt(states)).astype(np.float32)
        self.close()

    def close(self) -> None:
        """Padding keeps the state: its update gate is shut."""
        self.table[: self.states, PAD] = -60

    def step(self, h: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
        k, own = self.states, self.recur @ h
        given = np.take(self.table, symbols, axis=1, mode="clip")  # no symbol is beyond the table
        gates = logistic(given[: 2 * k] + own[: 2 * k])
        z, r, back = gates[:k], gates[k:], own[2 * k :]
        n = r * back
        n += given[2 * k :]
        n = tangent(n)
        new = n - h
        new *= z
        new += h
        return new, z, r, n, back

    def read(self, symbols: np.ndarray) -> Iterator[np.ndarray]:
        """The state after each row of ``symbols`` (steps x windows)."""
        h = np.zeros((self.states, symbols.shape[1]), np.float32)
        for row in symbols:
            h = self.step(h, row)[0]
            yield h

    def learn(self, symbols: np.ndarray, pull: list[np.ndarray], steps: list[tuple]) -> list[np.ndarray]:
        """Gradients of table and recur by going back through time.

        ``steps`` are the results of ``step`` for each row, ``pull`` the gradient of the loss by each state.
        """
        k, count = self.states, len(symbols)
        into, recur = np.empty((count, 3 * k, symbols.shape[1]), np.float32), np.zeros_like(self.recur)
        later = np.zeros_like(pull[0])
        for t in range(count - 1, -1, -1):
            h, (_, z, r, n, back) = (steps[t - 1][0] if t else np.zeros_like(later)), steps[t]
            d = pull[t] + later
            candidate = d * z * (1 - n * n)
            into[t, :k] = d * (n - h) * z * (1 - z)
            into[t, k : 2 * k] = candidate * back * r * (1 - r)
            into[t, 2 * k :] = candidate
            own = into[t].copy()
            own[2 * k :] = candidate * r
            recur += own @ h.T
            later = d * (1 - z) + self.recur.T @ own
        flat, at = into.transpose(1, 0, 2).reshape(3 * k, -1), symbols.ravel()
        return [np.stack([np.bincount(at, row, 257) for row in flat]).astype(np.float32), recur]


class Network:
    """Both directions and the output layer over the learned languages."""

    def __init__(self, languages: list[str], config: NetworkConfig) -> None:
        rng = np.random.default_rng(config.seed)
        self.languages, self.config = languages, config
        self.forward, self.backward = Direction(config.states, rng), Direction(config.states, rng)
        self.out = rng.normal(0, 0.1, (len(languages), 2 * config.states)).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), np.float32)

    def label(self, symbols: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(step, languages x windows): the probabilities of each position, from the last one to the first."""
        k = self.config.states
        ahead = list(self.forward.read(symbols))
        for t, behind in zip(range(len(symbols) - 1, -1, -1), self.backward.read(symbols[::-1])):
            yield t, softmax(self.out[:, :k] @ ahead[t] + self.out[:, k:] @ behind + self.bias)

    def pool(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over the bytes of each text (texts x languages); zeros for an empty one."""
        w = self.config.window
        sizes = np.array([len(t) for t in texts], np.int64)
        windows = -(-sizes // w)
        sums = np.zeros((len(texts), len(self.languages)))
        owner = np.repeat(np.arange(len(texts)), windows)
        first = np.repeat(np.cumsum(windows) - windows, windows)
        inside = np.arange(len(owner)) - first  # the window's number within its text
        raw = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.repeat(np.cumsum(sizes) - sizes, windows) + inside * w
        held = np.minimum(w, np.repeat(sizes, windows) - inside * w)
        for a in range(0, len(owner), self.config.batch):
            some = slice(a, a + self.config.batch)
            at = np.arange(w)[:, None]
            there = at < held[some]
            symbols = np.where(there, raw[np.minimum(begin[some] + at, len(raw) - 1)].astype(np.intp), PAD)  # no byte holds PAD
            total = np.zeros((len(self.languages), symbols.shape[1]), np.float32)
            for t, p in self.label(symbols):
                total += p * there[t]
            for lang, row in enumerate(total):
                sums[:, lang] += np.bincount(owner[some], row, len(texts))
        return sums / np.maximum(1, sizes)[:, None]

    def train(self, windows: list[bytes], labels: np.ndarray) -> None:
        """Steps on the cross-entropy of all positions; languages weigh the same, however many windows they have."""
        config = self.config
        symbols = np.full((config.window, len(windows)), PAD, np.intp)
        for i, window in enumerate(windows):
            symbols[: len(window), i] = np.frombuffer(window, np.uint8)
        weight = (len(windows) / np.bincount(labels, minlength=len(self.languages)).clip(1))[labels]
        rng = np.random.default_rng(config.seed)
        parameters = [self.forward.table, self.forward.recur, self.backward.table, self.backward.recur, self.out, self.bias]
        mean, square, count = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
        batches = -(-len(windows) // config.training_batch)
        for turn in range(config.rounds):
            order = rng.permutation(len(windows))
            for some in np.array_split(order, batches):
                count += 1
                rate = config.rate * (1 - (count - 1) / (config.rounds * batches)) + 1e-4
                for p, g, m, s in zip(parameters, self.gradients(symbols[:, some], labels[some], weight[some]), mean, square):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= (rate / (1 - 0.9**count) * m / (np.sqrt(s / (1 - 0.999**count)) + 1e-8)).astype(np.float32)
                self.forward.close()
                self.backward.close()

    def gradients(self, symbols: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted mean cross-entropy of the positions that hold a byte, by all parameters in turn."""
        k, steps = self.config.states, len(symbols)
        run = {}
        for direction, rows in ((self.forward, symbols), (self.backward, symbols[::-1])):
            h, run[direction] = np.zeros((k, symbols.shape[1]), np.float32), []
            for row in rows:
                run[direction].append(direction.step(h, row))
                h = run[direction][-1][0]
        ahead, behind = run[self.forward], run[self.backward]
        there = symbols != PAD
        scale = (there * weight / max(1e-9, float((there * weight).sum()))).astype(np.float32)
        out, bias, pull_ahead, pull_behind = np.zeros_like(self.out), np.zeros_like(self.bias), [], [None] * steps
        for t in range(steps):
            a, b = ahead[t][0], behind[steps - 1 - t][0]
            error = softmax(self.out[:, :k] @ a + self.out[:, k:] @ b + self.bias)
            error[labels, np.arange(len(labels))] -= 1
            error *= scale[t]
            out[:, :k] += error @ a.T
            out[:, k:] += error @ b.T
            bias += error.sum(axis=1, keepdims=True)
            pull_ahead.append(self.out[:, :k].T @ error)
            pull_behind[steps - 1 - t] = self.out[:, k:].T @ error
        return [
            *self.forward.learn(symbols, pull_ahead, ahead), *self.backward.learn(symbols[::-1], pull_behind, behind), out, bias,
        ]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=0))
    return e / e.sum(axis=0)


def held_out(config: NetworkConfig, doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: its checksum says so, or it has no id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == config.fold, F.lit(True))


def training_windows(docs: DataFrame, config: NetworkConfig) -> list[tuple[str, list[bytes]]]:
    """(lang, windows) of at most ``sample`` labelled documents outside the held-out fold, spread over their texts."""
    raw = F.encode("text", "UTF-8")
    gaps = max(1, config.windows - 1)
    room = F.greatest(F.lit(0), F.octet_length("text") - config.window)
    cut = [F.substring(raw, F.floor(room * i / gaps).cast("int") + 1, F.lit(config.window)) for i in range(config.windows)]
    labelled = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").filter(
        F.col("lang").isNotNull() & ~held_out(config) & F.col("text").rlike(r"\p{L}")
    )
    rows = labelled.select("lang", F.array_distinct(F.array(*cut)).alias("windows"), F.xxhash64("doc_id").alias("hash"), "doc_id")
    chosen = rows.orderBy("hash", "doc_id", "lang", "windows").limit(config.sample).collect()  # bounded, and so are its windows
    return [(r.lang, [bytes(w) for w in r.windows]) for r in chosen]


def fit(docs: DataFrame, config: NetworkConfig) -> Network:
    rows = training_windows(docs, config)
    languages = sorted({lang for lang, _ in rows})
    network = Network(languages, config)
    pairs = [(w, languages.index(lang)) for lang, windows in rows for w in windows]
    if pairs:
        network.train([w for w, _ in pairs], np.array([i for _, i in pairs]))
    return network


def identify(docs: DataFrame, config: NetworkConfig = NetworkConfig()) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred and score, the mean probability of that language.

    ``und`` with score 0: null and empty texts, texts without a letter, and every text if no document has a label to
    learn from. Null languages are not learned from. Null ids count as held out. Repeated rows stay. Very long texts are
    read in whole. Lang, source and doc_id are no inputs of a prediction; only doc_id, text and lang are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, config))  # its size does not depend on the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, room = model.value, config.batch * config.window
        names = network.languages
        for batch in batches:
            texts, lang, score = batch.column("text").to_pylist(), [], []
            at = 0
            while at < len(texts):  # as many texts as fill a batch of windows
                size, begin = 0, at
                while at < len(texts) and (at == begin or size < room):
                    size += len(texts[at] or "")
                    at += 1
                some = [t if t and any(map(str.isalpha, t)) else "" for t in texts[begin:at]]
                pooled = network.pool([t.encode("utf-8", "surrogatepass") for t in some]) if names else None
                for i, t in enumerate(some):
                    best = int(pooled[i].argmax()) if names and t else None
                    lang.append(UNKNOWN if best is None else names[best])
                    score.append(0.0 if best is None else min(1.0, float(pooled[i][best])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")
    return found.select("doc_id", held_out(config).alias("held_out"), "lang_pred", "score")
