"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table of frequent pre-tokens and their numbers of tokens, broadcast
once; tier two is each task's cache of everything else. A pre-token in neither is encoded
in place. Nothing is shuffled, whatever pre-tokens the texts hold.
"""

from __future__ import annotations

from collections import Counter as Counted
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.bpe import GROUP, Encoder, groups, vocabulary
from riskpanel.llm.common import text_slices, tidy


@dataclass(frozen=True)
class CountConfig:
    """``entries`` of at most ``entry_bytes`` are broadcast: 2 MB at most, whatever the data.

    They come from about ``sample_documents`` rows spread over the table. The sample decides what is looked up where, never a count.
    """

    limit: int = 1024
    entries: int = 50_000
    entry_bytes: int = 40
    sample_documents: int = 2_000
    sample_bytes: int = 20_000


def frequent_lengths(docs: DataFrame, vocab, config: CountConfig) -> tuple[bytes, bytes]:
    """The most frequent pre-tokens of a bounded sample, joined by zero bytes, and a byte for each one's length.

    Every row may be in the sample: the hash of its id and text decides, at a rate that gives about ``sample_documents``. Of a
    long text a piece is taken, where the hash says. Nothing is shuffled, and the driver gets twice ``sample_documents``
    pieces at most.
    """
    own, counts = Encoder(vocab.value), Counted()
    rate = min(1.0, config.sample_documents / max(1, docs.count()))
    picked = docs.select("text", F.xxhash64("doc_id", "text").alias("hash")).filter(
        F.col("text").isNotNull() & (F.pmod("hash", F.lit(1 << 30)) <= int(rate * (1 << 30)))
    )
    room = F.greatest(F.lit(1), F.length("text") - config.sample_bytes // 4 + 1)
    start = (F.pmod(F.shiftright("hash", 30), room) + 1).cast("int")
    for row in picked.select(F.substring("text", start, F.lit(config.sample_bytes // 4)).alias("piece")).limit(2 * config.sample_documents).collect():
        counts.update(own.pre_tokens(row.piece))
    usable = [t for t in counts if len(t.encode()) <= config.entry_bytes and "\0" not in t]
    tokens = sorted(usable, key=lambda t: (-counts[t], t))[: config.entries]
    ids = {**own.encode_tokens(t for t in tokens if t not in own.special_ids), **own.special_ids}
    return "\0".join(tokens).encode(), bytes(len(ids[t]) // 4 for t in tokens)


class Counter:
    """Counts tokens with the broadcast table and a cache of bounded size."""

    ROOM = 100_000

    def __init__(self, content: str, table: tuple[bytes, bytes]) -> None:
        self.encoder = Encoder(content)
        names, lengths = table
        self.frequent = dict(zip(names.decode().split("\0"), lengths)) if lengths else {}
        self.cache: dict[str, int] = {}

    def count(self, texts: list[str]) -> Iterator[int]:
        frequent, cache = self.frequent, self.cache
        for group in groups(texts):
            split = [self.encoder.pre_tokens(text) for text in group]
            missing = {t for tokens in split for t in tokens if t not in frequent}.difference(cache)
            special = self.encoder.special_ids
            new = {t: len(ids) // 4 for t, ids in self.encoder.encode_tokens(missing.difference(special)).items()}
            new |= dict.fromkeys(missing.intersection(special), 1)
            for tokens in split:
                yield sum([frequent.get(t) or cache.get(t) or new[t] for t in tokens])
            if len(cache) < self.ROOM:
                cache |= {t: n for t, n in new.items() if len(t) <= 64}


def count_tokens(docs: DataFrame, path: str, config: CountConfig = CountConfig()) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts: 0 bytes, 0 tokens. Repeated rows stay. Only doc_id and text are read.
    """
    vocab = vocabulary(docs.sparkSession, path)
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, vocab, config))
    limit = config.limit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(vocab.value, table.value)  # not while the JVM still gathers the first batch
            for some in text_slices(batch, GROUP):
                texts = [t or "" for t in some.column("text").to_pylist()]
                n = np.fromiter(counter.count(texts), np.int64, len(texts))
                size = pa.array([len(t.encode()) for t in texts], pa.int64())
                columns = [some.column("doc_id"), size, pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        tidy(run), f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
