"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A leaf of the tree holds rank and place of the pair that begins at a symbol, so its root is
the leftmost of the lowest-ranked pairs. A merge changes three leaves, and each change costs
the height of the tree. Merging ends when the root holds no pair. Short pre-tokens are
merged many at a time, one tree each, as rows of an array; long ones alone.

Each text is split by the special strings of the vocabulary file first, as its library does by
default, then by the pattern, and every pre-token is looked up in the task's bounded cache.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.llm.common import text_slices, tidy

# Fixed value: the pattern that cuts text into pre-tokens. White space is spelled out as Unicode has it.
_WHITE = r"\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)

NONE = np.int64(1) << np.int64(60)
LONG = 64  # symbols from which a pre-token gets a tree of its own
CELLS = 1 << 16  # bytes of short pre-tokens, padded to a power of two, merged at a time
CACHED = 100_000  # entries of a task's cache
CACHED_BYTES = 64  # longest pre-token kept there
GROUP = 500_000  # characters of text worked on at a time, and bytes of texts taken from a batch at a time


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary file: itself if it prints, else one from 256 on."""
    printing = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [b for b in range(256) if b not in printing]
    return [chr(b) if b in printing else chr(256 + others.index(b)) for b in range(256)]


class Encoder:
    """Encoder and decoder of one vocabulary file (its JSON text)."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        model, letters = spec["model"], byte_letters()
        vocabulary = model["vocab"]
        byte_of = {letter: b for b, letter in enumerate(letters)}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right, merged = (
            np.array([vocabulary[x] for x in column], np.int64)
            for column in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs])
        )
        self.merged = merged
        self.first = np.array([vocabulary[letter] for letter in letters], np.int64)
        self._hash_pairs(left, right)
        specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.text_of = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items()}
        self.text_of |= {i: token.encode() for token, i in specials.items()}
        self.special_ids = {token: np.uint32(i).tobytes() for token, i in specials.items()}
        longest_first = sorted(specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if specials else None
        self.pattern = regex.compile(PATTERN)
        self.cache: dict[str, bytes] = {}

    # ranks of pairs: a table with open addressing, probed for whole arrays

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return (key * np.int64(0x9E3779B1) >> np.int64(15)) & np.int64(self.size - 1)

    def _hash_pairs(self, left: np.ndarray, right: np.ndarray) -> None:
        self.size = 1 << (int(len(left)) * 8).bit_length()
        self.keys, self.ranks = np.full(self.size, -1, np.int64), np.full(self.size, NONE, np.int64)
        key, rank = left << np.int64(20) | right, np.arange(len(left), dtype=np.int64)
        slot = self._slots(key)
        while len(key):
            free = self.keys[slot] < 0
            winner = np.zeros(len(key), bool)
            at, first = np.unique(slot[free], return_index=True)
            winner[np.flatnonzero(free)[first]] = True
            self.keys[slot[winner]], self.ranks[slot[winner]] = key[winner], rank[winner]
            known = ~winner & (self.keys[slot] == key)  # a pair that is listed again keeps its first rank
            rest = ~winner & ~known
            key, rank, slot = key[rest], rank[rest], (slot[rest] + 1) & (self.size - 1)

    @cached_property
    def rank_of(self) -> dict[int, int]:
        """The same table as a dictionary, for pre-tokens that are merged alone."""
        held = np.flatnonzero(self.keys >= 0)
        return dict(zip(self.keys[held].tolist(), self.ranks[held].tolist()))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where it is not mergeable."""
        key = left << np.int64(20) | right
        slot = self._slots(key)
        ranks, held = self.ranks[slot], self.keys[slot]
        open_ = np.flatnonzero((held != key) & (held >= 0))
        ranks[held != key] = NONE
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (self.size - 1)
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            ranks[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return ranks

    # merging

    def _merge_rows(self, tokens: list[bytes], bits: int) -> list[bytes]:
        """Ids of tokens of 2 to 2**bits bytes; row i of each array belongs to token i."""
        width = 1 << bits
        raw = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in tokens), np.uint8).reshape(-1, width)
        length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        symbol = self.first[raw]
        column = np.arange(width)
        after = np.broadcast_to(column + 1, raw.shape).copy()
        before = np.broadcast_to(column - 1, raw.shape).copy()
        alive = column < length[:, None]
        tree = np.full((len(tokens), 2 * width), NONE, np.int64)
        has_pair = column[:-1] < (length - 1)[:, None]
        ranks = self.pair_ranks(symbol[:, :-1][has_pair], symbol[:, 1:][has_pair])
        leaf = np.full(has_pair.shape, NONE, np.int64)
        leaf[has_pair] = np.where(ranks < NONE, ranks << bits, NONE)
        tree[:, width:-1] = np.where(leaf < NONE, leaf | column[:-1], NONE)
        for level in range(bits - 1, -1, -1):
            lo = 1 << level
            tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])
        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            root = tree[row, 1]
            at = root & (width - 1)
            gone = after[row, at]
            symbol[row, at] = self.merged[root >> bits]
            alive[row, gone] = False
            then = after[row, gone]
            after[row, at] = then
            inside = then < length[row]
            before[row[inside], then[inside]] = at[inside]
            prior = before[row, at]
            own = np.full(len(row), NONE, np.int64)
            own[inside] = self._leaf(symbol[row[inside], at[inside]], symbol[row[inside], then[inside]], at[inside], bits)
            begun = np.flatnonzero(prior >= 0)
            of, prior, here = row[begun], prior[begun], at[begun]
            self._update(tree, row, gone + width, np.full(len(row), NONE, np.int64))
            self._update(tree, row, at + width, own)
            self._update(tree, of, prior + width, self._leaf(symbol[of, prior], symbol[of, here], prior, bits))
            row = row[tree[row, 1] < NONE]
        ids = symbol[alive].astype(np.uint32).tobytes()
        ends = np.cumsum(alive.sum(axis=1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        ranks = self.pair_ranks(left, right)
        return np.where(ranks < NONE, ranks << bits | at, NONE)

    @staticmethod
    def _update(tree: np.ndarray, row: np.ndarray, node: np.ndarray, value: np.ndarray) -> None:
        tree[row, node] = value
        for _ in range(tree.shape[1].bit_length() - 2):
            value = np.minimum(value, tree[row, node ^ 1])
            node = node >> 1
            tree[row, node] = value

    def _merge_long(self, token: bytes) -> bytes:
        """Ids of one long token, by the same tree in lists."""
        symbol = self.first[np.frombuffer(token, np.uint8)].tolist()
        n = len(symbol)
        width = 1 << (n - 1).bit_length()
        after, before, none = list(range(1, n + 1)), list(range(-1, n - 1)), (int(NONE), 0)
        tree = [none] * (2 * width)

        def pair(i: int) -> tuple[int, int]:
            j = after[i]
            rank = self.rank_of.get(symbol[i] << 20 | symbol[j]) if j < n else None
            return none if rank is None else (rank, i)

        def update(i: int, value: tuple[int, int]) -> None:
            node = i + width
            tree[node] = value
            while node > 1:
                node >>= 1
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        for i in range(n):
            tree[width + i] = pair(i)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        merged = self.merged.tolist()
        while tree[1] < none:
            rank, i = tree[1]
            j = after[i]
            symbol[i], symbol[j] = merged[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            update(j, none)
            update(i, pair(i))
            if before[i] >= 0:
                update(before[i], pair(before[i]))
        return np.array([s for s in symbol if s >= 0], np.uint32).tobytes()

    def encode_tokens(self, tokens: Iterable[str]) -> dict[str, bytes]:
        """Ids of different pre-tokens, as unsigned 32-bit integers, little-endian."""
        done: dict[str, bytes] = {}
        by_bits: dict[int, list[tuple[str, bytes]]] = {}
        for token in tokens:
            raw = token.encode("utf-8", "surrogatepass")
            if len(raw) == 1:
                done[token] = self.first[raw[0]].astype(np.uint32).tobytes()
            elif len(raw) > LONG:
                done[token] = self._merge_long(raw)
            else:
                by_bits.setdefault((len(raw) - 1).bit_length(), []).append((token, raw))
        for bits, listed in by_bits.items():
            step = CELLS >> bits
            for i in range(0, len(listed), step):
                some = listed[i : i + step]
                done.update(zip((t for t, _ in some), self._merge_rows([r for _, r in some], bits)))
        return done

    # texts

    def pre_tokens(self, text: str) -> list[str]:
        if not self.special:
            return self.pattern.findall(text)
        found: list[str] = []
        for part in self.special.split(text):
            if part in self.special_ids:
                found.append(part)
            elif part:
                found.extend(self.pattern.findall(part))
        return found

    def known(self, tokens: Iterable[str]) -> dict[str, bytes]:
        """A mapping that has the ids of all ``tokens``: the cache, or a copy with what it has no room for."""
        missing = set(tokens).difference(self.cache)
        missing.difference_update(self.special_ids)
        new = self.encode_tokens(missing)
        kept = {t: ids for t, ids in new.items() if len(t) <= CACHED_BYTES} if len(self.cache) < CACHED else {}
        self.cache |= kept
        return {**new, **self.special_ids}

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for group in groups(texts):
            split = [self.pre_tokens(text) for text in group]
            extra = self.known(t for tokens in split for t in tokens)
            look, other = self.cache.get, extra.get
            for tokens in split:
                yield b"".join([look(t) or other(t) for t in tokens])

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        text_of = self.text_of
        return b"".join([text_of[i] for i in np.frombuffer(ids, np.uint32).tolist()]).decode("utf-8", "replace")


def groups(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in order, so many at a time that they have about GROUP characters."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def vocabulary(spark: SparkSession, path: str):
    """The content of a vocabulary file for all executors; its size does not depend on the data."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _with_columns(docs: DataFrame, vocab, compute: Callable, added: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None  # the task's: a worker that keeps one holds it through whatever stages come next
        for batch in batches:
            own = own or Encoder(vocab.value)  # not while the JVM still gathers the first batch
            for some in text_slices(batch, GROUP):
                texts = [t or "" for t in some.column("text").to_pylist()]
                columns = list(zip(*compute(own, texts))) or [()] * len(added)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), *(pa.array(c, k) for c, (_, _, k) in zip(columns, added))],
                    names=["doc_id", *(name for name, _, _ in added)],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {id_type}", *(f"{name} {kind}" for name, kind, _ in added)])
    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, ids (array of token ids) and the decoded text.

    Null and empty texts: no ids, decoded empty. Repeated rows stay. No shuffle; memory of a task is bounded by
    its batch, its cache and its longest text. Only doc_id and text are read.
    """
    def compute(own: Encoder, texts: list[str]) -> Iterator[tuple]:
        for ids in own.encode(texts):
            yield np.frombuffer(ids, np.uint32).astype(np.int64), own.decode(ids)

    added = [("ids", "array<bigint>", pa.list_(pa.int64())), ("decoded", "string", pa.string())]
    return _with_columns(docs, vocabulary(docs.sparkSession, path), compute, added)


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, is_lossless; the ids stay in their task.

    ``is_lossless`` compares the decoded text with the text. Cases as in ``encode_documents``.
    """
    def compute(own: Encoder, texts: list[str]) -> Iterator[tuple]:
        for text, ids in zip(texts, own.encode(texts)):
            decoded = own.decode(ids)
            yield (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), decoded == text)

    added = [
        ("n_tokens", "bigint", pa.int64()), ("ids_sha256", "string", pa.string()),
        ("decoded_sha256", "string", pa.string()), ("is_lossless", "boolean", pa.bool_()),
    ]
    return _with_columns(docs, vocabulary(docs.sparkSession, path), compute, added)
