"""Phrase collocation mining with weighted acyclic automata.

A count automaton spells n-grams word by word; the arc that ends an n-gram carries its count, and states with the
same arcs are one. The texts of a task form shards of bounded size. For each shard:

1. *Build.* Its n-grams are sorted, and automata are built from the sorted list: states are closed from the
   longest prefixes up and looked up in a register, so equal ends are kept once.
2. *Union.* Each n-gram belongs to a range of the order of prefixes (the digest of its first three words). A shard sends one
   automaton per range; a range's automata are united and their weights summed. If there are many ranges, they are cut in
   several steps, so no step cuts a shard finely.
3. *Compose.* The parts of every cut of a phrase are looked up in the automaton of their range.

Words and word pairs are counted first. A part of a phrase occurs at least as often as the phrase, so longer phrases
are counted only where all their pairs pass a Bloom filter of fixed size over the frequent pairs; what it lets through
wrongly falls to the exact counts. For the same reason automata keep only n-grams with enough occurrences, and
no part of a candidate is missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.functions import splittable_join
from riskpanel.llm.common import join_small, stored


@dataclass(frozen=True)
class PhraseConfig:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; the ``top`` best of each language.

    The other sizes bound what a task holds, and change no result: words of a shard, bytes of text to a range and the fewest
    ranges, pieces per cut, and bits of the filter (8 MB).
    """

    longest: int = 5
    least: int = 100
    top: int = 2000
    shard_words: int = 2_000_000
    range_bytes: int = 24_000_000
    least_ranges: int = 64
    fan: int = 256
    filter_bits: int = 1 << 26
    rows_per_task: int = 50_000

    def __post_init__(self) -> None:
        if self.longest < 2 or self.least < 1 or self.fan < 2 or self.filter_bits % 64:
            raise ValueError("phrases have two words or more and occur at least once; fan from 2, bits in words of 64")


# What ends a piece, and what separates the words of one.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"

BREAK = b"."  # stands for all of them, since no word holds one
_MAP = bytes.maketrans(BREAKS + BLANKS, BREAK * len(BREAKS) + b" " * len(BLANKS))
PREFIX = 3  # words that decide the range of an n-gram
FINER = 4  # pieces of a range in which parts are looked up
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
AUTOMATA = "lang string, slice bigint, part bigint, total bigint, words binary, arcs array<binary>"
_AUTOMATA = pa.schema([
    ("lang", pa.string()), ("slice", pa.int64()), ("part", pa.int64()), ("total", pa.int64()), ("words", pa.binary()),
    ("arcs", pa.list_(pa.binary())),
])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def digests(lang: str, words: list[bytes]) -> np.ndarray:
    """A digest of each word of a language."""
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def joint(own: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """A digest of each row of word numbers; -1 stands for no word."""
    h = np.zeros(len(grams), np.uint64)
    for column in grams.T:
        there = column >= 0
        h[there] = mixed(h[there] * GOLDEN + own[column[there]])
    return h


def slices(own: np.ndarray, grams: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each n-gram: equal slices of the order of the digests of their prefixes."""
    return ((joint(own, grams[:, :PREFIX]) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def starts(rows: np.ndarray) -> np.ndarray:
    """Where a sorted array of rows has a new one."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return np.flatnonzero(new)


def summed(grams: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with the sums of their weights (or how often they occur)."""
    if not len(grams):
        return grams, np.empty(0, np.int64)
    if grams.shape[1] == 2:  # two word numbers fit one integer
        key = (grams[:, 0].astype(np.int64) << 32) | (grams[:, 1].astype(np.int64) + 1)
        order = None if weights is None else np.argsort(key, kind="stable")
        key = np.sort(key) if order is None else key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        distinct = np.stack([key[first] >> 32, (key[first] & 0xFFFFFFFF) - 1], axis=1).astype(np.int32)
    else:
        order = np.lexsort(grams.T[::-1])
        grams = grams[order]
        first = starts(grams)
        distinct = grams[first]
    if weights is None:
        return distinct, np.diff(np.append(first, len(order) if order is not None else len(key)))
    return distinct, np.add.reduceat(weights[order], first)


def small(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type, which travels best."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def pack(*columns: np.ndarray) -> bytes:
    parts = [small(c) for c in columns]
    head = np.array([x for p in parts for x in (len(p), p.itemsize)], np.int64)
    return b"".join([np.array([len(parts)], np.int64).tobytes(), head.tobytes(), *(p.tobytes() for p in parts)])


def unpack(content: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(content, np.int64, 1)[0])
    head, at, out = np.frombuffer(content, np.int64, 2 * n, 8), 8 + 16 * n, []
    for length, size in head.reshape(n, 2).tolist():
        out.append(np.frombuffer(content, f"<u{size}", length, at).astype(np.int64))
        at += length * size
    return out


class Automaton:
    """A weighted acyclic automaton over words.

    Level d holds the states reached by d words: ``sizes[d]`` arcs of each state, and for all arcs in order their
    ``labels`` (word numbers, ascending within a state), ``weights`` (0: no n-gram ends here) and ``targets`` in level d + 1.
    """

    def __init__(self, words: list[bytes], levels: list[tuple[np.ndarray, ...]]) -> None:
        self.words, self.levels = words, levels

    @classmethod
    def build(cls, words: list[bytes], grams: np.ndarray, weights: np.ndarray) -> Automaton:
        """From distinct n-grams in order, shorter ones padded with -1 and so before their continuations."""
        used = np.unique(grams)
        used = used[used >= 0]
        number = np.zeros(len(words) + 1, np.int64)
        number[used] = np.arange(len(used))
        depth, arcs = grams.shape[1], []
        new = np.ones(len(grams), bool)  # where a prefix of d words begins
        new[1:] = False
        for d in range(depth):  # the arcs of the tree of prefixes, level by level
            new = new.copy()
            new[1:] |= grams[1:, d] != grams[:-1, d]
            at = np.flatnonzero(new & (grams[:, d] >= 0))
            ends = np.ones(len(at), bool) if d + 1 == depth else grams[at, d + 1] < 0
            arcs.append((at, number[grams[at, d]], np.where(ends, weights[at], 0)))
        levels, states = [], None
        for d in range(depth - 1, -1, -1):  # states close from the longest prefixes up
            at, label, weight = arcs[d]
            parents = arcs[d - 1][0] if d else np.zeros(1, np.int64)
            below = np.zeros(len(at), np.int64) if states is None else states
            cut = np.searchsorted(at, np.append(parents, len(grams)))
            level, states = cls._register(cut, label, weight, below)
            levels.append(level)
        return cls([words[i] for i in used.tolist()], levels[::-1])

    @staticmethod
    def _register(cut: np.ndarray, label: np.ndarray, weight: np.ndarray, below: np.ndarray) -> tuple[tuple, np.ndarray]:
        """The distinct states of one level and the number of each prefix's state. State 0 has no arcs.

        States of one arc, the most by far, are told apart by that arc as one number; larger ones by all their arcs.
        """
        sizes, states = np.diff(cut), np.zeros(len(cut) - 1, np.int64)
        first = [np.empty(0, np.int64)]  # where the arcs of each distinct state begin
        count, single = 1, np.flatnonzero(sizes == 1)
        widths = [int(x.max(initial=0)) + 1 for x in (label, weight, below)]
        if widths[0] * widths[1] * widths[2] < 1 << 63:
            at = cut[single]
            _, begin, number = np.unique((label[at] * widths[1] + weight[at]) * widths[2] + below[at], return_index=True, return_inverse=True)
            states[single] = number + 1
            first.append(at[begin])
            count += len(begin)
            several = np.flatnonzero(sizes > 1)
        else:
            several = np.flatnonzero(sizes)
        signature = np.stack([label, weight, below], axis=1).astype(np.int64).tobytes()
        known: dict[bytes, int] = {}
        begins = []
        for i, a, b in zip(several.tolist(), cut[several].tolist(), cut[several + 1].tolist()):
            key = signature[24 * a : 24 * b]
            state = known.get(key)
            if state is None:
                state = known[key] = count + len(known)
                begins.append(a)
            states[i] = state
        begin = np.concatenate([*first, np.array(begins, np.int64)])
        new = np.concatenate([np.ones(len(first[-1]), np.int64), np.array([len(k) // 24 for k in known], np.int64)])
        order = np.repeat(begin - (np.cumsum(new) - new), new) + np.arange(new.sum())
        return (np.concatenate(([0], new)), label[order], weight[order], below[order]), states

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams in order of their words' numbers, level by level, and their counts."""
        depth = len(self.levels)
        paths = np.full((1, depth), -1, np.int32)
        state, out, weights = np.array([len(self.levels[0][0]) - 1]), [], []
        for d, (sizes, label, weight, target) in enumerate(self.levels):
            first = np.cumsum(sizes) - sizes
            n = sizes[state]
            at = np.repeat(first[state] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            paths = np.repeat(paths, n, axis=0)
            paths[:, d] = label[at]
            ends = weight[at] > 0
            out.append(paths[ends])
            weights.append(weight[at][ends])
            state = target[at]
        return np.concatenate(out), np.concatenate(weights)

    def weight(self, phrase: list[int]) -> int:
        """The count of a phrase, given by word numbers; 0 if the automaton does not hold it."""
        state, found = len(self.levels[0][0]) - 1, 0
        if len(phrase) > len(self.levels):
            return 0
        for d, word in enumerate(phrase):
            ends, label, weight, target = self.walk[d]
            a, b = (int(ends[state - 1]) if state else 0), int(ends[state])
            at = a + int(np.searchsorted(label[a:b], word))
            if at == b or label[at] != word:
                return 0
            state, found = int(target[at]), int(weight[at])
        return found

    @property
    def walk(self) -> list[tuple]:
        if not hasattr(self, "_walk"):
            self._walk = [(np.cumsum(sizes), *rest) for sizes, *rest in self.levels]
        return self._walk

    def packed(self) -> tuple[bytes, list[bytes]]:
        return b"\n".join(self.words), [pack(*level) for level in self.levels]

    @classmethod
    def unpacked(cls, words: bytes, levels: list[bytes]) -> Automaton:
        return cls(words.split(b"\n") if words else [], [tuple(unpack(x)) for x in levels])


def cut_ranges(lang: str, words: list[bytes], grams: np.ndarray, weights: np.ndarray, total: int, ranges: int, parts: int) -> Iterator[dict]:
    """One automaton per range that the sorted n-grams fall into; the first carries ``total``."""
    if not len(grams):
        if total:
            yield {"lang": lang, "slice": 0, "part": 0, "total": total, "words": b"", "arcs": []}
        return
    where = slices(digests(lang, words), grams, ranges)
    order = np.argsort(where, kind="stable")
    grams, weights, where = grams[order], weights[order], where[order]
    begin = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
    for a, b in zip(begin, np.append(begin[1:], len(where))):
        own, arcs = Automaton.build(words, grams[a:b], weights[a:b]).packed()
        part = xxhash.xxh3_64_intdigest(own + arcs[0]) % parts
        yield {"lang": lang, "slice": int(where[a]), "part": part, "total": 0 if a else total, "words": own, "arcs": arcs}


class Numbers(dict):
    """Numbers of words in the order in which they first occur; 0 ends a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Shard:
    """The words of some texts, by language."""

    def __init__(self) -> None:
        self.texts: dict[str, tuple[Numbers, list]] = {}
        self.size = 0

    def add(self, lang: str, text: str) -> None:
        if lang not in self.texts:
            self.texts[lang] = Numbers({BREAK: 0}), []
        numbers, parts = self.texts[lang]
        found = text.encode("utf-8", "surrogatepass").lower().translate(_MAP).replace(BREAK, b" . ").split()
        parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
        parts.append(np.zeros(1, np.int32))
        self.size += len(found) + 1

    def languages(self) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        """Each language's words in order and its texts as their numbers, counted from 0, with -1 between pieces."""
        for lang, (numbers, parts) in self.texts.items():
            words = sorted(w for w in numbers if w != BREAK)
            place = np.empty(len(numbers), np.int32)
            place[0] = -1
            place[[numbers[w] for w in words]] = np.arange(len(words))
            yield lang, words, place[np.concatenate(parts)]


def short_grams(lang: str, words: list[bytes], text: np.ndarray, _) -> tuple[np.ndarray, np.ndarray, int]:
    """Words and pairs with their counts, and the number of words."""
    inside = text >= 0
    single = np.bincount(text[inside], minlength=len(words))
    both = inside[:-1] & inside[1:]
    pairs, n = summed(np.stack([text[:-1][both], text[1:][both]], axis=1))
    alone = np.stack([np.arange(len(words), dtype=np.int32), np.full(len(words), -1, np.int32)], axis=1)
    grams, counts = summed(np.concatenate([alone, pairs]), np.concatenate([single, n]))
    return grams, counts, int(inside.sum())


def long_grams(longest: int) -> Callable:
    def run(lang: str, words: list[bytes], text: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Phrases of three words and more whose pairs all pass the filter, with their counts."""
        both = np.flatnonzero((text[:-1] >= 0) & (text[1:] >= 0))
        pair = np.zeros(max(0, len(text) - 1), bool)
        own = digests(lang, words)
        for some in np.array_split(both, 1 + len(both) // 500_000):
            pair[some] = passes(joint(own, np.stack([text[some], text[some + 1]], axis=1)), frequent)
        found, whole = [np.empty((0, longest), np.int32)], pair
        for m in range(3, longest + 1):
            whole = whole[: len(text) - m + 1] & pair[m - 2 :] if len(text) >= m else np.zeros(0, bool)
            at = np.flatnonzero(whole)
            rows = np.full((len(at), longest), -1, np.int32)
            for i in range(m):
                rows[:, i] = text[at + i]
            found.append(rows)
        return *summed(np.concatenate(found)), 0

    return run


def positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a digest in the filter."""
    return tuple(((mixed(h + np.uint64(k)) >> np.uint64(11)) % np.uint64(bits)).astype(np.int64) for k in (1, 2))


def passes(h: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    a, b = positions(h, 64 * len(frequent))
    return ((frequent[a >> 6] >> (a & 63)) & (frequent[b >> 6] >> (b & 63)) & 1) == 1


def shard_automata(count: Callable, config: PhraseConfig, ranges: int, parts: int, frequent=None) -> Callable:
    """Automata of each shard, cut by range; ``count`` gives the n-grams of one language."""

    def flush(shard: Shard) -> Iterator[pa.RecordBatch]:
        bits = frequent.value if frequent else None
        for lang, words, text in shard.languages():
            grams, counts, total = count(lang, words, text, bits)
            rows = list(cut_ranges(lang, words, grams, counts, total, ranges, parts))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_AUTOMATA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                shard.add(lang, text.as_py())
                if shard.size >= config.shard_words:
                    yield from flush(shard)
                    shard = Shard()
        yield from flush(shard)

    return run


def unite(least: int, ranges: int, parts: int) -> Callable:
    """The union of the automata of one language and range, weights summed, cut into finer ranges."""

    def run(rows: pa.Table) -> pa.Table:
        lang, total = rows.column("lang")[0].as_py(), sum(rows.column("total").to_pylist())
        numbers, grams, weights = Numbers(), [], []
        for words, arcs in zip(rows.column("words"), rows.column("arcs")):
            one = Automaton.unpacked(words.as_py(), arcs.as_py())
            if one.words:
                found, counts = one.grams()
                number = np.fromiter(map(numbers.__getitem__, one.words), np.int32, len(one.words))
                grams.append(np.where(found >= 0, number[found], -1))
                weights.append(counts)
        if not grams:
            return pa.Table.from_pylist(list(cut_ranges(lang, [], np.empty((0, 2), np.int32), np.empty(0), total, 1, 1)), schema=_AUTOMATA)
        words = sorted(numbers)
        place = np.empty(len(words), np.int32)
        place[[numbers[w] for w in words]] = np.arange(len(words), dtype=np.int32)
        every, counts = np.concatenate(grams), np.concatenate(weights)
        grams.clear()
        every, counts = summed(np.where(every >= 0, place[every], -1), counts)
        kept = counts >= least
        return pa.Table.from_pylist(list(cut_ranges(lang, words, every[kept], counts[kept], total, ranges, parts)), schema=_AUTOMATA)

    return run


def united(texts: DataFrame, count: Callable, config: PhraseConfig, ranges: int, frequent=None) -> DataFrame:
    """The automata of all texts, ``FINER`` per language and range, with the n-grams that occur often enough.

    Cut in steps of ``fan`` pieces. Before the last step a range is dealt to as many parts as it will be cut into, so every step
    has as many groups as there are ranges.
    """
    cut = min(config.fan, ranges)
    packed = texts.mapInArrow(shard_automata(count, config, cut, -(-ranges // cut), frequent), AUTOMATA)
    while cut < ranges:
        cut = min(config.fan * cut, ranges)
        packed = packed.groupBy("lang", "slice", "part").applyInArrow(unite(1, cut, -(-ranges // cut)), AUTOMATA)
    return packed.groupBy("lang", "slice").applyInArrow(unite(config.least, FINER * ranges, 1), AUTOMATA)


def frequent_pairs(automata: DataFrame, config: PhraseConfig) -> np.ndarray:
    """The filter of the pairs in ``automata``: ``filter_bits`` bits, whatever the data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one = Automaton.unpacked(row["words"], row["arcs"])
                if not one.words:
                    continue
                grams, _ = one.grams()
                pairs = grams[(grams >= 0).sum(axis=1) == 2][:, :2]
                at = np.unique(np.concatenate(positions(joint(digests(row["lang"], one.words), pairs), config.filter_bits)))
                yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], names=["word", "bit"])

    bits = automata.mapInArrow(run, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(config.filter_bits // 64, np.int64)
    out[np.asarray(bits.column("word"))] = np.asarray(bits.column("bits"))
    return out


CUTS = "lang string, phrase string, a bigint, k int, side int, part string, slice bigint"
_CUTS = pa.schema([
    ("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("k", pa.int32()), ("side", pa.int32()),
    ("part", pa.string()), ("slice", pa.int64()),
])


def cut_phrases(ranges: int) -> Callable:
    """Both parts of every cut of every phrase of two words or more, with the range of the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                one = Automaton.unpacked(row["words"], row["arcs"])
                if not one.words:
                    continue
                grams, counts = one.grams()
                own, names, length = digests(row["lang"], one.words), one.words, (grams >= 0).sum(axis=1)
                for m in range(2, grams.shape[1] + 1):
                    some = np.flatnonzero(length == m)
                    for at in np.array_split(some, 1 + len(some) // 20_000):
                        spelled = [[names[i] for i in g] for g in grams[at, :m].tolist()]
                        phrase = [b" ".join(g).decode("utf-8", "surrogatepass") for g in spelled]
                        for k in range(1, m):
                            for side, (x, y) in enumerate(((0, k), (k, m))):
                                part = [b" ".join(g[x:y]).decode("utf-8", "surrogatepass") for g in spelled]
                                n = len(at)
                                yield pa.RecordBatch.from_arrays(
                                    [
                                        pa.array([row["lang"]] * n), pa.array(phrase), pa.array(counts[at]), pa.array(np.full(n, k, np.int32)),
                                        pa.array(np.full(n, side, np.int32)), pa.array(part), pa.array(slices(own, grams[at, x:y], ranges)),
                                    ],
                                    schema=_CUTS,
                                )

    return run


def look_up(automata: pa.Table, asked: pa.Table) -> pa.Table:
    """The counts of the asked parts of one language and range."""
    schema = pa.schema([("lang", pa.string()), ("part", pa.string()), ("f", pa.int64())])
    if not asked.num_rows:
        return schema.empty_table()
    parts = asked.column("part").to_pylist()
    found = np.zeros(len(parts), np.int64)
    for words, arcs in zip(automata.column("words").to_pylist(), automata.column("arcs").to_pylist()):
        one = Automaton.unpacked(words, arcs)
        if not one.words:
            continue
        number = {w: i for i, w in enumerate(one.words)}
        for i, part in enumerate(parts):
            spelled = [number.get(w, -1) for w in part.encode("utf-8", "surrogatepass").split(b" ")]
            if not found[i] and min(spelled) >= 0:
                found[i] = one.weight(spelled)
    return pa.table([asked.column("lang"), asked.column("part"), pa.array(found)], schema=schema)


SCORED = "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"


def best_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lowest score over the cuts of each phrase, in whole numbers of any size; ties to the earliest cut."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), *((c, pa.int64()) for c in ("a", "l", "r", "n", "score"))])
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            parts = {(x["k"], x["side"]): x["f"] for x in row["parts"]}
            a, n = row["a"], row["n"]
            score, _, l, r = min(
                (1000 * a * n // (l * (r := parts[k, 1])), k, l, r) for (k, side), l in parts.items() if not side
            )
            rows.append({"lang": row["lang"], "phrase": row["phrase"], "a": a, "l": l, "r": r, "n": n, "score": score})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def collocations(docs: DataFrame, config: PhraseConfig = PhraseConfig()) -> DataFrame:
    """Every phrase that is no part of a longer one with as many occurrences: lang, phrase, a, l, r, n, score.

    ``a`` occurrences of the phrase, ``l`` and ``r`` of the parts of its weakest cut, ``n`` words of the language. A null
    language is ``und``; null and empty texts have no words. Rows count as often as they occur. Texts that lack
    a phrase frequent enough give no row. Only text and lang are read.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").filter("text IS NOT NULL AND text <> ''")
    letters = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = config.least_ranges + letters // config.range_bytes
    short = stored(united(texts, short_grams, config, ranges), "short")
    automata = short
    if config.longest > 2:
        frequent = docs.sparkSession.sparkContext.broadcast(frequent_pairs(short, config))  # of fixed size
        long = stored(united(texts, long_grams(config.longest), config, ranges, frequent), "long")
        automata = short.unionAll(long)

    # compose every cut with the automata of the ranges of its parts; a part is asked for once
    cuts = stored(automata.select("lang", "words", "arcs").mapInArrow(cut_phrases(FINER * ranges), CUTS), "cuts")
    asked = cuts.groupBy("lang", "slice", "part").agg(F.count(F.lit(1)).alias("times"))
    counts = stored(
        automata.groupBy("lang", "slice").cogroup(asked.groupBy("lang", "slice")).applyInArrow(look_up, "lang string, part string, f bigint"),
        "counts",
    )
    known = stored(splittable_join(cuts.drop("slice"), counts, ["lang", "part"]), "known")

    # a phrase occurs as often as a longer one only if it occurs as often as one with a word more, before or after it
    length = F.size(F.split("phrase", " "))
    covered = known.filter(
        (F.col("f") == F.col("a")) & F.col("part").contains(" ")
        & (((F.col("side") == 0) & (F.col("k") == length - 1)) | ((F.col("side") == 1) & (F.col("k") == 1)))
    ).select("lang", F.col("part").alias("phrase")).distinct()
    own = known.groupBy("lang", "phrase", "a").agg(F.collect_list(F.struct("k", "side", "f")).alias("parts"))  # two per cut
    totals = stored(short.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    candidates = own.join(covered, ["lang", "phrase"], "left_anti")
    return join_small(candidates, totals, ["lang"], "inner").mapInArrow(best_cuts, SCORED)


def top_phrases(docs: DataFrame, config: PhraseConfig = PhraseConfig()) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    By score and a, both descending, then phrase in the order of UTF-8 bytes. Rows are sorted by range into tasks of bounded
    size and numbered there, shifted by what earlier tasks hold of the language, so no language has to fit a task.
    """
    scored = stored(collocations(docs, config), "scored")
    order = [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")]
    tasks = max(1, -(-scored.count() // config.rows_per_task))
    numbered = stored(
        scored.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "numbered",
    )
    held = numbered.groupBy("lang", "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy("lang").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shift = held.select("lang", "_task", (F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    ranked = join_small(numbered, stored(shift, "shift"), ["lang", "_task"], "inner").withColumn("rank", F.col("_at") + F.col("_shift"))
    return ranked.filter(F.col("rank") <= config.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
