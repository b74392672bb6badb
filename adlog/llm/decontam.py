"""Benchmark decontamination: fingerprints of item-sized windows, looked up within a Hamming radius, then verified.

Every item has a SimHash of its words. In a document, the windows of an item's size that share a shingle with the item are
fingerprinted; a window without one has similarity 0 and needs no fingerprint. The index of item fingerprints is cut
in blocks of bits: two fingerprints within the radius agree in one block up to one bit at least, so looking up each block
and its one-bit neighbours finds all of them. What is found is verified by the weighted Jaccard similarity of shingles.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from adlog.llm.common import WordHashes, free_name, hashed, shingles, small_batches, words_of

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 1
#: Guaranteed: were all blocks two bits apart, the distance would be 16.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Items are sent to the tasks in portions of about this many characters; each portion is a pass over the documents.
PORTION = 8_000_000
#: Windows of a document that are fingerprinted at once start within this many words.
STRETCH = 4096

_BITS = np.arange(64, dtype=np.uint64)
_U = np.uint64


def signs(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For every word, its weight with the sign of each of its hash's bits."""
    bits = ((hashes[:, None] >> _BITS) & _U(1)).astype(np.int32)
    return (2 * bits - 1) * weights[:, None].astype(np.int32)


def packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 sums: the bits whose sum is positive."""
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


@dataclass
class Item:
    item: object
    size: int
    shingle: int
    fingerprint: int
    keys: np.ndarray  # its different shingles, sorted
    times: np.ndarray
    weights: np.ndarray  # characters of each
    total: float

    def similarity(self, keys: np.ndarray, weights: np.ndarray) -> float:
        """Weighted Jaccard similarity with a window's shingles, which may repeat."""
        own, at, times = np.unique(keys, return_index=True, return_counts=True)
        where = np.searchsorted(self.keys, own)
        where[where == len(self.keys)] = 0
        same = self.keys[where] == own
        shared = (np.minimum(times, self.times[where]) * self.weights[where])[same].sum()
        return float(shared / (self.total + (weights[at] * times).sum() - shared))


@dataclass
class Index:
    items: list[Item] = field(default_factory=list)
    #: shingle length -> sorted shingles of all items, and for each the items that have it
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    holders: dict[int, dict[int, list[int]]] = field(default_factory=dict)
    #: size -> block -> value -> items whose block is within one bit of it
    blocks: dict[int, list[dict[int, list[int]]]] = field(default_factory=dict)


def shingle_weights(lengths: np.ndarray, size: int) -> np.ndarray:
    through = np.concatenate([[0], np.cumsum(lengths)])
    return through[size:] - through[:-size]


def build(rows: list[tuple[object, str]]) -> Index:
    index, memory = Index(), WordHashes()
    for item, text in rows:
        words = words_of(text)
        if not words:
            continue
        hashes, lengths = hashed(words, memory), np.array([len(w) for w in words], dtype=np.int64)
        k = min(SHINGLE, len(words))
        found, weights = shingles(hashes, k), shingle_weights(lengths, k)
        keys, at, times = np.unique(found, return_index=True, return_counts=True)
        fingerprint = int(packed(signs(hashes, lengths).sum(axis=0)[None, :])[0])
        index.items.append(Item(item, len(words), k, fingerprint, keys, times, weights[at], float((weights[at] * times).sum())))
    for i, item in enumerate(index.items):
        holders = index.holders.setdefault(item.shingle, defaultdict(list))
        for key in item.keys.tolist():
            holders[key].append(i)
        blocks = index.blocks.setdefault(item.size, [defaultdict(list) for _ in range(BLOCKS)])
        for b in range(BLOCKS):
            value = item.fingerprint >> (b * BLOCK_BITS) & ((1 << BLOCK_BITS) - 1)
            for near in [value, *(value ^ (1 << bit) for bit in range(BLOCK_BITS))]:
                blocks[b][near].append(i)
    index.keys = {k: np.array(sorted(h), dtype=np.uint64) for k, h in index.holders.items()}
    return index


class Matcher:
    """Windows of one document after the other against an index."""

    def __init__(self, index: Index):
        self.index, self.memory = index, WordHashes()
        self.seen = {}
        for k, keys in index.keys.items():
            self.seen[k] = np.zeros(1 << 20, dtype=bool)
            self.seen[k][(keys >> _U(44)).astype(np.int64)] = True

    def hits(self, found: np.ndarray, k: int) -> np.ndarray:
        """Positions whose shingle belongs to an item."""
        maybe = np.flatnonzero(self.seen[k][(found >> _U(44)).astype(np.int64)])
        if not len(maybe):
            return maybe
        keys = self.index.keys[k]
        at = np.searchsorted(keys, found[maybe])
        at[at == len(keys)] = 0
        return maybe[keys[at] == found[maybe]]

    def near(self, size: int, fingerprint: int) -> set[int]:
        """Items of a size within the radius, by their blocks."""
        found: set[int] = set()
        for b, table in enumerate(self.index.blocks[size]):
            found.update(table.get(fingerprint >> (b * BLOCK_BITS) & ((1 << BLOCK_BITS) - 1), ()))
        return {i for i in found if (self.index.items[i].fingerprint ^ fingerprint).bit_count() <= RADIUS}

    def document(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """The best window (item, first word, bits apart, similarity) of every item that the text contains."""
        words = words_of(text)
        if not words or not self.index.items:
            return []
        hashes, out = hashed(words, self.memory), []
        lengths = None
        for k in self.index.keys:
            if len(words) < k:
                continue
            found = shingles(hashes, k)
            at = self.hits(found, k)
            if not len(at):
                continue
            if lengths is None:
                lengths = np.array([len(w) for w in words], dtype=np.int64)
            of: dict[int, list[int]] = defaultdict(list)
            for p, key in zip(at.tolist(), found[at].tolist()):
                for i in self.index.holders[k][key]:
                    of[i].append(p)
            weights = shingle_weights(lengths, k)
            for i, places in of.items():
                best = self.best(i, np.array(places), found, weights, hashes, lengths)
                if best:
                    out.append(best)
        return sorted(out)

    def best(self, i: int, places: np.ndarray, found, weights, hashes, lengths) -> tuple[int, int, int, float] | None:
        item, n = self.index.items[i], len(hashes)
        size = min(item.size, n)
        inner = size - item.shingle  # a window from s holds the shingles s .. s + inner
        # of the windows that hold a shared shingle, those whose shared weight can reach the threshold
        lows, highs = np.maximum(places - inner, 0), np.minimum(places, n - size)
        starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(lows, highs)])) if len(places) else places
        shared = np.zeros(len(found) + 1)
        shared[places + 1] = weights[places]
        shared, whole = np.cumsum(shared), np.concatenate([[0], np.cumsum(weights)])
        most = shared[starts + inner + 1] - shared[starts]
        rest = whole[starts + inner + 1] - whole[starts]
        starts = starts[np.minimum(most, item.total) >= SIMILARITY * np.maximum(rest, item.total) - 1e-9]
        if not len(starts):
            return None
        best = None
        for few in np.split(starts, np.flatnonzero(np.diff(starts // STRETCH)) + 1):
            first, last = int(few[0]), int(few[-1])
            sums = np.cumsum(signs(hashes[first : last + size], lengths[first : last + size]), axis=0)
            sums = np.vstack([np.zeros((1, 64), dtype=sums.dtype), sums])
            prints = packed(sums[few - first + size] - sums[few - first])
            for start, fingerprint in zip(few.tolist(), prints.tolist()):
                if i in self.near(item.size, fingerprint):
                    similarity = item.similarity(found[start : start + inner + 1], weights[start : start + inner + 1])
                    if similarity >= SIMILARITY and (best is None or similarity > best[3]):
                        best = (i, start, (fingerprint ^ item.fingerprint).bit_count(), similarity)
        return best


def _portions(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[object, str]]]:
    known = items.where(F.col(text).isNotNull()).select(F.col(item_id).alias("item"), F.col(text).alias("text")).distinct()
    n = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-n // PORTION))
    for part in range(parts):
        mine = known.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part)
        yield sorted(((r[0], r[1]) for r in mine.collect()), key=lambda r: (r[0] is None, r[0], r[1]))


def _look(shared, leak: StructType):
    """The function of a text column that finds the leaks of an index."""
    memory: list[Matcher] = []

    @F.pandas_udf(ArrayType(leak))
    def look(texts: pd.Series) -> pd.Series:
        if not memory:
            memory.append(Matcher(shared.value))
        items, out = memory[0].index.items, []
        for x in texts:
            found = memory[0].document(x) if isinstance(x, str) else []
            out.append([{"item": items[i].item, "first_word": s, "words": items[i].size, "bits": b, "similarity": v} for i, s, b, v in found])
        return pd.Series(out)

    return look


def matches(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", into: str = "leaks") -> DataFrame:
    """The same rows with an array of leaks (item, first_word, words, bits, similarity), one for each item a text contains.

    NULL, empty and wordless texts contain nothing, and such items are nowhere. Repeated items count once each id; repeated
    documents agree. Empty tables of documents or items give no leaks. A document shorter than an item is one window.
    Items go to the tasks in portions of a bounded number of characters, one pass over the documents for each.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = items.schema[item_id].dataType
    leak = StructType(
        [StructField("item", kind)] + [StructField(n, IntegerType()) for n in ("first_word", "words", "bits")] + [StructField("similarity", DoubleType())]
    )
    out, columns = docs, []
    for rows in _portions(items, item_id, item_text):
        look = _look(spark.sparkContext.broadcast(build(rows)), leak)
        (name,) = free_name(out, "portion")
        out, columns = out.withColumn(name, look(F.col(text))), [*columns, name]
    return out.withColumn(into, F.concat(*columns)).drop(*columns)


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Only the documents that contain no item."""
    (name,) = free_name(docs, "leaks")
    return matches(docs, items, text, into=name).where(F.size(name) == 0).drop(name)
