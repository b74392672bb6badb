"""Exact top-k search: BM25 over an inverted index in shards with block-max WAND pruning, merged exactly.

Every shard is a row of a Parquet table: the postings of like documents by term, in document order. Many queries are searched in a shard
at once. The lists of terms that are rare in it are read whole. Those of frequent terms are columns of an array: as in WAND, a document is a
pivot if what it has so far and the block maxima of the lists to come reach a lower bound of the k-th best score; products of arrays
read the columns for all queries in the blocks of their pivots and skip them elsewhere, the most frequent ones last. Sums are single
precision and may be off by a known amount; what may be among the best is scored anew in doubles.

The bound is shared: shards are searched in rounds, each some four times the one before, and a round starts from the k-th best
score of all earlier ones. Tasks merge their shards before rows go out. Frequencies, the number of documents and the mean length
are global, so scores of different shards compare.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlog.llm.common import small_batches, spans, stage, unstage, word_hashes

K1, B = 1.2, 0.75
BLOCK = 64
#: A task closes a shard at so many words or documents.
SHARD_WORDS, SHARD_DOCS = 4_000_000, 65_536
#: Terms of the queries that are sent to the tasks at once, about; each portion is a pass over the index.
PORTION_TERMS = 1_000_000
#: Shards have levels by a hash, each about a quarter as large as the one below; the first round has this many shards or more.
LEVELS, FIRST_SHARDS = 12, 8
#: A term that so large a share of a shard's documents has is frequent; arrays of documents and queries or terms have so many cells at most.
FREQUENT, CELLS = 0.05, 2_000_000
#: Documents are grouped by so many of the most frequent terms, halved so many times.
GROUP_TERMS, HALVINGS = 256, 2
#: Groups of fewer than twice so many documents are not halved.
GROUP_DOCS = 512
#: One in so many columns, of the most frequent terms, is read last.
COMMON = 8
#: Blocks that are read at once where most of them have pivots.
TOGETHER = 4
#: Postings of rare terms that are added up at once, about.
AT_ONCE = 1 << 16
#: Scores count to this many digits; documents of equal scores are ordered by id, NULL last.
DIGITS = 6
NO_ID = np.iinfo(np.int64).min

SHARD = "shard string, docs long, words long, ids binary, lengths binary, terms binary, ends binary, places binary, times binary, level int"


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents, as a staged table with a row for each shard. NULL texts are empty ones. Ids are whole numbers."""
    small_batches(docs.sparkSession)

    def build(batches):
        held: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        words = 0
        for pdf in batches:
            for ident, terms in zip(pdf["doc_id"], _terms(pdf["text"].tolist())):
                unique, times = np.unique(terms, return_counts=True)
                held.append((NO_ID if pd.isna(ident) else int(ident), unique, times.astype("<u4"), len(terms)))
                words += len(terms)
                if words >= SHARD_WORDS or len(held) >= SHARD_DOCS:
                    some, held, words = held, [], 0
                    yield from map(_shard, _alike(some))
                    del some
        if held:
            yield from map(_shard, _alike(held))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stage(rows.mapInPandas(build, SHARD), "index", partitionBy="level")


def _terms(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of each text's words."""
    for hashes, ends in word_hashes(texts):
        start = 0
        for end in ends.tolist():
            yield hashes[start:end]
            start = end


def _groups(docs: list[np.ndarray], halvings: int) -> np.ndarray:
    """A number for each document, of those with much the same frequent terms: all are halved along what tells them apart most, then the
    halves. Terms are told by some bits of their hashes. The numbers decide on places of documents alone."""
    place, term = np.repeat(np.arange(len(docs)), [len(x) for x in docs]), np.concatenate(docs)
    bits = (term & np.uint64(0xFFFF)).astype(np.int64)
    often = np.argsort(-np.bincount(bits, minlength=1 << 16), kind="stable")[:GROUP_TERMS]
    column = np.full(1 << 16, -1)
    column[often] = np.arange(len(often))
    column = column[bits]
    has = column >= 0
    rows = np.zeros((len(docs), len(often)), dtype=np.float32)
    rows[place[has], column[has]] = 1
    rows /= np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
    group = np.zeros(len(docs), dtype=np.int64)
    for _ in range(halvings):
        group *= 2
        for one in np.unique(group).tolist():
            of = np.flatnonzero(group == one)
            if len(of) < 2 * GROUP_DOCS:
                continue
            some = rows[of] - rows[of].mean(0)
            axis = some.T @ some[:, np.argmax(np.square(some).sum(0))]
            for _ in range(8):
                axis = some.T @ (some @ (axis / max(float(np.sqrt(axis @ axis)), 1e-12)))
            group[of] += some @ axis > 0
    return group


def _alike(held: list) -> Iterator[list]:
    """The documents in parts for shards of like documents, which have like terms and bounds."""
    group = _groups([x[1] for x in held], HALVINGS)
    for one in np.unique(group).tolist():
        yield [held[i] for i in np.flatnonzero(group == one).tolist()]


def _shard(held: list) -> pd.DataFrame:
    held.sort(key=lambda x: (x[3], x[0]))  # documents of like lengths have like bounds
    ids, lengths = np.array([x[0] for x in held], dtype="<i8"), np.array([x[3] for x in held], dtype="<i8")
    place = np.repeat(np.arange(len(held), dtype="<u4"), [len(x[1]) for x in held])
    term, times = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]).astype("<u4")
    order = np.argsort(term, kind="stable")
    term = term[order]
    start = np.flatnonzero(np.append(True, term[1:] != term[:-1])[: len(term)])
    terms = term[start]
    ends = np.append(start[1:], len(term))[: len(terms)].astype("<i8")  # none where no document has a word
    out = {"shard": f"{ids[0]}", "docs": len(held), "words": int(lengths.sum()), "ids": ids, "lengths": lengths, "terms": terms.astype("<u8")}
    out |= {"ends": ends, "places": place[order], "times": times[order]}
    share = (xxhash.xxh64_intdigest(out["terms"].tobytes()) + 1) / 2**64
    out["level"] = min(LEVELS, int(-math.log(share, 4)))
    return pd.DataFrame({k: [v.tobytes() if isinstance(v, np.ndarray) else v] for k, v in out.items()})


def document_frequencies(shards: DataFrame) -> DataFrame:
    """term (the hash as a signed number), df: over all shards."""

    def terms(batches):
        for pdf in batches:
            for keys, ends in zip(pdf["terms"], pdf["ends"]):
                ends = np.frombuffer(ends, dtype="<i8")
                yield pd.DataFrame({"term": np.frombuffer(keys, dtype="<u8").astype(np.int64), "df": np.diff(ends, prepend=0)})

    small = shards.select("terms", "ends").mapInPandas(terms, "term long, df long")
    return small.groupBy("term").agg(F.sum("df").alias("df"))


@dataclass
class Asked:
    """The queries of a portion: their different terms in order, and one after the other the terms of each query, by number, with weights."""

    names: list[str]
    keys: np.ndarray
    at: np.ndarray
    weights: np.ndarray
    sizes: np.ndarray

    @cached_property
    def query(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


class Shard:
    """The postings of a shard with their BM25 parts, and the largest part of each term. The lists of frequent terms are columns of an
    array, with the largest part in each block. These are single precision: whatever may be among the best is scored anew in doubles."""

    def __init__(self, row: dict, mean: float):
        self.ids = np.frombuffer(row["ids"], dtype="<i8")
        lengths = np.frombuffer(row["lengths"], dtype="<i8")
        self.terms = np.frombuffer(row["terms"], dtype="<u8")
        self.ends = np.frombuffer(row["ends"], dtype="<i8")
        self.starts = np.append(0, self.ends)[:-1]
        self.places = np.frombuffer(row["places"], dtype="<u4")
        self.times = np.frombuffer(row["times"], dtype="<u4")
        self.norm = K1 * (1 - B + B * lengths / max(mean, 1e-12))
        # postings are millions: two arrays of doubles at a time
        self.parts = self._part(self.times, self.places).astype(np.float32)
        self.term_most = np.maximum.reduceat(self.parts, self.starts) if len(self.terms) else self.parts
        self.blocks = -(-len(self.ids) // BLOCK)
        self.read = 0

    def _part(self, times: np.ndarray, places: np.ndarray) -> np.ndarray:
        below = self.norm[places]
        below += times
        return np.divide(times * (K1 + 1), below, out=below)

    @cached_property
    def frequent(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The column of each list, -1 of those that have none; the columns, by document; and by block their largest parts and numbers of
        postings."""
        sizes = self.ends - self.starts
        lists = np.flatnonzero(sizes >= FREQUENT * len(self.ids))
        lists = lists[np.argsort(-sizes[lists], kind="stable")][: 3 * CELLS // (self.blocks * BLOCK)]
        column = np.full(len(self.terms), -1)
        column[lists] = np.arange(len(lists))
        postings, at = spans(self.starts[lists], self.ends[lists], np.arange(len(lists)))
        parts = np.zeros((self.blocks * BLOCK, len(lists)), dtype=np.float32)
        parts[self.places[postings], at] = self.parts[postings]
        by_block = parts.reshape(self.blocks, BLOCK, len(lists))
        return column, parts, by_block.max(1), np.count_nonzero(by_block, axis=1).astype(np.float32)

    def by_document(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The lists and BM25 parts of the postings of some documents, one document after the other, and for all documents where theirs
        start and end."""
        some = np.zeros(len(self.ids), dtype=bool)
        some[places] = True
        here = np.flatnonzero(some[self.places])
        here = here[np.argsort(self.places[here].astype(np.min_scalar_type(len(self.ids))), kind="stable")]
        ends = np.append(0, np.cumsum(np.bincount(self.places[here], minlength=len(self.ids))))
        return np.searchsorted(self.ends, here, "right"), self._part(self.times[here], self.places[here]), ends[:-1], ends[1:]

    @staticmethod
    def exact(postings: tuple, places: np.ndarray, lists: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The scores of some documents, with their postings by document, for a query, whose lists come in order."""
        of, parts, starts, ends = postings
        here, document = spans(starts[places], ends[places], np.arange(len(places)))
        at = np.searchsorted(lists, of[here])
        at[at == len(lists)] = 0
        good = lists[at] == of[here]
        return np.bincount(document[good], weights[at[good]] * parts[here[good]], len(places))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: float = -math.inf) -> tuple[list[tuple[int, float]], int]:
        """:meth:`search_all` for one query: what it finds, and in how many blocks documents were scored."""
        keys, at = np.unique(terms, return_inverse=True)
        asked = Asked(["query"], keys, np.arange(len(keys)), np.bincount(at, weights, len(keys)), np.array([len(keys)]))
        found, scored = [], 0
        for _, found, scored in self.search_all(asked, k, np.array([least])):
            pass
        return found, scored

    def search_all(self, asked: Asked, k: int, least: np.ndarray) -> Iterator[tuple[int, list[tuple[int, float]], int]]:
        """For each query that has some: its number, the k best (id, score) by score, then id, of those that score its ``least`` or more,
        and in how many blocks documents were scored. Only documents with a term of the query. ``read`` counts the postings that were read."""
        if not len(self.terms) or not len(asked.keys):
            return
        at = np.searchsorted(self.terms, asked.keys)
        at[at == len(self.terms)] = 0
        at[self.terms[at] != asked.keys] = -1
        at = at[asked.at]
        known = np.flatnonzero(at >= 0)
        query, at, weight = asked.query[known], at[known], asked.weights[known]
        most = np.bincount(query, weight * self.term_most[at], len(least))
        # sums of single precision are so far off at most
        off = 10.0**-DIGITS + most * (np.bincount(query, minlength=len(least)) + 4) * 2.0**-23
        reach = (most > 0) & (most >= least - off)
        wanted, known = np.flatnonzero(reach), reach[query]
        query, at, weight = query[known], at[known], weight[known]
        size = max(1, CELLS // (self.blocks * BLOCK))
        for some in (wanted[i : i + size] for i in range(0, len(wanted), size)):
            first, end = np.searchsorted(query, [some[0], some[-1] + 1])
            starts, ends = np.searchsorted(query[first:end], [some, some + 1])
            yield from zip(some.tolist(), *self._scored(at[first:end], weight[first:end], starts, ends, k, least[some], off[some]))

    def _scored(self, lists, weights, starts, ends, k: int, least: np.ndarray, off: np.ndarray) -> tuple[list[list[tuple[int, float]]], list[int]]:
        column, parts, block_most, block_sizes = self.frequent
        rows, width = len(starts), len(parts)
        columns = column[lists]
        # the lists that are not frequent are read whole
        rare = np.flatnonzero(columns < 0)
        rare_lists, rare_weights = lists[rare], weights[rare].astype(np.float32)
        firsts, lasts = self.starts[rare_lists], self.ends[rare_lists]
        self.read += int((lasts - firsts).sum())
        sums = np.empty((rows, width), dtype=np.float32)
        begin, end = np.searchsorted(rare, starts), np.searchsorted(rare, ends)
        sizes = lasts - firsts
        many = np.append(0, np.cumsum(sizes))
        at, last = np.repeat(np.arange(rows) * width, end - begin), many[end]
        i = 0
        while i < rows:
            j = min(max(i + 1, int(np.searchsorted(last, many[begin[i]] + AT_ONCE))), i + max(1, 4 * AT_ONCE // width), rows)
            mine = slice(begin[i], end[j - 1])
            postings, w = spans(firsts[mine], lasts[mine], rare_weights[mine])
            w *= self.parts[postings]
            places = np.repeat(at[mine] - i * width, sizes[mine])
            places += self.places[postings]
            sums[i:j] = np.bincount(places, w, (j - i) * width).reshape(j - i, width)
            i = j
        # what documents have of them gives a first bound
        free = np.flatnonzero(least < 0) if len(self.ids) >= k else np.zeros(0, dtype=int)
        least = self._bounds(sums, k, least, off, free)
        entry, row = spans(starts, ends, np.arange(rows))
        often = columns[entry] >= 0
        entry, row = entry[often], row[often]
        asked = np.zeros((rows, parts.shape[1]), dtype=np.float32)
        asked[row, columns[entry]] = weights[entry]
        scored = np.zeros(rows, dtype=int)
        # the most frequent lists come last, when fewer documents are left that reach the bound with them
        common = slice(0, parts.shape[1] // COMMON)
        for some in (slice(common.stop, None), common):
            # a document is a pivot if the block maxima of the lists to come take it to the bound; they are read in blocks of pivots alone
            bounds = asked[:, : some.stop] @ block_most[:, : some.stop].T
            bounds += sums.reshape(rows, self.blocks, BLOCK).max(2)
            pivots = (bounds > 0) & (bounds >= (least - off)[:, None])
            if some is not common:
                scored += pivots.sum(1)
            self._add(sums, asked[:, some], parts[:, some], pivots)
            here = (columns[entry] < common.stop) == (some is common)
            self.read += int((pivots.astype(np.float32) @ block_sizes[:, some])[row[here], columns[entry[here]] - (some.start or 0)].sum(dtype=float))
        least = self._bounds(sums, k, least, off, free)
        row, place = np.divmod(np.flatnonzero(sums >= np.maximum(least - off, np.finfo(np.float32).tiny)[:, None].astype(np.float32)), width)
        found: list[list[tuple[int, float]]] = [[] for _ in range(rows)]
        postings = self.by_document(place)
        at = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)]).tolist()
        for a, b in zip(at, [*at[1:], len(row)]):
            i = int(row[a])
            mine = slice(starts[i], ends[i])
            values = np.round(self.exact(postings, place[a:b], lists[mine], weights[mine]), DIGITS)
            good = values >= least[i] - off[i]
            values, here = values[good], place[a:b][good]
            if len(here) > k:
                good = values >= np.partition(values, len(values) - k)[len(values) - k]
                values, here = values[good], here[good]
            found[i] = merged([], list(zip(self.ids[here].tolist(), values.tolist())), k)
        return found, scored.tolist()

    def _add(self, sums: np.ndarray, asked: np.ndarray, parts: np.ndarray, pivots: np.ndarray) -> None:
        """Add what the documents have of some frequent lists in blocks of pivots. Where others are read with them, these become pivots."""
        for first in range(0, self.blocks, TOGETHER):
            these = pivots[:, first : first + TOGETHER]
            rows = np.flatnonzero(these.any(1))
            alike = len(rows) and these[rows].mean() > 0.75
            for blocks in [these] if alike else np.split(these, range(1, these.shape[1]), axis=1):
                here, first = slice(first * BLOCK, (first + blocks.shape[1]) * BLOCK), first + blocks.shape[1]
                rows = rows if alike else np.flatnonzero(blocks[:, 0])
                if not len(rows):
                    continue
                if len(rows) > 0.8 * (rows[-1] + 1 - rows[0]):
                    rows = slice(rows[0], rows[-1] + 1)  # without a copy
                blocks[rows] = True
                sums[rows, here] += asked[rows] @ parts[here].T

    @staticmethod
    def _bounds(sums: np.ndarray, k: int, least: np.ndarray, off: np.ndarray, free: np.ndarray) -> np.ndarray:
        """Lower bounds of the k-th best scores of the free rows, from parts of the scores."""
        if not len(free):
            return least
        first = np.partition(sums[free], sums.shape[1] - k, axis=1)[:, sums.shape[1] - k] - off[free]
        least = least.copy()
        least[free] = np.where(first > 0, np.maximum(first, least[free]), least[free])
        return least


def merged(found: list[tuple[int, float]], more: list[tuple[int, float]], k: int) -> list[tuple[int, float]]:
    """The k best (id, score) of two lists."""
    return sorted(found + more, key=lambda x: (-x[1], x[0] == NO_ID, x[0]))[:k]


def query_terms(queries: DataFrame, text: str = "text") -> DataFrame:
    """query (key of the text), term, times: the terms of every different text of the queries."""
    small_batches(queries.sparkSession)

    def terms(batches):
        for pdf in batches:
            for key, hashes in zip(pdf["query"], _terms(pdf["text"].tolist())):
                unique, times = np.unique(hashes, return_counts=True)
                if len(unique):
                    yield pd.DataFrame({"query": [key] * len(unique), "term": unique.astype(np.int64), "times": times})

    rows = queries.where(F.col(text).isNotNull()).select(F.md5(F.col(text).cast("binary")).alias("query"), F.col(text).alias("text"))
    return rows.dropDuplicates(["query"]).mapInPandas(terms, "query string, term long, times long")


def top(docs: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", query_id: str = "doc_id") -> DataFrame:
    """``query_id, rank, doc_id, score``: the k best documents for the text of each query, as a bag of words.

    The score is the sum over the query's words of idf times the BM25 part, in six decimals; documents of equal scores are
    ordered by id. Documents without a word of the query are no result. NULL, empty and wordless queries have none; queries
    of equal texts have equal results, and repeated rows of queries each get theirs. Empty tables give no rows.
    """
    spark = docs.sparkSession
    shards = index(docs, doc_id, text)
    n, words = shards.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    mean = words / n if n else 0.0
    df = document_frequencies(shards)
    asked = query_terms(queries.select(F.col(query_id).alias("query_id"), F.col(text).alias("text")))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = asked.join(df, "term").select("query", "term", (F.col("times") * idf).alias("weight"))
    asked = stage(asked.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms")), "queries")
    total = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    portions = max(1, -(-total // PORTION_TERMS))
    rounds = _rounds(shards)
    best = None
    for part in range(portions):
        mine = asked.where(F.pmod(F.xxhash64("query"), F.lit(portions)) == part)
        some = _portion(shards, rounds, mine, mean, k)
        best = some if best is None else best.unionByName(some)
    unstage(shards)
    small_batches(spark)
    ids = queries.select(F.col(query_id).alias("query_id"), F.md5(F.col(text).cast("binary")).alias("query"))
    return ids.join(best, "query").select("query_id", "rank", "doc_id", "score")


def _rounds(shards: DataFrame) -> list[list[int]]:
    """Levels of shards for each round: the sparse ones first, together until they have a few shards, then each of its own."""
    sizes = sorted(((r["level"], r["count"]) for r in shards.groupBy("level").count().collect()), reverse=True)  # LEVELS + 1 rows at most
    first, have = [], 0
    while sizes and have < FIRST_SHARDS:
        level, count = sizes.pop(0)
        first, have = [*first, level], have + count
    return [first, *[[level] for level, _ in sizes]]


def _portion(shards: DataFrame, rounds: list[list[int]], asked: DataFrame, mean: float, k: int) -> DataFrame:
    """``query, doc_id, score, rank`` of a portion of the queries, staged. What is sent to the tasks is released at the end."""
    context = shards.sparkSession.sparkContext
    mine = asked.select("query", "terms.term", "terms.weight").toArrow()
    names, term, weight = (mine[c].combine_chunks() for c in ("query", "term", "weight"))
    hashes, weights = np.asarray(term.flatten()).astype(np.uint64), np.asarray(weight.flatten())
    ends = np.asarray(term.offsets) if len(term) else np.zeros(1, dtype=int)
    sent = context.broadcast(_asked(names.to_pylist(), hashes, weights, np.diff(ends)))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = None
    for levels in rounds:
        known = {}
        if best is not None:
            known = {r["query"]: r["score"] for r in best.where(F.col("rank") == k).select("query", "score").collect()}  # a row for each query of the portion
        least = context.broadcast(known)
        found = _searched(shards.where(F.col("level").isin(levels)), sent, least, mean, k)
        found = found if best is None else found.unionByName(best.drop("rank"))
        old, best = best, stage(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        unstage(old)
        least.destroy()
    sent.destroy()
    return best


def _asked(names: list[str], hashes: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> Asked:
    """Queries in an order that has like ones together, each with its terms in order."""
    keys, at = np.unique(hashes, return_inverse=True)
    query = np.repeat(np.arange(len(names)), sizes)
    group = _groups(np.split(hashes, np.cumsum(sizes)[:-1]), HALVINGS + 1) if names else np.zeros(0, dtype=int)
    order = np.lexsort((np.arange(len(names)), group))
    rank = np.empty(len(names), dtype=np.int64)
    rank[order] = np.arange(len(names))
    entries = np.lexsort((at, rank[query]))
    return Asked([names[i] for i in order.tolist()], keys, at[entries].astype(np.int32), weights[entries], sizes[order])


def _searched(shards: DataFrame, sent, least, mean: float, k: int) -> DataFrame:
    def search(batches):
        asked = sent.value
        best: list[list] = [[] for _ in asked.names]
        bound = np.array([least.value.get(query, -math.inf) for query in asked.names])
        for pdf in batches:
            records = pdf.to_dict("records")
            del pdf
            for row in records:
                shard = Shard(row, mean)
                row.clear()
                for i, found, _ in shard.search_all(asked, k, bound):
                    if found:
                        best[i] = merged(best[i], found, k)
                        if len(best[i]) >= k:
                            bound[i] = max(bound[i], best[i][-1][1])
                del shard  # before the next one comes
        for first in range(0, len(best), 4096):
            some = zip(asked.names[first : first + 4096], best[first : first + 4096])
            out = [(query, None if ident == NO_ID else ident, score) for query, found in some for ident, score in found]
            frame = pd.DataFrame(out, columns=["query", "doc_id", "score"])
            yield frame.astype({"query": object, "doc_id": "Int64", "score": float})

    # a shard is a large row: they go to Python one by one
    shards.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return shards.drop("level").mapInPandas(search, "query string, doc_id long, score double")


#: DuckDB SQL of the query.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents
), terms AS (
  SELECT doc_id, word, count(*) AS times FROM words GROUP BY doc_id, word
), lengths AS (
  SELECT d.doc_id, coalesce(w.n, 0) AS n FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id) w USING (doc_id)
), facts AS (
  SELECT count(*) AS docs, avg(n) AS mean FROM lengths
), idf AS (
  SELECT word, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM terms, facts GROUP BY word, docs
), scores AS (
  SELECT q.doc_id AS query_id, t.doc_id, round(sum(q.times * i.idf * t.times * 2.2 / (t.times + 1.2 * (0.25 + 0.75 * l.n / f.mean))), 6) AS score
  FROM terms q JOIN terms t USING (word) JOIN idf i USING (word) JOIN lengths l ON l.doc_id = t.doc_id, facts f
  WHERE q.doc_id % 100 = 0 GROUP BY q.doc_id, t.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
