"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of word shingles: the times of a shingle, times its inverse document frequency. Improved consistent
weighted sampling draws one shingle and one quantised weight for each of a number of hash functions, so that two
texts agree in a draw with a probability equal to their weighted Jaccard similarity. Draws are joined in bands; texts that
share a band are verified by their exact weighted Jaccard similarity; connected texts are one group.

Everything is decided between different texts: equal texts are one node from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlog.llm.common import WordHashes, connected, free_name, hashed, mixed, shingles, small_batches, stage, text_shingles, words_of

SHINGLE = 5
SIMILARITY = 0.8
BANDS, DRAWS = 10, 3
#: Document frequencies are counted in this many slots of shingle hashes, so the table has one size for any input.
#: Shingles that share a slot share its frequency; a weight depends on the shingle alone in every text.
SLOTS = 1 << 20
CHUNK = 1 << 14
#: Of BANDS * DRAWS draws, pairs that agree in fewer are not verified: at the least similarity, 30 draws agree in
#: fewer than 13 with probability 3e-6.
LEAST_DRAWS = 13
PACKED = ("d0", "d1", "d2", "d3")
#: Texts of a bucket that its others may be compared with, in each round.
HUBS = (1, 4, 8)
#: Different random numbers for draws; a shingle's come from the table by its hash.
RANDOM = 1 << 16
_U = np.uint64


class Draws:
    """Random numbers of consistent weighted sampling: r and c from Gamma(2, 1), b from [0, 1)."""

    def __init__(self) -> None:
        random = np.random.default_rng(20240601)
        self.r = random.gamma(2.0, 1.0, RANDOM).astype(np.float32)
        self.c = np.log(random.gamma(2.0, 1.0, RANDOM)).astype(np.float32)
        self.b = random.random(RANDOM).astype(np.float32)
        self.odd = random.integers(0, 1 << 63, BANDS * DRAWS, dtype=np.uint64) * _U(2) + _U(1)

    def of(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One hash of (shingle, quantised weight) for each function."""
        logs = np.log(weights).astype(np.float32)
        out = np.empty(len(self.odd), dtype=np.uint64)
        step = max(1, 60_000 // len(keys))
        for k in range(0, len(self.odd), step):
            at = ((keys[None, :] * self.odd[k : k + step, None]) >> _U(48)).view(np.int64)
            r, b, value = (table.take(at, mode="clip") for table in (self.r, self.b, self.c))
            t = logs / r
            t += b
            np.floor(t, out=t)
            # c - r * (t - b) - r
            np.subtract(t, b, out=b)
            b *= r
            value -= b
            value -= r
            first = np.argmin(value, axis=1)
            chosen = t[np.arange(len(first)), first].astype(np.int64).astype(np.uint64)
            out[k : k + step] = mixed(keys[first] ^ mixed(chosen + _U(1)))
        return out


def counted(text: str | None, memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles of a text, sorted, and their times."""
    return _times(shingles(hashed(words_of(text), memory), SHINGLE))


def all_counted(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """:func:`counted` of each text, with the words of many hashed at once."""
    return map(_times, text_shingles(texts, SHINGLE))


def _times(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys))


def slot(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys) >> _U(44)).astype(np.int64)


def frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """In how many documents a shingle of each slot occurs, over all documents; the last entry is their number.

    Tasks count in one array each and hand on its non-empty pieces; these are added in two steps.
    """
    small_batches(docs.sparkSession)

    def count(batches):
        counts, n = np.zeros(SLOTS, dtype=np.int64), 0
        seen = np.full(SLOTS, -1, dtype=np.int64)
        for pdf in batches:
            n += len(pdf)
            for keys in text_shingles(pdf["text"], SHINGLE):
                # a slot counts once for a document, also where it holds several of its shingles: that of the place it keeps
                slots, places = slot(keys), np.arange(len(keys))
                seen[slots] = places
                counts[slots[seen[slots] == places]] += 1
        pieces = [i for i in range(0, SLOTS, CHUNK) if counts[i : i + CHUNK].any()]
        data = [counts[i : i + CHUNK].astype("<u4").tobytes() for i in pieces] + [np.array([n], dtype="<u4").tobytes()]
        yield pd.DataFrame({"piece": [*pieces, SLOTS], "data": data})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype="<u8" if len(x) in (8, 8 * CHUNK) else "<u4").astype(np.int64) for x in pdf["data"])
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "data": [total.astype("<u8").tobytes()]})

    parts = docs.select(F.col(text).alias("text")).mapInPandas(count, "piece int, data binary").withColumn("deal", F.pmod(F.spark_partition_id(), F.lit(64)))
    parts = parts.groupBy("piece", "deal").applyInPandas(lambda pdf: add(pdf), "piece int, data binary")
    out = np.zeros(SLOTS + 1, dtype=np.int64)
    for piece, data in parts.groupBy("piece").applyInPandas(add, "piece int, data binary").toLocalIterator():
        values = np.frombuffer(bytes(data), dtype="<u8").astype(np.int64)
        out[piece : piece + len(values)] = values
    return out


def inverse(counts: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequency of each slot: 1 or more, as no slot counts more than the number of documents."""
    return (np.log((counts[-1] + 1) / (counts[:-1] + 1)) + 1.0).astype(np.float32)


def _signatures(docs: DataFrame, idf, text: str, doc_id: str) -> DataFrame:
    """doc_id, key (of the text; NULL for NULL), weight, bands, d0 .. d3: the lowest bytes of all draws, eight to a number."""
    small_batches(docs.sparkSession)
    fields = "weight double, bands array<long>, " + ", ".join(f"{d} long" for d in PACKED)
    memory: list = []

    @F.pandas_udf(fields)
    def sign(texts: pd.Series) -> pd.DataFrame:
        if not memory:
            memory.append(Draws())
        out = []
        for keys, times in all_counted(texts):
            if not len(keys):
                out.append((0.0, [], 0, 0, 0, 0))
                continue
            weights = times * idf.value[slot(keys)]
            found = memory[0].of(keys, weights)
            bands = found[0::DRAWS].copy()
            for i in range(1, DRAWS):
                bands = mixed(bands) + found[i::DRAWS]
            bands = mixed(bands + np.arange(1, BANDS + 1, dtype=np.uint64))
            low = np.zeros(8 * len(PACKED), dtype=np.uint8)
            low[: len(found)] = found.astype(np.uint8)
            out.append((float(weights.sum(dtype=float)), bands.astype(np.int64).tolist(), *low.view("<i8").tolist()))
        return pd.DataFrame(out, columns=["weight", "bands", *PACKED])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"), sign("text").alias("s"))
    return rows.select("doc_id", "key", "s.*")


def _weights_close(a: str, b: str):
    """No pair with weights further apart reaches the similarity."""
    return F.least(a, b) >= F.greatest(a, b) * (SIMILARITY - 1e-6)


def _draws_apart(a: str, b: str):
    """How many bytes of the packed draws differ. Draws that agree have equal bytes; the unused bytes always are."""
    apart = []
    for d in PACKED:
        x = F.col(f"{d}{a}").bitwiseXOR(F.col(f"{d}{b}"))
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        # what comes over from the next byte can only reach bits that this byte's own are folded out of
        apart.append(x)
    return sum((F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101))) for x in apart), F.lit(0))


def _texts(keys: DataFrame, docs: DataFrame, first: DataFrame, doc_id: str, text: str) -> DataFrame:
    """key, text of the keys, each from one row: ``first`` names it. Copies of a text are not brought together."""
    needed = first.join(keys, "key", "left_semi").select(F.col("key").alias("k"), F.col("doc_id").alias("d"))
    rows = docs.select(F.unhex(F.md5(F.col(text).cast("binary"))).alias("key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    on = (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d"))
    return stage(rows.join(needed, on, "left_semi").select("key", "text").dropDuplicates(["key"]), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """Pairs (a, b) of keys whose texts have the similarity, with it."""
    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    small_batches(pairs.sparkSession)

    def verify(batches):
        memory, known = WordHashes(), {}

        def features(key: bytes, value: str):
            if key not in known:
                if len(known) > 200:
                    known.clear()
                keys, times = counted(value, memory)
                known[key] = keys, times * idf.value[slot(keys)]
            return known[key]

        for pdf in batches:
            out = []
            for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"]):
                value = similarity(features(bytes(a), x), features(bytes(b), y))
                if value >= SIMILARITY:
                    out.append((a, b, value))
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])

    return stage(both.select("a", "b", "text_a", "text_b").mapInPandas(verify, "a binary, b binary, similarity double"), "links")


def _alone(texts: DataFrame, idf) -> DataFrame:
    """key, alone: the weight of those shingles of a text that none of the others has, of different texts; no row where it is 0.

    What two of the texts have in common is no more than either's other weight.
    """
    small_batches(texts.sparkSession)

    def weigh(batches):
        for pdf in batches:
            for key, (keys, times) in zip(pdf["key"], all_counted(pdf["text"])):
                high, low = np.frombuffer(key, dtype=">i8")
                weights = (times * idf.value[slot(keys)]).astype(float)
                yield pd.DataFrame({"high": high, "low": low, "shingle": keys.astype(np.int64), "weight": weights})

    # numbers alone are summed: a key is two of them, and a shingle of one text has that text's
    parts = texts.mapInPandas(weigh, "high long, low long, shingle long, weight double")
    one = [F.min(c).alias(c) for c in ("high", "low", "weight")]
    alone = parts.groupBy("shingle").agg(F.count("*").alias("n"), *one).where("n = 1")
    alone = alone.groupBy("high", "low").agg(F.sum("weight").alias("alone"))
    return stage(alone.select(F.unhex(F.format_string("%016x%016x", "high", "low")).alias("key"), "alone"), "alone")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of (sorted keys, weights); 0 for empty ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum(dtype=float)
    most = a[1].sum(dtype=float) + b[1].sum(dtype=float) - least
    return float(least / most) if most > 0 else 0.0


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links). members: ``doc_id, key, root``, a row for each document: the key of its text and of its group's
    smallest text, both NULL for a NULL text. links: ``a, b, similarity`` between keys.

    In a few rounds, some texts of each bucket (a band's value), chosen by a hash, stand for it: first one, then more. Every text is
    compared with that one of those in its buckets, of other groups so far, with which it shares most draws. That takes as many comparisons
    as there are texts in a round at most, and joins large groups of copies and near copies. Buckets that still hold several groups then compare all pairs across groups
    whose weights, common shingles and draws can reach the similarity: whatever the rounds missed. Nothing is capped.
    """
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(inverse(frequencies(docs, text)))
    members = stage(_signatures(docs, idf, text, doc_id), "members")
    different = members.where("weight > 0")
    first = different.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    one = stage(different.select("key", "weight", "bands", *PACKED).dropDuplicates(["key"]), "different")
    in_band = one.select("key", "weight", *PACKED, F.explode("bands").alias("band"))
    several = in_band.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = stage(in_band.join(several, "band", "left_semi"), "buckets")
    texts = _texts(buckets.select("key").distinct(), docs, first, doc_id, text)
    rooted = buckets.withColumn("root", F.col("key"))
    links, found = None, None

    def add(pairs: DataFrame) -> None:
        """Verify pairs, and put the groups that they join together."""
        nonlocal links, found, rooted
        more = _verified(pairs, texts, idf)
        links = more if links is None else links.union(more)
        found = connected(links)
        roots = found.withColumnRenamed("node", "key")
        rooted = buckets.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
        split = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band")
        rooted = stage(rooted.join(split, "band", "left_semi"), "rooted")

    def side(rows: DataFrame, name: str) -> DataFrame:
        """Rows of buckets with names for one side of a pair."""
        named = {"key": name, "root": f"r{name}", "weight": f"w{name}"} | {d: f"{d}{name}" for d in PACKED}
        named |= {"common": f"c{name}", "bands": f"i{name}"}
        return rows.select("band", *[F.col(old).alias(new) for old, new in named.items() if old in rows.columns], *[c for c in rows.columns if c == "size"])

    # Joins make only pairs that can reach the similarity.
    can_match = _weights_close("wa", "wb") & (_draws_apart("a", "b") <= BANDS * DRAWS - LEAST_DRAWS) & (F.col("ra") != F.col("rb"))
    for turn, n in enumerate(HUBS):
        chosen = [F.min(F.struct(F.xxhash64("key", F.lit(f"{turn}.{i}")).alias("h"), "key", "root", "weight", *PACKED)) for i in range(n)]
        hubs = rooted.groupBy("band").agg(F.array_distinct(F.array(*chosen)).alias("hubs")).select("band", F.explode("hubs").alias("hub"))
        against = side(hubs.select("band", "hub.*"), "a").join(side(rooted, "b").withColumnRenamed("band", "of"), (F.col("band") == F.col("of")) & can_match)
        # of all that a text meets, it is compared with the one it shares most draws with: one comparison for each text
        best = against.groupBy("b").agg(F.min(F.struct(_draws_apart("a", "b").alias("apart"), "a")).alias("best")).select("b", "best.a")
        add(stage(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs"))

    # Buckets that still hold several groups. Variants of one text, each with changes of its own, share most draws and may all be
    # below the similarity: what a text has alone tells, before pairs are made, which ones can reach it.
    alone = _alone(texts.join(rooted.select("key").distinct(), "key", "left_semi"), idf)
    least = SIMILARITY - 1e-6
    left = rooted.join(alone, "key", "left").withColumn("common", F.col("weight") - F.coalesce("alone", F.lit(0.0))).drop("alone")
    left = left.where(F.col("common") >= F.col("weight") * least)
    can_match &= F.least("ca", "cb") * (1 + least) >= (F.col("wa") + F.col("wb")) * least
    # a pair is made in the first bucket that both are in
    left = left.join(left.groupBy("key").agg(F.collect_list("band").alias("bands")), "key")
    can_match &= F.array_min(F.array_intersect("ia", "ib")) == F.col("band")
    left = left.withColumn("size", F.floor(F.log("weight") / F.lit(-math.log(SIMILARITY - 1e-6))).cast("int"))
    near = left.withColumn("size", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))
    other = side(near, "b").withColumnsRenamed({"band": "of", "size": "as"})
    on = (F.col("band") == F.col("of")) & (F.col("size") == F.col("as")) & (F.col("a") < F.col("b")) & can_match
    across = stage(side(left, "a").join(other, on).select("a", "b").distinct(), "across")
    if not across.isEmpty():
        add(across)
    idf.destroy()  # all that asks for it is staged
    rooted = members.select("doc_id", "key").join(found.withColumnRenamed("node", "key"), "key", "left")
    return rooted.select("doc_id", "key", F.coalesce("root", "key").alias("root")), links


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, class_id`` for every row: the smallest id of the group (NULL only if all its ids are).

    A document without copies, and every NULL text, is a class of its own; empty texts are copies of one another, and so are
    texts that have no word and are equal. Texts of fewer than five words are one shingle. Repeated rows are in one class.
    """
    members = stage(groups(docs, doc_id, text)[0], "grouped")
    least = members.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    found = members.join(least, "root", "left")
    return found.select("doc_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: that with the smallest id (NULL last), of those the smallest text's key; all NULL texts.

    Rows equal in id and text are one document, of which one row stays.
    """
    key, has = free_name(docs, "key", "has")
    members = groups(docs, doc_id, text)[0].where("root is not null")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))
    kept = members.groupBy("root").agg(best.alias("best")).select(F.col("best.key").alias("k"), F.col("best.doc_id").alias("d"))
    rows = docs.withColumn(key, F.unhex(F.md5(F.col(text).cast("binary"))))
    on = (F.col(key) == F.col("k")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("d"))
    known = rows.where(F.col(key).isNotNull()).join(kept, on, "left_semi").dropDuplicates([key])
    return known.unionByName(rows.where(F.col(key).isNull())).drop(key)
