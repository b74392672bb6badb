"""What several operators share: staged tables, connected groups, word and shingle hashes."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Spark removes the shuffle files of a job when it ends, not when the driver happens to collect its garbage.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = 512
WORD = re.compile(r"\w+")

_U = np.uint64
_SPREAD = _U(0x9E3779B97F4A7C15)  # odd multiplier of 64 bits: golden ratio


# ---- staged tables


def staging_folder(spark: SparkSession) -> str:
    """A new folder below the shared one that the cluster names in ``spark.checkpoint.dir``.

    A local session without the setting, as in tests, gets a temporary folder. The folder goes when the driver ends.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="adlog-llm-")
    folder = f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stage(rows: DataFrame, label: str = "rows", measures: dict[str, str] | None = None, **options: str) -> DataFrame:
    """Write rows as Parquet to the shared folder and read them back: lineage ends there, lost executors cost a re-read.

    What the write has shuffled goes with it, as nothing reads it again. ``measures``, aggregates by name, are taken while the rows
    are written, without a job of their own, and are found in the table's ``measured``.
    """
    spark = rows.sparkSession
    seen = Observation() if measures else None
    if seen is not None:
        rows = rows.observe(seen, *[F.expr(measure).alias(name) for name, measure in measures.items()])
    path = f"{staging_folder(spark)}/{label}"
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        rows.write.parquet(path, **options)
    finally:
        spark.conf.set(CLEANUP_SETTING, before)
    staged = spark.read.schema(rows.schema).parquet(path)
    staged.staged_at = path
    staged.measured = seen.get if seen is not None else {}
    return staged


#: The number of rows, as a measure of a staged table.
COUNTED = {"n": "count(1)"}


def unstage(*tables: DataFrame | None) -> None:
    """Remove staged tables that nothing reads any more: what was made of them is staged itself."""
    for table in tables:
        if table is not None and (at := getattr(table, "staged_at", None)):
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(at).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Rows of a batch that goes to Python: a few hundred, so that very long texts do not add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def free_name(frame: DataFrame, *names: str) -> list[str]:
    """Column names for own use that clash with none of the frame's."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


# ---- connected groups


def _star(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step: edges (a, b) with a > b, the same groups, shallower."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b").distinct()
    low = large.groupBy("a").agg(F.min("b").alias("low"))
    small = large.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return small.union(low.select("a", F.col("low").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """Connected groups of an edge table ``a, b``: ``node, root`` for every node of an edge, root the group's smallest.

    Alternates large-star and small-star steps until nothing changes; the rounds grow with the logarithm of the nodes.
    Every round is one job on keys alone, written to the shared folder; what tells rounds apart is measured in it. NULL ends and loops
    link nothing.
    """
    mark = COUNTED | {"sum": "sum(cast(xxhash64(a, b) as decimal(38,0)))"}
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges", mark)
    while now.measured["n"]:
        old, now = now, stage(_star(now), "edges", mark)
        unstage(old)
        if old.measured == now.measured:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


# ---- words and shingles, inside tasks


class WordHashes(dict):
    """64-bit hash of a word, remembered; forgotten when the memory holds too many words."""

    limit = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str | None) -> list[str]:
    """Lower-case words of a text: runs of letters, digits and underscores."""
    return WORD.findall(text.lower()) if text else []


def hashed(words: list[str], memory: WordHashes) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))


#: Characters of texts whose words are hashed at once; a longer text is taken alone.
HASHED_AT_ONCE = 1 << 18
_P1, _P2, _P3, _P4, _P5 = map(_U, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


@cache
def _in_words() -> np.ndarray:
    """For each character, whether it is part of a word."""
    table = np.zeros(sys.maxunicode + 1, dtype=bool)
    for run in WORD.finditer("".join(map(chr, range(sys.maxunicode + 1)))):
        table[run.start() : run.end()] = True
    return table


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << _U(bits)) | (x >> _U(64 - bits))


def _xxh64(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``xxh64`` of slices of the data: step by step for all that are shorter than its stripes of 32 bytes, one by one for the others."""
    padded = data + bytes(8)
    eight, four = (np.ndarray(len(data) + 1, kind, padded, strides=(1,)) for kind in ("<u8", "<u4"))
    one = np.frombuffer(padded, np.uint8)
    out, at, left = sizes.astype(np.uint64) + _P5, starts.copy(), sizes.copy()
    for size, lanes in ((8, eight), (8, eight), (8, eight), (4, four), (1, one), (1, one), (1, one)):
        some = np.flatnonzero(left >= size)
        if not len(some):
            continue
        here = at[some]
        lane, h = lanes[here].astype(np.uint64), out[some]
        if size == 8:
            out[some] = _rotated(h ^ (_rotated(lane * _P2, 31) * _P1), 27) * _P1 + _P4
        elif size == 4:
            out[some] = _rotated(h ^ (lane * _P1), 23) * _P2 + _P3
        else:
            out[some] = _rotated(h ^ (lane * _P5), 11) * _P1
        at[some] = here + size
        left[some] -= size
    out = (out ^ (out >> _U(33))) * _P2
    out = (out ^ (out >> _U(29))) * _P3
    out ^= out >> _U(32)
    for i in np.flatnonzero(sizes >= 32).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + sizes[i]])
    return out


def word_hashes(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of all texts, some texts at a time: those of :func:`words_of` by :class:`WordHashes`, and where those of each
    text end."""
    some, size = [], 0
    for text in texts:
        text = text.lower() if isinstance(text, str) else ""
        if some and size + len(text) > HASHED_AT_ONCE:
            yield _hashes_of(some)
            some, size = [], 0
        some.append(text)
        size += len(text) + 1
    if some:
        yield _hashes_of(some)


def _hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    whole = "\n".join(texts)
    data = whole.encode()
    inside = np.zeros(len(whole) + 2, dtype=bool)
    inside[1:-1] = _in_words()[np.frombuffer(whole.encode("utf-32-le"), "<u4")]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[0::2], turns[1::2]
    text_ends = np.searchsorted(starts, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1)
    if len(data) > len(whole):  # from characters to bytes
        places = np.append(np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80), len(data))
        starts, ends = places[starts], places[ends]
    return _xxh64(data, starts, ends - starts), text_ends


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> _U(32))) * _SPREAD
    return x ^ (x >> _U(29))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole where there are fewer words, none where there are none."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    out = hashes[: n - size + 1].copy()
    for i in range(1, size):
        out = mixed(out) + hashes[i : n - size + 1 + i]
    return mixed(out + _U(size))


def text_shingles(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The :func:`shingles` of each text's words."""
    for hashes, ends in word_hashes(texts):
        # all runs of the words of several texts, of which those within one are taken
        runs = shingles(hashes, size)
        start = 0
        for end in ends.tolist():
            yield runs[start : end - size + 1] if end - start >= size else shingles(hashes[start:end], size)
            start = end


def spans(starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, one after the other, each with its range's value."""
    sizes = ends - starts
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return np.arange(sizes.sum()) + shift, np.repeat(values, sizes)
