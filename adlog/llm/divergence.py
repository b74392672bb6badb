"""Source divergence audit: how far apart the words of the sources of a language are.

Terms are counted in tasks, on the bytes of their texts. A term of up to 8 bytes is one 64-bit number, one of up to 16 bytes
two; numbers are radix-sorted by 16-bit digits and runs of equal ones counted. Longer terms are sorted as bytes, each length in a
bucket of its own. What leaves a task is a row for each group and term of a few megabytes of text; Spark adds these rows up.

A group is a language and a source. A share p of a kept term is 1 + floor(10^9 (count + 5) / (N + 5 V)), exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlog.llm.common import small_batches, stage

LEAST_DOCS = 30
SMOOTH = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
#: Bytes of text whose terms are sorted at once.
CHUNK = 4_000_000
#: Terms times sources that are held at once when sources are compared.
CELLS = 1_000_000

_U = np.uint64


def _table() -> np.ndarray:
    """For each byte: itself, in lower case, where it belongs to a term, else 0."""
    out = np.zeros(256, dtype=np.uint8)
    out[128:] = np.arange(128, 256)
    for low, high in zip(range(ord("a"), ord("z") + 1), range(ord("A"), ord("Z") + 1)):
        out[low] = out[high] = low
    return out


LETTERS = _table()


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order of numbers of one or more 64-bit words, the first word weighing most."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> _U(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]  # a radix sort for 16 bits
    return order


def packed(data: np.ndarray, start: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms as big-endian numbers of so many words, zeros behind."""
    out = []
    for w in range(words):
        value = np.zeros(len(start), dtype=np.uint64)
        for j in range(8 * w, 8 * w + 8):
            inside = j < length
            value = (value << _U(8)) | np.where(inside, data[np.where(inside, start + j, 0)], 0).astype(np.uint64)
        out.append(value)
    return out


def _runs(changes: np.ndarray, group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sorted terms, ``changes`` where one differs from that before it: the place of each run of a term in a group, its length
    and its number of documents."""
    n = len(group)
    new = changes.copy()
    new[1:] |= group[1:] != group[:-1]
    first = new.copy()
    first[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, n)), np.add.reduceat(first.astype(np.int64), at)


def count_terms(texts: list[bytes], groups: list[int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """(group, times, documents, terms) for each bucket of term lengths. ``groups`` must not fall."""
    data = LETTERS[np.frombuffer(b"\0".join([b"", *texts, b""]), dtype=np.uint8)]
    inside = np.flatnonzero(np.diff((data != 0).astype(np.int8)))
    start, length = inside[::2] + 1, np.diff(inside)[::2]
    if not len(start):
        return []
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, start - 1, side="right")
    group = np.asarray(groups)[doc]
    out = []
    for words, low, high in ((1, 0, 8), (2, 8, 16)):
        mine = np.flatnonzero((length > low) & (length <= high))
        if not len(mine):
            continue
        values = packed(data, start[mine], length[mine], words)
        order = radix_order(values)
        values, mine = [v[order] for v in values], mine[order]
        changes = np.ones(len(mine), dtype=bool)
        changes[1:] = np.any([v[1:] != v[:-1] for v in values], axis=0)
        at, times, docs = _runs(changes, group[mine], doc[mine])
        terms = np.ascontiguousarray(np.stack([v[at] for v in values], axis=1).astype(">u8")).view(f"S{8 * words}").ravel()
        out.append((group[mine][at], times, docs, terms.tolist()))
    for size in np.unique(length[length > 16]).tolist():
        mine = np.flatnonzero(length == size)
        terms = np.stack([data[start[mine] + j] for j in range(size)], axis=1) if size < 1000 else np.array([data[s : s + size] for s in start[mine]])
        terms = np.ascontiguousarray(terms).view(f"S{size}").ravel()
        order = np.argsort(terms, kind="stable")
        terms, mine = terms[order], mine[order]
        changes = np.ones(len(mine), dtype=bool)
        changes[1:] = terms[1:] != terms[:-1]
        at, times, docs = _runs(changes, group[mine], doc[mine])
        out.append((group[mine][at], times, docs, terms[at].tolist()))
    return out


def named(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, text`` with NULL as empty strings."""
    return docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])


def term_counts(rows: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of rows ``lang, source, text``: occurrences of every term and the documents it is in."""
    small_batches(rows.sparkSession)

    def count(batches):
        held: list[tuple[str, str, bytes]] = []
        size = 0

        def frames():
            held.sort(key=lambda x: x[:2])
            keys = sorted({x[:2] for x in held})
            at = {key: i for i, key in enumerate(keys)}
            for group, times, docs, terms in count_terms([x[2] for x in held], [at[x[:2]] for x in held]):
                langs, sources = zip(*[keys[g] for g in group])
                yield pd.DataFrame({"lang": langs, "source": sources, "term": terms, "n": times, "docs": docs})

        for pdf in batches:
            for key, other, text in zip(pdf["lang"], pdf["source"], pdf["text"]):
                held.append((key, other, data := text.encode()))
                size += len(data) + 1
                if size >= CHUNK:
                    yield from frames()
                    held.clear()
                    size = 0
        if held:
            yield from frames()

    found = rows.mapInPandas(count, "lang string, source string, term binary, n long, docs long")
    found = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return found.withColumn("term", F.col("term").cast("string"))


def _share(count: Column) -> Column:
    """p of a term with the count, in a row with the total and V; decimals, as the product may pass 64 bits."""
    over = F.lit(UNIT).cast("decimal(10,0)") * (count + F.lit(SMOOTH)).cast("decimal(20,0)")
    return F.call_function("div", over, (F.col("total") + F.lit(SMOOTH) * F.col("V")).cast("decimal(20,0)")) + F.lit(1)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _distances(cells: DataFrame) -> DataFrame:
    """``lang, source, item, value``: the sums of the differences of shares of pairs of sources, over the terms of each block.

    ``cells`` are rows ``lang, block, source, term, p``: the shares of a block's terms, and a row with a NULL term for each
    source with the share of the terms that it lacks.
    """

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        base = pdf[pdf["term"].isna()].sort_values("source")
        names = base["source"].to_numpy()
        have = pdf[pdf["term"].notna()]
        column, terms = pd.factorize(have["term"])
        shares = np.repeat(base["p"].to_numpy(dtype=np.int64)[:, None], len(terms), axis=1)
        shares[np.searchsorted(names, have["source"].to_numpy()), column] = have["p"].to_numpy(dtype=np.int64)
        parts = []
        for i in range(len(names) - 1):  # each pair once
            values = np.abs(shares[i + 1 :] - shares[i]).sum(axis=1)
            parts.append(pd.DataFrame({"source": names[i], "item": names[i + 1 :], "value": values}))
        out = pd.concat(parts) if parts else pd.DataFrame({"source": [], "item": [], "value": []})
        return out.assign(lang=pdf["lang"].iloc[0]).astype({"source": object, "item": object, "value": np.int64})

    once = cells.groupBy("lang", "block").applyInPandas(compare, "lang string, source string, item string, value long")
    once = once.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    turned = once.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    return once.unionByName(turned)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group.

    Part ``pair``: every other source of the language and the sum of the differences of shares over the language's kept terms, those
    in at least 30 of its documents. Part ``term``: the ``top`` terms that the group has more of than the language.

    NULL text, language and source are empty strings. Every row is a document, also repeated ones. Groups without terms have
    shares as well; a language with one source has no pairs, one without kept terms has distances of 0 and no terms. Equal
    values are ranked by the item's bytes. An empty table gives no rows.
    """
    rows = named(docs, text, lang, source)
    counts = stage(term_counts(rows), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST_DOCS)
    kept = stage(kept.select("lang", "term", "all"), "kept")
    have = stage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all"), "have")

    # a row for each group, and its language's V, sum and number of sources
    groups = rows.select("lang", "source").distinct()
    sums = have.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = kept.groupBy("lang").agg(F.count("*").alias("V"), F.sum("all").alias("M"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("S"))
    facts = groups.join(sums, ["lang", "source"], "left").join(whole, "lang", "left").join(sources, "lang")
    facts = stage(facts.na.fill(0, ["total", "V", "M"]), "facts")

    shares = have.join(facts, ["lang", "source"])
    mine = _share(F.col("n"))
    usual = shares.withColumn("p", mine).withColumn("total", F.col("M"))
    terms = usual.select("lang", "source", F.col("term").alias("item"), (F.col("p") - _share(F.col("all"))).alias("value")).where("value > 0")
    terms = _ranked(terms, "term").where(F.col("rank") <= top)

    blocks = F.ceil(F.col("V") * F.col("S") / F.lit(CELLS)).cast("int")
    block = F.pmod(F.xxhash64("term"), blocks).cast("int")
    several = facts.where("S > 1")
    cells = shares.where("S > 1").select("lang", block.alias("block"), "source", "term", mine.alias("p"))
    bases = several.where("V > 0").select("lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), _share(F.lit(0)).alias("p"))
    pairs = _distances(cells.unionByName(bases))
    # languages without kept terms: all distances are 0
    idle = several.where("V = 0").select("lang", "source")
    zero = idle.join(idle.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    return _ranked(pairs.unionByName(zero), "pair").unionByName(terms)


#: DuckDB SQL of the query.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), counts AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs FROM words GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= 30
), groups AS (
  SELECT DISTINCT lang, source FROM d
), cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS m FROM groups g JOIN kept k USING (lang)
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p,
    1 + (1000000000::HUGEINT * (m + 5)) // (sum(m) OVER g + 5 * count(*) OVER g) AS q
  FROM cells WINDOW g AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""
