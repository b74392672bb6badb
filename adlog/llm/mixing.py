"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled by a hash. A document's virtual finish time is the number of its source's words
up to its end, over all copies so far, divided by the source's target. All documents are put in order of that time and
the mix takes them until the budget of words is used up, so every source runs out of time at its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlog.llm.common import free_name, stage

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one task orders at most, about.
ROWS_TOGETHER = 50_000
#: Sources whose table is small enough to be sent to every task.
SOURCES_SENT = 100_000


def size_of(text: Column) -> Column:
    """Number of words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """60 bits of a hash of id and text: the shuffled place of a document in its source."""
    parts = [F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``source, source_size`` with ``place`` (sources in order of code points, NULL last), ``weight`` and ``target``.

    The budget is the sum of all sizes. A target stops at ``most`` times its source's size and the excess goes to the
    others by weight: with sources in order of size over weight, the first that its share does not fill sets the level.
    One row for each source runs through a window without keys.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_place = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("place", F.row_number().over(order)).withColumn("weight", by_place)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    rows = rows.withColumn("full", most * F.col("source_size"))
    rows = rows.withColumn("left", F.sum("source_size").over(everything) - F.sum("full").over(fill) + F.col("full"))
    rows = rows.withColumn("heavy", F.sum("weight").over(everything) - F.sum("weight").over(fill) + F.col("weight"))
    # 'full / weight >= left / heavy' in whole numbers: from here on no source is filled
    open_ = F.col("full").cast("decimal(38,0)") * F.col("heavy") >= F.col("left").cast("decimal(38,0)") * F.col("weight")
    level = F.min(F.when(open_, F.struct("full_order", "left", "heavy"))).over(everything)
    rows = rows.withColumn("full_order", F.row_number().over(Window.orderBy(F.col("source_size") / F.col("weight"), "place")))
    rows = rows.withColumn("level", level)
    share = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.heavy")
    target = F.when(F.col("level").isNull() | (F.col("full_order") < F.col("level.full_order")), F.col("full").cast("double")).otherwise(share)
    return rows.select("source", "source_size", "place", "weight", target.alias("target"))


def plan(slim: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Where the mix ends in every source: ``source, source_size, target, last_copy, last_key`` of rows
    ``source, size, key``.

    A document is taken ``last_copy`` times, and once more if its key is not above ``last_key``; both are NULL for a source
    of which nothing is taken. Sums run within pieces of the key range, whose sums are added up before, and the order of
    finish times is cut in ranges of which only the last one taken is sorted: no task gets a whole source.
    """
    keyed = slim.groupBy("source", "key").agg(F.sum("size").alias("size"))
    keyed = stage(keyed, "keyed")
    n, budget = keyed.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    pieces = max(16, -(-n // ROWS_TOGETHER))
    sources = stage(targets(keyed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "targets")

    def with_sources(rows: DataFrame) -> DataFrame:
        small = sources if sources.count() > SOURCES_SENT else F.broadcast(sources)
        return rows.join(small.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")

    piece = F.shiftright(F.shiftright("key", 30) * F.lit(pieces), 30)
    rows = with_sources(keyed).select("place", "key", "size", "source_size", "target", piece.alias("piece"))
    sums = rows.groupBy("place", "piece").agg(F.sum("size").alias("own"))
    before = sums.withColumn("before", F.sum("own").over(Window.partitionBy("place").orderBy("piece")) - F.col("own")).drop("own")
    inside = F.sum("size").over(Window.partitionBy("place", "piece").orderBy("key"))
    ends = rows.withColumn("inside", inside).join(before, ["place", "piece"])
    ends = stage(ends.select("place", "key", "size", "source_size", "target", (F.col("before") + F.col("inside")).alias("end")), "ends")

    items = ends.where("target > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    finish = (F.col("copy") * F.col("source_size") + F.col("end")).cast("double") / F.col("target")
    ranges = max(64, -(-n // (ROWS_TOGETHER // 4)))
    items = items.select("place", "key", "size", "copy", finish.alias("finish"))
    items = items.withColumn("range", F.floor(ranges * (F.col("finish") / (1 + F.col("finish")))))
    through = items.groupBy("range").agg(F.sum("size").alias("own")).withColumn("through", F.sum("own").over(Window.orderBy("range")))
    over = through.where(F.col("through") > budget).agg(F.min(F.struct("range", (F.col("through") - F.col("own")).alias("used"))).alias("x")).first()["x"]
    if over is None:
        taken = items
    else:
        in_order = Window.orderBy("finish", "place", "copy", "key")
        last = items.where(F.col("range") == over["range"]).withColumn("used", F.sum("size").over(in_order) + over["used"])
        taken = items.where(F.col("range") < over["range"]).unionByName(last.where(F.col("used") <= budget).drop("used"))
    ends_at = taken.groupBy("place").agg(F.max(F.struct("copy", "key")).alias("last"))
    cut = sources.join(ends_at, "place", "left").select("source", "source_size", "target", F.col("last.copy").alias("last_copy"), F.col("last.key").alias("last_key"))
    return stage(cut, "cut")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (5, 2, 1), most: int = 3
) -> DataFrame:
    """The same rows with ``size``, ``source_size``, ``target`` and ``taken``, the words the mix takes of them.

    Whole documents, up to ``most`` times each. NULL text: size 0, taken 0. NULL sources are one source, NULL ids count by
    their text. Rows equal in id and text are taken together. An empty table stays empty. Columns of the four names are
    replaced. Texts are never moved: the plan is made from sizes and keys, and decides every row by itself.
    """
    key, size = free_name(docs, "key", "size_of")
    # one pass over the texts for sizes and keys
    slim = stage(docs.select(F.col(source).alias("source"), size_of(F.col(text)).alias("size"), shuffle_key(F.col(doc_id), F.col(text)).alias("key")), "slim")
    cut = plan(slim, weights, most)
    rest = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    rows = docs.withColumn(size, size_of(F.col(text))).withColumn(key, shuffle_key(F.col(doc_id), F.col(text)))
    return _decided(rows, cut, source, size, key, rest)


def _decided(rows: DataFrame, cut: DataFrame, source: str, size: str, key: str, rest: list[str]) -> DataFrame:
    cut = cut.select(F.struct("source", "source_size", "target", "last_copy", "last_key").alias("cut"))
    if cut.count() <= SOURCES_SENT:
        cut = F.broadcast(cut)
    (name,) = free_name(rows, "cut")
    rows = rows.join(cut.withColumnRenamed("cut", name), F.col(f"`{source}`").eqNullSafe(F.col(f"{name}.source")))
    copies = F.coalesce(F.col(f"{name}.last_copy") + F.when(F.col(key) <= F.col(f"{name}.last_key"), 1).otherwise(0), F.lit(0))
    return rows.select(
        *[F.col(f"`{c}`") for c in rest],
        F.col(size).alias("size"),
        F.col(f"{name}.source_size").alias("source_size"),
        F.col(f"{name}.target").alias("target"),
        (copies * F.col(size)).cast("long").alias("taken"),
    )


def amounts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """The id with the four columns of :func:`mix`, from one pass over the texts."""
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("words"),
        shuffle_key(F.col(doc_id), F.col(text)).alias("key"),
    )
    slim = stage(slim, "slim")
    cut = plan(slim.select("source", F.col("words").alias("size"), "key"), weights, most)
    return _decided(slim, cut, "source", "words", "key", ["doc_id"])


#: DuckDB SQL of the query: the same keys, targets and finish times, with plain windows.
ORACLE = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sources
), weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most FROM placed
), filled AS (
  SELECT *, row_number() OVER w AS nth, sum(source_size) OVER () - sum(most) OVER w + most AS rest,
    sum(weight) OVER () - sum(weight) OVER w + weight AS heavy
  FROM weighed WINDOW w AS (ORDER BY source_size / weight, place ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT min(nth) AS nth FROM filled WHERE CAST(most AS HUGEINT) * heavy >= CAST(rest AS HUGEINT) * weight
), aims AS (
  SELECT f.source, f.source_size, f.place,
    CASE WHEN l.nth IS NULL OR f.nth < l.nth THEN CAST(f.most AS DOUBLE) ELSE CAST(f.weight * x.rest AS DOUBLE) / x.heavy END AS target
  FROM filled f CROSS JOIN level l LEFT JOIN filled x ON x.nth = l.nth
), units AS (
  SELECT source, key, sum(size) AS size FROM docs GROUP BY source, key
), ends AS (
  SELECT a.place, u.key, u.size, a.source_size, a.target, sum(u.size) OVER (PARTITION BY a.place ORDER BY u.key) AS finish
  FROM units u JOIN aims a ON u.source IS NOT DISTINCT FROM a.source
), items AS (
  SELECT place, key, size, copy, CAST(copy * source_size + finish AS DOUBLE) / target AS time
  FROM ends CROSS JOIN (VALUES (0), (1), (2)) c(copy) WHERE target > 0
), used AS (
  SELECT place, key, copy, sum(size) OVER (ORDER BY time, place, copy, key) AS used FROM items
), copies AS (
  SELECT place, key, count(*) AS copies FROM used WHERE used <= (SELECT sum(size) FROM docs) GROUP BY place, key
)
SELECT d.doc_id, d.size, a.source_size, a.target, CAST(coalesce(c.copies, 0) * d.size AS BIGINT) AS taken
FROM docs d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source LEFT JOIN copies c ON c.place = a.place AND c.key = d.key
"""
