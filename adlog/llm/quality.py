"""Quality by ordinal cumulative-link regression: one weight for each hashed token, ordered thresholds between grades.

P(grade > k) = sigmoid(w.x - t_k) with t_0 < t_1 < ..: all grades share the weights w, so a text's score is one number,
and its expected grade and the tail probability of a grade follow from the thresholds.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from adlog.llm.common import free_name, small_batches, stage

SLOTS = 1 << 16
#: Rated rows that are learned from, as expected number; beyond, a share is chosen by a hash of the row.
RATED_ROWS = 20_000
#: Tasks of the fit: the driver gets one gradient of SLOTS numbers from each in every round.
FIT_TASKS = 12
ROUNDS = 40
STEP = 0.5
RIDGE = 1e-4
TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}]*|\p{N}+|[^\s\p{L}\p{N}]+")


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # between grade k and k + 1, rising

    @property
    def grades(self) -> int:
        return len(self.thresholds) + 1


class Slots(dict):
    """Slot of a token, remembered; forgotten when there are too many."""

    limit = 400_000

    def __missing__(self, token: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[token] = zlib.crc32(token.encode("utf-8", "replace")) % SLOTS
        return value


def features(text: str | None, memory: Slots) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text's tokens and their weights: 1 + log(times), scaled to length 1.

    Tokens are words in lower case, numbers and runs of other signs; a further one for every spelling in capitals.
    """
    counts = Counter(TOKEN.findall(text)) if text else {}
    slots: Counter = Counter()
    for token, times in counts.items():
        slots[memory[token.lower()]] += times
        if len(token) > 1 and token.isupper():
            slots[memory["^"]] += times
    at = np.fromiter(slots, np.int64, len(slots))
    x = 1.0 + np.log(np.fromiter(slots.values(), float, len(slots)))
    return at, x / max(np.sqrt((x * x).sum()), 1e-12)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _loss_parts(score: np.ndarray, grade: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """d loss / d score for every row, d loss / d threshold, loss; the loss is that of all 'grade > k' questions."""
    above = (grade[:, None] > np.arange(len(t))[None, :]).astype(float)
    p = _sigmoid(score[:, None] - t[None, :])
    off = p - above
    loss = -np.log(np.clip(np.where(above > 0, p, 1 - p), 1e-12, 1)).sum()
    return off.sum(axis=1), -off.sum(axis=0), float(loss)


def fit(rated: DataFrame, text: str = "text", grade: str = "grade", rows: int = RATED_ROWS) -> Model:
    """Fit on rows with a text and a grade (0, 1, ..), about ``rows`` of them.

    Every round is a job: each of a few tasks returns the gradient of its rows, the driver adds them and steps (Adagrad).
    No rated rows, or one grade only: weights 0, and thresholds by the share of each grade.
    """
    spark = rated.sparkSession
    small_batches(spark)
    known = rated.where(F.col(text).isNotNull() & F.col(grade).isNotNull()).select(
        F.col(text).alias("text"), F.col(grade).cast("int").alias("grade")
    )
    sizes = {r[0]: r[1] for r in known.groupBy("grade").count().limit(1001).collect()}
    total = sum(sizes.values())
    if len(sizes) > 1000 or min(sizes, default=0) < 0:
        raise ValueError("grades are 0, 1, .. and at most 1000")
    top = max(sizes, default=0)
    if total == 0 or len(sizes) < 2:
        at = np.array([8.0 if k >= top else -8.0 for k in range(max(1, top))])
        return Model(np.zeros(SLOTS), np.sort(at) + 1e-6 * np.arange(len(at)))
    share = min(1.0, rows / total)
    part = F.pmod(F.xxhash64("text", "grade"), F.lit(1_000_000)) / 1_000_000

    def cut(batches):
        memory = Slots()
        for pdf in batches:
            if not len(pdf):
                continue
            found = [features(x, memory) for x in pdf["text"]]
            yield pd.DataFrame({"grade": pdf["grade"], "at": [a.astype(np.int32) for a, _ in found], "x": [x.astype(np.float32) for _, x in found]})

    cuts = known.where(part < share).mapInPandas(cut, "grade int, at array<int>, x array<float>")
    cuts = stage(cuts.repartition(FIT_TASKS), "rated")

    above = [sum(n for g, n in sizes.items() if g > k) / total for k in range(top)]
    t = np.array([-np.log(max(p, 1e-6) / max(1 - p, 1e-6)) for p in above]) + 1e-6 * np.arange(top)
    w, seen_w, seen_t = np.zeros(SLOTS), np.full(SLOTS, 1e-8), np.full(top, 1e-8)
    for _ in range(ROUNDS):
        now = spark.sparkContext.broadcast((w, t))

        def gradient(batches, now=now):
            w, t = now.value
            gw, gt, n = np.zeros(SLOTS), np.zeros(len(t)), 0
            for pdf in batches:
                if not len(pdf):
                    continue
                lengths = [len(a) for a in pdf["at"]]
                at, x = np.concatenate(pdf["at"].tolist()).astype(np.int64), np.concatenate(pdf["x"].tolist()).astype(float)
                row = np.repeat(np.arange(len(pdf)), lengths)
                score = np.bincount(row, w[at] * x, len(pdf))
                by_row, by_t, _ = _loss_parts(score, pdf["grade"].to_numpy(), t)
                gw += np.bincount(at, by_row[row] * x, SLOTS)
                gt += by_t
                n += len(pdf)
            yield pd.DataFrame({"gw": [gw.tobytes()], "gt": [gt.tobytes()], "n": [n]})

        parts = cuts.coalesce(FIT_TASKS).mapInPandas(gradient, "gw binary, gt binary, n long").collect()
        now.unpersist()
        parts = sorted((bytes(p["gw"]), bytes(p["gt"]), p["n"]) for p in parts)
        n = sum(p[2] for p in parts)
        gw = sum(np.frombuffer(p[0]) for p in parts) / n + RIDGE * w
        gt = sum(np.frombuffer(p[1]) for p in parts) / n
        seen_w, seen_t = seen_w + gw * gw, seen_t + gt * gt
        w = w - STEP * gw / np.sqrt(seen_w)
        t = np.maximum.accumulate(t - STEP * 0.2 * gt / np.sqrt(seen_t) + 1e-9 * np.arange(top))
    return Model(w, t)


RESULT = StructType([StructField("score", DoubleType()), StructField("expected_grade", DoubleType()), StructField("tail", DoubleType())])


def grade(docs: DataFrame, model: Model, at_least: int, text: str = "text") -> DataFrame:
    """The same rows with ``score``, ``expected_grade`` and ``tail``, the probability of grade ``at_least`` or better.

    A NULL or empty text has score 0, as one without any known token. Rows are judged one by one, so repeated rows agree
    and an empty table stays empty. Columns of the three names are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    memory = Slots()

    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        scores = np.zeros(len(texts))
        for i, value in enumerate(texts):
            if isinstance(value, str):
                at, x = features(value, memory)
                scores[i] = (m.weights[at] * x).sum()
        above = _sigmoid(scores[:, None] - m.thresholds[None, :])
        tail = above[:, at_least - 1] if 1 <= at_least < m.grades else np.full(len(scores), float(at_least < 1))
        return pd.DataFrame({"score": scores, "expected_grade": above.sum(axis=1), "tail": tail})

    names = [f.name for f in RESULT]
    (name,) = free_name(docs, "judged")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.withColumn(name, judge(F.col(text))).select(*rest, *[F.col(f"{name}.{c}") for c in names])


def ratings(docs: DataFrame, labels: DataFrame, rows: int = RATED_ROWS) -> DataFrame:
    """Rated texts: 0 for toxic ones, 1 for those of low quality, 2 for the others; of about ``rows`` labels.

    Labels are chosen by a hash of their document before they meet the texts, so their number is bounded and no text is moved.
    Labels without a document, and documents without both labels, are left out; of repeated labels of a document each counts.
    """
    value = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    rated = labels.select("doc_id", value.alias("grade")).where("grade is not null and doc_id is not null")
    share = min(1.0, rows / max(1, rated.count()))
    part = F.pmod(F.xxhash64("doc_id", F.lit("rated")), F.lit(1_000_000)) / 1_000_000
    chosen = stage(rated.where(part < share), "labels")
    if chosen.count() <= 2 * rows:
        chosen = F.broadcast(chosen)
    return docs.select("doc_id", "text").join(chosen, "doc_id")
