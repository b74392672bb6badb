"""Language identification by words with a backoff to character n-grams.

A known word scores by its logarithmic relative frequency in each language. An unseen word is cut into character
n-grams, the longest first: at the first length of which any n-gram is known, the mean over the known ones counts.
A text goes to the language with the highest mean over its words.

All words and n-grams of the learned rows are kept, as sorted 64-bit hashes with a sparse table of languages and scores. Texts are
scored in batches: new words are looked up together, and a text is one sum over the rows of its words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from adlog.llm.common import free_name, small_batches, spans, stage

UNKNOWN = "und"
LONGEST = 5
#: Labelled rows of each language that are learned from, as expected number; counts by language decide on the share.
ROWS_PER_LANGUAGE = 4000
MOST_LANGUAGES = 10_000
#: Times as unlikely as a feature seen once in the language most learned from: what a language scores that lacks a feature others have.
PENALTY = 10.0
#: Seed of the hash that Spark's ``xxhash64`` is.
SEED = 42
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
JVM_WORD = r"\p{L}[\p{L}\p{M}]*"

RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


@dataclass
class Model:
    """Languages, and for each size (0 for words, else of n-grams) the sorted hashes of its features, where the entries of each
    end, and the entries: language, and by how much its score is above ``least``, the score of a language without the feature."""

    languages: list[str]
    keys: list[np.ndarray]
    ends: list[np.ndarray]
    lang: list[np.ndarray]
    above: list[np.ndarray]
    least: list[float]

    def find(self, size: int, hashes: np.ndarray) -> np.ndarray:
        """The feature of each hash, -1 for unknown ones."""
        keys = self.keys[size]
        if not len(keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, at, -1)

    def sums(self, size: int, features: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
        """Scores of features, added up by owner: owners x languages."""
        ends = self.ends[size]
        starts = np.where(features > 0, ends[features - 1], 0)
        entries, whose = spans(starts, ends[features], owner)
        width = len(self.languages)
        cells = np.bincount(whose.astype(np.int64) * width + self.lang[size][entries], self.above[size][entries], owners * width)
        return cells.reshape(owners, width) + self.least[size] * np.bincount(owner, minlength=owners)[:, None]


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked; single characters without the marks."""
    if n == 1:
        return list(word)
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from rows whose text and language are not NULL.

    Of a language with more rows a share is taken, chosen by a hash of the row, so that about ``rows_per_language`` stay.
    Words and n-grams are counted on the cluster; all of those of the chosen rows reach the driver, as numbers.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: is {lang} a language column?")
    sizes = F.broadcast(docs.sparkSession.createDataFrame([tuple(x) for x in sizes], "lang string, n long"))
    ident = [c for c in docs.columns if c not in (text, lang) and dict(docs.dtypes)[c] in ("bigint", "int", "string")] or [text]
    part = F.pmod(F.xxhash64(*[F.col(c) for c in ident], F.lit("language")), F.lit(1_000_000)) / 1_000_000
    chosen = (
        known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), part.alias("part"))
        .join(sizes, "lang")
        .where(F.col("part") * F.col("n") < rows_per_language)
    )
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(JVM_WORD), 0))
    words = stage(chosen.select("lang", word.alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    features = words.select("lang", F.lit(0).alias("size"), F.col("word").alias("feature"), "n")
    for size in range(1, LONGEST + 1):
        source = F.col("word") if size == 1 else padded
        pieces = F.expr(f"transform(sequence(1, greatest(length(s) - {size - 1}, 1)), i -> substring(s, i, {size}))")
        cut = words.withColumn("s", source).where(F.length("s") >= size).select("lang", F.explode(pieces).alias("feature"), "n")
        features = features.union(cut.groupBy("lang", "feature").agg(F.sum("n").alias("n")).select("lang", F.lit(size), "feature", "n"))
    features = stage(features.select("lang", "size", F.xxhash64("feature").alias("feature"), "n"), "features")
    totals = features.groupBy("lang", "size").agg(F.sum("n").alias("total")).collect()  # a row for each language and size
    languages = sorted({row["lang"] for row in totals})
    at = {name: i for i, name in enumerate(languages)}
    numbers = F.broadcast(docs.sparkSession.createDataFrame([(name, i) for name, i in at.items()], "lang string, number int"))
    found = features.join(numbers, "lang").select("size", "feature", "number", "n").toArrow()
    size, feature, number, n = (found[c].to_numpy() for c in ("size", "feature", "number", "n"))
    feature = feature.view(np.uint64)
    sums = np.ones((LONGEST + 1, len(languages)))
    for lang, length, total in totals:
        sums[length, at[lang]] = total
    model = Model(languages, [], [], [], [], [])
    for length in range(LONGEST + 1):
        mine = np.flatnonzero(size == length)
        mine = mine[np.lexsort((number[mine], feature[mine]))]
        keys, first = np.unique(feature[mine], return_index=True)
        least = -math.log(PENALTY * sums[length].max()) if languages else 0.0
        model.keys.append(keys)
        model.ends.append(np.append(first[1:], len(mine)))
        model.lang.append(number[mine].astype(np.int32))
        model.above.append((np.log(n[mine] / sums[length][number[mine]]) - least).astype(np.float64))
        model.least.append(least)
    return model


class Hashes(dict):
    """Spark's ``xxhash64`` of strings, remembered while their number is moderate."""

    limit = 400_000

    def __missing__(self, text: str) -> int:
        value = xxhash.xxh64_intdigest(text, SEED)
        if len(self) < self.limit:
            self[text] = value
        return value


class Scorer:
    """Scores of texts; those of words are remembered while their number is moderate."""

    #: Cells (words times languages) that are remembered, and that are added up at once.
    limit = 4_000_000

    def __init__(self, model: Model):
        self.model, self.width = model, len(model.languages)
        self.grams = Hashes()
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.table, self.known = np.zeros((0, self.width)), np.zeros(0, dtype=bool)

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words, and which of them are known at all."""
        model, out = self.model, np.zeros((len(words), self.width))
        hashes = np.fromiter((xxhash.xxh64_intdigest(word, SEED) for word in words), np.uint64, len(words))
        features = model.find(0, hashes)
        known = features >= 0
        mine = np.flatnonzero(known)
        out[mine] = model.sums(0, features[mine], np.arange(len(mine)), len(mine))
        for n in range(LONGEST, 0, -1):
            left = np.flatnonzero(~known)
            cut = [grams(words[i], n) for i in left]
            sizes = [len(x) for x in cut]
            hashes = np.fromiter((self.grams[g] for x in cut for g in x), np.uint64, sum(sizes))
            features, owner = model.find(n, hashes), np.repeat(np.arange(len(left)), sizes)
            features, owner = features[features >= 0], owner[features >= 0]
            times = np.bincount(owner, minlength=len(left))
            some = np.flatnonzero(times)
            out[left[some]] = model.sums(n, features, owner, len(left))[some] / times[some, None]
            known[left[some]] = True
        return out, known

    def _tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the words of all texts, and where those of each text end."""
        if len(self.rows) * max(1, self.width) > self.limit:
            self._forget()
        rows, fresh, tokens, ends = self.rows, [], [], []
        for text in texts:
            words = WORD.findall(text.lower()) if text else []
            for word in words:
                if (row := rows.get(word)) is None:
                    row = rows[word] = len(rows)
                    fresh.append(word)
                tokens.append(row)
            ends.append(len(tokens))
        if fresh:
            scores, known = self.of_words(fresh)
            self.table, self.known = np.concatenate([self.table, scores]), np.concatenate([self.known, known])
        return np.array(tokens, dtype=np.int64), np.array(ends, dtype=np.int64)

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text: the posterior if the mean of n words weighs as sqrt(n) words do."""
        tokens, ends = self._tokens(texts)
        out, start, step = [], 0, max(1, self.limit // max(1, self.width))
        for end in ends.tolist():
            # known words of one text, some at a time
            total, n = np.zeros(self.width), 0
            for i in range(start, end, step):
                mine = tokens[i : min(end, i + step)]
                total += self.table[mine].sum(axis=0)  # unknown words have zeros
                n += int(self.known[mine].sum())
            out.append(self._judged(total, n) if end > start else (UNKNOWN, 0.0))
            start = end
        return out

    def _judged(self, total: np.ndarray, n: int) -> tuple[str, float]:
        if not self.width:
            return UNKNOWN, 0.0
        if n == 0:  # letters, but none that any language has: the first language, without confidence
            return self.model.languages[0], 1.0 / self.width
        logs = total / n * math.sqrt(n)
        logs -= logs.max()
        best = int(np.argmax(logs))
        return self.model.languages[best], float(1.0 / np.exp(logs).sum())

    def text(self, text: str | None) -> tuple[str, float]:
        return self.texts([text])[0]


def judged(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """The same rows with a struct (lang_pred, score).

    NULL, empty texts and texts without a letter: ``und``, 0. Ties go to the first language in order. Every row is judged
    by its own text alone, so repeated rows agree; an empty table stays empty. Without anything learned: ``und``, 0.
    """
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    scorers: list[Scorer] = []

    @F.pandas_udf(RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        if not scorers:
            scorers.append(Scorer(shared.value))
        found = scorers[0].texts([x if isinstance(x, str) else None for x in texts])
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return docs.withColumn(into, judge(F.col(text)))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """:func:`judged` with columns ``lang_pred`` and ``score``; columns of such names are replaced."""
    (name,) = free_name(docs, "judged")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return judged(docs, model, text, name).select(*rest, F.col(f"{name}.lang_pred"), F.col(f"{name}.score"))


def held_out(doc_id: str = "doc_id"):
    """Rows that are not learned from: a fifth, by the checksum of the id's text. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
