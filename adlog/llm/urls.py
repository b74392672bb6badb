"""URL filter: rules by host and path, and for the rest a ratio of two character language models.

Each model is a Markov model of variable order: the next character is predicted from the longest context that was seen,
smoothed by all shorter ones (Witten and Bell). Every string counts, however rare; the models are tables that stay on the cluster. A URL's evidence is the difference of its mean
log-likelihood per character under accepted and under rejected URLs; the threshold is calibrated on held-out URLs.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlog.llm.common import free_name, small_batches, stage

ORDER = 5
ALPHABET = 256
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Strings counted in a task before they are handed on.
HELD_STRINGS = 500_000
#: Different addresses that are scored together: they ask for each of their strings once.
BLOCK = 512
STEPS = 2000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``; both empty for NULL and where there is none. Only A-Z are lower-cased, in the host."""
    form = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(known, form, 1), UPPER, LOWER), F.regexp_extract(known, form, 2)


def apply_rules(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """Adds host, path, rule (the longest that fits; of equally long ones the first listed) and ruled (its verdict)."""
    host, path = host_and_path(F.col(url))
    out = pages.withColumn("host", host).withColumn("path", path)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        name, verdict = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return out.withColumn("rule", name).withColumn("ruled", verdict)


def strings(text: str) -> list[str]:
    """All strings of up to ORDER + 1 characters that end in a character of the text or its end."""
    padded = START * ORDER + text + END
    return [padded[i - n : i + 1] for i in range(ORDER, len(padded)) for n in range(ORDER + 1)]


@dataclass
class Model:
    """counts of strings, and for each context the number of followers and of different ones."""

    counts: dict[str, int]
    followers: dict[str, tuple[int, int]]

    def mean_log(self, text: str) -> float:
        """Mean log-likelihood of a character and the end."""
        padded, total = START * ORDER + text + END, 0.0
        for i in range(ORDER, len(padded)):
            p = 1.0 / ALPHABET
            for n in range(ORDER + 1):
                context = padded[i - n : i]
                seen = self.followers.get(context)
                if seen is None:
                    break
                times, kinds = seen
                p = (self.counts.get(padded[i - n : i + 1], 0) + kinds * p) / (times + kinds)
            total += math.log(p)
        return total / (len(padded) - ORDER)


def _models(counted: DataFrame) -> dict[str, Model]:
    """Both models whole and in one place, for small tables only; :func:`scores` gives the same from the cluster."""
    out = {v: Model({}, {}) for v in ("allow", "block")}
    for row in counted.select("ruled", "string", "n").orderBy("ruled", "string").toLocalIterator():
        out[row[0]].counts[row[1]] = row[2]
    for model in out.values():
        times, kinds = Counter(), Counter()
        for string, n in model.counts.items():
            times[string[:-1]] += n
            kinds[string[:-1]] += 1
        model.followers = {c: (times[c], kinds[c]) for c in times}
    return out


def count_strings(known: DataFrame) -> DataFrame:
    """ruled, string, size, n over all rows ``ruled, address``: partial counts in tasks, sums by a shuffle."""
    small_batches(known.sparkSession)

    def count(batches):
        held: Counter = Counter()

        def out():
            keys = list(held)
            return pd.DataFrame({"ruled": [k[0] for k in keys], "string": [k[1] for k in keys], "n": [held[k] for k in keys]})

        for pdf in batches:
            for verdict, address in zip(pdf["ruled"], pdf["address"]):
                held.update((verdict, s) for s in strings(address))
            if len(held) > HELD_STRINGS:
                yield out()
                held.clear()
        if held:
            yield out()

    rows = known.select("ruled", "address").mapInPandas(count, "ruled string, string string, n long")
    return rows.groupBy("ruled", "string").agg(F.sum("n").alias("n")).withColumn("size", F.length("string"))


def seen_strings(counted: DataFrame) -> DataFrame:
    """Both models as a table: for each string that is one or a context, and each verdict, n, times and kinds."""
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    itself = counted.select("ruled", "string", "n", zero.alias("times"), zero.alias("kinds"))
    context = counted.select("ruled", F.expr("left(string, size - 1)").alias("string"), zero.alias("n"), F.col("n").alias("times"), one.alias("kinds"))
    sums = [F.sum(F.when(F.col("ruled") == v, F.col(c)).otherwise(0)).alias(f"{c}_{v}") for v in ("allow", "block") for c in ("n", "times", "kinds")]
    return itself.union(context).groupBy("string").agg(*sums)


@dataclass
class Filter:
    #: The models as :func:`seen_strings` gives them.
    seen: DataFrame
    threshold: float


def _needed(pdf: pd.DataFrame) -> pd.DataFrame:
    """The strings and contexts of a block's addresses, each once."""
    found = {""} | {START * n for n in range(1, ORDER + 1)}
    for address in pdf["address"]:
        found.update(strings(address))
    return pd.DataFrame({"block": pdf["block"].iloc[0], "string": list(found)})


def _scored(pdf: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
    models = []
    for v in ("allow", "block"):
        counts = {s: n for s, n in zip(seen["string"], seen[f"n_{v}"]) if n}
        followers = {s: (times, kinds) for s, times, kinds in zip(seen["string"], seen[f"times_{v}"], seen[f"kinds_{v}"]) if times}
        models.append(Model(counts, followers))
    good, bad = models
    return pd.DataFrame({"address": pdf["address"], "score": [good.mean_log(x) - bad.mean_log(x) for x in pdf["address"]]})


def scores(addresses: DataFrame, seen: DataFrame) -> DataFrame:
    """address, score (the difference of the mean log-likelihoods) of every different address of ``address`` but the empty.

    Addresses are dealt into blocks by a hash. A block's different strings meet the models in a join, and what is found comes
    back to the block: a string that all addresses have is asked for once a block, and no task holds more of the models than that.
    """
    small_batches(addresses.sparkSession)
    addresses = stage(addresses.where("address <> ''").distinct(), "addresses")
    blocks = addresses.count() // BLOCK + 1
    dealt = addresses.select(F.pmod(F.xxhash64("address"), F.lit(blocks)).alias("block"), "address")
    needed = dealt.groupBy("block").applyInPandas(_needed, "block long, string string")
    found = needed.join(seen, "string")
    out = dealt.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(_scored, "address string, score double")
    return stage(out, "scores")


def fit(ruled: DataFrame, key: Column) -> Filter:
    """Models from the rows that a rule decides, ``host, path, ruled``; every one of them counts, whatever their number.

    A fifth, chosen by a hash of ``key``, is held out to calibrate: the threshold is where the sum of the two shares of right
    decisions is largest, in the middle if that is a range. Without rows of both verdicts it is 0.
    """
    known = ruled.where("ruled is not null and host <> ''").select(
        "ruled", F.concat("host", "path").alias("address"), (F.pmod(F.xxhash64(key, F.lit("url")), F.lit(5)) == 0).alias("held")
    )
    seen = stage(seen_strings(count_strings(known.where("not held"))), "seen")
    held = known.where("held").groupBy("ruled", "address").agg(F.count("*").alias("n"))
    held = held.join(scores(held.select("address"), seen), "address").withColumnRenamed("score", "d")
    step = F.least(F.lit(STEPS), F.greatest(F.lit(0), F.floor((F.col("d") + 5) * (STEPS / 10)))).cast("int")
    found = held.groupBy("ruled", step.alias("step")).agg(F.sum("n").alias("count")).collect()
    by = {v: Counter({r["step"]: r["count"] for r in found if r["ruled"] == v}) for v in ("allow", "block")}
    sums = {v: sum(c.values()) for v, c in by.items()}
    if not all(sums.values()):
        return Filter(seen, 0.0)
    best, at, below = -1.0, [], {"allow": 0, "block": 0}
    for step in range(STEPS + 2):
        right = (sums["allow"] - below["allow"]) / sums["allow"] + below["block"] / sums["block"]
        if right > best + 1e-12:
            best, at = right, [step]
        elif right > best - 1e-12:
            at.append(step)
        for v in below:
            below[v] += by[v][step]
    return Filter(seen, (at[0] + at[-1]) / 2 / (STEPS / 10) - 5)


def judge(ruled: DataFrame, fitted: Filter) -> DataFrame:
    """Adds ``difference`` and ``verdict``: the rule's, else allow where the difference reaches the threshold.

    NULL URLs and such without ``://`` have no address: no rule, difference 0, and the verdict block. Repeated rows agree.
    """
    name, score = free_name(ruled, "address", "score")
    rows = ruled.withColumn(name, F.concat("host", "path"))
    asked = F.col("ruled").isNull() & (F.col(name) != "")
    found = scores(rows.where(asked).select(F.col(name).alias("address")), fitted.seen)
    scored = rows.where(asked).join(found.select(F.col("address").alias(name), F.col("score").alias(score)), name, "left")
    others = rows.where(~asked).withColumn(score, F.when(F.col("ruled").isNull(), F.lit(0.0)))
    rows = scored.unionByName(others).withColumn("difference", F.col(score))
    good = (F.col(name) != "") & (F.col("difference") >= fitted.threshold)
    verdict = F.coalesce(F.col("ruled"), F.when(good, F.lit("allow")).otherwise(F.lit("block")))
    columns = [f"`{c}`" for c in ruled.columns if c not in ("difference", "verdict")]
    return rows.withColumn("verdict", verdict).select(*columns, "difference", "verdict")
