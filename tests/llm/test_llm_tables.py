"""Operators that join and group: near duplicates, lines, mixing, search, tool calls, URLs, the pipeline, all queries."""

import ctypes
import json
import math
import sys
import time
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from adlog.llm import lines, mixing, neardup, search, toolcalls, urls
from adlog.llm.common import CLEANUP_SETTING, WordHashes, connected, stage
from adlog.llm.queries import ORACLE, QUERIES, URL_RULES
from conftest import SMALL, rows
from odd_rows import BLUE, CLASHES, documents, none, odd  # noqa: F401
from testbed.compare import difference, rows_of_duckdb, rows_of_spark


class Sets:
    def __init__(self, n):
        self.of = list(range(n))

    def find(self, x):
        while self.of[x] != x:
            self.of[x] = self.of[self.of[x]]
            x = self.of[x]
        return x

    def join(self, a, b):
        self.of[self.find(a)] = self.find(b)


def test_connected_groups(spark):
    random = np.random.default_rng(5)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(200, i) for i in range(201, 240)]
    other = [tuple(map(int, random.integers(300, 400, 2))) for _ in range(60)]
    edges = [*chain, *star, *other, (7, 7), (None, 3), (chain[0][1], chain[0][0])]
    found = dict(rows(connected(spark.createDataFrame(edges, "a long, b long"))))
    sets = Sets(400)
    for a, b in [*chain, *star, *other]:
        sets.join(a, b)
    members = defaultdict(list)
    for x in {x for e in [*chain, *star, *other] if e[0] != e[1] for x in e}:
        members[sets.find(x)].append(x)
    assert found == {x: min(group) for group in members.values() for x in group}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- near duplicates


def plain_classes(texts, frequencies):
    """Classes of the different texts by exact weighted Jaccard similarity of all pairs."""
    idf, memory = neardup.inverse(frequencies), WordHashes()
    features = [(k, t * idf[neardup.slot(k)]) for k, t in (neardup.counted(x, memory) for x in texts)]
    holders, sets = defaultdict(list), Sets(len(texts))
    for i, (keys, _) in enumerate(features):
        for key in keys.tolist():
            holders[key].append(i)
    for a, b in {(g[i], g[j]) for g in holders.values() for j in range(len(g)) for i in range(j)}:
        if neardup.similarity(features[a], features[b]) >= 0.8:
            sets.join(a, b)
    return [sets.find(i) for i in range(len(texts))]


def variants(spark):
    """Two dense groups of near copies, one chain of them, and texts that share a passage only."""
    words = [f"w{i}" for i in range(200)]
    texts = []
    for g in range(2):
        base = [f"g{g}{w}" for w in words]
        texts += [" ".join(base[:i] + ["changed"] + base[i + 1 :]) for i in range(0, 200, 9)]
    for i in range(6):
        texts.append(" ".join([f"c{w}" for w in words][6 * i : 6 * i + 120]))
    texts += [" ".join([f"own{i}{w}" for w in words[:60]] + words[:50]) for i in range(8)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), texts


def test_near_duplicates_are_those_of_all_pairs(spark):
    frame, texts = variants(spark)
    roots = plain_classes(texts, neardup.frequencies(frame))
    least = {r: min(i for i, x in enumerate(roots) if x == r) for r in set(roots)}
    assert dict(rows(neardup.classes(frame))) == {i: least[r] for i, r in enumerate(roots)}
    assert 5 < len(least) < 20


def test_variants_below_the_similarity_make_no_pairs(spark, monkeypatch):
    """Texts that share most draws with all others, but each with changes of its own: the rounds alone compare them."""
    base = [f"w{i}" for i in range(600)]

    def variant(i, changes):
        return " ".join(f"own{i}x{j}" if j in {60 * (c + 1) for c in range(changes)} else w for j, w in enumerate(base))

    texts = [variant(i, 4) for i in range(40)] + [variant(i, 1) for i in range(40, 46)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counts, verified = [], neardup._verified
    monkeypatch.setattr(neardup, "_verified", lambda pairs, *more: counts.append(pairs.count()) or verified(pairs, *more))
    roots = plain_classes(texts, neardup.frequencies(frame))
    least = {r: min(i for i, x in enumerate(roots) if x == r) for r in set(roots)}
    assert 40 <= len(least) < 46
    assert dict(rows(neardup.classes(frame))) == {i: least[r] for i, r in enumerate(roots)}
    assert sum(counts) <= 4 * len(texts)


def test_document_frequencies(spark):
    texts = ["a b c d e f", "a b c d e", "a b c d e a b c d e", "x y", None, ""]
    found = neardup.frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    memory, want = WordHashes(), Counter()
    for t in texts:
        want.update(set(neardup.slot(neardup.counted(t, memory)[0]).tolist()))
    assert found[-1] == len(texts) and {i: n for i, n in enumerate(found[:-1].tolist()) if n} == want


def test_weights_of_very_long_copies_are_positive(spark):
    """Texts with so many shingles that slots hold several of one document: weights stay above 0 and draws differ."""
    words = [f"w{i * i % 1_000_003}" for i in range(300_000)]
    texts = [" ".join(words), " ".join([*words[:150_000], "changed", *words[150_000:]])]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    counts = neardup.frequencies(frame)
    assert counts[:-1].max() == 2 and neardup.inverse(counts).min() >= 1
    keys, times = neardup.counted(texts[0], WordHashes())
    draws = neardup.Draws().of(keys, times * neardup.inverse(counts)[neardup.slot(keys)])
    assert len(set(draws.tolist())) == len(draws)


def test_draws_agree_as_often_as_texts_are_similar():
    random, draws = np.random.default_rng(2), neardup.Draws()
    agreed, similar = [], []
    for _ in range(150):
        keys = np.unique(random.integers(0, 1 << 63, 60, dtype=np.uint64))
        weights = random.uniform(1, 9, len(keys))
        other = weights * np.where(random.random(len(keys)) < 0.3, random.uniform(0.3, 1, len(keys)), 1)
        chosen = random.random(len(keys)) < 0.9
        a, b = (keys, weights), (keys[chosen], other[chosen])
        agreed.append((draws.of(*a) == draws.of(*b)).mean())
        similar.append(neardup.similarity(a, b))
    assert np.mean(agreed) == pytest.approx(np.mean(similar), abs=0.03)


def test_near_duplicates_of_odd_rows(odd, none):
    found = neardup.classes(odd)
    assert found.count() == odd.count() and neardup.classes(none).count() == 0
    by = defaultdict(set)
    for doc, group in found.collect():
        by[doc].add(group)
    assert by[1] == by[2] == by[3] == {1}
    assert by[4] == {4} and by[10] == {10} and by[5] == {5} and by[None] == {None}
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns and neardup.keep_one(none).columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, None, 4, 5, 6, 7, 8, 9, 10, 11])
    assert neardup.keep_one(none).count() == 0


# ---- staged tables


def test_staged_tables_leave_no_shuffle_files(spark):
    """Their shuffle files go with the write, not with the driver's garbage; a frame that was staged can be asked again."""
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        blocks = store.getAllBlocks()
        names = {blocks.apply(i).name() for i in range(blocks.size())}
        return {name for name in names if name.startswith("shuffle_")}

    before = held()
    counts = spark.range(1000).repartition(4).groupBy((F.col("id") % 7).alias("k")).count()
    staged = stage(counts, "counts")
    until = time.monotonic() + 20
    while held() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not held() - before
    assert rows(staged) == rows(counts) and spark.conf.get(CLEANUP_SETTING) == "false"


# ---- lines


def normal(line):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")


def plain_prints(key):
    """SimHashes over the words, and over each word with the next one."""
    words = key.split(" ")
    first = [xxhash.xxh64_intdigest(w, seed=42) for w in words]
    both = [xxhash.xxh64_intdigest(after, seed=h) if after else h for h, after in zip(first, [*words[1:], ""])]
    both[-1] = xxhash.xxh64_intdigest("", seed=first[-1])
    return tuple(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) for hashes in (first, both))


def plain_blocks(line):
    """Blocks of words of a line, as bags of words: classes of eight, of four, and pairs of these."""
    words = line.split(" ")
    bags = defaultdict(Counter)
    for word in words:
        h = ctypes.c_int64(xxhash.xxh64_intdigest(word.encode(), seed=42)).value
        for classes in (8, 4):
            bags[classes, h % classes][word] += 1
    large = {at for at, bag in bags.items() if bag.total() >= lines.ALONE}
    found = {(at, frozenset(bags[at].items())) for at in large}
    for a, b in combinations(range(4), 2):
        bag = bags[4, a] + bags[4, b]
        if not {(4, a), (4, b)} & large and bag.total() >= max(lines.LEAST_WORDS, lines.COVERED * len(words)):
            found.add(((a, b), frozenset(bag.items())))
    return found


def plain_removed(documents):
    seen = defaultdict(list)
    for doc, text in documents:
        if text is not None:
            key = ctypes.c_int64(xxhash.xxh64_intdigest(b"doc", seed=xxhash.xxh64_intdigest(text.encode(), seed=42))).value
            for place, line in enumerate(text.split("\n")):
                if normal(line):
                    seen[normal(line)].append((doc is None, doc or 0, key, place))
    keys, con = list(seen), duckdb.connect()
    prints, blocks = [plain_prints(key) for key in keys], [plain_blocks(key) for key in keys]
    sets = Sets(len(keys))
    for a in range(len(keys)):
        for b in range(a):
            apart, pairs = ((x ^ y).bit_count() for x, y in zip(prints[a], prints[b]))
            if apart <= (lines.WORD_RADIUS if blocks[a] & blocks[b] else 3) and pairs <= lines.PAIR_RADIUS:
                most = max(len(keys[a]), len(keys[b]))
                if con.execute("SELECT levenshtein(?, ?)", [keys[a], keys[b]]).fetchone()[0] <= 0.2 * most + 1e-9:
                    sets.join(a, b)
    groups, gone = defaultdict(list), defaultdict(set)
    for i, key in enumerate(keys):
        groups[sets.find(i)] += seen[key]
    for group in groups.values():
        for no_id, doc, key, place in group:
            if (no_id, doc, key, place) != min(group):
                gone[None if no_id else doc, key].add(place)
    return gone


def test_removed_lines_are_those_of_all_pairs(spark, documents):
    texts = [(r["doc_id"], r["text"]) for r in documents.where("doc_id < 60").collect()]
    base = [f"token{i}" for i in range(90)]
    near = ["\n".join(" ".join(base[:i] + ["x"] + base[i + 1 :]) for i in range(s, 90, 11)) for s in range(5)]
    texts += [(1000 + i, t) for i, t in enumerate(near)] + [(2000, "One line.\n\n---\nONE LINE!\n one  line"), (2001, None), (2002, "")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    want = plain_removed(texts)
    for row in lines.removed(frame).collect():
        assert set(row["removed"]) == want.get((row["doc_id"], row["doc"]), set()), row["doc_id"]
    assert sum(map(len, want.values())) > 30


def test_recall_of_similar_lines(spark, documents):
    """Of pairs of lines that are similar by edit distance alone, by their length and by the words that differ."""
    random = np.random.default_rng(4)
    words = [w for r in documents.select("text").where("text is not null").collect() for w in normal(r["text"]).split(" ") if w]
    texts, of = [], []
    for n, changed in ((8, 1), (12, 1), (20, 1), (30, 1), (50, 1), (120, 1), (50, 2), (120, 3)):
        for _ in range(100):
            at = int(random.integers(len(words) - n))
            line = words[at : at + n]
            other = list(line)
            for i in random.choice(n, changed, replace=False):
                other[i] = f"changed{len(of)}"[-max(1, len(line[i])) :]
            texts += [(2 * len(of), " ".join(line)), (2 * len(of) + 1, " ".join(other))]
            of.append((n, changed))
    con = duckdb.connect()
    similar = [con.execute("SELECT levenshtein(?, ?)", [a, b]).fetchone()[0] <= 0.2 * max(len(a), len(b)) for (_, a), (_, b) in zip(texts[::2], texts[1::2])]
    gone = {r["doc_id"] for r in lines.removed(spark.createDataFrame(texts, "doc_id long, text string")).where("size(removed) > 0").collect()}
    for kind in set(of):
        wanted = [i for i in range(len(of)) if of[i] == kind and similar[i]]
        assert len(wanted) > 50 and np.mean([2 * i + 1 in gone for i in wanted]) >= 0.9, kind


def test_masks_agree_within_the_radius():
    random = np.random.default_rng(0)
    for blocks, equal in ((4, 1), (5, 2), (6, 3)):
        found = [m & (1 << 64) - 1 for m in lines.masks(blocks, equal)]
        assert len(found) == math.comb(blocks, equal)
        for _ in range(200):
            other = 0
            for bit in random.choice(64, 3, replace=False):
                other |= 1 << int(bit)
            assert any(other & m == 0 for m in found)


def test_edit_similarity(spark):
    long = "abcdefghij" * 300
    pairs = [("kitten kitten", "kitten kittem"), ("abc", "xyz"), (long, long[:-20] + "z" * 20), (long, "q" * 40 + long), (long, long[::-1]), ("a", "a" * 9), ("x y z w", "new x y z w"), ("aaaa bb", "bb aaaa")]
    found = spark.createDataFrame(pairs, "a string, b string").select(lines.edit_similar("a", "b").alias("x")).collect()
    assert [r["x"] for r in found] == [True, False, True, True, False, False, False, False]


def test_edit_similarity_of_long_lines_is_exact(spark):
    """Words inserted or left out in the middle of lines over 1,000 characters, on both sides of the limit."""
    random = np.random.default_rng(3)
    words = lambda n: ["".join(random.choice(list("abcdefghij"), random.integers(2, 9))) for _ in range(n)]
    pairs = []
    for n, more in ((1600, (35, 200, 400)), (300, (20, 60, 90))):
        base = words(n)
        for k in more:
            at = n * 3 // 10
            pairs.append((" ".join(base), " ".join(base[:at] + words(k) + base[at:])))
            pairs.append((" ".join(base[: n // 2] + base[n // 2 + k // 2 :]), " ".join(base[:at] + words(k // 2) + base[at:])))
    con = duckdb.connect()
    want = [con.execute("SELECT levenshtein(?, ?)", [a, b]).fetchone()[0] <= 0.2 * max(len(a), len(b)) + 1e-9 for a, b in pairs]
    assert want[0] and not all(want)
    found = spark.createDataFrame(pairs, "a string, b string").select(lines.edit_similar("a", "b").alias("x")).collect()
    assert [r["x"] for r in found] == want


def test_alignment_of_words_settles_no_pair_wrongly(spark):
    """Words moved, left out, put in and replaced all over the line, about as many as the limit allows."""
    random = np.random.default_rng(8)
    word = lambda: "".join(random.choice(list("abcdé"), random.integers(1, 7)))
    pairs = []
    for _ in range(300):
        base = [word() for _ in range(random.integers(1, 60))]
        other = list(base)
        for _ in range(random.integers(0, 1 + len(base) // 3)):
            at = int(random.integers(0, len(other) + 1))
            end = at + int(random.integers(0, 3))
            other[at:end] = [base[int(random.integers(len(base)))] if random.random() < 0.3 else word() for _ in range(random.integers(0, 3))]
        pairs.append((" ".join(base), " ".join(other or base)))
    con = duckdb.connect()
    # the database counts bytes: a letter of two is told as one
    want = [con.execute("SELECT levenshtein(?, ?)", [a.replace("é", "e"), b.replace("é", "e")]).fetchone()[0] for a, b in pairs]
    want = [d <= int(0.2 * max(len(a), len(b)) + 1e-9) for d, (a, b) in zip(want, pairs)]
    assert 60 < sum(want) < 240
    found = spark.createDataFrame(pairs, "a string, b string").select(lines.edit_similar("a", "b").alias("x")).collect()
    assert [r["x"] for r in found] == want


def test_no_pair_of_lines_is_compared_twice(spark, monkeypatch):
    """Lines of the same words in another order meet in every round, and are not similar."""
    compared, verified = [], lines._verified

    def watched(pairs, texts):
        compared.extend((bytes(r["a"]), bytes(r["b"])) for r in pairs.collect())
        return verified(pairs, texts)

    monkeypatch.setattr(lines, "_verified", watched)
    words = [f"word{i:02}" for i in range(24)]
    texts = [" ".join(words), " ".join(words[12:] + words[:12]), " ".join([*words[:-1], "another"]), " ".join([*words[12:], *words[1:12], "other"])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = {r["doc_id"] for r in lines.removed(frame).where("size(removed) > 0").collect()}
    assert gone == {2, 3}
    assert compared and len(compared) == len(set(compared))


def test_what_a_staged_table_measures(spark):
    found = stage(spark.range(7), "numbers", {"n": "count(1)", "high": "max(id)"})
    assert found.measured == {"n": 7, "high": 6} and found.count() == 7
    assert stage(spark.range(0), "numbers", {"n": "count(1)"}).measured == {"n": 0}
    assert stage(spark.range(2).where("id > 5"), "numbers", {"n": "count(1)"}).measured == {"n": 0}


def test_fingerprints(spark):
    """Repeated lines, short ones and one that is longer than the narrow counts hold."""
    texts = ["some words that stand in a line of words", "one", " ".join(f"w{i % 777}" for i in range(70_000))]
    frame = spark.createDataFrame([(bytes([k]), texts[k], 9 * k + i) for k in range(3) for i in range(5)], "key binary, line string, row long")
    found = {bytes(r["key"])[0]: (r["print"] & (1 << 64) - 1, r["pairs"] & (1 << 64) - 1, r["size"]) for r in lines.fingerprints(frame).collect()}
    assert found == {k: (*plain_prints(text), len(text)) for k, text in enumerate(texts)}
    assert lines.fingerprints(frame).count() == 3


def test_lines_of_odd_rows(odd, none):
    kept = lines.clean(odd)
    assert kept.columns == odd.columns
    by = defaultdict(list)
    for row in kept.collect():
        by[row["doc_id"]].append(row["text"])
    assert by[1] == [BLUE] and 2 not in by and len(by[None]) == 1
    assert by[4] == by[10] == [None] and by[5] == [""] and by[6] == [" \t\n "] and by[7] == ["123 456 !!! ---"]
    assert by[8] == ["Das ist ein Haus"] and by[11] == ["und noch eine Zeile mit Wörtern\n"]
    assert lines.clean(none).count() == 0 and lines.removed(none).count() == 0


# ---- mixing


def test_targets(spark):
    sizes = {None: 10, "a": 100, "b": 1, "c": 400, "é": 50, "z": 0}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    order = ["a", "b", "c", "z", "é", None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, open_, budget = {}, set(order), float(sum(sizes.values()))
    while True:
        share = {s: budget * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            break
        want |= {s: 3.0 * sizes[s] for s in over}
        budget -= sum(3 * sizes[s] for s in over)
        open_ -= over
    assert found == pytest.approx(want | share)


def test_mix_of_odd_rows(odd, none):
    found = mixing.mix(odd)
    assert found.columns == [*odd.columns, "size", "source_size", "target", "taken"]
    got = found.collect()
    assert len(got) == odd.count() and mixing.mix(none).count() == 0
    assert all(r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"]) for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (4, 5, 6, 10)} == {0}
    assert sum(r["taken"] for r in got) <= sum(r["size"] for r in got)
    assert rows(mixing.mix(odd), "doc_id", "taken") == rows(mixing.mix(odd.repartition(7)), "doc_id", "taken")


def test_mix_comes_near_its_targets(spark):
    random = np.random.default_rng(1)
    docs = [(i, " ".join(["w"] * int(random.integers(1, 60))), "hot" if i % 3 else f"s{i % 7}") for i in range(4000)]
    found = mixing.amounts(spark.createDataFrame(docs, "doc_id long, text string, source string"))
    source = {i: s for i, _, s in docs}
    taken, target = Counter(), {}
    for r in found.collect():
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - t) <= 120 for s, t in target.items())


# ---- search


def test_a_shard_takes_little_memory_beside_its_postings():
    import tracemalloc

    random = np.random.default_rng(8)
    held = []
    for i in range(4000):
        terms, times = np.unique(random.zipf(1.3, 120).astype(np.uint64) % np.uint64(20_000), return_counts=True)
        held.append((i, terms, times, 120))
    row = search._shard(held).iloc[0].to_dict()
    postings = len(row["places"]) // 4
    tracemalloc.start()
    shard = search.Shard(row, 120.0)
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(shard.parts) == postings > 150_000
    assert kept <= 18 * postings and peak <= 28 * postings


def test_a_shard_without_words():
    row = search._shard([(1, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 0)]).iloc[0].to_dict()
    assert len(row["ends"]) == len(row["terms"]) == 0
    assert search.Shard(row, 0.0).search(np.ones(1, dtype=np.uint64), np.ones(1), 3) == ([], 0)


def test_search_prunes_and_stays_exact():
    random = np.random.default_rng(4)
    held = []
    for i in range(1500):
        size = int(random.integers(1, 40))
        terms, times = np.unique(random.zipf(1.6, size).astype(np.uint64) % np.uint64(300), return_counts=True)
        held.append((i, terms, times, size))
    every = list(held)
    shard = search.Shard(search._shard(held).iloc[0].to_dict(), np.mean([h[3] for h in every]))
    blocks = 0
    for _ in range(60):
        terms = np.unique(random.choice(300, 4).astype(np.uint64))
        weights = random.uniform(0.1, 6, len(terms))
        found, scored = shard.search(terms, weights, 5)
        blocks += scored
        want = []
        for i, t, n, size in every:
            norm = search.K1 * (1 - search.B + search.B * size / np.mean([h[3] for h in every]))
            score = sum(w * c * (search.K1 + 1) / (c + norm) for q, w in zip(terms, weights) for x, c in zip(t, n) if x == q)
            if score > 0:
                want.append((round(score, 6), i))
        want = [(i, s) for s, i in sorted(want, key=lambda x: (-x[0], x[1]))[:5]]
        assert [(i, pytest.approx(s, abs=2e-6)) for i, s in want] == [(i, s) for i, s in found] or [s for _, s in found] == pytest.approx([s for _, s in want], abs=2e-6)
    assert blocks < 60 * shard.blocks


def test_search_with_a_bound_skips_lists():
    random = np.random.default_rng(9)
    held = []
    for i in range(2000):
        terms, times = np.unique(random.zipf(1.4, 60).astype(np.uint64) % np.uint64(2000), return_counts=True)
        held.append((i, terms, times, 60))
    shard = search.Shard(search._shard(held).iloc[0].to_dict(), 60.0)
    lists = dict(zip(shard.terms.tolist(), (shard.ends - shard.starts).tolist()))
    whole = bounded = 0
    for _ in range(40):
        terms = np.unique(random.choice(shard.terms, 12))
        terms = np.unique(np.append(terms, np.uint64(1)))  # the most frequent one
        weights = np.array([math.log(1 + 2000 / lists[t]) for t in terms.tolist()])
        best, _ = shard.search(terms, weights, 10)
        before = shard.read
        again, _ = shard.search(terms, weights, 10, best[-1][1])
        bounded += shard.read - before
        whole += sum(lists[t] for t in terms.tolist())
        assert again == best
        assert shard.search(terms, weights, 10, best[0][1] + 1)[0] == []
    assert bounded < 0.5 * whole


def kinds_of_documents(many):
    """Documents of two kinds, with words of their own and some in common, of 10 to 200 words."""
    random = np.random.default_rng(12)
    held = []
    for i in range(many):
        size = int(random.integers(10, 200))
        words = random.zipf(1.2, size).astype(np.uint64) % np.uint64(5000)
        terms, times = np.unique(np.where(words % 7 == 0, words, words + np.uint64(10_000 * (1 + i % 2))), return_counts=True)
        held.append((i, terms, times, size))
    return held


def asked_of(held, frequency):
    terms = np.concatenate([h[1] for h in held])
    weights = np.concatenate([h[2] * np.array([math.log(1 + 3000 / frequency[t]) for t in h[1].tolist()]) for h in held])
    return search._asked([str(h[0]) for h in held], terms, weights, np.array([len(h[1]) for h in held]))


def test_many_whole_documents_are_searched_at_once():
    held = kinds_of_documents(3000)
    mean = np.mean([h[3] for h in held])
    frequency = Counter(t for h in held for t in h[1].tolist())
    asked = asked_of(held[:150], frequency)
    shard = search.Shard(search._shard(list(held)).iloc[0].to_dict(), mean)
    parts = [{t: c * 2.2 / (c + 1.2 * (0.25 + 0.75 * size / mean)) for t, c in zip(terms.tolist(), times.tolist())} for _, terms, times, size in held]
    ends = np.cumsum(asked.sizes)
    unbounded, bound, most = np.full(150, -math.inf), np.zeros(150), np.zeros(150)
    for number, found, _ in shard.search_all(asked, 10, unbounded):
        mine = slice(ends[number] - asked.sizes[number], ends[number])
        terms = asked.keys[asked.at[mine]].tolist()
        want = sorted(((-round(sum(w * p.get(t, 0) for t, w in zip(terms, asked.weights[mine])), 6), i) for i, p in enumerate(parts)))[:10]
        assert [s for _, s in found] == pytest.approx([-s for s, _ in want], abs=2e-6)
        assert asked.names[number] in {str(i) for i, _ in found}
        assert shard.search(np.array(terms, dtype=np.uint64), asked.weights[mine], 10)[0] == found
        bound[number], most[number] = found[-1][1], found[0][1]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    # with bounds that no document reaches, nothing is done for single queries
    before = shard.read
    sys.setprofile(count)
    try:
        rest = [found for _, found, _ in shard.search_all(asked, 10, most + 1) if found]
    finally:
        sys.setprofile(None)
    assert not rest and shard.read > before and calls < 30 * 150, calls
    assert all(len(found) >= 10 and found[9][1] == bound[number] for number, found, _ in shard.search_all(asked, 10, bound))


def test_shards_have_like_documents():
    parts = list(search._alike(kinds_of_documents(3000)))
    assert len(parts) > 1 and sorted(h[0] for part in parts for h in part) == list(range(3000))
    odd = [sum(h[0] % 2 for h in part) / len(part) for part in parts]
    assert all(x < 0.05 or x > 0.95 for x in odd)


def test_search_of_odd_rows(odd, none, monkeypatch):
    found = search.top(odd, odd, k=3)
    by = defaultdict(list)
    for r in found.collect():
        by[r["query_id"]].append((r["rank"], r["doc_id"]))
    assert sorted(by[1]) == [(1, 1), (2, 2), (3, 2)] and not {4, 5, 6, 10} & set(by)
    assert sorted(by[8]) == [(1, 11), (2, 8)]  # 11 has the words twice
    assert search.top(none, odd).count() == 0 and search.top(odd, none).count() == 0
    monkeypatch.setattr(search, "PORTION_TERMS", 20)
    monkeypatch.setattr(search, "SHARD_WORDS", 30)
    assert rows(search.top(odd, odd, k=3)) == rows(found)


# ---- tool calls


def plain_json(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_tool_calls(spark):
    calls = [
        (1, 0, "a", "lookup", '{"limit": 3, "query": "x\\"é"}', "b"),  # needs a later call
        (1, 2, "b", "translate", '{"to": "en"}', None),
        (1, 4, "c", "note", '{"body": 5, "extra": [1, {"z": 1, "a": null}]}', "a"),
        (1, 6, "d", "unheard", "{}", "nobody"),
        (1, 8, "e", "note", "[1]", "f"),
        (1, 9, "f", "note", '{"body": "x", "body": "y"}', "e"),  # a cycle; repeated keys
        (1, 10, "e", "note", '{"body": "again"}', None),  # repeated identifier
        (2, 0, "a", "note", None, None),
        (2, 0, "a", "note", None, None),
        (None, 1, "a", "note", '{"body": "x", "pinned": 1.5}', "a"),
        (3, 1, None, "lookup", '{"query": null}', None),
    ]
    results = [(1, 3, "b", "done"), (1, 7, "a", None), (1, 5, "zz", "lost"), (None, 2, "a", "x"), (2, 1, "a", "r1"), (2, 2, "a", "r2")]
    frame = spark.createDataFrame([(*c, "x") for c in calls], "conv_id long, position int, call_id string, name string, arguments string, after string, at string")
    answers = spark.createDataFrame([(*r, "x") for r in results], "conv_id long, position int, call_id string, content string, step string")
    found = toolcalls.link(frame, answers, toolcalls.tools(spark)).collect()
    by = {(r["conv_id"], r["place"], r["kind"]): r for r in found}
    assert len(found) == 16
    errors = {k[:2]: r["errors"] for k, r in by.items() if r["kind"] == "call"}
    assert errors == {
        (1, 0): [],
        (1, 2): ["missing:text"],
        (1, 4): ["type:body", "unknown:extra"],
        (1, 6): ["unknown_tool"],
        (1, 8): ["cycle", "not_object"],
        (1, 9): ["cycle", "not_json"],
        (1, 10): ["repeated_id"],
        (2, 0): ["missing:body"],
        (None, 1): ["type:pinned"],
        (3, 1): ["type:query"],
    }
    order = sorted((r for r in found if r["conv_id"] == 1 and r["place"] < 8), key=lambda r: (r["at"], r["step"], r["call_id"], r["kind"], r["place"]))
    assert [(r["kind"], r["call_id"]) for r in order] == [("call", "b"), ("result", "b"), ("call", "a"), ("result", "a"), ("call", "c"), ("result", "zz"), ("call", "d")]
    assert by[1, 0, "call"]["json"] == plain_json({"arguments": {"limit": 3, "query": 'x"é'}, "id": "a", "name": "lookup", "type": "call"})
    assert by[1, 4, "call"]["json"] == plain_json({"arguments": {"body": 5, "extra": [1, {"a": None, "z": 1}]}, "id": "c", "name": "note", "type": "call"})
    assert by[1, 5, "result"]["errors"] == ["unknown_call"] and by[None, 2, "result"]["errors"] == ["unknown_call"]
    assert by[2, 1, "result"]["at"] == by[2, 2, "result"]["at"] == 0
    none = toolcalls.link(frame.where("false"), answers.where("false"), toolcalls.tools(spark))
    assert none.count() == 0


def test_long_chains_of_calls(spark):
    n = 700
    frame = spark.range(n).select(F.lit(1).alias("conv_id"), (n - F.col("id")).alias("position"), F.col("id").cast("string").alias("call_id"), (F.col("id") - 1).cast("string").alias("after"))
    found = toolcalls.ordered(frame).collect()
    assert all(r["step"] == int(r["call_id"]) and r["at"] == n and not r["cyclic"] for r in found)


def test_query_of_tool_calls(spark):
    """Against plain Python on the small table."""
    said = {(r["conv_id"], r["turn"]): r for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()}
    found = QUERIES["op3_chat_formatting"](spark, SMALL).collect()
    assert len(found) == len(said)
    for r in found:
        row = said[r["conv_id"], r["place"]]
        value = json.loads(r["json"])
        assert plain_json(value) == r["json"]
        if r["kind"] == "result":
            assert value["content"] == row["text"] and (r["errors"] == "") == ((r["conv_id"], r["place"] - 1) in said and said[r["conv_id"], r["place"] - 1]["role"] == "assistant")
            continue
        n = len(row["text"])
        name = ["lookup", "translate", "note"][n % 3]
        want = "not_json" if n % 13 == 0 else "type:limit" if name == "lookup" and n % 7 == 0 else "missing:to" if name == "translate" and n % 11 == 0 else ""
        assert (r["name"], r["errors"]) == (name, want)
        if n % 13:
            assert row["text"] in value["arguments"].values()


def test_bad_arguments_hold_whole_texts(spark):
    text = 'say "x" ' + "word " * 49  # 253 characters, not a multiple of 13
    texts = [text + "y" * k for k in range(40)]
    frame = spark.createDataFrame([(i, 1, "assistant", x) for i, x in enumerate(texts)], "conv_id long, turn int, role string, text string")
    calls, results = toolcalls.calls_of(frame)
    found = toolcalls.link(calls, results, toolcalls.tools(spark)).collect()
    bad = {r["conv_id"]: json.loads(r["json"])["arguments"] for r in found if "not_json" in r["errors"]}
    assert set(bad) == {i for i, x in enumerate(texts) if len(x) % 13 == 0} and len(bad) > 2
    for i, arguments in bad.items():
        assert json.dumps(texts[i]) in arguments


# ---- URLs


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail] + [len(tail)])]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


URLS = ["http://WWW.Example.COM/en/x?q=/fr/", "https://a.example.com/en/", "x://b.net/es/1#f", "http://com/", "http://com", "nothing", "", None, "http://é.COM/É/", "a://b://c/d", "http://host\n.com/x"]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for r in urls.apply_rules(pages, URL_RULES).collect():
        host, path, rule = plain_rule(r["url"])
        assert (r["host"], r["path"], r["rule"], r["ruled"]) == (host, path, rule and rule.name, rule and rule.verdict)


def test_character_models(spark):
    """Probabilities of all continuations add up to 1 at most, and equal a plain version."""
    texts = ["abab", "abac", "aba"]
    frame = spark.createDataFrame([("allow", t) for t in texts], "ruled string, address string")
    model = urls._models(urls.count_strings(frame))["allow"]
    counts = Counter(s for t in texts for s in urls.strings(t))
    assert model.counts == counts

    def p(context, c):
        below = p(context[1:], c) if context else 1 / urls.ALPHABET
        base = 1 / urls.ALPHABET if not context else below
        seen = {s: n for s, n in counts.items() if len(s) == len(context) + 1 and s.startswith(context)}
        if not seen:
            return base
        return (seen.get(context + c, 0) + len(seen) * base) / (sum(seen.values()) + len(seen))

    text = urls.START * urls.ORDER + "abc" + urls.END
    want = sum(math.log(p(text[i - urls.ORDER : i], text[i])) for i in range(urls.ORDER, len(text))) / 4
    assert model.mean_log("abc") == pytest.approx(want)


def test_url_models_keep_rare_strings(spark):
    """On a table of more than 200,000 strings of a length, and scores from blocks are those of the whole models."""
    random = np.random.default_rng(9)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz./-"))
    texts = [("allow", "".join(random.choice(letters, 30))) for _ in range(8000)] + [("allow", "once.seen/Qx~7")]
    texts += [("block", "".join(random.choice(letters[:9], 12))) for _ in range(300)]
    counted = urls.count_strings(spark.createDataFrame(texts, "ruled string, address string"))
    models = urls._models(counted)
    assert models["allow"].counts["/Qx~7"] == models["allow"].counts["x~7" + urls.END] == 1
    asked = ["once.seen/Qx~7", "seen/Qx~", "abc.é/1", "A", *[x for _, x in texts[::40]]]
    found = urls.scores(spark.createDataFrame([(x,) for x in [*asked, asked[0], ""]], "address string"), urls.seen_strings(counted))
    assert dict(rows(found)) == {x: models["allow"].mean_log(x) - models["block"].mean_log(x) for x in asked}


def test_url_verdicts(spark):
    good = [f"http://good{i % 9}.site.com/news/{i}" for i in range(80)]
    bad = [f"http://pills{i % 9}.cheap.net/es/buy{i}" for i in range(80)]
    asked = ["http://good3.site.org/news/7", "http://pills4.cheap.org/buy3", "nothing", None]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate([*good, *bad, *asked])], "page_id long, url string, address string, difference string")
    ruled = urls.apply_rules(pages, URL_RULES)
    found = urls.judge(ruled, urls.fit(ruled, F.col("page_id"))).where("page_id >= 160")
    assert rows(found, "page_id", "verdict") == [(160, "allow"), (161, "block"), (162, "block"), (163, "block")]
    none = ruled.where("false")
    assert urls.judge(none, urls.fit(none, F.col("page_id"))).count() == 0


# ---- pipeline and queries


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_odd_and_empty_documents(spark, odd, none, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (odd, none):
        found = stage(spark, docs, SMALL)
        more = ["size", "source_size", "target", "taken"] if name == "mix" else []
        assert found.columns == [*odd.columns, *more]
        assert found.count() <= docs.count()


def test_pipeline(spark, documents):
    """Each stage's decisions on its own input."""
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(stage(spark, docs, SMALL), name)
        kept[name] = docs
    assert kept["language_id"].count() == documents.where(r"text rlike '\\p{L}'").count()
    gone = {r["doc_id"]: set(r["removed"]) for r in lines.removed(kept["language_id"]).collect()}
    want = {}
    for r in kept["language_id"].collect():
        left = [x for i, x in enumerate(r["text"].split("\n")) if i not in gone[r["doc_id"]]]
        if any(map(normal, left)):
            want[r["doc_id"]] = "\n".join(left)
    assert {r["doc_id"]: r["text"] for r in kept["line_dedup"].collect()} == want
    classes = dict(rows(neardup.classes(kept["line_dedup"])))
    assert {r["doc_id"] for r in kept["near_dedup"].collect()} == set(classes.values())
    assert kept["decontamination"].count() <= kept["near_dedup"].count()
    taken = {r["doc_id"]: r["taken"] for r in mixing.amounts(kept["decontamination"]).collect() if r["taken"]}
    assert {r["doc_id"]: r["taken"] for r in kept["mix"].collect()} == taken
    assert corpus_pipeline.run(spark, SMALL).count() == len(taken)


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    assert difference(rows_of_spark(QUERIES[name](spark, SMALL)), rows_of_duckdb(con, ORACLE[name])) is None


@pytest.mark.parametrize("name", ["op1_language_id", "op2_quality_classifier", "op6_minhash_near_dedup", "op7_line_dedup", "op9_url_filters", "op10_decontamination"])
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
    assert CLASHES


def test_counts_of_words_are_not_shuffled(spark):
    """Lines are dealt by key before their words are counted, each once; nothing wider than a line is dealt."""
    frame = spark.createDataFrame([(bytes([i % 7]), f"a line of words {i % 7}", i) for i in range(50)], "key binary, line string, row long")
    prints = lines.fingerprints(frame)
    plan = prints._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate explode") == 2
    executed = prints._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(executed) if "Exchange hashpartitioning" in line]
    cut = [i for i, line in enumerate(executed) if "Generate explode" in line]
    assert len(dealt) == 2 and all(any(c < d for c in cut) for d in dealt)
    assert not any("Exchange" in line for line in executed[: cut[0]])
    assert prints.count() == 7
