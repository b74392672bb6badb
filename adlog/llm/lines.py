"""Fuzzy line deduplication: SimHash of normalised lines, pigeonhole blocks, edit similarity, one occurrence of each group.

Everything is DataFrame operations. Lines are compared in normal form: lower-case runs of letters and digits, joined by
blanks; lines without any are left alone. Equal normal forms are one node from the start. Two nodes are linked if they meet as
candidates and their normal forms have an edit similarity of 0.8 or more. Candidates meet in two families of pigeonhole blocks:

* bits: the SimHashes over words are at most three bits apart. Good for lines of some hundred words; in shorter ones a
  changed word turns more bits.
* words: the words of a line are dealt into classes by their hashes. A changed word spoils two classes at most, one left out or
  added only one. A class of enough words is a block by itself, of eight classes or else of four; smaller ones are blocks
  in pairs. Lines that agree in a block are candidates if their SimHashes are within a wide radius.

Long lines of one language may be within three bits for their frequent words alone, and such pairs grow with the square of the lines.
So every line has a second SimHash, over pairs of neighbouring words, in which lines without common passages are some 32 bits apart:
pairs beyond 26 bits there are not candidates.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlog.llm.common import COUNTED, connected, free_name, stage, unstage

BITS, RADIUS = 64, 3
#: Most bits apart of the SimHashes over pairs of words. Lines of which a fifth of the words differ are about 19 apart.
PAIR_RADIUS = 26
#: Classes of words; each joins the one half of them further to one of half as many.
CLASSES = 8
#: Words of a class that is a block by itself; the part of a line's words, and the least number, that make a block of two classes.
ALONE, COVERED, LEAST_WORDS = 6, 0.25, 2
#: Most bits apart of the SimHashes over words of lines that agree in a block of words: one word of eight turns about 9 bits,
#: a fifth of the words about 13, and lines that share half of their words are 21 apart.
WORD_RADIUS = 20
SIMILARITY = 0.8
#: Lines of fewer words have counts of 15 bits at most, so that a number holds four.
SHORT = 1 << 15
#: Characters of a piece. Lines of more than four are first compared in pieces; the sum of their edit distances bounds that of the
#: whole, which is worked out where the bound does not settle a pair. The whole of shorter ones costs less than their pieces.
PIECE = 1000
#: Words that the next word of a line is looked for among, and how many more for each word before it that was not found.
AHEAD, MORE = 3, 2
#: Places of lines whose text is asked for that are sent to every task, at most; more are shuffled.
SENT = 100_000
#: Rounds of comparisons with one line of a bucket, at most; what they leave is compared pair by pair.
ROUNDS = 4
#: Lines up to which one equal block of four is a key; beyond, two of five, then three of six. All find the same pairs.
FEW_LINES, MANY_LINES = 4_000_000, 4_000_000_000

_OTHER = r"[^\p{L}\p{N}]+"


def normal(line: Column) -> Column:
    """A line's normal form, empty for one without letters and digits."""
    return F.trim(F.regexp_replace(F.lower(line), _OTHER, " "))


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _blocks(n: int) -> list[list[int]]:
    return [list(range(BITS * i // n, BITS * (i + 1) // n)) for i in range(n)]


def masks(blocks: int, equal: int) -> list[int]:
    """Bits to compare: every choice of ``equal`` of the blocks; with at most ``blocks - equal`` bits apart, one agrees."""
    parts = _blocks(blocks)
    return [_mask(sum((parts[i] for i in chosen), [])) for chosen in combinations(range(blocks), equal)]


def _occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, doc (hash of the text), lines (of the text), pos, line (normal form), key of the line; NULL texts as one row
    without a line."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), _doc(F.col(text)).alias("doc"), F.split(F.col(text), "\n", -1).alias("all"))
    rows = rows.select("doc_id", "doc", F.coalesce(F.size("all"), F.lit(0)).alias("lines"), F.posexplode_outer("all").alias("pos", "raw"))
    rows = rows.select("doc_id", "doc", "lines", "pos", normal(F.col("raw")).alias("line"))
    return rows.select("doc_id", "doc", "lines", "pos", "line", _key(F.col("line")).alias("key"))


def _doc(text: Column) -> Column:
    """What tells documents of one id apart; NULL for NULL."""
    return F.when(text.isNotNull(), F.xxhash64(text, F.lit("doc")))


def _key(line: Column) -> Column:
    return F.when(F.length(line) > 0, F.unhex(F.md5(line.cast("binary"))))


def fingerprints(lines: DataFrame) -> DataFrame:
    """key, size, print, pairs, blocks: length, SimHashes over words and over pairs of them, and blocks of words, of every
    different line, of rows ``key, line``.

    A bit is set where more than half of the words' hashes have it. Counts share numbers, so that few sums in generated code give
    all 64: four counts of 16 bits where a line has fewer words than that, two of 32 bits for longer ones. Equal lines become one
    before their words are counted, and lines then lie by their keys: the counts, far larger than a line, are not shuffled.
    """
    short = F.length("line") < 2 * SHORT  # words have a character at least and a blank between them
    once = lambda rows: rows.select("key", "line").dropDuplicates(["key"])
    return _prints(once(lines.where(short)), 4).union(_prints(once(lines.where(~short)), 2))


def _prints(lines: DataFrame, lanes: int) -> DataFrame:
    width = BITS // lanes
    ones = sum(1 << i * width for i in range(lanes))
    split = F.split("line", " ")
    words = lines.select("key", F.length("line").alias("size"), split.alias("words"))
    after = F.concat(F.slice("words", 2, F.size("words")), F.array(F.lit("")))
    words = words.select("key", "size", F.size("words").alias("long"), F.explode(F.arrays_zip("words", after.alias("after"))).alias("word"))
    words = words.select("key", "size", "long", F.xxhash64("word.words").alias("h"), F.xxhash64("word.words", "word.after").alias("g"))
    sums = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(ones))).alias(f"{h}{j}") for h in "hg" for j in range(width)]
    # 24 bits of each word; the words of a short line, below 2^15, are counted above bit 40 of the same sum
    one = F.shiftrightunsigned("h", 40) + F.lit(1 << 40 if lanes == 4 else 0)
    sums += [F.sum(F.when(F.pmod("h", F.lit(CLASSES)) == c, one).otherwise(F.lit(0))).alias(f"c{c}") for c in range(CLASSES)]
    counts = words.groupBy("key").agg(F.max("size").alias("size"), F.max("long").alias("long"), F.count("*").alias("n"), *sums)

    def majority(h: str) -> Column:
        count = lambda j, i: F.shiftrightunsigned(f"{h}{j}", i * width).bitwiseAND(F.lit((1 << width) - 1))
        bits = [F.when(2 * count(j, i) > F.col("n"), F.lit(_mask([j + i * width]))).otherwise(F.lit(0)) for i in range(lanes) for j in range(width)]
        return reduce(lambda a, b: a.bitwiseOR(b), [bit.cast("long") for bit in bits])

    if lanes == 4:
        held = [F.shiftrightunsigned(f"c{c}", 40) for c in range(CLASSES)]
        value = [F.col(f"c{c}").bitwiseAND(F.lit((1 << 40) - 1)) for c in range(CLASSES)]
    else:  # no class of so many words is small
        held = [F.lit(SHORT)] * CLASSES
        value = [F.col(f"c{c}") for c in range(CLASSES)]
    half = CLASSES // 2
    both = [(held[c] + held[c + half], value[c] + value[c + half]) for c in range(half)]
    block = lambda *of: F.xxhash64(F.lit("words"), *of)
    blocks = [F.when(held[c] >= ALONE, block(F.lit(c), value[c])) for c in range(CLASSES)]
    # what a block above already says is left out: lines that agree here agree there
    apart = [(held[c] < ALONE) & (held[c + half] < ALONE) for c in range(half)]
    blocks += [F.when(apart[c] & (both[c][0] >= ALONE), block(F.lit(CLASSES + c), both[c][1])) for c in range(half)]
    enough = F.greatest(F.lit(LEAST_WORDS), F.ceil(COVERED * F.col("long")))
    for a, b in combinations(range(half), 2):
        small = (both[a][0] < ALONE) & (both[b][0] < ALONE) & (both[a][0] + both[b][0] >= enough)
        blocks.append(F.when(small, block(F.lit(CLASSES + half + len(blocks)), both[a][1], both[b][1])))
    return counts.select("key", "size", majority("h").alias("print"), majority("g").alias("pairs"), F.array_compact(F.array(*blocks)).alias("blocks"))


def _near(a: str, b: str, radius: Column) -> Column:
    """Prints within a radius, of lines of which neither is too long for the similarity."""
    sizes = F.least(f"s{a}", f"s{b}") >= (SIMILARITY - 1e-9) * F.greatest(f"s{a}", f"s{b}")
    apart = lambda c: F.bit_count(F.col(f"{c}{a}").bitwiseXOR(F.col(f"{c}{b}")))
    return (apart("p") <= radius) & (apart("q") <= PAIR_RADIUS) & sizes


def edit_similar(a: str, b: str) -> Column:
    """Whether two texts have the edit similarity: 1 - distance / longer length.

    Words that differ at one place, counted from the beginning or from the end, bound the distance from above, which settles
    most pairs before the distance itself is worked out. So do words aligned one after the other, and pieces of long texts; what no
    bound settles gets the distance of the whole texts, of any length.
    """
    most = f"cast(floor({1 - SIMILARITY:.6f} * greatest(length({a}), length({b})) + 1e-9) as int)"
    whole = f"levenshtein({a}, {b}, {most}) >= 0"
    piece = f"substring({{0}}, 1 + i * {PIECE}, {PIECE})"
    pieces = (
        f"aggregate(sequence(0, cast((greatest(length({a}), length({b})) - 1) div {PIECE} as int)), 0L, "
        f"(sum, i) -> sum + levenshtein({piece.format(a)}, {piece.format(b)})) <= {most}"
    )
    words_a, words_b = f"split({a}, ' ')", f"split({b}, ' ')"
    # a word that stands against none costs its length and a blank
    apart = "(x, y) -> if(x <=> y, 0, greatest(coalesce(length(x), 0), coalesce(length(y), 0)) + int(x is null or y is null))"
    by_place = f"aggregate(zip_with({words_a}, {words_b}, {apart}), 0, (sum, n) -> sum + n) <= {most}"
    from_end = f"aggregate(zip_with(reverse({words_a}), reverse({words_b}), {apart}), 0, (sum, n) -> sum + n) <= {most}"
    # Each word of the one text is looked for a few words ahead in the other (p: the next word there). Words without a match (g:
    # characters of those in the one, n of them) stand against the words passed over in the other. Texts count as if a blank followed
    # each word: that adds nothing to a distance, and where there are words on both sides their last blanks are one match.
    passed = "aggregate({0}, 0, (sum, y) -> sum + length(y) + 1)"
    cost = "transform(array({0}), d -> greatest(s.g, d) - int(s.g > 0 and d > 0))[0]"
    skipped = cost.format(f"if(o = 1, 0, {passed.format('slice(other, s.p, o - 1)')})")
    step = (
        f"transform(array(int(array_position(slice(other, s.p, {AHEAD} + {MORE} * s.n), x))), o -> if(o = 0, "
        f"named_struct('p', s.p, 'n', s.n + 1, 'g', s.g + length(x) + 1, 'cost', s.cost), "
        f"named_struct('p', s.p + o, 'n', 0, 'g', 0, 'cost', s.cost + {skipped})))[0]"
    )
    rest = cost.format(passed.format("slice(other, s.p, size(other))"))
    start = "named_struct('p', 1, 'n', 0, 'g', 0, 'cost', 0)"
    aligned = f"transform(array({words_b}), other -> aggregate({words_a}, {start}, (s, x) -> {step}, s -> s.cost + {rest}))[0] <= {most}"
    close = f"least(length({a}), length({b})) >= {SIMILARITY - 1e-9} * greatest(length({a}), length({b}))"
    in_pieces = f"greatest(length({a}), length({b})) > {4 * PIECE} and {pieces}"
    return F.expr(f"{close} and ({by_place} or {from_end} or {aligned} or ({in_pieces}) or {whole})")


def _verified(pairs: DataFrame, texts) -> DataFrame:
    """The staged pairs (a, b) whose lines are similar; ``texts`` finds the lines of a table of keys."""
    lines = texts(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
    both = pairs.join(lines.select(F.col("key").alias("a"), F.col("line").alias("line_a")), "a")
    both = both.join(lines.select(F.col("key").alias("b"), F.col("line").alias("line_b")), "b")
    links = stage(both.where(edit_similar("line_a", "line_b")).select("a", "b"), "links", COUNTED)
    unstage(lines)
    return links


def _side(rows: DataFrame, name: str, *more: str) -> DataFrame:
    """Rows with names for one side of a pair."""
    return rows.select(*[F.col(c) for c in more], F.col("kid").alias(f"k{name}"), F.col("print").alias(f"p{name}"), F.col("pairs").alias(f"q{name}"), F.col("size").alias(f"s{name}"), F.col("rid").alias(f"r{name}"))


def linked(prints: DataFrame, texts) -> DataFrame:
    """``node, root`` of all lines that have a partner, of the table ``key, size, print, pairs, blocks``.

    In rounds, lines that agree in all but one block of four of the print, or in a block of words, are compared with one of them, one
    comparison for each line and bucket: that joins the many close variants of a line. A round takes buckets that still hold several
    groups; there is another one while one joins anything, up to a few. Then pairs of different groups that agree in enough blocks of
    the print, or in a block of words, and are within the radius of these are compared. No pair is compared twice. No bucket is capped,
    and all steps together find every pair of both families that is not in one group already.
    """
    # Joins work on numbers: a line's key stands behind a hash of it and is looked up for the pairs that are found. Keys that
    # share a hash would only add pairs, which are verified like all others.
    prints = stage(prints.select("key", "size", "print", "pairs", "blocks", F.xxhash64("key").alias("kid")), "prints", COUNTED)
    n = prints.measured["n"]
    tried: list[DataFrame] = []

    def keys_of(pairs: DataFrame) -> DataFrame:
        """Pairs (ka, kb) of numbers as a staged table of pairs (a, b) of keys, the smaller first, without those of earlier tables."""
        numbers = stage(pairs.distinct(), "numbers", COUNTED)
        sides = numbers.select(F.col("ka").alias("kid")).union(numbers.select("kb")).distinct()
        sides = F.broadcast(sides) if numbers.measured["n"] <= SENT else sides
        known = stage(prints.select("kid", "key").join(sides, "kid", "left_semi"), "keys")
        found = numbers
        for side in "ab":
            found = found.join(known.select(F.col("kid").alias(f"k{side}"), F.col("key").alias(side)), f"k{side}")
        found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
        if tried:
            found = found.join(reduce(DataFrame.union, tried), ["a", "b"], "left_anti")
        found = stage(found, "pairs", COUNTED)
        unstage(numbers, known)
        tried.append(found)
        return found

    def rooted(rows: DataFrame, found: DataFrame | None) -> DataFrame:
        """Rows of lines with their group's number."""
        if found is None:
            return rows.withColumn("rid", F.col("kid"))
        roots = found.select(F.xxhash64("node").alias("kid"), F.xxhash64("root").alias("root"))
        roots = F.broadcast(roots) if found.count() <= SENT else roots
        return rows.join(roots, "kid", "left").withColumn("rid", F.coalesce("root", "kid")).drop("root")

    parts = _blocks(4)
    rest = [F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(~_mask(parts[i])))) for i in range(4)]
    # most buckets hold one line: they are told from the others by narrow rows, shuffled once, and few rows get their prints
    buckets = prints.select("kid", F.posexplode(F.concat(F.array(*rest), "blocks")).alias("place", "bucket"))
    buckets = buckets.select("kid", "bucket", (F.col("place") >= len(rest)).alias("by_words"))
    shared = buckets.withColumn("n", F.count("*").over(Window.partitionBy("bucket"))).where("n > 1").drop("n")
    shared = stage(shared, "shared")
    dense = stage(shared.join(prints.select("kid", "size", "print", "pairs"), "kid"), "dense")
    unstage(shared)
    radius = F.when(F.col("by_words"), WORD_RADIUS).otherwise(RADIUS)
    links, found = None, None
    for _ in range(ROUNDS):
        now = rooted(dense, found)
        best = F.min(F.struct("kid", "print", "pairs", "size", "rid"))
        hubs = now.groupBy("bucket").agg(best.alias("hub"), F.min("rid").alias("low"), F.max("rid").alias("high")).where("low < high").select("bucket", "hub.*")
        stars = _side(now, "b", "bucket", "by_words").join(_side(hubs, "a", "bucket"), "bucket").where(_near("a", "b", radius) & (F.col("ra") != F.col("rb")))
        # a group needs one link to another
        one = stars.groupBy("ra", "rb").agg(F.min(F.struct("ka", "kb")).alias("pair")).select("pair.*")
        pairs = keys_of(one)
        more = _verified(pairs, texts) if pairs.measured["n"] else None
        if more is None or not more.measured["n"]:
            break
        links = more if links is None else links.union(more)
        found, old = connected(links), found
        unstage(old)

    blocks, equal = (4, 1) if n <= FEW_LINES else (5, 2) if n <= MANY_LINES else (6, 3)
    choose = [F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(m))) for i, m in enumerate(masks(blocks, equal))]
    # a line's group is looked up once, not in each of its blocks
    by_bits = rooted(prints.select("kid", "size", "print", "pairs"), found).withColumn("block", F.explode(F.array(*choose)))
    by_words = rooted(dense.where("by_words").select("kid", "size", "print", "pairs", F.col("bucket").alias("block")), found)
    met = []
    for keyed, most in ((by_bits, RADIUS), (by_words, WORD_RADIUS)):
        one, other = _side(keyed, "a", "block"), _side(keyed, "b", "block").withColumnRenamed("block", "of")
        close = _near("a", "b", F.lit(most)) & (F.col("ka") < F.col("kb")) & (F.col("ra") != F.col("rb"))
        met.append(one.join(other, (F.col("block") == F.col("of")) & close).select("ka", "kb"))
    pairs = keys_of(met[0].union(met[1]))
    unstage(dense)
    more = _verified(pairs, texts)
    unstage(prints, *tried)
    return connected(more if links is None else links.union(more))


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, doc, lines, removed`` (doc a hash of the text): for each document the number of its lines and the places (from 0) of those to remove.

    Of each group of similar lines the occurrence stays that has the smallest id (NULL last), hash of text and place. NULL
    texts have no lines; empty and wordless lines stay. Rows equal in id and text are one document. Whole texts count, lines of
    any length. An empty table stays empty.
    """
    seen = stage(_occurrences(docs, doc_id, text), "lines", compression="zstd")
    known = seen.where("key is not null").select("key", "line")
    places = seen.select("doc_id", "doc", "lines", "pos", "key")
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc", "pos")
    first = places.where("key is not null").groupBy("key").agg(F.min(at).alias("first"), F.count("*").alias("n"))
    first = stage(first, "first")

    def texts(keys: DataFrame) -> DataFrame:
        """Lines of keys, each from its first place only."""
        wanted = first.join(keys, "key", "left_semi").select(F.col("key").alias("k"), F.col("first.doc").alias("d"), F.col("first.pos").alias("p"))
        places_of = stage(wanted, "wanted", COUNTED)
        wanted = F.broadcast(places_of) if places_of.measured["n"] <= SENT else places_of
        on = (F.col("key") == F.col("k")) & (F.col("doc") == F.col("d")) & (F.col("pos") == F.col("p"))
        lines = stage(seen.select("key", "doc", "pos", "line").join(wanted, on, "left_semi").select("key", "line").dropDuplicates(["key"]), "texts")
        unstage(places_of)
        return lines

    groups = linked(fingerprints(known), texts)
    rooted = first.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("n")).where("n > 1").select("root", "kept")
    kept = stage(rooted.select("key", "root").join(kept, "root").select("key", "kept"), "kept")
    out = places.join(kept, "key", "left")
    gone = F.col("kept").isNotNull() & (F.col("kept") != at)
    return out.groupBy("doc_id", "doc", "lines").agg(F.sort_array(F.collect_set(F.when(gone, F.col("pos")))).alias("removed"))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the lines that :func:`removed` names. Those of which no line with a word is left go, unless
    they had none; of rows equal in id and text one stays."""
    key, gone, left = free_name(docs, "key", "gone", "left")
    found = removed(docs, doc_id, text).where(F.size("removed") > 0).select(F.col("doc").alias("d"), F.col("doc_id").alias("i"), F.col("removed").alias(gone))
    rows = docs.withColumn(key, _doc(F.col(text)))
    on = (F.col(key) == F.col("d")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("i"))
    rows = rows.join(found, on, "left").drop("d", "i")
    lines = F.filter(F.split(F.col(text), "\n", -1), lambda line, i: ~F.array_contains(F.col(gone), i))
    rows = rows.withColumn(left, F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(lines, "\n")))
    rows = rows.where(F.col(gone).isNull() | F.col(left).rlike(r"[\p{L}\p{N}]"))
    once = rows.where(F.col(key).isNotNull()).dropDuplicates([key, doc_id]).unionByName(rows.where(F.col(key).isNull()))
    return once.select(*[F.col(left).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
