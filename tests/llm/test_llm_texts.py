"""Language ID, quality, personal data, decontamination: operators that judge texts one by one."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from adlog.llm import decontam, langid, neardup, pii, quality
from adlog.llm.common import WordHashes, hashed, shingles, text_shingles, word_hashes, words_of
from conftest import rows
from odd_rows import documents, none, odd  # noqa: F401


@pytest.fixture(scope="module")
def model(documents):
    return langid.learn(documents.where(~langid.held_out()).select("doc_id", "text", "lang"))


# ---- language ID


def test_language_of_held_out_documents(documents, model):
    found = langid.identify(documents.withColumn("held", langid.held_out()), model).where("held").select("lang", "lang_pred").collect()
    assert len(found) > 20 and sum(r[0] == r[1] for r in found) >= 0.97 * len(found)


def test_language_model_by_hand(documents):
    """Frequencies and scores against a plain version."""
    learned = documents.where("doc_id < 40")
    model = langid.learn(learned.select("doc_id", "text", "lang"))
    texts = learned.select("lang", "text").collect()
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in texts:
        for word in regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower()):
            counts[0, word][lang] += 1
            totals[0, lang] += 1
            for n in range(1, langid.LONGEST + 1):
                padded = word if n == 1 else f" {word} "
                for i in range(len(padded) - n + 1):
                    counts[n, padded[i : i + n]][lang] += 1
                    totals[n, lang] += 1
    most = {n: max(total for (size, _), total in totals.items() if size == n) for n in range(langid.LONGEST + 1)}
    least = lambda n: -math.log(langid.PENALTY * most[n])
    log = lambda key, lang: math.log(counts[key][lang] / totals[key[0], lang]) if counts[key][lang] else least(key[0])

    def word_scores(word, lang):
        if (0, word) in counts:
            return log((0, word), lang)
        for n in range(langid.LONGEST, 0, -1):
            padded = word if n == 1 else f" {word} "
            known = [k for i in range(len(padded) - n + 1) if (k := (n, padded[i : i + n])) in counts]
            if known:
                return sum(log(k, lang) for k in known) / len(known)
        return None

    scorer = langid.Scorer(model)
    for text in [texts[0][1], "unseenish wordlike tokens of nowhere", "qqqq zzzz", "the"]:
        words = [w for w in regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower()) if word_scores(w, model.languages[0]) is not None]
        means = [sum(word_scores(w, lang) for w in words) / len(words) * math.sqrt(len(words)) for lang in model.languages]
        best = int(np.argmax(means))
        lang, score = scorer.text(text)
        assert lang == model.languages[best]
        assert score == pytest.approx(1 / sum(math.exp(m - means[best]) for m in means))


def test_language_of_odd_rows(odd, none, model):
    found = langid.identify(odd, model)
    assert found.columns == [c for c in odd.columns if c not in ("score", "lang_pred")] + ["lang_pred", "score"]
    by = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == odd.count()
    for doc in (4, 5, 6, 7, 10):
        assert (by[doc]["lang_pred"], by[doc]["score"]) == ("und", 0.0)
    assert by[9]["lang_pred"] != "und" and 0 <= by[9]["score"] <= 1
    assert langid.identify(none, model).count() == 0
    unlearned = langid.learn(none.select("doc_id", "text", "lang"))
    assert {r["lang_pred"] for r in langid.identify(odd, unlearned).collect()} == {"und"}


# ---- quality


def test_quality_separates_rated_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rated = quality.ratings(documents, labels)
    model = quality.fit(rated)
    assert np.all(np.diff(model.thresholds) > 0)
    found = quality.grade(rated, model, at_least=2).toPandas()
    good = found[found.grade == 2]
    bad = found[found.grade < 2]
    assert (good["tail"] > 0.5).mean() > 0.95 and (bad["tail"] < 0.5).mean() > 0.8
    assert found.expected_grade.between(0, 2).all()


def test_quality_gradient_is_that_of_the_loss():
    random = np.random.default_rng(1)
    score, grade, t = random.normal(size=20), random.integers(0, 3, 20), np.array([-0.5, 0.7])
    by_score, by_t, loss = quality._loss_parts(score, grade, t)
    for i in range(3):
        moved = score.copy()
        moved[i] += 1e-6
        assert (quality._loss_parts(moved, grade, t)[2] - loss) / 1e-6 == pytest.approx(by_score[i], abs=1e-4)
    for k in range(2):
        moved = t.copy()
        moved[k] += 1e-6
        assert (quality._loss_parts(score, grade, moved)[2] - loss) / 1e-6 == pytest.approx(by_t[k], abs=1e-4)


def test_quality_of_odd_rows(spark, odd, none):
    rated = odd.selectExpr("*", "case when doc_id in (1, 3) then 1 when doc_id in (8, 9) then 0 end as grade")
    model = quality.fit(rated)
    found = quality.grade(odd, model, at_least=1)
    assert found.count() == odd.count()
    by = {r["doc_id"]: r for r in found.collect()}
    assert by[4]["score"] == by[5]["score"] == by[10]["score"] == 0.0
    assert by[1]["tail"] > by[9]["tail"]
    assert quality.grade(none, model, at_least=1).count() == 0
    empty = quality.fit(none.selectExpr("*", "1 as grade"))
    assert quality.grade(odd, empty, at_least=1).count() == odd.count()
    same = quality.fit(rated.where("grade = 1"))
    assert {round(r["tail"], 2) for r in quality.grade(odd, same, at_least=1).collect()} == {1.0}


# ---- personal data

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+_%0123459 ()\n:/é", max_size=60))
def test_base_spans_are_those_of_the_forms(text):
    assert [s for s in pii.spans_of(text) if s[0] in pii.BASE] == plain_spans(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "1.2.3.4", "256.1.1.1", "a.b@c.de", "@", ".", " ", "é", "1", "+"]), max_size=8))
def test_base_spans_of_joined_pieces(pieces):
    text = "".join(pieces)
    assert [s for s in pii.spans_of(text) if s[0] in pii.BASE] == plain_spans(text)


def test_added_spans():
    kinds = lambda text: {k: text[a:b] for k, a, b in pii.spans_of(text)}
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00.")["iban"] == "DE89 3704 0044 0532 0130 00"
    assert "iban" not in kinds("IBAN: DE88 3704 0044 0532 0130 00.")
    assert kinds("Kontonummer: 12345678 und")["account"] == "12345678"
    assert kinds("see https://jo:pw@host.example/x")["url_user"] == "https://jo:pw@host.example"
    assert kinds("an jörg@müller.de")["email_intl"] == "jörg@müller.de"
    assert kinds("the account is closed, https://host.example/x") == {}


def test_personal_data_of_odd_rows(spark, odd, none, documents):
    found = pii.digest(odd)
    assert found.count() == odd.count() and pii.digest(none).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in found.where("doc_id in (4, 5, 6)").collect()} == {empty}
    for row in pii.digest(documents).join(documents.select("doc_id", "text"), "doc_id").collect():
        spans = plain_spans(row["text"])
        assert row["base_sha256"] == hashlib.sha256(pii.joined(spans).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
    one = spark.createDataFrame([("mail a@b.cd and 1.2.3.4",), (None,)], "text string")
    assert rows(pii.redact(one)) == [("mail <EMAIL> and <IP>",), (None,)]


# ---- decontamination


def window_similarity(a, b):
    """Weighted Jaccard of word runs, weights in characters."""
    k = min(5, len(b))
    runs = lambda words: Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    x, y = runs(a), runs(b)
    weight = lambda s: sum(map(len, s))
    most = sum(max(x[s], y[s]) * weight(s) for s in {*x, *y})
    return sum(min(x[s], y[s]) * weight(s) for s in {*x, *y}) / most if most else 0.0


def plain_matches(text, items):
    words, memory, out = words_of(text), WordHashes(), {}
    print_of = lambda ws: int(decontam.packed(decontam.signs(hashed(ws, memory), np.array([len(w) for w in ws])).sum(axis=0)[None])[0])
    for name, item in items:
        parts = words_of(item)
        n = min(len(parts), len(words))
        if not parts or not words:
            continue
        for s in range(len(words) - n + 1):
            window = words[s : s + n]
            if (print_of(window) ^ print_of(parts)).bit_count() <= decontam.RADIUS:
                similarity = window_similarity(window, parts)
                if similarity >= 0.8 - 1e-12 and similarity > out.get(name, (0, 0))[1] + 1e-12:
                    out[name] = (s, similarity)
    return out


def test_leaks_are_those_of_all_windows(documents, spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(12).collect()
    pairs = [(r["item_id"], r["text"]) for r in items] + [(900, "tiny item"), (901, "one two three four five six")]
    texts = [r["text"] for r in documents.where("length(text) < 1500").orderBy("doc_id").limit(40).collect()]
    for i, (_, item) in enumerate(pairs[:8]):
        words = item.split()
        texts += [f"{texts[i]} {item} {texts[i + 1]}", f"before {' '.join(words[2:])} after it", f"{item} {item}", " ".join(words[:-1])]
    texts += ["a tiny item here", "one two three four five six", "tiny items", "one two three four five"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(pairs, "item_id long, text string")
    found = decontam.matches(frame, bench)
    got = {r["doc_id"]: {x["item"]: (x["first_word"], x["similarity"]) for x in r["leaks"]} for r in found.collect()}
    for doc, text in enumerate(texts):
        want = plain_matches(text, pairs)
        assert {k: (s, pytest.approx(v)) for k, (s, v) in want.items()} == got[doc], text
    assert sum(bool(v) for v in got.values()) >= 25


def test_hamming_blocks_find_all_within_the_radius():
    random = np.random.default_rng(3)
    for _ in range(300):
        item = int(random.integers(0, 1 << 63))
        index = decontam.Index([decontam.Item(0, 9, 5, item, np.array([], dtype=np.uint64), None, None, 1.0)])
        index.blocks[9] = [defaultdict(list) for _ in range(decontam.BLOCKS)]
        for b in range(decontam.BLOCKS):
            value = item >> (8 * b) & 255
            for near in [value, *(value ^ (1 << bit) for bit in range(8))]:
                index.blocks[9][b][near].append(0)
        other = item
        for bit in random.choice(64, size=int(random.integers(0, 20)), replace=False):
            other ^= 1 << int(bit)
        near = (other ^ item).bit_count() <= decontam.RADIUS
        assert decontam.Matcher(index).near(9, other) == ({0} if near else set())


def test_decontamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "across a wide cold lake near an old stone mill"), (3, "across a wide cold lake near an old stone mill")], "item_id int, text string")
    found = decontam.matches(odd, items, into="found")
    assert found.columns == [*odd.columns, "found"]
    hit = {r["doc_id"] for r in found.where("size(found) > 0").collect()}
    assert hit == {1, 2, 3} and max(len(r["found"]) for r in found.collect()) == 1
    kept = decontam.clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert decontam.clean(none, items).count() == 0
    assert decontam.clean(odd, items.where("false")).count() == odd.count()


def test_shingles():
    memory = WordHashes()
    h = hashed("a b c d e f g".split(), memory)
    assert len(shingles(h, 5)) == 3 and len(shingles(h[:3], 5)) == 1 and len(shingles(h[:0], 5)) == 0
    assert shingles(h, 5)[1] == shingles(h[1:], 5)[0]


def test_words_of_many_texts_are_hashed_at_once():
    texts = ["ÅΣΑΣ ς ß İstanbul 北京", "", None, "a", "a b c", f"_x_ {'y' * 31} {'z' * 32} {'q' * 70}", "é‍𝔘𝔫𝔦 १२ ٣", " .", "one two three four five", "\n\n a\nb c\rd e f \x00 g"]
    texts += [" ".join(f"{'wörd' * (i % 7)}{i}" for i in range(j, 3 * j)) for j in (5, 40, 50_000)]
    memory = WordHashes()
    found = [row for hashes, ends in word_hashes(texts) for row in np.split(hashes, ends[:-1])]
    assert [row.tolist() for row in found] == [hashed(words_of(text), memory).tolist() for text in texts]
    assert [row.tolist() for row in text_shingles(texts, 5)] == [shingles(hashed(words_of(text), memory), 5).tolist() for text in texts]
    for (keys, times), text in zip(neardup.all_counted(texts), texts, strict=True):
        want = neardup.counted(text, memory)
        assert keys.tolist() == want[0].tolist() and times.tolist() == want[1].tolist()


def test_words_of_a_batch_take_no_step_of_their_own(monkeypatch):
    """Near-dedup, which needs every word of every text three times, does not cut words one by one."""
    monkeypatch.setattr(neardup, "words_of", lambda text: pytest.fail("a text's words were cut one by one"))
    docs = [f"{i} " + "some words that a text has " * 20 for i in range(50)]
    assert sum(len(keys) for keys, _ in neardup.all_counted(docs)) > 0
