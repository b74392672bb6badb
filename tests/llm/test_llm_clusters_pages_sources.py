"""Centroid clustering, main texts of pages, divergence of sources."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlog.llm import clusters, divergence, maintext
from adlog.llm.queries import op12_html_extraction
from conftest import SMALL, rows
from odd_rows import documents, none, odd  # noqa: F401
from testbed.compare import difference, rows_of_duckdb, rows_of_spark

# ---- centroid clustering


@pytest.mark.parametrize("seed,scale", [(1, 300), (2, 3), (3, 1 << 26)])
def test_the_outward_scan_finds_the_nearest_centroid(seed, scale):
    random = np.random.default_rng(seed)
    centroids, vectors = random.integers(-scale, scale, (40, 64)), random.integers(-scale, scale, (700, 64))
    centroids[7], centroids[12] = centroids[30], centroids[3]  # equal centroids
    vectors[:5] = centroids[[30, 3, 0, 1, 2]]
    found, distance, worked = clusters.Centroids(centroids).nearest(vectors)
    full = ((vectors[:, None, :].astype(object) - centroids[None].astype(object)) ** 2).sum(axis=2)
    assert distance.tolist() == full.min(axis=1).tolist()
    assert found.tolist() == [row.tolist().index(min(row)) for row in full]
    assert worked <= full.size


def test_far_centroids_are_ruled_out():
    random = np.random.default_rng(4)
    centroids = random.integers(-9, 9, (40, 64)) + 100 * np.arange(40)[:, None]
    vectors = centroids.repeat(50, axis=0) + random.integers(-3, 3, (2000, 64))
    found, _, worked = clusters.Centroids(centroids).nearest(vectors)
    assert found.tolist() == np.arange(40).repeat(50).tolist()
    assert worked < 2 * len(vectors)


VECTORS = "vec_id long, embedding array<float>, label int, cluster string, v string, distance string"


def vector_rows(n, seed=6):
    random = np.random.default_rng(seed)
    return [(i, random.normal(0, 2, 64).astype(np.float32).tolist(), 0, "c", "v", "d") for i in range(n)]


def plain_clusters(vectors):
    """Lloyd's rounds in plain integers; vectors as (id, floats), all of them valid."""
    whole = [(i, [max(-(1 << 26), min(1 << 26, math.floor(256 * float(x)))) for x in v]) for i, v in vectors]
    order = sorted(whole, key=lambda x: (x[0] is None, hashlib.sha256(f"2:{x[0]}".encode()).hexdigest(), x[1]))
    centroids = [v for _, v in order[:40]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(5):
        members = defaultdict(list)
        for _, v in whole:
            members[nearest(v)[1]].append(v)
        for i, group in members.items():
            centroids[i] = [sum(column) // len(group) for column in zip(*group)]
    placed = [(i, *nearest(v)[::-1]) for i, v in whole]
    inertia = Counter()
    for _, cluster, distance in placed:
        inertia[cluster] += distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in placed]


def test_clusters_are_those_of_the_full_search(spark):
    vectors = vector_rows(230) + [vector_rows(1)[0]] * 3  # repeated rows
    vectors += [(500 + i, vectors[3][1], 0, "c", "v", "d") for i in range(4)] + [(None, vectors[9][1], None, None, None, None)]
    vectors.append((600, [3e5] * 32 + [-1e38] * 32, 0, "c", "v", "d"))  # beyond what counts
    broken = [[], None, [1.0] * 63, [1.0] * 65, [1.0] * 63 + [None], [1.0] * 63 + [math.nan], [math.inf] + [0.0] * 63, [0.0, -math.inf] * 32]
    frame = spark.createDataFrame(vectors + [(900 + i, v, 0, "c", "v", "d") for i, v in enumerate(broken)], VECTORS).repartition(5)
    found = clusters.clustered(frame)
    want = plain_clusters([(i, v) for i, v, *_ in vectors])
    assert rows(found) == sorted(want, key=lambda row: tuple((v is None, "" if v is None else str(v)) for v in row))


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame(vector_rows(3), VECTORS)
    assert sorted(row[1:5] for row in rows(clusters.clustered(few))) == [(0, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0)]
    assert rows(clusters.clustered(few.where("vec_id < 0"))) == []
    assert rows(clusters.clustered(few.where("vec_id < 0").unionByName(spark.createDataFrame([(1, [1.0], 0, "", "", "")], VECTORS)))) == []


# ---- main texts

SENTENCE = "The house on the hill was built by a family that had come to the valley in the spring of the year before. "
PAGES = {
    # everything that is not the article, around it and in it
    """<html><head><title>No</title><style>p{color:red}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><div id="cookie-notice"><p>We use cookies on this site to make it
    better for you and for all.</p></div><main><article class="post"><header><h1>A &amp; B</h1></header><p>One<br>two&nbsp;&#8211;
    three.</p><p>Short.</p><aside>By the way</aside><div class="ad-box">Buy</div><ul><li>an item<li>another <a href=z>one</a></ul>
    <form>Name <input> <button>Send</button></form><footer>Posted in news</footer></article><section id="comments"><article
    class="comment"><p>I do not think that this is the way it was in the valley at all.</p></article></section></main>
    <div class="sidebar"><p>Most read</p></div><footer>&copy; 2020 us</footer></body></html>""": "A & B\nOne two – three.\nShort.\nan item\nanother one",
    # no marked article: blocks are judged by themselves, then by their neighbours
    f"""<body><div><a href=1>Home</a> <a href=2>About</a></div><div>Buy now</div><h2>The house</h2><p>{SENTENCE * 3}</p><p>Yes.</p><p>{SENTENCE * 2}</p>
    <p>So it was.</p><div>&copy; 2019 The house of the valley and its owners</div></body>""": f"The house\n{(SENTENCE * 3).strip()}\nYes.\n{(SENTENCE * 2).strip()}\nSo it was.",
    # names in place of elements
    f"""<div class="topMenu"><p>{SENTENCE}</p></div><div class="entry-content"><div class="entry-header"><h1>Title</h1></div><p>Text &lt;b&gt;.
    <p>More<div class="newsletter-signup">{SENTENCE * 3}</div></div>""": "Title\nText <b>.\nMore",
    # tags that are not closed, scripts and comments with tags in them, no end of the page
    "<article><h1>T<p><b>One <i>two</b><br><p>three<script>var a='</p><article>';</script> four<!-- <p>no --><p>five &am &amp": "T\nOne two\nthree four\nfive &am &",
    "<p title='a>b' hidden>no</p><p title=\"x > y\">yes</p><p style='display: none'>no</p>": "yes",
    "<p title=\"open>one</p><p>two</p>": "one\ntwo",
    "plain text,  no\n tags & all": "plain text, no tags & all",
    "<article>a<svg><text>no</text></svg>b <img src=x>c<hr>d<table><tr><td>e<td>f</table></article>": "ab c\nd\ne\nf",
    "<main><p>Read <a href=x>all of this long link text</a> now then</p><p><a href=y>Next</a></p></main>": "Read all of this long link text now then",
    "<nav>a</nav><footer>b</footer>": "",
    "<!-- open <p>no": "",
    "<script>no": "",
    "< 3 and > 2 <": "< 3 and > 2 <",
    " \n\t ": "",
    "": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert maintext.main_text(page) == PAGES[page]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<a href=x>", "</a>", "<li>", "<article>", "</article>", "<b>", "</i>", "<!--", "-->", "<script>", "</script>", "<nav>", "'", '"', "<", ">", "&amp;", "text ", "\n", "<td>", "<h1>", "</h1>"]), max_size=40))
def test_any_page_is_read(parts):
    found = maintext.main_text("".join(parts))
    assert found == "\n".join(" ".join(line.split()) for line in found.split("\n"))


def test_words_decide_where_no_article_is_marked():
    unlike = "Lorem ipsum dolor amet consectetur " * 8
    page = f"<div>{unlike}</div><div>{SENTENCE * 3}</div><div>{unlike}</div>"
    assert maintext.main_text(page) == (SENTENCE * 3).strip()
    # a language without known stop words: lengths decide
    assert maintext.main_text(f"<div>{unlike}</div><div><a href=x>x</a></div>") == unlike.strip()


def test_long_pages_and_deep_ones():
    text = "word " * 200_000
    assert maintext.main_text(f"<article><p>{text}</p></article>") == text.strip()
    assert maintext.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert maintext.main_text("<p title=it's>" * 300 + "end") == "end"


def test_pages_keep_their_columns(spark):
    frame = spark.createDataFrame([(1, None, "x", None), (1, "", "x", 2), (None, "<p>a</p>", None, 3), (None, "<p>a</p>", None, 3)], "page_id long, html string, text string, main_text long")
    found = maintext.extracted(frame)
    assert sorted(found.columns) == sorted(frame.columns)
    assert rows(found, "page_id", "html", "text", "main_text") == [(1, "", "", 2), (1, None, "", None), (None, "<p>a</p>", "a", 3), (None, "<p>a</p>", "a", 3)]
    assert maintext.extracted(frame.where("false")).count() == 0


def test_articles_of_the_pages(spark):
    """The query against a plain reading of these pages' one layout."""
    import html

    want = []
    for page in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", page["html"], re.S)[1].replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        parts = [" ".join(html.unescape(part).split()) for part in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(part for part in parts if part)
        want.append((page["page_id"], page["url"], text, len(text)))
    assert sorted(rows(op12_html_extraction(spark, SMALL))) == sorted(want)


# ---- divergence


def plain_terms(texts):
    found = []
    for text in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        found.append(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower))
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.text(alphabet="abAB zÄß语😀-_1\x00\x7f\n", max_size=60)), max_size=8))
def test_terms_are_counted_like_plain_matches(texts):
    texts = sorted(texts, key=lambda x: x[0])
    want = Counter()
    for (group, _), terms in zip(texts, plain_terms(t for _, t in texts)):
        for term, n in Counter(terms).items():
            times, docs = want.get((group, term), (0, 0))
            want[group, term] = times + n, docs + 1
    found = {}
    for groups, times, docs, terms in divergence.count_terms([t.encode() for _, t in texts], [g for g, _ in texts]):
        for group, n, d, term in zip(groups.tolist(), times.tolist(), docs.tolist(), terms):
            assert (group, term.decode()) not in found
            found[group, term.decode()] = n, d
    assert found == dict(want)


def test_radix_order():
    random = np.random.default_rng(3)
    words = [random.integers(0, 3, 500).astype(np.uint64) << np.uint64(40), random.integers(0, 1 << 63, 500, dtype=np.uint64)]
    words[1][100:200] = words[1][:100]
    assert divergence.radix_order(words).tolist() == np.lexsort((words[1], words[0])).tolist()


def audit_sql(frame):
    connection = duckdb.connect()
    arrow_table = frame.select("text", "lang", "source").toArrow()
    connection.register("documents", arrow_table)
    return rows_of_duckdb(connection, divergence.ORACLE)


def test_audit_of_whole_documents(documents):
    assert difference(rows_of_spark(divergence.audit(documents)), audit_sql(documents)) is None


def test_audit_of_odd_rows(spark, odd, none, monkeypatch):
    assert difference(rows_of_spark(divergence.audit(odd)), audit_sql(odd)) is None  # no term is in 30 documents
    assert rows(divergence.audit(none)) == []
    texts = ["the Cat and the Hat", "Straße über " + "x" * 17, "語" * 9 + " the", "ein Satz mit Wörtern", None, "", "1 2 3"]
    made = [(texts[i % 7] and texts[i % 7] * (1 + i % 3), [None, "en", "de", ""][i % 4], [None, "a", "b", "", "Ä"][i % 5]) for i in range(900)]
    made += [(None, "fr", "only"), ("the the the", "es", "one"), ("the", "es", "two")]
    frame = spark.createDataFrame(made, "text string, lang string, source string").repartition(4)
    want = audit_sql(frame)
    assert {row[want[0].index("part")] for row in want[1]} == {"pair", "term"}
    assert difference(rows_of_spark(divergence.audit(frame)), want) is None
    monkeypatch.setattr(divergence, "CELLS", 6)  # several blocks of terms
    monkeypatch.setattr(divergence, "CHUNK", 50)  # and many chunks of texts
    assert difference(rows_of_spark(divergence.audit(frame)), want) is None
    assert rows(divergence.audit(frame.withColumnsRenamed({"lang": "l", "source": "s", "text": "t"}).withColumn("term", F.lit(1)), "t", "l", "s")) == rows(divergence.audit(frame))


def test_shares_of_huge_counts_are_exact(spark):
    big = 9_000_000_000_000_000
    frame = spark.createDataFrame([(big, 10 * big, 3)], "n long, total long, V long")
    assert frame.select(divergence._share(F.col("n"))).first()[0] == 1 + 10**9 * (big + 5) // (10 * big + 15)
