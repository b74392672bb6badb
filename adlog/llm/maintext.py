"""Main text of web pages by two passes of rules over blocks.

A page is cut into blocks at its block-level tags. The first pass looks at each block by itself: what stands in a menu, header, footer,
sidebar, form, notice, advert or comment section is none of the text; a block of links is not either; long blocks with many stop words
are text; blocks that are short or in between stay open. In the second pass open blocks take the label of the nearest decided
blocks: those of both sides, if they agree, else of the nearer one; a heading that of what follows it.

Where a page marks its article (``article``, ``main``, or names that say so), open blocks in it are text, whatever their words: only
what the first pass rules out by place or links is dropped there, and other blocks are no text if an ``article`` holds any.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlog.llm.common import free_name, small_batches

#: Characters of a short block, and of one that is text by itself.
SHORT, LONG = 70, 200
#: Share of stop words among the words: below the first a block is no text, from the second on it is.
FEW_STOPS, MANY_STOPS = 0.25, 0.32
#: Share of a block's characters in links beyond which it is a block of links, in an article and elsewhere.
LINKED, LINKED_ELSEWHERE = 0.8, 0.33

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a an and are as at be but by for from has have he her his if in is it its not of on or she that the their they this to was were
    which will with you
    als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach nicht oder sich
    sie sind um und von war wie wird zu zum zur
    au aux avec ce ces cette dans de du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se
    ses son sur un une vous
    al como con del el ella entre era esta este ha hay las lo los más muy no para pero por sin sobre su sus también una uno y ya""".split()
)

# Elements of HTML by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is no text of the page.
SILENT = ("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "canvas", "audio", "video", "select", "button")
#: Elements that hold no part of an article.
OUTSIDE = frozenset("nav footer aside form dialog menu".split())
ROLES_OUTSIDE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Parts of ids and class names of such elements.
NAMES_OUTSIDE = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent
    cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter
    notice notices notification overlay pager pagination popup promo promotion recommended related replies reply respond share sharebar
    sharing sidebar sidebars sidenav signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar""".split()
)
#: Parts after which a name speaks of something else: a page *with a* sidebar.
NOT_NAMES = frozenset("has with without no is".split())
#: Names of articles without an element for it.
NAMES_ARTICLE = frozenset("article articlebody entry story post".split())
#: Names of sections that no article stands in.
NAMES_LASTING = frozenset("comment comments commentlist disqus recommended related replies reply respond".split())
#: Elements of running text.
PROSE = HEADINGS | frozenset("p pre blockquote li dd".split())
#: Names that an article's own parts carry as well.
OWN_PARTS = frozenset("header banner promo teaser".split())

#: Elements that end one another.
SIBLINGS = (("li",), ("dt", "dd"), ("td", "th"), ("tr",))

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<silent>" + "|".join(SILENT) + r")(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=silent)(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<close_2>/?)(?P<name_2>[a-zA-Z][^\s/>]*)(?P<rest_2>[^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)",  # quotes without an end
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
WORD = re.compile(r"\w+")
COPYRIGHT = re.compile(r"©|\(c\)\s*\d{4}|all rights reserved", re.I)


@dataclass
class Block:
    """A block of text. ``place``: 2 in an article, 1 in a main part, 0 elsewhere; ``label``: True, False or None (open)."""

    text: str
    linked: int
    place: int
    outside: bool
    heading: bool
    prose: bool
    label: bool | None = None


@dataclass
class Element:
    name: str
    place: int
    outside: bool
    lasting: bool  # an article inside is outside as well
    block: bool


def _names(value: str) -> set[str]:
    """Parts of the names in an id or class, without those of names that speak of something else."""
    out: set[str] = set()
    for name in value.split():
        parts = [part.lower() for part in NAME_PARTS.findall(name)]
        if parts and parts[0] not in NOT_NAMES:
            out.update(parts)
    return out


def _opened(name: str, rest: str, around: Element) -> Element:
    """The element that a tag opens inside another one."""
    given = {a[0].lower(): unescape(a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(rest)} if rest.strip(" /\t\r\n") else {}
    names = _names(f"{given.get('id', '')} {given.get('class', '')}")
    role = given.get("role", "").strip().lower()
    hidden = "hidden" in given or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I) is not None
    marked = name in ("article", "main") or role in ("article", "main") or given.get("itemprop", "").lower() == "articlebody"
    place = 2 if "article" in (name, role) else 1 if marked else 0
    if name in ("html", "body"):
        return Element(name, 0, hidden, hidden, True)
    ended = hidden or not names.isdisjoint(NAMES_LASTING)
    lasting = around.lasting or ended or name == "aside"
    if marked:
        return Element(name, max(place, around.place), around.lasting or ended, lasting, True)
    named = names & NAMES_OUTSIDE
    if around.place == 2 or around.place and not names.isdisjoint(NAMES_ARTICLE):
        named -= OWN_PARTS
    furniture = name in OUTSIDE or role in ROLES_OUTSIDE or (name == "header" and around.place < 2)
    outside = around.outside or ended or furniture or bool(named)
    if not outside and not names.isdisjoint(NAMES_ARTICLE):
        place = 1
    return Element(name, max(place, around.place), outside, lasting, name not in INLINE)


def blocks(page: str) -> list[Block]:
    """The blocks of a page, in order, with texts decoded and white space made one blank."""
    out: list[Block] = []
    open_: list[Element] = [Element("", 0, False, False, True)]
    pieces: list[str] = []
    linked, links = 0, 0

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            value = unescape(raw) if "&" in raw else raw
            pieces.append(value)
            if links:
                linked += len(value.strip())

    def end() -> None:
        nonlocal linked
        value = " ".join("".join(pieces).split()) if pieces else ""
        pieces.clear()
        if value:
            around = open_[-1]
            names = {e.name for e in open_[-3:]}
            heading, prose = not names.isdisjoint(HEADINGS), not names.isdisjoint(PROSE)
            out.append(Block(value, linked, around.place, around.outside, heading, prose))
        linked = 0

    def close(place: int) -> None:
        nonlocal links
        links -= sum(e.name == "a" for e in open_[place:])
        del open_[place:]

    at = 0
    for token in TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        if (name := token["name"] or token["name_2"]) is None:
            if token["silent"] and token["silent"].lower() not in ("button", "svg", "math"):
                pieces.append(" ")
            elif token[0].startswith("<![CDATA["):
                text(token[0][9:].removesuffix("]]>"))
            continue
        name, inline = name.lower(), name.lower() in INLINE
        if name in VOID:
            if name == "hr":
                end()
            elif name == "br":
                pieces.append(" ")
        elif token["close"] or token["close_2"]:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].name == name:
                    if not inline or any(e.outside != open_[i - 1].outside for e in open_[i:]):
                        end()
                    close(i)
                    break
                if inline and open_[i].block:
                    break
            else:
                if not inline:
                    end()
        else:
            if not inline:
                end()
            # a block ends the paragraph it begins in, an item the item before it, a link the link before it
            ends = {"a"} if name == "a" else set() if inline else {"p", *next((pair for pair in SIBLINGS if name in pair), ())}
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].name in ends:
                    last = open_[i].name != "p"
                    close(i)
                    if last:
                        break
                elif open_[i].block:
                    break
            element = _opened(name, token["rest"] or token["rest_2"] or "", open_[-1])
            if inline and element.outside != open_[-1].outside:
                end()
            links += name == "a"
            open_.append(element)
    text(page[at:])
    end()
    return out


def _stops(text: str) -> tuple[int, int]:
    words = WORD.findall(text.lower())
    return len(words), sum(word in STOP_WORDS for word in words)


def _first_pass(found: list[Block]) -> None:
    counts = [_stops(block.text) for block in found]
    # the page's language has none of the stop words: its blocks are judged by their lengths
    known = sum(stops for _, stops in counts) >= 0.05 * sum(words for words, _ in counts)
    for block, (words, stops) in zip(found, counts):
        share, size = block.linked / len(block.text), len(block.text)
        density = stops / max(1, words)
        if block.outside or share > (LINKED if block.place else LINKED_ELSEWHERE):
            block.label = False
        elif not block.place and size < LONG and COPYRIGHT.search(block.text):
            block.label = False
        elif block.place:
            block.label = None
        elif size < SHORT:
            block.label = False if block.linked else None
        elif known and density < FEW_STOPS:
            block.label = False
        elif size >= LONG and (density >= MANY_STOPS or not known):
            block.label = True


def _second_pass(found: list[Block]) -> None:
    last = len(found)
    before, after = [-1] * last, [last] * last
    for i in range(1, last):
        before[i] = i - 1 if found[i - 1].label is not None else before[i - 1]
    for i in range(last - 2, -1, -1):
        after[i] = i + 1 if found[i + 1].label is not None else after[i + 1]
    labels = [block.label for block in found]
    decided = any(labels)
    for i, block in enumerate(found):
        if block.label is not None:
            continue
        left, right = before[i], after[i]
        sides = [found[j].label for j in (left, right) if 0 <= j < last]
        if block.place:
            labels[i] = True
        elif not decided:
            labels[i] = not block.linked  # a page of short blocks, furniture apart
        elif block.heading and right < last:
            labels[i] = found[right].label
        elif len(set(sides)) == 1:
            labels[i] = sides[0]
        elif i - left != right - i:
            labels[i] = found[left if i - left < right - i else right].label
        else:
            labels[i] = block.prose
    for block, label in zip(found, labels):
        block.label = label


def main_text(page: str | None) -> str:
    """The main text of a page: its blocks by lines, empty if there is none."""
    found = blocks(page) if page else []
    _first_pass(found)
    _second_pass(found)
    inside = [block for block in found if block.label and block.place == 2]
    return "\n".join(block.text for block in (inside or [block for block in found if block.label]))


def extracted(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """The pages with the main text of their ``html`` as a further column, which replaces one of its name.

    NULL and empty pages have an empty text, and so have pages of furniture alone. A page without tags is one block. Every page is
    read whole and by itself, so repeated rows agree; an empty table stays empty. What is not closed lasts to the end of what
    it stands in, comments and scripts to the end of the page.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(values: pd.Series) -> pd.Series:
        return pd.Series([main_text(value if isinstance(value, str) else None) for value in values], dtype=object)

    (name,) = free_name(pages, "main_text")
    found = pages.withColumn(name, extract(F.col(f"`{html}`")))
    return found.drop(into).withColumnRenamed(name, into) if into != html else found.withColumn(html, F.col(name)).drop(name)
