"""Personal data by anchors: an Aho-Corasick automaton finds cues, local parsers expand and validate what surrounds them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from adlog.llm.common import free_name, small_batches

BASE = ("email", "ip", "card", "phone")
#: What the method finds besides: addresses with letters beyond ASCII, credentials in a URL, bank accounts, cued numbers.
ADDED = ("email_intl", "url_user", "iban", "account")
KINDS = BASE + ADDED

DIGIT = frozenset("0123456789")
LETTER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = LETTER | DIGIT | frozenset("._%+-")
LABEL = LETTER | DIGIT | frozenset("-")
DIAL = DIGIT | frozenset(" ().-")
SPACE = frozenset(" \t\n\r\x0b\x0c")
#: Words before an account number, in the languages of the data.
ACCOUNT_CUES = ("account no", "account number", "acct", "konto", "kontonummer", "compte", "cuenta", "passport no", "ssn")
#: IBAN lengths run from 15 to 34 characters; its number leaves 1 modulo 97.
IBAN_LEAST, IBAN_MOST = 15, 34

SPAN = StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])


@cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in DIGIT:
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in ACCOUNT_CUES:
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            found.add_word(form, ("cue", len(form)))
    for form in ("IBAN", "Iban", "iban"):
        found.add_word(form, ("iban", 4))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, x in enumerate(reversed(digits)):
        value = int(x) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    if not (IBAN_LEAST <= len(value) <= IBAN_MOST and value[:2].isalpha() and value[2:4].isdigit()):
        return False
    return int("".join(str(int(x, 36)) for x in value[4:] + value[:4])) % 97 == 1


def run_right(text: str, at: int, of: frozenset) -> int:
    """End of the run of such characters that starts at a place."""
    n = len(text)
    while at < n and text[at] in of:
        at += 1
    return at


def run_left(text: str, at: int, of: frozenset, least: int = 0) -> int:
    """Start of the run of such characters that ends before a place, not before ``least``."""
    while at > least and text[at - 1] in of:
        at -= 1
    return at


def domain_end(text: str, at: int, label) -> int:
    """End of a host name with one dot at least that starts at a place, or -1."""
    end = label(text, at)
    if end == at:
        return -1
    dots = 0
    while end < len(text) and text[end] == "." and (after := label(text, end + 1)) > end + 1:
        end, dots = after, dots + 1
    return end if dots else -1


def ascii_label(text: str, at: int) -> int:
    return run_right(text, at, LABEL)


def any_label(text: str, at: int) -> int:
    n = len(text)
    while at < n and (text[at].isalnum() or text[at] == "-"):
        at += 1
    return at


def dotted_end(text: str, at: int) -> int:
    """End of four runs of digits joined by dots from the first one's start, or -1."""
    end = run_right(text, at, DIGIT)
    for _ in range(3):
        if not (end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGIT):
            return -1
        end = run_right(text, end + 1, DIGIT)
    return end


def joined_end(text: str, at: int) -> int:
    """End of the runs of digits joined by single blanks or hyphens."""
    end = run_right(text, at, DIGIT)
    while end + 1 < len(text) and text[end] in " -" and text[end + 1] in DIGIT:
        end = run_right(text, end + 1, DIGIT)
    return end


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end), in code points, by kind as listed and then start."""
    if not text:
        return []
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    after = dict.fromkeys(("email", "ip", "card", "phone", "email_intl", "url_user"), 0)  # where the next match may start
    for last, (what, length) in automaton().iter(text):
        at = last - length + 1
        if what == "digit":
            for kind in ("ip", "card"):
                if at < after[kind]:
                    continue
                if at > after[kind] and text[at - 1] in DIGIT:
                    continue  # not the first of its run
                if kind == "ip":
                    if (dotted := dotted_end(text, at)) >= 0:
                        after[kind] = dotted
                        parts = text[at:dotted].split(".")
                        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
                            found[kind].append((at, dotted))
                elif (end := joined_end(text, at)) - at > 1:
                    after[kind] = end
                    digits = text[at:end].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found[kind].append((at, end))
        elif what == "at":
            start = run_left(text, at, LOCAL, after["email"])
            end = domain_end(text, at + 1, ascii_label)
            if start < at and end >= 0:
                found["email"].append((start, end))
                after["email"] = end
            wide = at
            while wide > after["email_intl"] and (text[wide - 1].isalnum() or text[wide - 1] in "._%+-"):
                wide -= 1
            wide_end = domain_end(text, at + 1, any_label)
            if wide < at and wide_end >= 0:
                after["email_intl"] = wide_end
                if not text[wide:wide_end].isascii():
                    found["email_intl"].append((wide, wide_end))
        elif what == "plus":
            if at >= after["phone"] and at + 1 < len(text) and text[at + 1] in DIGIT:
                end = run_left(text, run_right(text, at + 2, DIAL), DIAL - DIGIT)
                if end >= at + 4:
                    after["phone"] = end
                    if 9 <= sum(x in DIGIT for x in text[at:end]) <= 15:
                        found["phone"].append((at, end))
        elif what == "scheme":
            start = run_left(text, at, LETTER, after["url_user"])
            end = last + 1
            while end < len(text) and text[end] not in SPACE and text[end] not in "/?#\"'<>":
                end += 1
            authority = text[last + 1 : end]
            if start < at and "@" in authority[1:]:
                found["url_user"].append((start, end))
                after["url_user"] = end
        elif what in ("cue", "iban"):
            if at and text[at - 1].isalnum():
                continue
            start = last + 1
            if what == "cue" and start < len(text) and text[start].isalpha():
                continue
            limit = start + 4
            while start < min(limit, len(text)) and (text[start] in SPACE or text[start] in ":#.="):
                start += 1
            end = start
            while end < len(text) and (text[end] in LETTER or text[end] in DIGIT or text[end] in " -") and end - start < 2 * IBAN_MOST:
                if what == "cue" and text[end] == " ":
                    break
                end += 1
            value = text[start:end]
            if what == "iban":
                plain = value.replace(" ", "").replace("-", "").upper()
                for size in range(min(len(plain), IBAN_MOST), IBAN_LEAST - 1, -1):
                    if iban_valid(plain[:size]):
                        end, seen = start, 0
                        while seen < size:
                            seen += text[end] not in " -"
                            end += 1
                        found["iban"].append((start, end))
                        break
            else:
                value = value.rstrip("-")
                if 6 <= sum(x in DIGIT for x in value) and len(value) <= IBAN_MOST:
                    found["account"].append((start, start + len(value)))
    return [(kind, start, end) for kind in KINDS for start, end in sorted(set(found[kind]))]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """The same rows with an array of spans (kind, start, end; code points, end exclusive).

    NULL and empty texts have none. Every row is read by itself: repeated rows agree, an empty table stays empty.
    The column ``into`` is replaced if it is there.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(ArrayType(SPAN))
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(x)] if isinstance(x, str) else [] for x in texts])

    return docs.withColumn(into, spans(F.col(text)))


def digest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text."""
    (name,) = free_name(docs, "pii")
    found = find(docs.select(doc_id, text), text, name)
    base = F.filter(name, lambda s: s.kind.isin(*BASE))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    of = lambda kind: F.filter(name, lambda s: s.kind == kind)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        F.col(doc_id).alias("doc_id"), *counts, F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(name).alias("spans")
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "<{}>") -> DataFrame:
    """Texts with every span replaced by a mark of its kind; overlapping spans become one, named by the first."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(StringType())
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series(["".join(_pieces(x, mark)) if isinstance(x, str) else None for x in texts])

    return docs.withColumn(text, clean(F.col(text)))


def _pieces(text: str, mark: str) -> Iterator[str]:
    at = 0
    for kind, start, end in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            yield text[at:start]
            yield mark.format(kind.upper())
        at = max(at, end)
    yield text[at:]


def base_sha256(text: str | None) -> str:
    """The digest of one text, for tests."""
    return hashlib.sha256(joined([s for s in spans_of(text) if s[0] in BASE]).encode()).hexdigest()
