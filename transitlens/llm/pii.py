"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of every text in one pass: at-signs,
URL schemes, plus signs, digits and the cue words of accounts and secrets.  A
local parser for each kind expands around an anchor and validates what it
finds; nothing else of the text is looked at.

Kinds and their parsers (spans are code points, end exclusive):

* ``email``: the run of local-part characters left of an at-sign (not before
  the end of the last email) and the dotted domain right of it.
* ``ip``, ``card``, ``phone``: from the first digit (or plus sign) outside the
  last match of the kind, the longest expansion; then octets at most 255, 14
  to 19 digits passing Luhn, 10 to 15 digits.  What fails is dropped without a
  second try inside it.
* ``url``: from a scheme (http, https, ftp) up to white space, quotes or angle
  brackets, without trailing punctuation.
* ``account``: the value after a cue (account, iban, token, password, api_key,
  secret and the like) and ``=`` or ``:``, at least 6 characters of letters,
  digits, ``_`` and ``-`` with at least one digit.

The first four are the base kinds; their spans equal what leftmost
non-overlapping matching of their pattern gives.  ``url`` and ``account`` are
what the cues add; base spans are never dropped for them.

Edge cases: null and empty texts have no spans; repeated rows give equal rows;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "iban", "token", "password", "passwd", "api_key", "apikey", "secret", "user_id")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL = re.compile(r"[^\s\"'<>]+")
VALUE = re.compile(r"[\"']?\s?[=:]\s?[\"']?([A-Za-z0-9_-]{6,})")
DIGITS = "0123456789"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    for d in DIGITS:
        a.add_word(d, ("digit", 1))
    for s in SCHEMES:
        for form in {s, s.upper(), s.capitalize()}:
            a.add_word(form, ("scheme", len(form)))
    for c in CUES:
        for form in {c, c.upper(), c.capitalize()}:
            a.add_word(form, ("cue", len(form)))
    a.make_automaton()
    return a


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def find_spans(text: str, anchors) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span, by start, then kind as listed."""
    spans: list[tuple[int, int, int]] = []
    # per kind: where the next match may begin (after the last expansion)
    email_end = ip_end = card_end = phone_end = url_end = 0
    for last, (what, length) in anchors.iter(text):
        i = last - length + 1
        if what == "digit":
            if i >= ip_end:
                m = IP.match(text, i)
                if m:
                    ip_end = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m.group().split(".")):
                        spans.append((i, ip_end, 1))
                else:
                    ip_end = skip_digits(text, i)
            if i >= card_end:
                m = CARD.match(text, i)
                if m:
                    card_end = m.end()
                    if card_end - i >= 14:
                        digits = m.group().replace(" ", "").replace("-", "")
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            spans.append((i, card_end, 2))
                else:
                    card_end = i + 1
        elif what == "at":
            if i >= email_end:
                found = email_at(text, i, email_end)
                if found:
                    spans.append((*found, 0))
                    email_end = found[1]
        elif what == "plus":
            if i >= phone_end:
                m = PHONE.match(text, i)
                if m:
                    phone_end = m.end()
                    if 10 <= sum(c in DIGITS for c in m.group()) <= 15:
                        spans.append((i, phone_end, 3))
        elif what == "scheme":
            if i >= url_end:
                m = URL.match(text, last + 1)
                if m:
                    end = last + 1 + len(m.group().rstrip(".,;:!?)]}"))
                    if end > last + 1:
                        spans.append((i, end, 4))
                        url_end = end
        else:
            m = VALUE.match(text, last + 1)
            if m and any(c in DIGITS for c in m.group(1)):
                spans.append((m.start(1), m.end(1), 5))
    return [(a, b, KINDS[k]) for a, k, b in sorted({(a, k, b) for a, b, k in spans})]


def skip_digits(text: str, i: int) -> int:
    """Where the next address may begin after a failed one that began at i.

    From any later digit of the same run the expansion meets the same dots and
    fails likewise, so the whole run is passed over.
    """
    while i < len(text) and text[i] in DIGITS:
        i += 1
    return i


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans,
    and whether there is any but plain URLs (personal)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for b in slices(batches):
            columns: list[list] = [[] for _ in range(7)]
            for text in b.column("text").to_pylist():
                spans = find_spans(text or "", anchors)
                base = [s for s in spans if s[2] in BASE_KINDS]
                for column, kind in zip(columns, BASE_KINDS, strict=False):
                    column.append(sum(s[2] == kind for s in base))
                columns[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                columns[5].append(joined(spans))
                columns[6].append(any(s[2] != "url" for s in spans))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:4]], *[pa.array(c, pa.string()) for c in columns[4:6]], pa.array(columns[6], pa.bool_())],
                names=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "personal"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, personal boolean"
    )


def personal_data_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
