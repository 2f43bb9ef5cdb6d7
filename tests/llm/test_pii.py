import hashlib
import random
import re

from transitlens.llm import pii

from .conftest import odd_rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_pattern_matching():
    anchors, r = pii.automaton(), random.Random(4)
    pieces = ["@", ".", "a", "b-", "+4", "1", "22", "255", "300", " ", "-", "(0)", "😀", "é", "4539 1488 0343 6467", "x@y.z", "1.2.3.4", "+49 30 1234567", "\n", "%"]
    for _ in range(6000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 14)))
        got = [(a, pii.KINDS.index(k), b) for a, b, k in pii.find_spans(text, anchors) if k in pii.BASE_KINDS]
        assert got == base(text), repr(text)


def test_cues_add_spans():
    text = 'see https://a.example/x?y=1. token = "24be64439e3e" Account: DE89370400440532013000 password: short'
    found = {(k, text[a:b]) for a, b, k in pii.find_spans(text, pii.automaton())}
    assert ("url", "https://a.example/x?y=1") in found
    assert ("account", "24be64439e3e") in found and ("account", "DE89370400440532013000") in found
    assert not any("short" in s for _, s in found)


def test_query_rows(docs_of, words):
    rows = odd_rows(words) + [(60, "mail a.b@c.example.org now"), (61, "10.0.0.1 and 4539148803436467, +1 (212) 555-0100"), (62, "1" * 30000)]
    got = {(r["doc_id"], r["spans"]): r for r in pii.personal_data(docs_of(rows, extra=True)).collect()}
    for i, t in rows:
        spans = base(t or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        r = next(r for (j, _), r in got.items() if j == i and r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest())
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert r["personal"] == any(not s.startswith("url:") for s in r["spans"].split(",") if s)
    assert pii.personal_data(docs_of([])).count() == 0
