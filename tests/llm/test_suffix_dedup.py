import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from transitlens.llm import suffix_dedup as S
from transitlens.llm.common import BITMAP_BITS, RANGE, HashParts

from .conftest import odd_rows


def brute(rows, k=50):
    def strings(t):
        raw = (t or "").encode()
        return {raw[p : p + k] for p in range(len(raw) - k + 1)}

    last = (1 << 63) - 1  # a null id counts as equal to the largest one
    order = sorted({last if i is None else i for i, _ in rows})
    seen, before = set(), {}
    for i in order:
        before[i] = frozenset(seen)
        for j, t in rows:
            if (last if j is None else j) == i:
                seen |= strings(t)
    out = []
    for i, t in rows:
        raw, gone = (t or "").encode(), set()
        for p in range(len(raw) - k + 1):
            if raw[p : p + k] in before[last if i is None else i]:
                gone.update(range(p, p + k))
        kept = bytes(b for p, b in enumerate(raw) if p not in gone)
        spans = sum(p - 1 not in gone for p in gone)
        out.append((str(i), len(raw), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_matches_brute_force(docs_of, words):
    r = random.Random(3)
    passages = [" ".join(words(r.randint(4, 30))) for _ in range(6)]
    rows = [(i, t) for i, t in odd_rows(words) if not t or len(t) < 40]
    rows += [(20, "ab" * 60), (21, "ab" * 80), (22, "a" * 300), (23, "b" + "a" * 120), (24, "é" * 60), (25, "xé" + "é" * 40), (26, passages[0]), ((1 << 63) - 1, passages[1])]
    for i in range(30, 70):
        t = " ".join(words(r.randint(0, 25)))
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randrange(len(p))
            t += p[a : a + r.randint(30, 160)] + " ".join(words(r.randint(0, 6)))
        rows.append((i, t))
    rows += [(None, passages[1] + passages[2]), (40, passages[3]), (41, rows[-1][1]), (41, rows[-1][1])]
    got = S.remove_repeats(docs_of(rows, extra=True)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows)


def test_sampled_place_depends_on_the_string_only():
    """A string's run and rank are the same wherever it stands."""
    r = random.Random(7)
    text = bytes(r.choice(b"abc ") for _ in range(400))
    whole, shifted = S.Runs([text]), S.Runs([b"zz" + text[100:300], b"tail"])
    ranks = dict(zip(whole.starts.tolist(), whole.rank.tolist()))
    inner = dict(zip((shifted.starts - 2 + 100).tolist(), shifted.rank.tolist()))
    assert all(ranks[p] == rank for p, rank in inner.items() if p >= 100)
    assert len(set(ranks.values())) == len({text[p : p + 50] for p in ranks})


def test_very_long_text_and_empty_table(docs_of, words):
    long = " ".join(words(60000))
    rows = [(1, long), (2, "begin " + long[1000:200000] + " end")]
    got = {r["doc_id"]: r for r in S.remove_repeats(docs_of(rows)).collect()}
    assert got[1]["n_removed"] >= 0 and got[2]["n_removed"] >= 199000 and got[2]["n_spans"] >= 1
    assert S.remove_repeats(docs_of([])).count() == 0


def test_a_range_of_hashes_stays_small_at_any_size():
    for n in (0, 10**6, 6 * 10**7, 4 * 10**9):
        how = HashParts(n, 2.0**-12)
        assert n / how.segments <= RANGE and how.segments * how.bits == BITMAP_BITS and how.bits >= 8


def test_batches_are_small_inside_and_the_setting_is_kept(spark, docs_of, monkeypatch):
    name, seen, inner = "spark.sql.execution.arrow.maxRecordsPerBatch", [], S.without_repeats
    before = spark.conf.get(name)
    monkeypatch.setattr(S, "without_repeats", lambda *a: seen.append(int(spark.conf.get(name))) or inner(*a))
    got = S.remove_repeats(docs_of([(1, "a" * 60), (2, "b" + "a" * 55)]))
    assert seen == [min(1000, int(before))] and spark.conf.get(name) == before
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got.collect()) == [(1, 60, 0, 0), (2, 56, 55, 1)]


def test_hashes_of_sampled_ranks_are_even(words):
    """A sampled rank is the least of many; its bit in the bitmap must not crowd with the others."""
    upper = S.hash_of(S.Runs([" ".join(words(40000)).encode()]).anchor)
    distinct = np.unique(upper)
    assert len(distinct) > 5000 and np.bincount(distinct >> np.uint32(28), minlength=16).max() < len(distinct) / 8


@pytest.mark.parametrize("threshold", [50, 90])
def test_common_line_with_many_surroundings(docs_of, words, threshold):
    """A frequent string in very many classes: same rows, and no join of rows with their groups."""
    r, line = random.Random(5), " ".join(words(40))
    rows = [(i, " ".join(words(8)) + r.choice(["", line[r.randrange(30) :], line[: r.randrange(60, 200)], line + line]) + " ".join(words(9))) for i in range(150)]
    rows += [(i, rows[7][1][: 40 + i] + "x" + rows[7][1][40 + i :]) for i in range(150, 170)]
    spans = S.repeated_spans(S.named_texts(docs_of(rows)), threshold)
    assert "Join" not in spans._jdf.queryExecution().optimizedPlan().toString()
    got = S.remove_repeats(docs_of(rows), threshold).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows, threshold)


def test_rows_are_cut_between_keys_only():
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 3, 4, 5, 5]
    batches = [pa.RecordBatch.from_pydict({"key": keys[i : i + 2], "n": list(range(i, i + 2))}) for i in range(0, 12, 2)]
    tables = [t.to_pydict() for t in S.whole_keys(iter([batches[0].slice(0, 0), *batches]))]
    assert [n for t in tables for n in t["n"]] == list(range(12)) and len(tables) > 2
    assert all(a["key"][-1] != b["key"][0] for a, b in zip(tables, tables[1:], strict=False))
