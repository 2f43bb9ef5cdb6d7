import hashlib
import re
from collections import Counter

import pyarrow as pa

from transitlens.llm import exact_dedup

from .conftest import CLASHING, odd_rows


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = True
        for i in ids:
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def test_matches_brute_force_with_and_without_heavy_groups(docs_of, words):
    rows = odd_rows(words) + [(100 + i, "hot  text") for i in range(60)] + [(200 + i, f"rare {i // 2}") for i in range(20)]
    for share in (4, 256):
        got = exact_dedup.exact_duplicates(docs_of(rows, extra=True), heavy_share=share, counters=64)
        assert Counter(map(tuple, got.collect())) == brute(rows)


def test_drop_keeps_one_of_each_group_and_all_columns(docs_of, words):
    rows = odd_rows(words) + [(100 + i, "hot  text") for i in range(60)]
    docs = docs_of(rows, extra=True)
    left = exact_dedup.drop_exact_duplicates(docs, heavy_share=4, counters=64)
    assert left.columns == docs.columns and set(CLASHING) <= set(left.columns)
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(r[0] for r in brute(rows).elements() if r[3])


def test_empty_table(docs_of):
    assert exact_dedup.exact_duplicates(docs_of([])).count() == 0
    assert exact_dedup.drop_exact_duplicates(docs_of([])).count() == 0


def test_misra_gries_bound():
    values = [b"a"] * 500 + [b"b"] * 300 + [bytes([i % 250, i // 250]) for i in range(2000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i::7], pa.binary())], names=["digest"]) for i in range(7)]
    counts = exact_dedup.misra_gries(batches, 20)
    assert len(counts) <= 20
    for v, n in ((b"a", 500), (b"b", 300)):
        assert n - len(values) / 21 <= counts.get(v, 0) <= n
