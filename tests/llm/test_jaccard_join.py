import random

from transitlens.llm import jaccard_join as J

from .conftest import odd_rows


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((str(i), len(sets[k]), str(least.get(find(k)))) for k, (i, _) in enumerate(rows))


def rows_with_copies(words):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    some = lambda n: [r.choice(vocabulary) for _ in range(n)]
    base, line = some(60), some(12)
    rows = odd_rows(words)
    for i in range(100, 320):
        kind = r.random()
        if kind < 0.4:
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(60)] = r.choice(vocabulary)
        elif kind < 0.7:
            w = line + some(r.randint(0, 4))
        elif kind < 0.8:
            w = [r.choice(vocabulary[:3]) for _ in range(r.randint(0, 8))]
        else:
            w = some(r.randint(0, 50)) + line
        rows.append((i, " ".join(w)))
    return rows + [(None, rows[20][1]), (105, rows[17][1])]


def test_components_equal_brute_force_for_narrow_and_wide_columns(docs_of, words, monkeypatch):
    monkeypatch.setattr(J, "SQUARE", 7)
    rows = rows_with_copies(words)
    want = brute(rows)
    for wide in (1, 4, 48):
        got = J.jaccard_components(docs_of(rows, extra=True), wide=wide).collect()
        assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want


def test_drop_keeps_the_smallest_of_each_component(docs_of, words):
    rows = rows_with_copies(words)
    docs = docs_of(rows, extra=True)
    left = J.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    got = sorted(str(r["doc_id"]) for r in left.collect())
    want = {str(i) for i, n, c in brute(rows) if n and i == c}
    empty = [str(i) for i, n, _ in brute(rows) if not n]
    assert [i for i in got if i not in empty and i != "None"] == sorted(want)
    assert all(i in got for i in empty)


def test_least_overlap_bounds():
    for n in range(1, 60):
        for m in range(n, 80):
            linked = [i for i in range(n + 1) if 100 * i >= 80 * (n + m - i)]
            assert (linked[0] if linked else n + 1) == min(J.least_overlap(n, m, 80), n + 1)
            if linked:
                assert n - J.prefix_length(n, 80) + 1 <= linked[0] and m - J.prefix_length(m, 80) + 1 <= linked[0]


def test_empty_table(docs_of):
    assert J.jaccard_components(docs_of([])).count() == 0
    assert J.drop_near_duplicates(docs_of([])).count() == 0


def test_drop_tells_rows_of_one_id_apart(docs_of):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(1, a), (7, a), (7, b), (None, a), (None, "x y z"), (None, "x y z"), (9, ""), (9, "")]
    left = J.drop_near_duplicates(docs_of(rows, extra=True)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == [("1", a), ("7", b), ("9", ""), ("9", ""), ("None", "x y z")]
