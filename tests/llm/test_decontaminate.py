import random

import pytest

from transitlens.llm import decontaminate as D

from .conftest import odd_rows


def edited(r, text, n):
    t = list(text)
    for _ in range(n):
        i, o = r.randrange(len(t)), r.random()
        if o < 0.33:
            t[i] = r.choice("abcdeiorst")
        elif o < 0.66:
            del t[i]
        else:
            t.insert(i, r.choice("abcdeiorst"))
    return "".join(t)


def best_distance(pattern, text):
    """Edit distance of the pattern to the best part of the text, row by row."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


@pytest.fixture
def items(words):
    return [(i, " ".join(words(random.Random(i).randint(14, 45)))) for i in range(40)]


def test_distance_equals_dynamic_programming(items):
    index, r = D.Index(items[:8], 0.1), random.Random(6)
    for k in range(8):
        for n in (0, 1, index.limit[k], index.limit[k] + 3):
            region = "left part " + edited(r, index.items[k][1], n) + " right part"
            want = best_distance(index.items[k][1], region)
            got = index.distance(k, region)
            assert got == want if want <= index.limit[k] else got > index.limit[k]


def test_recall_at_the_largest_distance_and_no_false_hits(items, words):
    index, r = D.Index(items, D.EDIT_SHARE), random.Random(8)
    texts, planted = [], []
    for i, t in items:
        for share in (0.0, 0.04, D.EDIT_SHARE):
            q = edited(r, t, int(share * len(t)))
            texts.append(" ".join(words(80)) + " " + q + " " + " ".join(words(60)))
            planted.append(i)
    clean = [" ".join(words(200)) for _ in range(100)]
    hits = index.hits(texts + clean)
    assert sum(i in h for i, h in zip(planted, hits)) >= D.RECALL * len(planted)
    assert all(i in h for i, h in list(zip(planted, hits))[::3])
    for text, found in zip(texts + clean, hits):
        for i, edits in found.items():
            pattern = D.normalised(dict(items)[i])
            assert best_distance(pattern, D.normalised(text)) <= edits <= D.EDIT_SHARE * len(pattern)


def test_query_rows_in_one_and_several_blocks(spark, docs_of, words, items):
    rows = odd_rows(words) + [(80, "a " + items[3][1].upper() + " b"), (81, items[3][1] + "\n" + items[4][1]), (82, "needs Short item here")]
    rows += [(83, "held " + items[5][1] + " without id"), (82, "Short items, another text, is clean"), (None, items[6][1])]
    nameless = [(None, items[5][1]), (None, items[7][1]), (5, "not in any text but of an id that is")]
    bench = [(i, t) for i, t in items if i not in (5, 7)] + nameless
    bench = spark.createDataFrame([*bench, (90, None), (91, ""), (92, "short  item here"), (92, "no short item")], "item_id long, text string")
    want = {80: [3], 81: [3, 4], 82: [92], 83: [None], None: [6]}
    clean = {"Short items, another text, is clean", "one two three"}
    for block in (20_000, 15):
        got = D.contamination(docs_of(rows, extra=True), bench, block=block).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r["contaminated"] == bool(r["item_ids"]) == bool(r["edits"]) == (r["n_items"] > 0)
        found = sorted((str(r["doc_id"]), r["item_ids"]) for r in got)
        assert found == sorted((str(i), [] if t in clean else want.get(i, [])) for i, t in rows)
        docs = docs_of(rows, extra=True)
        left = D.drop_contaminated(docs, bench, block=block)
        assert left.columns == docs.columns and left.count() == len(rows) - 5
    assert D.contamination(docs_of([]), bench).count() == 0 and D.contamination(docs_of([]), bench, block=15).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(docs_of(rows), none).count() == len(rows)


def test_short_items_are_found_at_every_place(words):
    """Copies at the largest distance, the item's first word at any rank of the text."""
    r = random.Random(21)
    short = [(i, " ".join(words(40))[: r.choice([18, 33, 48, 52, 60, 65])].strip()) for i in range(30)]
    unspaced = [(100 + i, "".join(chr(0x4E00 + r.randrange(300)) for _ in range(r.randint(50, 70)))) for i in range(10)]
    index = D.Index(short + unspaced, D.EDIT_SHARE)
    texts, planted = [], []
    for i, t in short + unspaced:
        for before in range(5):
            for share in (0.0, D.EDIT_SHARE):
                lead = "".join(chr(0x4E00 + r.randrange(300)) for _ in range(20 + before)) if i >= 100 else " ".join(words(20 + before)) + " "
                texts.append(lead + edited(r, t, int(share * len(t))) + lead[::-1])
                planted.append(i)
    assert all(i in found for i, found in zip(planted, index.hits(texts)))


def test_pieces_cover_an_item():
    for length in range(10, 200):
        n = length // 10 + 1
        borders = D.pieces(length, n)
        assert borders[0] == 0 and borders[-1] == length and len(borders) == n + 1
        assert all(b > a for a, b in zip(borders, borders[1:]))


def indexed_starts(text):
    return sum(len(text) - o >= D.WALK for o in [0, *[j + 1 for j, c in enumerate(text) if c == " "]])


def test_recall_of_the_shortest_items_in_a_block_of_long_ones(words):
    """At the largest distance only, per length class; the block does not change the result."""
    r = random.Random(22)
    long = [(100 + i, " ".join(words(50))) for i in range(40)]
    walked = []
    while len(walked) < 20:  # the fewest starts that walks are used for
        w = words(60)
        walked += [(len(walked), t) for t in (" ".join(w[:n]) for n in range(30, 60)) if indexed_starts(t) == D.WINDOWS * D.STRIDE][:1]
    short = [(50 + i, " ".join(words(18))) for i in range(20)]
    for items in (short, walked):
        index = D.Index(items + long, D.EDIT_SHARE)
        copies = [edited(r, t, int(D.EDIT_SHARE * len(t))) for _, t in items]
        texts = [" ".join([*words(20 + k % 4), q, *words(20)]) for k, q in enumerate(copies)]
        found = index.hits(texts)
        assert sum(i in h for (i, _), h in zip(items, found)) >= D.RECALL * len(items)
        alone = D.Index(items, D.EDIT_SHARE).hits(texts)
        assert alone == [{i: n for i, n in h.items() if i < 100} for h in found]


def test_recall_of_items_of_distinct_words_in_a_block_of_long_ones():
    r = random.Random(23)
    words = lambda n: ["".join(r.choice("abcdefghiklmnoprstuw") for _ in range(r.randint(2, 8))) for _ in range(n)]
    items, long = [(i, " ".join(words(15))) for i in range(60)], [(100 + i, " ".join(words(55))) for i in range(90)]
    texts = [" ".join([*words(20 + i % 4), edited(r, t, int(D.EDIT_SHARE * len(t))), *words(20)]) for i, t in items]
    found, alone = D.Index(items + long, D.EDIT_SHARE).hits(texts), D.Index(items, D.EDIT_SHARE).hits(texts)
    assert sum(i in h for (i, _), h in zip(items, found)) >= D.RECALL * len(items)
    assert found == alone
