import random
import time

import numpy as np
import pytest

from transitlens.llm import token_counts as T

from .conftest import odd_rows

tokenizers = pytest.importorskip("tokenizers")
ALPHABET = "aaabbehtioéßüñÉİΣςσ'srevmld 0123_-!😀́\x1c\x85 　\nǅĳ中文кириA"


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    with open(public.path(T.VOCABULARY), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(vocabulary):
    t = tokenizers.Tokenizer.from_str(vocabulary)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(vocabulary, library):
    counter, r = T.PrefixCounter(vocabulary), random.Random(1)
    for _ in range(4000):
        text = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 25)))
        if r.random() < 0.1:
            text += "<|endoftext|>" + text[:3] + "<|startoftext|>"
        assert counter.count(text) == library(text), repr(text)


def test_every_prefix_and_budget(vocabulary, library):
    counter, r = T.PrefixCounter(vocabulary), random.Random(2)
    marks = "e\u0301a\u0323\u0302 \u1112\u1161\u11ab's"
    for k in range(400):
        alphabet = ("abcdehinorst'sé. ", ALPHABET, marks + "'re'll!", "ab'<|endoftext|>")[k % 4]
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
        if k % 5 == 0:
            text += "ab!<|endoftext|>'s" + text[:5]
        table = counter.prefix_table(text).tolist()
        counts = [library(text[:k]) for k in range(len(text) + 1)]
        assert table == counts, repr(text)
        for budget in (0, 3, 7):
            assert counter.cut(text, budget) == max(k for k, n in enumerate(counts) if n <= budget), (text, budget)


def test_text_without_spaces_is_cut_inside(vocabulary, library):
    r = random.Random(3)
    text = "".join(r.choice("abcdefghij0123.,!é中") for _ in range(21_000))
    counter = T.PrefixCounter(vocabulary)
    started = time.process_time()
    table, cut = counter.prefix_table(text), counter.cut(text, 2048)
    assert time.process_time() - started < 10  # linear: some 50 microseconds a character
    assert table[-1] == library(text) and cut == max(np.flatnonzero(table <= 2048))
    assert library(text[:cut]) <= 2048 < library(text[: cut + 1])
    for k in r.sample(range(len(text)), 30):
        assert table[k] == library(text[:k])


def test_word_table_is_exact_at_every_prefix(vocabulary, library):
    counter = T.PrefixCounter(vocabulary)
    word = "internationalizationthsh" * 4
    _, closed = counter.word(word)
    assert closed[1:] == [library(word[:i]) for i in range(1, len(word) + 1)]


def test_query_rows(docs_of, words, vocabulary, library):
    rows = odd_rows(words) + [(50, "x" * 20000), (51, "a<|endoftext|>b")]
    got = T.token_counts(docs_of(rows, extra=True), vocabulary).collect()
    want = sorted((str(i), len((t or "").encode()), library(t or ""), library(t or "") > T.TOKEN_LIMIT) for i, t in rows)
    assert sorted((str(r[0]), *r[1:4]) for r in got) == want
    texts = {i: t or "" for i, t in rows}
    for r in got:
        text, k = texts[r["doc_id"]], r["limit_chars"]
        assert (k < len(text)) == r["over_limit"]
        assert library(text[:k]) <= T.TOKEN_LIMIT and (not r["over_limit"] or library(text[: k + 1]) > T.TOKEN_LIMIT)
    assert T.token_counts(docs_of([]), vocabulary).count() == 0


def test_stored_prefix_table_answers_budgets(docs_of, words, vocabulary, library):
    rows = odd_rows(words) + [(60, "antidisestablishmentarianism" * 9)]
    stored = T.prefix_tables(docs_of(rows, extra=True), vocabulary)
    got = stored.withColumn("cut", T.chars_in_budget(20)).withColumn("head", T.tokens_in_prefix(11)).collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t or "")
    assert len(got) == len(rows)
    for r in got:
        text = next(t for t in texts[r["doc_id"]] if len(t) + 1 == len(r["counts"]))
        assert r["counts"][-1] == library(text) and r["head"] == library(text[:11])
        assert r["cut"] == max(k for k, n in enumerate(r["counts"]) if n <= 20)
        assert library(text[: r["cut"]]) <= 20
    assert T.prefix_tables(docs_of([]), vocabulary).count() == 0
