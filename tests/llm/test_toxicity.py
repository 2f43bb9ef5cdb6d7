import random
import zlib

import numpy as np
import pytest

from transitlens.llm import toxicity as X
from transitlens.llm.common import id_remainder

from .conftest import odd_rows

BAD = ["idiot", "moron", "worthless", "scum"]


def rows_and_labels(words, n=600):
    r = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        w, toxic = words(30), int(r.random() < 0.25)
        if toxic:
            for b in r.sample(BAD, 3):
                w.insert(r.randrange(len(w)), b)
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture
def model(spark, docs_of, words):
    rows, labels = rows_and_labels(words)
    return X.train(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_viterbi_restores_obfuscated_spellings(model):
    reader = X.Deobfuscator(X.Source(model["trigrams"]))
    for spelling in ("1d10t", "id!ot", "i.d.i.o.t", "i-d-i-o-t", "idiooot", "m0r0n", "w0rthl3ss", "$cum", "s.c.u.m"):
        assert reader.words(f"the {spelling} here") & set(BAD), spelling
    assert "idiot" in reader.words("you i d i o t there")
    assert reader.words("Plain words, stay. (as) they!") == {"plain", "words", "stay", "as", "they"}


def test_viterbi_path_is_the_cheapest(model):
    """Against all paths of the lattice, spelled out."""
    source, r = X.Source(model["trigrams"]), random.Random(5)

    def paths(spelling, i=0):
        if i == len(spelling):
            yield "", 0.0
            return
        for letter, cost in X.readings(spelling, i):
            for rest, more in paths(spelling, i + 1):
                yield letter + rest, cost + more

    def total(word, cost):
        padded = "^^" + word + "$"
        return cost + sum(source.cost(padded[i : i + 2], padded[i + 2]) for i in range(len(padded) - 2))

    for _ in range(60):
        spelling = "".join(r.choice("idotm10!.esSs$a") for _ in range(r.randint(1, 7))).lower()
        best = min(total(w, c) for w, c in paths(spelling))
        word = X.restore(spelling, source)
        assert min(total(w, c) for w, c in paths(spelling) if w == word) == pytest.approx(best)


def test_held_out_accuracy_and_obfuscation(docs_of, words, model):
    rows, labels = rows_and_labels(words)
    got = {r["doc_id"]: r for r in X.toxicity(docs_of(rows, extra=True), model, id_remainder(4) == 2).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i, _ in rows)
    assert sum(got[i]["predicted"] == dict(labels)[i] for i in held) >= 0.97 * len(held)
    hidden = [(i, t.replace("idiot", "1d10t").replace("moron", "m.o.r.o.n").replace("scum", "s c u m")) for i, t in rows]
    again = {r["doc_id"]: r["predicted"] for r in X.toxicity(docs_of(hidden), model, id_remainder(4) == 2).collect()}
    assert sum(again[i] == dict(labels)[i] for i in held) >= 0.95 * len(held)


def test_odd_rows_and_drop(spark, docs_of, words, model):
    rows = odd_rows(words) + [(70, "you idiot moron worthless scum")]
    docs = docs_of(rows, extra=True)
    scored = X.toxicity(docs, model, id_remainder(4) == 2).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    left = X.drop_toxic(docs, model)
    assert left.columns == docs.columns
    assert left.count() == sum(r["predicted"] == 0 for r in scored) and left.filter("doc_id = 70").isEmpty()
    assert X.toxicity(docs_of([]), model, id_remainder(4) == 2).count() == 0
    none = X.train(docs_of(rows), spark.createDataFrame([], "doc_id long, toxic int"))
    assert X.drop_toxic(docs, none).count() == len(rows)


def test_language_model_covers_unlabelled_texts(spark, docs_of, words):
    """Spellings of words that only texts without labels hold are restored."""
    rows, labels = rows_and_labels(words, 200)
    rows += [(5000 + i, "zzz kyvgrwq xoplumk kyvgrwq " + " ".join(words(5))) for i in range(60)]
    model = X.train(docs_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model["trigrams"]["kyv"] == 60 and "zzz" not in model["trigrams"]
    reader = X.Deobfuscator(X.Source(model["trigrams"]))
    assert "xoplumk" in reader.words("x0plumk") and "kyvgrwq" in reader.words("k.y.v.g.r.w.q")


def test_source_is_a_distribution():
    """Also where trigrams and pairs are left out."""
    counts = {"a": 4, "b": 6, "$": 5, "^a": 3, "ab": 3, "b$": 4, "^^a": 3, "^ab": 2, "ab$": 2}
    source = X.Source(counts)
    for before in ("^^", "^a", "ab", "bb", "zz"):
        unknown = source.share(before, "?")
        assert sum(source.share(before, c) for c in "ab$") + unknown == pytest.approx(1)


def test_spaced_and_doubled_spellings(model):
    reader = X.Deobfuscator(X.Source(model["trigrams"]))
    for text, word in (
        ("you are a i d i o t", "idiot"), ("s c u m!", "scum"), ("(s c u m) they", "scum"), ("such id i ot there", "idiot"),
        ("mo r on", "moron"), ("the iddiot here", "idiot"), ("a morron", "moron"), ("1 d 1 0 t", "idiot"),
    ):
        assert word in reader.words(text), text
    assert {"an", "is"} <= reader.words("an is an is here")


def test_doubled_letters_decided_alone_equal_the_lattice():
    import random

    r = random.Random(3)
    counts = {}
    for _ in range(2000):
        w = "^^" + "".join(r.choices("abcdeil", k=r.randint(1, 9))) + "$"
        for i in range(2, len(w)):
            for k in range(3):
                counts[w[i - k : i + 1]] = counts.get(w[i - k : i + 1], 0) + 1
    source, changed = X.Source(counts), 0
    for _ in range(4000):
        w = "".join(r.choices("abcei", k=r.randint(2, 10)))
        if not X.RUN.search(w):
            got = X.without_doubles(w, source)
            assert got == X.restore(w, source)
            changed += got != w
    assert changed > 10


def test_remembered_spellings_do_not_change_the_words(monkeypatch):
    texts = ["an iddiot said n o t h i n g to the m4n", "stuupid stuff, really"] * 3
    counts = {"^^t": 3, "^th": 3, "the": 3, "he$": 3, "t": 4, "h": 4, "e": 5, "$": 3}
    want = [X.Deobfuscator(X.Source(counts)).words(t) for t in texts]
    monkeypatch.setattr(X, "REMEMBERED", 2)
    reader = X.Deobfuscator(X.Source(counts))
    assert [reader.words(t) for t in texts] == want
    assert len(reader.known) <= 3 and len(reader.same) <= 3


def test_marks_at_the_edges_cost_no_reading_of_their_own(monkeypatch):
    source = X.Source({"a": 5, "b": 4, "$": 9, "ab": 4})
    asked, token = [], X.Deobfuscator.token
    monkeypatch.setattr(X.Deobfuscator, "token", lambda self, t: asked.append(t) or token(self, t))
    reader = X.Deobfuscator(source)
    assert reader.words('Haus, "haus" (haus) haus. maus; 1d10t') >= {"haus", "maus"}
    assert not {"haus,", '"haus"', "haus.", "maus;"} & set(asked)
    assert {"(haus)", "1d10t"} <= set(asked)  # an edge that imitates a letter is read


def test_score_is_the_sum_of_the_words_features():
    counts = {"a": 5, "b": 4, "$": 9, "ab": 4}
    weights = {"abc": 1.0, "^abcd": -0.5, "abcdef": 2.0, "^abcdef": 0.25, "^xyzzyx": 3.0, "xyzz": 0.125}
    reader, score = X.Deobfuscator(X.Source(counts)), X.scorer({"trigrams": counts, "weights": weights, "bias": -1.0})
    for text in ["", "abc", "abcd", "abcdef. abcdefg", "xyzzyxes xyz", "xyzz, abc! ab", "abcde 4bcd"]:
        z = -1.0 + sum(weights.get(f, 0.0) for f in X.features(reader.words(text)))
        assert abs(score(text) - 1 / (1 + np.exp(-z))) < 1e-12, text
