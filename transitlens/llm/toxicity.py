"""Toxicity by noisy-channel deobfuscation.

1. Channel and source.  Spellings such as ``1d10t``, ``i.d.i.o.t``, ``i d i o t``
   or ``idiooot`` are read as a lattice: each character stands for itself, for
   the letters it imitates, or for nothing (separators, repeated letters), at
   a cost.  The Viterbi path under a character trigram model of clean words is
   the restored word.  Clean words pass as they are.  The model is counted over
   the clean words of all documents (text only, no labels).
2. Score.  A logistic regression on the restored words and their beginnings
   (4 to 6 letters), features picked by their G statistic.

Labels are learned from a bounded sample: at most ``SAMPLE`` labelled rows
whose crc32(id) mod 4 is not 2, the first by a hash of the id.  Counts are
made by Spark; the driver gets at most ``MAX_FEATURES`` features,
``MAX_TRIGRAMS`` trigrams and as many letter pairs, all letters, and the
sample's hits on these features.  Rarer trigrams and pairs are not lost: their
mass is dealt by the pairs' and the letters' shares.  The pass that scores all
documents needs no shuffle.

Edge cases: null and empty texts get the intercept's score; a null ``doc_id``
is scored like any other and never trained on; repeated rows are scored alike
and trained on once; no labels at all gives score 0; an empty table gives an
empty result; other columns are never read for a score.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, slices, table, text_or_empty, worker_memory, written

SAMPLE = 20_000
MAX_FEATURES = 2000
MAX_TRIGRAMS = 50_000
LEAST_G = 6.0
LEAST_TOXIC = 3
THRESHOLD = 0.3
RIDGE = 1.0
STEPS = 300
#: weight of the shorter context's distribution in the character model
PRIOR = 2.0
#: a task hands on its word counts when it holds so many (bounds its memory)
HELD = 200_000
#: spellings remembered by a Python worker; a fuller memory is emptied
REMEMBERED = 200_000

# what a character may stand for besides itself (fixed values)
IMITATES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l",
}
# natural-log costs of the channel: imitation, dropped separator, dropped third
# and further equal letter, dropped second one, dropped digit
IMITATION, SEPARATOR, REPEATED, DOUBLE, DROPPED = 1.0, 0.5, 0.1, 3.0, 6.0
LETTER = re.compile(r"[^\W\d_]")
WORD = re.compile(r"[^\W\d_]+")
RUN = re.compile(r"(.)\1\1")
TWICE = re.compile(r"(.)\1")
TWICE_IN = TWICE.search
EDGE = "\"'.,;:?!#%&*()[]{}<>/\\|-_=~`^"


class Source:
    """Character trigram model of clean words; ``^^`` before, ``$`` after.  The
    counts are of trigrams, of pairs (the last two of a trigram) and of letters
    (its last one).  What a context's trigrams leave of its count, those not
    held, is dealt by the shorter context's distribution, as is ``PRIOR``."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.held: Counter = Counter()
        for t, n in counts.items():
            if len(t) > 1:
                self.held[t[:-1]] += n
        letters = [n for t, n in counts.items() if len(t) == 1]
        self.letters, self.total = len(letters) + 1, sum(letters)
        self.costs: dict[str, float] = {}

    def share(self, before: str, letter: str) -> float:
        if not before:
            return (self.counts.get(letter, 0) + 1) / (self.total + self.letters)
        # every word has one end, and begins once
        n = self.counts.get("$" if before in ("^", "^^") else before, 0)
        held = self.held.get(before, 0)
        n = max(n, held)
        return (self.counts.get(before + letter, 0) + (n - held + PRIOR) * self.share(before[1:], letter)) / (n + PRIOR)

    def cost(self, before: str, letter: str) -> float:
        found = self.costs.get(before + letter)
        if found is None:
            if len(self.costs) > REMEMBERED:
                self.costs.clear()
            found = self.costs[before + letter] = -math.log(self.share(before, letter))
        return found


def readings(spelling: str, i: int) -> list[tuple[str, float]]:
    """(letter or nothing, cost) for the i-th character of a spelling."""
    char = spelling[i]
    if char.isalpha() or LETTER.match(char):
        out = [(char, 0.0)]
        if i and spelling[i - 1] == char:  # a double letter is common, a third one isn't
            out.append(("", REPEATED if spelling[max(i - 2, 0) : i + 1] == 3 * char else DOUBLE))
        return out
    out = [(c, IMITATION) for c in IMITATES.get(char, "")]
    out.append(("", SEPARATOR if not char.isalnum() else DROPPED))
    return out


def restore(spelling: str, source: Source, gaps=frozenset()) -> str:
    """Viterbi path through the lattice of a spelling.  The states are the
    last two letters read, a handful at each character, so the work is linear
    in the length.  At the places ``gaps`` a word may end and another begin
    (a space in the result)."""
    states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    known = source.costs.get
    for i in range(len(spelling)):
        if i in gaps:
            ended = [(cost + source.cost(last, "$"), (" ", path)) for last, (cost, path) in states.items() if last != "^^"]
            joined = {last: (cost + (SEPARATOR if last != "^^" else 0.0), path) for last, (cost, path) in states.items()}
            ended += [joined["^^"]] if "^^" in joined else []
            states = {**joined, "^^": min(ended, key=lambda x: x[0])}
        reached: dict[str, tuple[float, tuple | None]] = {}
        for letter, extra in readings(spelling, i):
            for last, (cost, path) in states.items():
                if letter:
                    step = known(last + letter) or source.cost(last, letter)
                    total, state, way = cost + extra + step, last[1] + letter, (letter, path)
                else:
                    total, state, way = cost + extra, last, path
                if state not in reached or total < reached[state][0]:
                    reached[state] = (total, way)
        states = reached
    _, path = min(((cost + source.cost(last, "$"), path) for last, (cost, path) in states.items()), key=lambda x: x[0])
    letters = []
    while path:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


def without_doubles(word: str, source: Source) -> str:
    """The Viterbi path of a spelling of letters without a third equal one in a
    row: only second letters may go, and letting one go changes the costs of the
    two letters behind it and no others.  So where doubled letters stand three
    places apart each is decided by itself; else the lattice is walked."""
    twice = [m.end() - 1 for m in TWICE.finditer(word)]
    if len(twice) > 1 and any(b - a < 3 for a, b in zip(twice, twice[1:], strict=False)):
        return restore(word, source)
    # neighbours on both sides, with the marks of the ends
    w, drop = "^^" + word + "$", []
    known, cost = source.costs.get, source.cost
    for i in twice:
        ab, c, d, e = w[i : i + 2], w[i + 2], w[i + 3], w[i + 4 : i + 5]  # the letter before, the double
        bc, bd, cd = w[i + 1 : i + 3], ab[1] + d, c + d
        keep = (known(ab + c) or cost(ab, c)) + (known(bc + d) or cost(bc, d))
        gone = DOUBLE + (known(ab + d) or cost(ab, d))
        if e:
            keep += known(cd + e) or cost(cd, e)
            gone += known(bd + e) or cost(bd, e)
        if gone < keep:
            drop.append(i)
    return "".join(x for i, x in enumerate(word) if i not in drop) if drop else word


def spaced(tokens: list[str]) -> list[list[str]]:
    """Runs of three and more tokens of one or two characters, marks at their
    edges not counted, that may be words spelt with spaces."""
    out: list[list[str]] = []
    run: list[str] = []
    last = -1
    # only tokens of up to five characters can take part, and of three and more
    # only those with marks
    for i in [i for i, n in enumerate(map(len, tokens)) if n < 3 or (n < 6 and not tokens[i].isalpha() and 0 < len(tokens[i].strip(EDGE)) < 3)]:
        if i != last + 1:
            if len(run) > 2:
                out.append(run)
            run = []
        run.append(tokens[i])
        last = i
    if len(run) > 2:
        out.append(run)
    return out


class Deobfuscator:
    def __init__(self, source: Source):
        self.source = source
        self.known: dict[str, tuple[str, ...]] = {}
        #: tokens that are read as they are
        self.same: set[str] = set()

    def remember(self, key: str, words: tuple[str, ...]) -> tuple[str, ...]:
        if len(self.known) > REMEMBERED:  # the older half goes
            for old in list(islice(self.known, REMEMBERED // 2)):
                del self.known[old]
        self.known[key] = words
        return words

    def token(self, token: str) -> tuple[str, ...]:
        """Words of one token without white space."""
        found = self.known.get(token)
        if found:
            return found
        core = token.strip(EDGE)
        plain = not core or WORD.fullmatch(core) is not None
        edges = bool(core) and (token[0] in IMITATES or (token[-1] in IMITATES and token[-1] not in EDGE))
        if plain and not edges and not TWICE.search(core):
            return (core,) if core else ()
        return self.remember(token, self.doubtful(token, core, plain, edges))

    def doubtful(self, token: str, core: str, plain: bool, edges: bool) -> tuple[str, ...]:
        if plain and not RUN.search(core):
            words = {core} if core else set()
            if TWICE.search(core):  # as it is, and without letters put in
                words.add(without_doubles(core, self.source))
            if edges:
                words.add(restore(token, self.source))
            return tuple(words)
        # the spelling as a whole, and its clean parts
        return tuple({restore(core, self.source), *WORD.findall(core)} - {""})

    def words(self, text: str) -> set[str]:
        """Distinct restored words of a text."""
        tokens = text.lower().split()
        distinct = set(tokens)
        out = distinct & self.same
        rest = distinct - out
        for t in [t for t in rest if not t.isalpha()]:
            rest.remove(t)
            core = t.strip(EDGE)
            if core.isalpha() and t[0] not in IMITATES:  # marks at the edges change nothing
                rest.add(core)
            else:
                out.update(self.token(t))
        # letters alone, none of them doubled, are read as they are
        same = {t for t in rest if not TWICE_IN(t)}
        if len(self.same) > REMEMBERED:
            self.same.clear()
        self.same |= same
        out |= same
        for t in rest - same:
            out.update(self.token(t))
        for run in spaced(tokens):
            out.update(self.run(run))
        return out

    def run(self, run: list[str]) -> tuple[str, ...]:
        """Words of a run of short tokens: its best division into words, and
        for single characters the run as one word."""
        key = " ".join(run)
        words = self.known.get(key)
        if words is None:
            parts = [t.strip(EDGE) or t for t in run]
            gaps, at = set(), 0
            for t in parts:
                gaps.add(at)
                at += len(t)
            joined = "".join(parts)
            found = set(restore(joined, self.source, gaps - {0}).split(" "))
            if all(len(t) == 1 for t in parts):
                found.add(restore(joined, self.source))
            words = self.remember(key, tuple(found - {""}))
        return words


def features(words) -> set[str]:
    out = set()
    for w in words:
        if len(w) > 2:
            out.add(w)
        for n in (4, 5, 6):
            if len(w) >= n:
                out.add("^" + w[:n])
    return out


def labelled_texts(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, y: distinct texts of the bounded sample of training labels."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (id_remainder(4) != 2))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("y"))
    taken = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` pairs of numbers: a proven bound for the broadcast
    local = docs.sparkSession.createDataFrame([(int(r[0]), int(r[1])) for r in taken.collect()], "doc_id long, y int")
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(local), "doc_id")
    return written(known.groupBy(F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text"), F.max("y").alias("y")), "labelled")


def clean(token: str) -> str:
    """The word of a token that is not disguised, or nothing."""
    if not token.isalpha():
        token = token.strip(EDGE)
        if not WORD.fullmatch(token):
            return ""
    return "" if RUN.search(token) else token


def count_trigrams(docs: DataFrame) -> dict[str, int]:
    """Counts of trigrams, pairs and letters over the distinct clean words of
    every text.  Tasks count words; their letters are counted once per distinct
    word, by built-in expressions."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words: Counter = Counter()
            for token, n in held.items():
                if w := clean(token):
                    words[w] += n
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["w", "n"])

        for b in slices(batches):
            for text in b.column("text").to_pylist():
                tokens = text.lower().split()
                # the parts of a spaced spelling are no words
                held.update(set(tokens).difference(*spaced(tokens)))
            if len(held) > HELD:
                yield flush()
        yield flush()

    words = docs.select(text_or_empty().alias("text")).mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    whole = F.concat(F.lit("^^"), F.col("w"), F.lit("$"))
    ends = words.select("n", whole.alias("w"), F.explode(F.sequence(F.lit(3), F.length("w") + 3)).alias("end"))
    grams = F.explode(F.array(*[F.substring("w", F.col("end") - k, F.lit(k + 1)) for k in range(3)]))
    counted = ends.select("n", grams.alias("t")).groupBy("t").agg(F.sum("n").alias("n"))
    counted = written(counted, "letters")
    grams: dict[str, int] = {}
    for k in (1, 2, 3):  # all letters: Unicode has some 140,000
        part = counted.filter(F.length("t") == k)
        part = part if k == 1 else part.orderBy(F.desc("n"), "t").limit(MAX_TRIGRAMS)
        grams.update((r["t"], r["n"]) for r in part.collect())
    return grams


def pick_features(texts: DataFrame, trigrams: dict[str, int], n1: int, n0: int) -> list[str]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held = Deobfuscator(Source(trigrams)), {0: Counter(), 1: Counter()}
        for b in slices(batches):
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                held[y].update(features(reader.words(text)))
        names = list(held[0].keys() | held[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([held[y][f] for f in names], pa.int64()) for y in (1, 0)]], names=["f", "a", "b"]
        )

    counted = texts.select("text", "y").mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # G statistic of a feature in a of n1 toxic and b of n0 other texts
    n = n1 + n0
    term = lambda seen, share, group: F.when(seen > 0, 2 * seen * F.log(seen * F.lit(float(n)) / (share * F.lit(float(group))))).otherwise(0.0)
    a, b = F.col("a"), F.col("b")
    g = term(a, a + b, n1) + term(b, a + b, n0) + term(n1 - a, n - a - b, n1) + term(n0 - b, n - a - b, n0)
    toxic = (a >= LEAST_TOXIC) & (a / (a + b) >= 1.5 * n1 / n)
    best = counted.filter(toxic).withColumn("g", g).filter(F.col("g") >= LEAST_G)
    return [r["f"] for r in best.orderBy(F.desc("g"), "f").limit(MAX_FEATURES).collect()]


def sample_hits(texts: DataFrame, trigrams: dict[str, int], picked: list[str]) -> list[tuple[int, list[int]]]:
    """(y, places of the picked features) of every sample text."""
    place = {f: i for i, f in enumerate(picked)}

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Deobfuscator(Source(trigrams))
        for b in slices(batches):
            found = [sorted(place[f] for f in features(reader.words(t)) if f in place) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("digest"), b.column("y"), pa.array(found, pa.list_(pa.int32()))], names=["digest", "y", "hits"])

    rows = texts.select("digest", F.col("y").cast("int").alias("y"), "text").mapInArrow(hit, "digest string, y int, hits array<int>")
    return [(r["y"], list(r["hits"])) for r in sorted(rows.collect(), key=lambda r: r["digest"])]


def fit(hits: list[tuple[int, list[int]]], n_features: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by full-batch gradient steps (Adam)."""
    y = np.array([t for t, _ in hits], float)
    row = np.repeat(np.arange(len(hits)), [len(h) for _, h in hits])
    col = np.array([i for _, h in hits for i in h], np.int64)
    w, first, second = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    w[-1] = -2.0
    for k in range(1, STEPS + 1):
        z = w[-1] + np.bincount(row, w[col], len(y))
        d = (1 / (1 + np.exp(-z)) - y) / len(y)
        grad = np.append(np.bincount(col, d[row], n_features) + RIDGE * w[:-1] / len(y), d.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        w -= 0.1 * first / (1 - 0.9**k) / (np.sqrt(second / (1 - 0.99**k)) + 1e-9)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The model: plain values, at most MAX_FEATURES + 2 * MAX_TRIGRAMS entries and the letters."""
    texts = labelled_texts(docs, labels, sample)
    groups = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = groups.get(1, 0), groups.get(0, 0)
    if not n1 or not n0:
        return {"trigrams": {}, "weights": {}, "bias": 50.0 if n1 else -50.0}
    trigrams = count_trigrams(docs)
    picked = pick_features(texts, trigrams, n1, n0)
    weights, bias = fit(sample_hits(texts, trigrams, picked), len(picked))
    return {"trigrams": trigrams, "weights": dict(zip(picked, weights.tolist(), strict=True)), "bias": bias}


def scorer(model: dict):
    """text -> probability of being toxic."""
    reader = Deobfuscator(Source(model["trigrams"]))
    weights, bias = model["weights"], model["bias"]
    # whatever a word can hit begins with its first four letters, or is a word of three
    by_head: dict[str, list[tuple[str, str]]] = {}
    for f in weights:
        start = f.removeprefix("^")
        by_head.setdefault(start[:4], []).append((start, f))
    heads = by_head.keys()

    def score(text: str | None) -> float:
        found = set()
        for w in [w for w in reader.words(text or "") if w[:4] in heads]:
            for start, f in by_head[w[:4]]:
                if w.startswith(start) and (f[0] == "^" or w == f):
                    found.add(f)
        z = bias + sum(sorted(weights[f] for f in found))
        return 1 / (1 + math.exp(-min(max(z, -50.0), 50.0)))

    return score


def toxicity(docs: DataFrame, model: dict, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    shipped, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = worker_memory("toxicity", key, lambda: scorer(shipped.value))
        for b in slices(batches):
            got = pa.array([score(t) for t in b.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), got], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    shipped, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = worker_memory("toxicity", key, lambda: scorer(shipped.value))
        for b in slices(batches):
            yield b.filter(pa.array([score(t) < threshold for t in b.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return toxicity(docs, model, id_remainder(4) == 2)
