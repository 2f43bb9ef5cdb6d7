"""Token counts by prefix dynamic programming over a word-end BPE vocabulary.

White space always separates the tokenizer's words, so a text is cut at white
space into chunks and each distinct chunk is solved once per task.  Within a
chunk the tokenizer's own normaliser and word splitter give the words; for
each word the dynamic programme stores, for every prefix, the number of tokens
the merges give:

* ``open[i]``: tokens of the first i symbols when the word goes on,
* ``closed[i]``: tokens when the word ends there (its last symbol carries the
  word-end mark).

A sequence of tokens is what the merges produce exactly when every adjacent
pair is (each pair re-encodes to itself), so the last token of a prefix is the
one vocabulary entry that ends there and is compatible with the last token of
the prefix before it: ``count[i] = count[i - len(last)] + 1``.  Work per word
is linear in its length (times the longest token).

Stored per document (:func:`prefix_tables`): the exact count at every prefix,
by code points, also inside words, from which :func:`tokens_in_prefix` and
:func:`chars_in_budget` answer truncation and budget questions with DataFrame
functions alone.  The query keeps the last count and the place where the text
would be cut to the limit: of a text beyond the limit, the prefix counts of the
one chunk in which the limit falls are looked up.

A prefix of a chunk cuts one word; the words before it stay as they are, and
``closed`` of the cut word gives the rest.  Only three things look ahead:
contractions ("'re"; at most three characters), strings of special tokens
(ordinary text until they are complete) and combining marks that are not yet
composed (the words at the cut are then counted anew).

Edge cases: null and empty texts have 0 tokens and one prefix; the strings of special tokens
inside a text count as the library counts them by default; a chunk of any
length, and a text of any length, is processed whole, in time linear in its
length; repeated rows count alike, and of prefixes with equal counts the longest
is the cut; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, worker_memory

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
#: words and chunks remembered by a Python worker; a fuller memory is emptied (results stay the same)
REMEMBERED = 700_000
# white space of the tokenizer's \s (Unicode White_Space); the last pattern
# finds the separators that str.split() knows and \s does not
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
# composed Latin letters (whose lower case is one letter), then ASCII signs but
# the apostrophe: the normaliser and word splitter do nothing else to these
PLAIN = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]+)([!-&(-/:-@\[-`{-~]*)")
ONLY_PYTHON_SPACES = re.compile(r"[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others count up from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


BYTE_SYMBOLS = byte_symbols()


class PrefixCounter:
    """Prefix token counts for one vocabulary file (built once per task)."""

    def __init__(self, vocabulary_json: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary_json)
        model = json.loads(vocabulary_json)
        self.end = model["model"]["end_of_word_suffix"]
        merges = model["model"]["merges"]
        pairs = (m if isinstance(m, list) else m.split(" ", 1) for m in merges)
        self.rank = {tuple(p): i for i, p in enumerate(pairs)}
        whole = set(model["model"]["vocab"])
        self.split_of: dict[str, tuple[str, str]] = {}
        for left, right in self.rank:  # the first merge that makes a token is the one used
            self.split_of.setdefault(left + right, (left, right))
        single = {t for t in whole if len(t.removesuffix(self.end)) == 1}
        self.tokens = (whole & self.split_of.keys()) | single
        self.longest = max((len(t.removesuffix(self.end)) for t in self.tokens), default=1)
        self.specials = [t["content"] for t in model.get("added_tokens", [])]
        self.right_edges: dict[str, list] = {}
        self.left_edges: dict[str, list] = {}
        self.pair_ok: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}
        self.letters: dict[str, str] = {}

    def edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """The symbols that stand at one edge of a token while it is merged,
        from the single character up, each with the rank of the merge that
        takes it in (infinity for the token itself)."""
        known = (self.right_edges if side else self.left_edges).get(token)
        if known is None:
            known, node, taken = [], token, float("inf")
            while True:
                known.append((node, taken))
                parts = self.split_of.get(node)
                if parts is None:
                    break
                taken, node = self.rank[parts], parts[side]
            known.reverse()
            (self.right_edges if side else self.left_edges)[token] = known
        return known

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merges leave the border between two tokens alone: at no
        time do the symbols beside it merge before either is taken in."""
        xs, ys = self.edge(left, 1), self.edge(right, 0)
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = xs[i], ys[j]
            across = self.rank.get((x, y))
            if across is not None and across < x_taken and across <= y_taken:
                return False
            if x_taken <= y_taken:
                if i + 1 == len(xs):
                    return True
                i += 1
            else:
                j += 1

    def ends_prefix(self, last: str, token: str) -> bool:
        ok = self.pair_ok.get((last, token))
        if ok is None:
            if len(self.pair_ok) > REMEMBERED:
                self.pair_ok.clear()  # the entries are a memory only
            ok = self.pair_ok[last, token] = self.compatible(last, token)
        return ok

    def word(self, word: str, every: bool = True) -> tuple[list[int], list[int]]:
        """(open, closed) counts for every prefix length of a word, whose
        characters are the vocabulary's byte symbols.  Without ``every``, only
        the last of the closed counts is filled in."""
        n, tokens, end = len(word), self.tokens, self.end
        known, fits, longest = self.pair_ok, self.ends_prefix, self.longest
        opened, closed, last = [0] * (n + 1), [0] * (n + 1), [""] * (n + 1)
        for i in range(1, n):
            if i <= longest and word[:i] in tokens:
                opened[i], last[i] = 1, word[:i]
                continue
            for j in range(1 if i <= longest else i - longest, i):
                token = word[j:i]
                if token in tokens:
                    ok = known.get((last[j], token))
                    if fits(last[j], token) if ok is None else ok:
                        opened[i], last[i] = opened[j] + 1, token
                        break
        for i in range(1 if every else n, n + 1) if n else ():
            for j in range(max(0, i - longest), i):
                token = word[j:i] + end
                if token in tokens and (not j or fits(last[j], token)):
                    closed[i] = opened[j] + 1
                    break
        return opened, closed

    def word_total(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            if len(self.words) > REMEMBERED:
                self.words.clear()
            n = self.words[word] = self.word(word, every=False)[1][-1]
        return n

    def pieces(self, chunk: str) -> list[str]:
        plain = PLAIN.fullmatch(chunk)
        if plain:  # one word of Latin letters, perhaps a run of signs
            letters, signs = plain.groups()
            word = letters.lower()
            if not word.isascii():
                word = "".join(map(BYTE_SYMBOLS.__getitem__, word.encode()))
            return [word, signs] if signs else [word]
        normal = self.tokenizer.normalizer.normalize_str(chunk)
        return [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def chunk(self, chunk: str) -> int:
        """Tokens of a chunk without white space."""
        count = 0
        for i, part in enumerate(self.split_specials(chunk)):
            count += 1 if i % 2 else sum(map(self.word_total, self.pieces(part)))
        if len(self.chunks) > REMEMBERED:
            self.chunks.clear()
        self.chunks[chunk] = count
        return count

    def split_specials(self, chunk: str) -> list[str]:
        """Ordinary text at even places, special strings at odd ones."""
        if not any(s in chunk for s in self.specials):
            return [chunk]
        return re.split("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")", chunk)

    def split(self, text: str) -> list[str]:
        if ONLY_PYTHON_SPACES.search(text):
            return [c for c in SPACES.split(text) if c]
        return text.split()

    def count(self, text: str) -> int:
        known, total = self.chunks.get, 0
        for c in self.split(text):
            n = known(c)
            if n is None:
                n = self.chunk(c)
                known = self.chunks.get
            total += n
        return total

    def places(self, part: str, normal: str) -> list[int] | None:
        """How much of the normal text the first 1, 2, ... characters give;
        None where they are not normalised one by one."""
        if not unicodedata.is_normalized("NFC", part):
            return None
        known, out, at = self.letters, [], 0
        for c in part:
            own = known.get(c)
            if own is None:
                own = known[c] = self.tokenizer.normalizer.normalize_str(c)
            if not normal.startswith(own, at):
                return None
            at += len(own)
            out.append(at)
        return out if at == len(normal) else None

    def plain_prefixes(self, part: str) -> list[int]:
        """Tokens of part[:1], part[:2], ... of a chunk without special strings."""
        normal = self.tokenizer.normalizer.normalize_str(part)
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        counts, starts, done = [0] * (len(normal) + 1), [0], 0
        for symbols, (a, b) in split:
            starts.append(a)
            if normal[a] == "'" and b - a > 1 and normal[a + 1].isalpha():  # a contraction
                for e in range(a + 1, b + 1):
                    counts[e] = done + sum(map(self.word_total, self.pieces(normal[a:e])))
            else:
                closed, at = self.word(symbols)[1], 0
                for e in range(a, b):
                    at += len(normal[e].encode())
                    counts[e + 1] = done + closed[at]
            done = counts[b]
        places = self.places(part, normal)
        if places is not None:
            return [counts[e] for e in places]
        out = []
        for k in range(1, len(part) + 1):
            cut = self.tokenizer.normalizer.normalize_str(part[:k])
            if normal.startswith(cut):
                out.append(counts[len(cut)])
                continue
            # the last letter is another one: from the word before the cut on, anew
            same = len(commonprefix([cut, normal]))
            a = ([0, 0] + [x for x in starts if x < max(same, 1)])[-2]
            out.append(counts[a] + sum(map(self.word_total, self.pieces(cut[a:]))))
        return out

    def prefix_counts(self, chunk: str) -> list[int]:
        """Tokens of every prefix (by code points, the empty one first) of a chunk."""
        out, parts = [0], self.split_specials(chunk)
        for i in range(0, len(parts), 2):
            before = out[-1]
            if parts[i]:
                out += [before + n for n in self.plain_prefixes(parts[i])]
            if i + 1 < len(parts):
                whole = out[-1] + 1
                out += [before + n for n in self.plain_prefixes(parts[i] + parts[i + 1][:-1])[len(parts[i]) :]]
                out.append(whole)
        return out

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        """Start and end of every chunk."""
        start = 0
        for m in SPACES.finditer(text):
            if m.start() > start:
                yield start, m.start()
            start = m.end()
        if start < len(text):
            yield start, len(text)

    def prefix_table(self, text: str) -> np.ndarray:
        """Tokens of text[:0], text[:1], ... text[:n]."""
        out, total, end, known = np.zeros(len(text) + 1, np.int32), 0, 0, {}
        for a, b in self.spans(text):
            chunk = text[a:b]
            counts = known.get(chunk)
            if counts is None:
                counts = np.array(self.prefix_counts(chunk), np.int32)
                if len(chunk) < 32 and len(known) < REMEMBERED // 10:
                    known[chunk] = counts
            out[end:a] = total  # the white space between
            out[a : b + 1] = total + counts
            total, end = int(out[b]), b
        out[end:] = total
        return out

    def cut(self, text: str, budget: int) -> int:
        """The longest prefix (code points) whose tokens fit into the budget."""
        total = 0
        for a, b in self.spans(text):
            n = self.chunks.get(text[a:b])
            n = self.chunk(text[a:b]) if n is None else n
            if total + n > budget:
                counts = self.prefix_counts(text[a:b])
                return a + max(i for i, c in enumerate(counts) if total + c <= budget)
            total += n
        return len(text)


def vocabulary_text(spark: SparkSession, path: str | None = None) -> str:
    """The vocabulary file's text; it is read by the driver and shipped to the
    tasks (a fixed file of a few MB, the same at every input size)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_counts(docs: DataFrame, vocabulary_json: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and limit_chars (code points of the
    longest prefix within the limit) for every document."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary_json)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_memory("prefix counter", shipped.value, lambda: PrefixCounter(shipped.value))
        for b in slices(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            n_bytes = pa.array([len(t.encode()) for t in texts], pa.int64())
            counts = [counter.count(t) for t in texts]
            kept = [len(t) if n <= limit else counter.cut(t, limit) for t, n in zip(texts, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), n_bytes, pa.array(counts, pa.int64()), pa.array(kept, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "limit_chars"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, limit_chars long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "limit_chars")


def prefix_tables(docs: DataFrame, vocabulary_json: str) -> DataFrame:
    """doc_id, counts: the tokens of every prefix of every document, the empty
    one first.  One text at a time is held beside its counts."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary_json)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_memory("prefix counter", shipped.value, lambda: PrefixCounter(shipped.value))
        for b in slices(batches, 1):
            table = pa.array(counter.prefix_table(b.column("text")[0].as_py() or ""))
            counts = pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), counts], names=["doc_id", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(build, "doc_id long, counts array<int>")


def tokens_in_prefix(length: int) -> Column:
    """Over a prefix table: tokens of the first ``length`` characters (of the
    whole text, where it is shorter); nothing is encoded."""
    return F.element_at("counts", F.least(F.lit(length + 1), F.size("counts")))


def chars_in_budget(budget: int) -> Column:
    """Over a prefix table: characters of the longest prefix within ``budget``
    tokens; nothing is encoded."""
    return F.array_max(F.transform("counts", lambda c, i: F.when(c <= budget, i)))


def counted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_text(spark))
