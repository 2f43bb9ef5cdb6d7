"""The broadcast part of the suffix tree: frequent words and hot contexts."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import repeat

import numpy as np

END = b""  # no word is empty
#: keys below this are looked up by a table of places
DENSE = 1 << 17


def words(text: str | None) -> list[bytes]:
    """The text's symbols: bytes.lower and bytes.split know ASCII only."""
    out = (text or "").encode().lower().split()
    out.append(END)
    return out


@dataclass
class Tree:
    """Frequent words and retained contexts, as shipped to the tasks."""

    ids: dict[bytes, int]  # frequent words, most frequent first
    counts: np.ndarray  # training counts by id
    n_symbols: int  # ids below this take part in contexts and pairs
    total: int
    vocabulary: int
    contexts: list[np.ndarray] = field(default_factory=list)  # by depth: sorted keys
    states: list[np.ndarray] = field(default_factory=list)  # by depth: state of each key
    parent: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    back: np.ndarray = field(default_factory=lambda: np.zeros(1))  # log10 of rest / (1 - B)
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # state * n_symbols + symbol
    pair_logp: np.ndarray = field(default_factory=lambda: np.zeros(0))
    hot: list[np.ndarray] = field(default_factory=list)  # by depth: sorted keys of all candidates, one depth more
    hot_state: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # longest state of the empty context, then of each candidate

    def base_log(self) -> np.ndarray:
        return np.log10((self.counts + 1.0) / (self.total + self.vocabulary + 1.0))

    def encode(self, tokens: list[bytes]) -> np.ndarray:
        return encoded(self.ids, tokens)


def encoded(ids: dict[bytes, int], tokens: list[bytes]) -> np.ndarray:
    """The tokens' ids, -1 for a word without one."""
    return np.fromiter(map(ids.get, tokens, repeat(-1)), np.int64, len(tokens))


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key (negative: none) in the sorted keys, -1 where
    it is absent."""
    out = np.full(len(wanted), -1, np.int64)
    if not len(keys) or not len(wanted):
        return out
    some = np.flatnonzero((wanted >= keys[0]) & (wanted <= keys[-1]))
    sought = wanted[some]
    if 0 <= keys[0] and keys[-1] < min(DENSE, 8 * len(wanted)):
        place = np.full(int(keys[-1]) + 1, -1, np.int64)
        place[keys] = np.arange(len(keys))
        out[some] = place[sought]
    else:
        at = np.searchsorted(keys, sought)
        out[some] = np.where(keys[at] == sought, at, -1)
    return out


def context_keys(ids: np.ndarray, depth: int, n_symbols: int) -> np.ndarray:
    """Key of the ``depth`` symbols before each place, -1 where there are
    fewer or one of them is not a symbol."""
    key = np.zeros(len(ids), np.int64)
    ok = np.ones(len(ids), bool)
    for back in range(depth, 0, -1):
        before = np.full(len(ids), -1, np.int64)
        before[back:] = ids[:-back] if back < len(ids) else ids[:0]
        ok &= (before >= 0) & (before < n_symbols)
        key = key * n_symbols + before
    return np.where(ok, key, -1)
