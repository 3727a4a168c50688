"""Byte-pair merging of many words at once with flat numpy arrays.

All words lie behind each other in one symbol array. A round finds the best (lowest) pair rank of every word
by a segmented minimum, merges its occurrences from the left, and closes the gaps. Words without a pair leave.

This equals merging one pair at a time (lowest rank, leftmost first): further occurrences of the word's best
pair come next anyway, unless a merge makes a pair that ranks as good or better. In that case only the leftmost
occurrence is merged in the round.
"""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)


class PairTable:
    """Which adjacent symbols merge: rank (lower first) by (left, right), and the product by rank."""

    def __init__(self, left, right, rank, product_of_rank, symbols: int):
        self.base = np.int64(symbols)
        keys = np.asarray(left, np.int64) * self.base + np.asarray(right, np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(2**62))
        self.rank = np.append(np.asarray(rank, np.int32)[order], NONE)
        self.product = np.asarray(product_of_rank, np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.rank[at], NONE)


def merge_rounds(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols of all words behind each other, and the number each word has left.

    ``lengths`` are the words' symbol counts; words without symbols stay empty.
    """
    words = len(lengths)
    sym = symbols.astype(np.int32, copy=True)
    word = np.repeat(np.arange(words, dtype=np.int32), lengths)
    if not sym.size:
        return sym, np.zeros(words, np.int64)
    rank = np.full(sym.size, NONE, np.int32)
    inner = np.flatnonzero(word[1:] == word[:-1])
    rank[inner] = table.ranks(sym[inner], sym[inner + 1])
    ended_words, ended_symbols = [], []
    while sym.size:
        starts = np.append(0, np.flatnonzero(word[1:] != word[:-1]) + 1)
        sizes = np.diff(np.append(starts, sym.size))
        best = np.minimum.reduceat(rank, starts)
        ended = best == NONE
        if ended.any():
            gone = np.repeat(ended, sizes)
            ended_words.append(word[gone])
            ended_symbols.append(sym[gone])
            if ended.all():
                break
            stay = ~gone
            sym, word, rank = sym[stay], word[stay], rank[stay]
            best, sizes = best[~ended], sizes[~ended]
        pos = _leftmost(np.flatnonzero(rank == np.repeat(best, sizes)))
        pos = _undisturbed(pos, sym, word, rank, table)
        sym[pos] = table.product[rank[pos]]
        stay = np.ones(sym.size, bool)
        stay[pos + 1] = False
        sym, word, rank = sym[stay], word[stay], rank[stay]
        pos = pos - np.arange(pos.size)
        near = np.concatenate([pos, pos[pos > 0] - 1])
        rank[near] = NONE
        near = near[near + 1 < sym.size]
        near = near[word[near] == word[near + 1]]
        rank[near] = table.ranks(sym[near], sym[near + 1])
    word, sym = np.concatenate(ended_words), np.concatenate(ended_symbols)
    return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=words)


def _leftmost(pos: np.ndarray) -> np.ndarray:
    """Of overlapping occurrences (consecutive positions) every second, from the left."""
    if pos.size < 2:
        return pos
    step = np.arange(pos.size)
    first = np.append(True, np.diff(pos) != 1)
    return pos[(step - np.maximum.accumulate(np.where(first, step, 0))) % 2 == 0]


def _undisturbed(pos, sym, word, rank, table) -> np.ndarray:
    """All positions of a word, or its first alone where a merge makes a pair that ranks as good or better."""
    own = word[pos]
    again = own[1:] == own[:-1]
    if not again.any():
        return pos
    several = np.append(again, False) | np.append(False, again)
    p = pos[several]
    made, limit = table.product[rank[p]], rank[p]
    before, after = p - 1, p + 2
    has_left = (before >= 0) & (word[np.maximum(before, 0)] == word[p])
    left = np.where(np.append(False, np.diff(p) == 2) & has_left, made, sym[np.maximum(before, 0)])
    last = sym.size - 1
    has_right = (after <= last) & (word[np.minimum(after, last)] == word[p])
    right = sym[np.minimum(after, last)]
    bad = has_left & (table.ranks(left, made) <= limit) | has_right & (table.ranks(made, right) <= limit)
    if not bad.any():
        return pos
    return pos[np.append(True, ~again) | ~np.isin(own, word[p[bad]])]
