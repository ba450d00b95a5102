"""Byte-pair merges of many words at once, in numpy.

The symbols of all words stand in one flat array. A round finds every adjacent
pair's rank by binary search over the sorted pair keys, takes the lowest rank
of each word, and merges all its occurrences there, left to right. Words with
nothing left to merge leave the array. That equals merging one pair at a time
as long as no pair ranks before the merge that made one of its symbols; the
table checks this, and merges only the leftmost occurrence in a round if it
does not hold.
"""

from __future__ import annotations

import numpy as np

from tidemill.llm.common import ragged

NONE = np.int64(1 << 40)


class MergeTable:
    """Pairs (left, right) -> (rank, merged symbol), in arrays sorted by pair key."""

    def __init__(self, left, right, rank, merged):
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        rank, merged = np.asarray(rank, np.int64), np.asarray(merged, np.int64)
        self.base = int(max([0, *left, *right, *merged])) + 1
        keys = left * self.base + right
        order = np.argsort(keys)
        self.keys, self.rank, self.merged = keys[order], rank[order], merged[order]
        made = np.full(self.base, -1)
        np.maximum.at(made, merged, rank)
        self.monotone = bool(np.all(rank > np.maximum(made[left], made[right])))

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NONE where the pair never merges."""
        if not len(self.keys):
            return np.full(len(left), NONE), np.zeros(len(left), np.int64)
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0) & (right < self.base)
        return np.where(hit, self.rank[at], NONE), self.merged[at]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge words to the end. ``lengths`` are at least 1; negative symbols never merge."""
        symbols, lengths = np.asarray(symbols, np.int64), np.asarray(lengths, np.int64)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        word = np.arange(len(lengths))
        if len(symbols):
            rank, into = self.find(symbols, np.append(symbols[1:], -1))
        while len(word):
            ends = np.cumsum(lengths)
            starts = ends - lengths
            rank[ends - 1] = NONE
            low = np.minimum.reduceat(rank, starts)
            idle = low == NONE
            if idle.any():
                gone = np.repeat(idle, lengths)
                out.append((word[idle], symbols[gone], lengths[idle]))
                symbols, rank, into = symbols[~gone], rank[~gone], into[~gone]
                word, lengths, low = word[~idle], lengths[~idle], low[~idle]
                if not len(word):
                    break
                starts = np.cumsum(lengths) - lengths
            chosen = np.flatnonzero(rank == np.repeat(low, lengths))
            owner = np.searchsorted(starts, chosen, side="right") - 1
            if self.monotone:  # of touching occurrences (a a a) every second one
                fresh = np.r_[True, (np.diff(chosen) != 1)]
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(chosen)), 0))
                take = (np.arange(len(chosen)) - run) % 2 == 0
            else:
                take = np.r_[True, np.diff(owner) != 0]
            chosen, owner = chosen[take], owner[take]
            symbols[chosen] = into[chosen]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            shift = np.cumsum(keep) - 1
            symbols, rank, into = symbols[keep], rank[keep], into[keep]
            lengths = lengths - np.bincount(owner, minlength=len(lengths))
            touched = np.zeros(len(symbols), bool)
            touched[shift[chosen]] = touched[np.maximum(shift[chosen] - 1, 0)] = True
            new = np.flatnonzero(touched)
            rank[new], into[new] = self.find(symbols[new], np.append(symbols, -1)[new + 1])
        words = np.concatenate([o[0] for o in out]) if out else np.zeros(0, np.int64)
        counts = np.concatenate([o[2] for o in out]) if out else words
        flat = np.concatenate([o[1] for o in out]) if out else words
        order = np.argsort(words)
        starts = np.cumsum(counts) - counts
        return flat[ragged(starts[order], counts[order])], counts[order]
