"""Similarity links among sets of 64-bit tokens, found by walking a prefix tree of the sets."""

from __future__ import annotations

import numpy as np


class PrefixTree:
    """Sets under a common order of tokens; shared beginnings share nodes and partial overlaps.

    Sets are ranked by their tokens in descending order, so those below a node are a range of ranks, and
    their first differences say where nodes branch. Tokens of one set only cannot be shared and are not
    in the tree, though they count in sizes. A component is named by its smallest member.
    """

    def __init__(self, sets: list[np.ndarray], labels: list, percent: int):
        """``sets`` hold tokens in ascending order. Those of equal label are one component."""
        self.percent, n = percent, len(sets)
        sizes = np.array([len(tokens) for tokens in sets], np.int64)
        _, numbers, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        several = holders > 1
        held = several[numbers]
        numbers = (np.cumsum(several, dtype=np.int32) - 1)[numbers[held]]
        member = np.repeat(np.arange(n, dtype=np.int32), sizes)[held]
        lengths = np.bincount(member, minlength=n)
        paths = [path[::-1] for path in np.split(numbers, np.cumsum(lengths)[:-1])]
        bytewise = [path.astype(">u4").tobytes() for path in paths]
        self.order = np.array(sorted(range(n), key=bytewise.__getitem__))
        known: dict = {}
        first = np.array([known.setdefault(label, i) for i, label in enumerate(labels)])
        # By rank from here on.
        self.paths = [paths[i] for i in self.order]
        self.sizes, self.lengths, self.component = sizes[self.order], lengths[self.order], first[self.order]
        self.same = np.zeros(n, np.int64)  # tokens that a path shares with the one before
        for rank in range(1, n):
            span = min(self.lengths[rank - 1], self.lengths[rank])
            differs = self.paths[rank - 1][:span] != self.paths[rank][:span]
            place = int(differs.argmax()) if span else 0
            self.same[rank] = place if span and differs[place] else span
        # The ranks that hold a token, ascending, are a stretch of ``holders``.
        rank_of = np.argsort(self.order).astype(np.int32)[member]
        self.holders = rank_of[np.lexsort((rank_of, numbers))]
        held_by = holders[several]
        self.after = np.cumsum(held_by)
        self.start = self.after - held_by

    def _shared(self, tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each rank holds that the walk has not passed."""
        start, after = self.start[tokens], self.after[tokens]
        count = after - start
        places = np.repeat(after - np.cumsum(count), count) + np.arange(count.sum())
        return np.bincount(self.holders[places], minlength=len(self.paths))

    def _join(self, ranks: np.ndarray) -> None:
        found = np.unique(self.component[ranks])
        if len(found) > 1:
            self.component[np.isin(self.component, found)] = found[0]

    def walk(self) -> np.ndarray:
        """The component of each set, in the order given, once all similar sets are joined.

        Every node is reached once, from left to right, together with all later sets that may be similar
        to one below it and are not in the one component of those. Similar means
        100 * overlap >= percent * union, so (100 + percent) * overlap >= percent * (both sizes).
        """
        n, percent, whole = len(self.paths), self.percent, 100 + self.percent
        passed = 0
        stack = [(0, n, 0, np.arange(n), np.zeros(n, np.int64))]
        while stack:
            low, high, depth, others, overlap = stack.pop()
            while passed < low:
                self.start[self.paths[passed]] += 1
                passed += 1
            keep = others > low
            if (self.component[low:high] == self.component[low]).all():
                keep &= self.component[others] != self.component[low]
            others, overlap = others[keep], overlap[keep]
            if not len(others):
                continue
            # Where the sets below part, or the only one ends.
            reached = int(self.same[low + 1 : high].min() if high > low + 1 else self.lengths[low])
            if reached > depth:
                overlap = overlap + self._shared(self.paths[low][depth:reached])[others]
            # Even if all that is left below were shared:
            left = self.lengths[low:high].max() - reached
            keep = whole * (overlap + left) >= percent * (self.sizes[others] + self.sizes[low:high].min())
            others, overlap = others[keep], overlap[keep]
            if not len(others):
                continue
            rest = low
            while rest < high and self.lengths[rest] == reached:
                similar = whole * overlap >= percent * (self.sizes[others] + self.sizes[rest])
                self._join(np.append(others[similar], rest))
                rest += 1
            if rest < high:
                branches = rest + 1 + np.flatnonzero(self.same[rest + 1 : high] == reached)
                bounds = [rest, *branches.tolist(), high]
                for a, b in zip(bounds[-2::-1], bounds[:0:-1]):
                    stack.append((a, b, reached, others, overlap))
        found = np.empty(n, np.int64)
        found[self.order] = self.component
        return found


def linked(sets: list[np.ndarray], labels: list, percent: int) -> list[int]:
    """The component of each set, as the index of its first member.

    ``sets`` hold tokens in ascending global order. Sets of equal label are one component from the
    start and are not compared.
    """
    return PrefixTree(sets, labels, percent).walk().tolist()
