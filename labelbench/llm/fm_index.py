"""An FM-index over words: counting and locating phrases in a text by backward search.

The text is an array of symbols, some of which are ends of documents. Its suffixes are sorted by
prefix multiplying, the words before them (the Burrows-Wheeler transform) are kept in a wavelet
matrix, and every few places of the text a suffix's position is kept.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8  # every so many words of a document the position is kept


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The order of all suffixes of ``symbols``, which are not negative.

    All suffixes are sorted by their first few symbols at once; then only those that still tie, by as
    many times more, until none do.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    rank, span = symbols.astype(np.int64), 1
    open_, order, place = np.arange(n), None, None
    while True:
        bits = int(rank.max() + 1).bit_length()
        keys = np.zeros(len(open_), np.int64)
        taken = max(2, 62 // bits)
        for i in range(taken):
            at = open_ + i * span
            inside = at < n
            keys <<= bits
            keys[inside] += rank[at[inside]] + 1
        by_key = np.argsort(keys, kind="stable")
        sorted_, keys = open_[by_key], keys[by_key]
        new = np.append(True, keys[1:] != keys[:-1])
        if order is None:
            order, place = sorted_, np.arange(n)
        else:
            order[place] = sorted_  # those of one tie are behind each other and stay there
        # A suffix's rank is the place of the first one that it still ties with.
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        rank = rank if span > 1 else np.zeros(n, np.int64)
        rank[sorted_] = place[head]
        alone = new & np.append(new[1:], True)
        if alone.all():
            return order
        open_, place = sorted_[~alone], place[~alone]
        span *= taken


class WaveletMatrix:
    """Ranks of symbols below 2**bits: one packed row of bits per level, zeros before ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.rows, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            ones = ((symbols >> level) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            packed = np.append(packed, np.zeros(16 - len(packed) % 8, np.uint8)).view(np.uint64)
            before = np.append(0, np.cumsum(np.bitwise_count(packed), dtype=np.int64))[:-1]
            self.rows.append((packed, before))
            self.zeros.append(len(symbols) - int(ones.sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        # Where each symbol's run begins in the last order.
        new = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1])[: len(symbols)])
        self.first = np.zeros(1 << bits, np.int64)
        self.first[symbols[new]] = new

    def _ones(self, row: int, at: np.ndarray) -> np.ndarray:
        packed, before = self.rows[row]
        word = at >> 6
        low = packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return before[word] + np.bitwise_count(low)

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is before the position beside it."""
        for row in range(self.bits):
            ones = self._ones(row, at)
            high = (symbols >> (self.bits - 1 - row)) & 1
            at = np.where(high, self.zeros[row] + ones, at - ones)
        return at - self.first[symbols]

    def read(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the symbols at these positions, how often each is before)."""
        symbols = np.zeros(len(at), np.int64)
        for row in range(self.bits):
            ones = self._ones(row, at)
            packed, _ = self.rows[row]
            high = ((packed[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            symbols = symbols << 1 | high
            at = np.where(high, self.zeros[row] + ones, at - ones)
        return symbols, at - self.first[symbols]


class FMIndex:
    """The documents of one shard, as the hashes of their words.

    ``owner`` is the document of each word, not descending; ``count`` is the number of documents.
    Positions are places in the text where each document is followed by one end.
    """

    def __init__(self, owner: np.ndarray, words: np.ndarray, count: int):
        self.words, inverse = np.unique(words, return_inverse=True)
        n = len(words) + count
        at = np.arange(len(words)) + owner
        ends = np.bincount(owner, minlength=count).cumsum() + np.arange(count)
        # Ends sort before words and by their place, so copies of a document part at their ends.
        ordered = np.empty(n, np.int64)
        ordered[ends], ordered[at] = np.arange(count), inverse + count
        order = suffix_array(ordered)
        symbols = np.zeros(n, np.int64)  # all ends are one symbol, 0
        symbols[at] = inverse + 1
        self.bits = max(1, int(len(self.words)).bit_length())
        self.matrix = WaveletMatrix(symbols[order - 1], self.bits)
        counts = np.bincount(symbols, minlength=len(self.words) + 2)
        self.start = np.append(0, np.cumsum(counts))
        self.text_start = np.append(0, ends[:-1] + 1)[:count]
        self.ends = ends
        inside = order - self.text_start[np.searchsorted(ends, order)] if n else order
        kept = inside % SAMPLE == 0
        self.kept = np.append(0, np.cumsum(kept))
        self.positions = order[kept]

    def symbols_of(self, words: np.ndarray) -> np.ndarray:
        """The symbol of each word's hash; 0 where no document has the word."""
        if not len(self.words):
            return np.zeros(words.shape, np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1, 0)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, last) row of the suffixes that begin with each phrase, last excluded. ``phrases``
        has one row of hashes per phrase."""
        found = self.symbols_of(phrases)
        low, high = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        here = np.flatnonzero((found > 0).all(axis=1))
        if len(here):
            symbol = found[here, -1]
            low[here], high[here] = self.start[symbol], self.start[symbol + 1]
        for column in range(found.shape[1] - 2, -1, -1):
            here = here[low[here] < high[here]]
            symbol = found[here, column]
            for bound in (low, high):
                bound[here] = self.start[symbol] + self.matrix.rank(symbol, bound[here])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position in the text of each row's suffix: back to the next kept position."""
        found, steps = np.zeros(len(rows), np.int64), 0
        left, rows = np.arange(len(rows)), rows.copy()
        while len(left):
            is_kept = self.kept[rows + 1] > self.kept[rows]
            found[left[is_kept]] = self.positions[self.kept[rows[is_kept]]] + steps
            left, rows = left[~is_kept], rows[~is_kept]
            symbol, rank = self.matrix.read(rows)
            rows = self.start[symbol] + rank
            steps += 1
        return found

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, positions)
