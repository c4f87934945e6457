"""Merges of a byte-level BPE vocabulary with word ends, applied to many words side by side.

Words of one length are the rows of a matrix. In each step every row joins its pair of least rank, the
first of equals, until no row has a pair to join, as the merges of one word after the other would.
"""

from __future__ import annotations

from string import punctuation

import numpy as np

#: Character that stands for a byte in byte-level vocabularies.
SHOWN = {b: chr(b) for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
SHOWN |= {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in SHOWN)}
#: Longest word in bytes that goes through the matrix.
LONGEST = 48
_NONE = np.int32(2**31 - 1)
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[list(punctuation.encode())] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Merges:
    def __init__(self, vocabulary: dict[str, int], merges: list, end: str):
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        self.inner = np.array([vocabulary[SHOWN[b]] for b in range(256)], dtype=np.int32)
        self.last = np.array([vocabulary[SHOWN[b] + end] for b in range(256)], dtype=np.int32)
        self.size = max(vocabulary.values()) + 1
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], dtype=np.int64)
        # Open addressing; free places hold -1.
        self.shift = np.uint64(64 - int(np.ceil(np.log2(8 * len(keys) + 2))))
        places = 1 << (64 - int(self.shift))
        self.keys, self.ranks, self.joined = np.full(places + 64, -1), np.full(places + 64, _NONE), np.zeros(places + 64, dtype=np.int32)
        for rank, (key, at, (a, b)) in enumerate(zip(keys.tolist(), self._at(keys).tolist(), pairs)):
            while self.keys[at] not in (-1, key):
                at += 1
            self.keys[at], self.ranks[at], self.joined[at] = key, rank, vocabulary[a + b]

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined id of each pair; _NONE and 0 where it has none."""
        keys = left.astype(np.int64) * self.size + right
        at = self._at(keys)
        found = self.keys[at]
        off = np.flatnonzero((found != keys) & (found != -1))
        while len(off):
            at[off] += 1
            found = self.keys[at[off]]
            off = off[(found != keys[off]) & (found != -1)]
        return self.ranks[at], self.joined[at]

    def _rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each row after all merges, and how many they are."""
        m, width = ids.shape
        sizes, out = np.full(m, width), ids.copy()
        if width < 2:
            return out, sizes
        rows = np.arange(m)
        ranks, joined = (x.reshape(m, width - 1) for x in self._find(ids[:, :-1].ravel(), ids[:, 1:].ravel()))
        ids = ids.copy()
        while True:
            at = ranks.argmin(axis=1)
            n = np.arange(len(rows))
            live = ranks[n, at] != _NONE
            if not live.all():
                done = ~live
                out[rows[done], : ids.shape[1]] = ids[done]
                sizes[rows[done]] = ids.shape[1]
                rows, ids, ranks, joined, at = rows[live], ids[live], ranks[live], joined[live], at[live]
                n = np.arange(len(rows))
            if not len(rows):
                return out, sizes
            ids[n, at] = joined[n, at]
            w = ids.shape[1] - 1  # all live rows have had the same number of merges
            ids = ids[np.arange(w + 1)[None, :] != at[:, None] + 1].reshape(-1, w)
            if w == 1:
                out[rows, :1], sizes[rows] = ids, 1
                return out, sizes
            keep = np.arange(w)[None, :] != at[:, None]
            ranks, joined = ranks[keep].reshape(-1, w - 1), joined[keep].reshape(-1, w - 1)
            for side in (at - 1, at):  # the two pairs around the joined one
                x = np.flatnonzero((side >= 0) & (side < w - 1))
                y = side[x]
                ranks[x, y], joined[x, y] = self._find(ids[x, y], ids[x, y + 1])

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words data[start:end] in lower case, one after the other, and each one's number."""
        sizes = ends - starts
        order = np.argsort(sizes, kind="stable")
        edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
        counts, parts = np.zeros(len(sizes), dtype=np.int64), []
        for a, b in zip(edges.tolist(), edges[1:].tolist()):
            at = order[a:b]
            raw = data[starts[at][:, None] + np.arange(sizes[at[0]])[None, :]]
            ids = self.inner[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            ids, counts[at] = self._rows(ids)
            parts.append((at, ids))
        begins = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), dtype=np.uint32)
        for at, ids in parts:
            column = np.arange(ids.shape[1])[None, :]
            there = column < counts[at][:, None]
            out[(begins[at][:, None] + column)[there]] = ids[there]
        return out, counts


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with letters of ASCII and Latin-1 in lower case."""
    out = _LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = data[after]
    up = after[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]
    out[up] += 32
    return out


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the words data[offsets[i]:offsets[i + 1]] are Latin-1 letters with ASCII punctuation after
    them, either may be missing; and the number of bytes of their letters."""
    letter, mark = _LETTER[data], _PUNCTUATION[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    lead = lead[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
    letter[lead], letter[lead + 1] = True, True

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    sizes = np.diff(offsets)
    letters = within(letter)
    back = np.zeros(len(data), dtype=bool)  # a letter after a mark
    back[1:] = letter[1:] & mark[:-1]
    inner = within(back)
    some = np.flatnonzero(sizes > 0)
    inner[some] -= back[offsets[:-1][some]]  # the byte before a word is another word's
    return (letters + within(mark) == sizes) & (inner == 0) & (sizes <= LONGEST), letters
