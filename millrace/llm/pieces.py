"""Splits texts into the pieces that byte-level vocabularies merge within, by whole arrays, and joins the ids of pieces to those of texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex

from .common import Spans, text_buffers

#: The split pattern that is done by whole arrays; any other goes through the regex module.
COMMON = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, NUMBER, BLANK, OTHER = range(4)
_tables: dict[str, np.ndarray] = {}


def _classes() -> np.ndarray:
    """The class of every code point, as the regex module sees it."""
    if "classes" not in _tables:
        every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "!" for c in range(0x110000))
        table = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
            for m in regex.finditer(pattern, every):
                table[m.start() : m.end()] = kind
        _tables["classes"] = table
    return _tables["classes"]


def split_common(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of COMMON begin, in texts of code points between bounds (n + 1); each text begins one unless empty.

    A piece is a run of one class, with these changes: of a run of blanks before anything else in its text the last one
    goes with what follows if it is a space, and stands alone if it is another blank; an apostrophe alone between other
    classes takes the letters of a contraction from the run behind it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    edge = np.empty(n, bool)
    edge[0], edge[1:] = True, kind[1:] != kind[:-1]
    text_start = np.zeros(n + 1, bool)
    text_start[bounds] = True
    edge |= text_start[:n]
    start = np.flatnonzero(edge)
    end = np.append(start[1:], n)
    run = kind[start]
    blank = (run == BLANK) & ~text_start[end]  # followed by something in the same text
    last = end - 1
    space = np.zeros(len(start), bool)
    space[blank] = points[last[blank]] == 32
    edge[last[blank]] = True  # the last blank begins a piece: with what follows, or alone
    edge[end[space]] = False  # what follows a space is of the space's piece
    joined = np.zeros(len(start), bool)
    joined[1:] = space[:-1]
    quote = np.flatnonzero((run == OTHER) & (end - start == 1) & (points[start] == 39) & ~joined & ~text_start[end])
    quote = quote[kind[end[quote]] == LETTER]
    if len(quote):
        a = end[quote]
        stop = end[quote + 1]  # of the letters
        one = np.isin(points[a], [ord(c) for c in "stmd"])
        follow = np.where(a + 1 < stop, points[np.minimum(a + 1, n - 1)], 0)
        two = np.zeros(len(a), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (points[a] == ord(x)) & (follow == ord(y))
        taken = np.where(one, 1, np.where(two, 2, 0))
        some = taken > 0
        edge[a[some]] = False
        after = (a + taken)[some & (a + taken < stop)]
        edge[after] = True
    return np.flatnonzero(edge)


class PieceIds:
    """Ids of texts from ids of pieces. encode gives the ids of new pieces, one after another, and their numbers.

    Known pieces are found by hash and then compared byte by byte, in a text as in memory, so that a hash never decides. A piece that
    shares its hash with another one is encoded anew in every slice. When `most` pieces are known the memory starts anew.
    """

    def __init__(self, pattern: str, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 1_500_000):
        self.find = regex.compile(pattern).findall
        self.common, self.encode, self.most = pattern == COMMON, encode, most
        self.forget()

    def forget(self) -> None:
        self.hash, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # of indexed pieces, in order of hash
        self.bounds, self.text_bounds = np.zeros(1 << 10, np.int32), np.zeros(1 << 10, np.int32)  # of each slot's ids and bytes
        self.pool, self.text, self.slots = np.zeros(1 << 16, np.uint32), Spans(np.zeros(1 << 16, np.uint8)), 0

    def take_up(self, pieces: list[str], data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """New slots with the ids and bytes of pieces."""
        ids = self.encode(pieces)
        first = self.slots
        self.slots += len(pieces)

        def put(values: np.ndarray, ends: np.ndarray, new: np.ndarray, sizes: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray]:
            ends = room(ends, first + 1, len(sizes))
            at = int(ends[first])
            values = room(values, at, len(new) + spare)
            values[at : at + len(new)] = new
            ends[first + 1 : self.slots + 1] = at + np.cumsum(sizes)
            return values, ends

        self.pool, self.bounds = put(self.pool, self.bounds, *ids, 0)
        self.text.data, self.text_bounds = put(self.text.data, self.text_bounds, data, sizes, 8)
        return np.arange(first, self.slots, dtype=np.int32)

    def known(self, h: np.ndarray, spans: Spans, start: np.ndarray, end: np.ndarray, parts: Callable[[np.ndarray], tuple[list[str], np.ndarray, np.ndarray]]) -> np.ndarray:
        """Slots of pieces of distinct hashes, given in order of hash. parts: pieces by their numbers, as texts, and as joined bytes with sizes."""
        at = np.searchsorted(self.hash, h)
        there = np.flatnonzero(at < len(self.hash))
        there = there[self.hash[at[there]] == h[there]]
        slot = np.full(len(h), -1, np.int32)
        own = self.slot[at[there]]
        same = spans.same(start[there], end[there], self.text, self.text_bounds[own].astype(np.int64), self.text_bounds[own + 1].astype(np.int64))
        slot[there[same]] = own[same]
        new = np.flatnonzero(slot < 0)
        if len(new):
            slot[new] = self.take_up(*parts(new))
            index = np.setdiff1d(new, there, assume_unique=True)  # a hash that is taken stays with the piece that has it
            self.hash, self.slot = np.insert(self.hash, at[index], h[index]), np.insert(self.slot, at[index], slot[index])
        return slot

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after another, and where each text's begin (n + 1). Null counts as empty."""
        data, offsets = text_buffers(column)
        data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        whole = data.tobytes().decode()
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # where characters begin
        chars = np.searchsorted(lead, offsets)  # bounds of texts in characters
        if self.common:
            start = split_common(np.frombuffer(whole.encode("utf-32-le"), "<u4"), chars)
        else:
            sizes = [len(p) for a, b in zip(chars[:-1], chars[1:], strict=True) for p in self.find(whole[a:b])]
            start = np.cumsum([0, *sizes])[:-1]
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.slots >= self.most:
            self.forget()
        spans, bounds = Spans(data), np.append(lead[start], len(data))
        a, b = bounds[:-1], bounds[1:]
        ends = np.append(start, len(lead))

        def parts(k: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
            size = b[k] - a[k]
            return [whole[i:j] for i, j in zip(ends[k].tolist(), ends[k + 1].tolist(), strict=True)], data[runs(a[k], size)], size

        h, back = np.unique(spans.hashes(a, b), return_inverse=True)
        one = np.zeros(len(h), np.int64)  # a piece of each hash
        one[back] = np.arange(len(back))
        slot = self.known(h, spans, a[one], b[one], lambda k: parts(one[k]))[back]
        like = one[back]
        odd = np.flatnonzero(~spans.same(a, b, spans, a[like], b[like]))
        if len(odd):
            slot[odd] = self.take_up(*parts(odd))
        begin = self.bounds[slot]
        size = self.bounds[slot + 1] - begin
        stop = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=stop[1:])
        return self.pool[runs(begin, size)], stop[np.searchsorted(start, chars)]


def runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of runs that begin at `begin`, one run after another."""
    stop = np.cumsum(size, dtype=np.int64)
    out = np.repeat(begin - (stop - size), size)
    out += np.arange(len(out))
    return out


def room(values: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, at twice the size or more if so many entries don't fit behind the used ones."""
    if used + more <= len(values):
        return values
    out = np.zeros(max(2 * len(values), used + more), values.dtype)
    out[:used] = values[:used]
    return out
