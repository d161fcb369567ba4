"""External induced suffix sorting with common-prefix values.

A text is a sequence of symbols in which every 0 ends a string and counts as a symbol
of its own, smaller than all others and ordered by position.  Suffixes that rise
towards their next symbol are S, the others L; an S after an L starts an LMS piece.

1. LMS pieces are named by their order.  The names in text order form a shorter text;
   it is sorted by recursion, or in memory once it is short.
2. From the sorted LMS suffixes the L suffixes are induced in rising, then the S
   suffixes in falling order.  A scanned suffix sends the one before it to the queue of
   its first symbol.  Scans go in rank order, so a queue per symbol, first in first out,
   is a priority queue by (symbol, rank).
3. Entries carry the length of the common prefix with the entry before them: one more
   than the least value between the two suffixes that sent them, up to ``cap``.

Queues and sorted runs are held in a bank that goes to disk beyond ``memory`` bytes.
"""

from __future__ import annotations

import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

#: Entries worked on at once, and names sorted in memory rather than by recursion.
CHUNK, IN_MEMORY = 1 << 18, 1 << 22


class Bank:
    """Append-only runs of (position, common prefix) per symbol, on disk beyond ``memory``."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.runs: dict[int, deque] = {}
        self.file = None

    def push(self, key: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        for a in range(0, pos.size, CHUNK):
            block = (pos[a: a + CHUNK].copy(), lcp[a: a + CHUNK].copy())
            self.runs.setdefault(key, deque()).append(block)
            self.held += block[0].nbytes + block[1].nbytes
        if self.held > self.memory:
            self._spill()

    def put_first(self, key: int, pos: np.ndarray) -> None:
        block = (pos, np.zeros(pos.size, np.uint8))
        self.runs.setdefault(key, deque()).appendleft(block)
        self.held += pos.nbytes + pos.size

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for run in self.runs.values():
            for i, block in enumerate(run):
                if isinstance(block[0], np.ndarray):
                    at = self.file.tell()
                    self.file.write(block[0].tobytes())
                    self.file.write(block[1].tobytes())
                    run[i] = (at, block[0].size, block[0].dtype)
        self.held = 0

    def _load(self, block) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(block[0], np.ndarray):
            return block
        at, n, dtype = block
        self.file.seek(at)
        return (np.frombuffer(self.file.read(n * dtype.itemsize), dtype), np.frombuffer(self.file.read(n), np.uint8))

    def pop(self, key: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The oldest entries of a run, about ``CHUNK`` of them, taken out."""
        run, parts, size = self.runs.get(key), [], 0
        while run and size < CHUNK:
            block = run.popleft()
            if isinstance(block[0], np.ndarray):
                self.held -= block[0].nbytes + block[1].nbytes
            parts.append(self._load(block))
            size += parts[-1][0].size
        if not parts:
            return None
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def blocks(self, key: int, reverse: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        run = self.runs.get(key, ())
        for block in (reversed(run) if reverse else run):
            yield self._load(block)

    def drop(self, key: int) -> None:
        for block in self.runs.pop(key, ()):
            if isinstance(block[0], np.ndarray):
                self.held -= block[0].nbytes + block[1].nbytes

    def close(self) -> None:
        self.runs.clear()
        if self.file is not None:
            self.file.close()  # a temporary file is gone once closed


def rising(text: np.ndarray, zero_ends: bool) -> np.ndarray:
    """True where a suffix is S: each 0 that ends a string; the last suffix of a plain
    text is L."""
    edge = np.flatnonzero(np.append(text[1:] != text[:-1], True))  # last of each run of one symbol
    up = np.append(text[edge[:-1]] < text[edge[:-1] + 1], False)
    out = np.repeat(up, np.diff(edge, prepend=-1))
    if zero_ends:
        out[text == 0] = True
    return out


def refined(cls: np.ndarray, active: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split the classes of ``active`` by ``key``; a class's number is the rank of its
    first member.  Gives the new numbers and the sizes of their classes."""
    base = int(key.max()) + 1 if key.size else 1
    value, inverse, count = np.unique(cls[active] * base + key, return_inverse=True, return_counts=True)
    start = np.cumsum(count) - count
    old = value // base
    first = np.searchsorted(old, old)
    return (old + start - start[first])[inverse], count[inverse]


def piece_names(text: np.ndarray, s: np.ndarray, lms: np.ndarray, zero_ends: bool) -> np.ndarray:
    """Order-preserving names of the LMS pieces (each up to the next one's first symbol)."""
    size = np.diff(lms, append=text.size) + 1
    kind = np.append(text.astype(np.int64) * 2 + s + 1, 0)  # 0: the end of the text
    cls = np.zeros(lms.size, np.int64)
    key = kind[lms]
    if zero_ends:
        ends = text[lms] == 0
        key = np.where(ends, np.cumsum(ends), key + int(ends.sum()) + 1)
    active, k = np.arange(lms.size), 0
    while active.size:
        cls[active], count = refined(cls, active, key)
        k += 1
        on = (count > 1) & (size[active] > k)
        active = active[on]
        key = kind[lms[active] + k]
    return np.unique(cls, return_inverse=True)[1]


def doubled(names: np.ndarray) -> np.ndarray:
    """Suffix order of a text of names by prefix doubling, in memory."""
    n = names.size
    cls, count = refined(np.zeros(n, np.int64), np.arange(n), names)
    active, k = np.flatnonzero(count > 1), 1
    while active.size:
        ahead = active + k
        key = np.where(ahead < n, cls[np.minimum(ahead, n - 1)] + 1, 0)
        new, count = refined(cls, active, key)
        cls[active] = new
        active = active[count > 1]
        k *= 2
    return np.argsort(cls)


def common(text: np.ndarray, order: np.ndarray, cap: int, zero_ends: bool) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to ``cap``."""
    out = np.zeros(order.size, np.uint8)
    at, a, b = np.arange(1, order.size), order[:-1], order[1:]
    for k in range(cap):
        if not zero_ends:  # else a 0 stops both suffixes before the text's end
            inside = np.maximum(a, b) < text.size
            at, a, b = at[inside], a[inside], b[inside]
        x = text[a]
        same = x == text[b]
        if zero_ends:
            same &= x != 0
        at, a, b = at[same], a[same] + 1, b[same] + 1
        if not at.size:
            break
        out[at] = k + 1
    return out


class Sender:
    """Sends the suffixes before scanned ones to their queues, within one bucket."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, bank: Bank, cap: int):
        self.text, self.wanted, self.bank, self.cap = text, wanted, bank, cap

    def bucket(self) -> None:
        self.tail: dict[int, int] = {}  # least value since the last entry for a symbol

    def scan(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        before = pos - 1
        k = np.flatnonzero((pos > 0) & self.wanted[np.maximum(before, 0)])
        target = self.text[before[k]]
        order = np.argsort(target, kind="stable")
        k, target = k[order], target[order]
        first = np.flatnonzero(np.append(True, target[1:] != target[:-1])) if k.size else k
        low = self._least(lcp)
        value = np.zeros(k.size, np.int64)
        if k.size > 1:
            value[1:] = self._between(low, np.minimum(k[:-1] + 1, k[1:]), k[1:])
        whole, here = int(lcp.min()) if lcp.size else self.cap, set()
        if k.size:
            last = np.append(first[1:], k.size) - 1
            lead = self._between(low, np.zeros(first.size, np.int64), k[first])
            ends = np.where(k[last] + 1 < lcp.size, self._between(low, np.minimum(k[last] + 1, lcp.size - 1), np.full(last.size, lcp.size - 1)), self.cap)
            for t, i, j, ahead, rest in zip(target[first].tolist(), first.tolist(), last.tolist(), lead.tolist(), ends.tolist(), strict=True):
                value[i] = min(self.tail[t], ahead) if t in self.tail else 0
                self.bank.push(t, before[k[i: j + 1]], np.minimum(value[i: j + 1] + 1, self.cap).astype(np.uint8))
                here.add(t)
                self.tail[t] = rest
        for t in self.tail:
            if t not in here:
                self.tail[t] = min(self.tail[t], whole)

    def _least(self, v: np.ndarray) -> np.ndarray:
        """Least values of runs of 1, 2, 4, ... entries from each on, a row for each length."""
        out = np.empty((max(1, int(v.size).bit_length()) if self.cap else 1, v.size), v.dtype)
        out[0] = v
        for d in range(1, out.shape[0]):
            width, n = 1 << (d - 1), v.size - (1 << d) + 1
            np.minimum(out[d - 1, :n], out[d - 1, width: width + n], out=out[d, :n])
        return out

    def _between(self, low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least value at ``a..b``, both included."""
        if not self.cap:
            return np.zeros(a.size, np.int64)
        level = np.frexp((b - a + 1).astype(np.float64))[1].astype(np.int64) - 1
        row, flat = level * low.shape[1], low.ravel()
        return np.minimum(flat.take(row + a), flat.take(row + b - (1 << level) + 1)).astype(np.int64)


def _pieces(pos: np.ndarray, lcp: np.ndarray):
    for a in range(0, pos.size, CHUNK):
        yield pos[a: a + CHUNK], lcp[a: a + CHUNK]


def _run_length(text: np.ndarray, at: int, cap: int) -> int:
    part = text[at: at + cap]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if other.size else part.size


def sorted_suffixes(text: np.ndarray, cap: int = 0, memory: int = 256 << 20,
                    zero_ends: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of (first symbol, positions, common prefixes with the suffix before) in rank
    order within a first symbol, first symbols from the greatest down; the first entry of
    each symbol has value 0.  With ``zero_ends`` a 0 ends a string and the suffixes that
    begin with it are left out; else the text's own end counts as the least symbol."""
    if not text.size:
        return
    s = rising(text, zero_ends)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    names = piece_names(text, s, lms, zero_ends) if lms.size else lms
    if lms.size <= IN_MEMORY:
        order = lms[doubled(names)] if lms.size else lms
    else:
        order = lms[rank_order(names, memory)]
    lcp = common(text, order, cap, zero_ends)
    symbols = np.unique(text).tolist()
    borders = np.searchsorted(text[order], [*symbols, symbols[-1] + 1])
    queue, done = Bank(memory // 2), Bank(memory // 2)
    try:
        small = np.int32 if text.size < 1 << 31 else np.int64
        send = Sender(text, ~s, queue, cap)
        for c, a, b in zip(symbols, borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            send.bucket()
            last = None
            if not zero_ends and c == text[-1] and not s[-1]:
                # the last suffix is the least of its symbol and comes before any sent one
                queue.put_first(c, np.array([text.size - 1], small))
            while (block := queue.pop(c)) is not None:
                pos, own = block
                if last is None:
                    own = own.copy()
                    own[0] = 0
                done.push(c, pos, own)
                send.scan(pos, own)
                last = int(pos[-1])
            if b > a:
                own = lcp[a:b].copy()
                own[0] = 0 if last is None else min(_run_length(text, last, cap), _run_length(text, int(order[a]), cap)) if cap else 0
                for pos, part in _pieces(order[a:b].astype(small), own):
                    send.scan(pos, part)
        send = Sender(text, s & (text != 0) if zero_ends else s, queue, cap)
        for c in reversed(symbols):
            if zero_ends and c == 0:
                continue
            send.bucket()
            falling, last, first = [], None, True
            while (block := queue.pop(c)) is not None:
                pos, own = block
                if first:
                    own = own.copy()
                    own[0] = 0
                    first = False
                falling.append((pos, own))
                send.scan(pos, own)
                last = int(pos[-1])
            ahead = None
            border = 0
            for pos, own in done.blocks(c, reverse=True):
                if ahead is None:
                    border = min(_run_length(text, last, cap), _run_length(text, int(pos[-1]), cap)) if last is not None and cap else 0
                    ahead = border
                send.scan(pos[::-1], np.append(ahead, own[:0:-1]).astype(np.uint8))
                ahead = int(own[0])
            for pos, own in done.blocks(c):
                yield c, pos, own
            done.drop(c)
            # S suffixes were found from the greatest down
            ahead = border
            for i in range(len(falling) - 1, -1, -1):
                pos, own = falling[i]
                yield c, pos[::-1], np.append(ahead, own[:0:-1]).astype(np.uint8)
                ahead = int(own[0])
    finally:
        queue.close()
        done.close()


def rank_order(text: np.ndarray, memory: int) -> np.ndarray:
    """Suffix order of a plain text, by recursion."""
    by_symbol: list[list[np.ndarray]] = []
    held = None
    for c, pos, _ in sorted_suffixes(text, 0, memory):
        if c != held:
            by_symbol.append([])
            held = c
        by_symbol[-1].append(pos)
    return np.concatenate([pos for blocks in reversed(by_symbol) for pos in blocks])
