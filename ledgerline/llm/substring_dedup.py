"""Operator 6, repeated substrings across documents by external induced suffix sorting.

A byte goes when a ``SPAN``-byte string that covers it also starts in a document with a
smaller id.  The suffix order of a whole corpus is cut into shards by content:

1. Rows are stored as packs of some megabytes.  Each window of ``SPAN`` bytes belongs to
   its anchor, the first of the ``GRAM``-byte strings in it with the least hash, so equal
   windows have equal anchors wherever they are; runs of windows with one anchor are
   segments.  A segment's contexts are the strings of 33 bytes that end with its anchor and
   that begin with it: one of them is in each of its windows.
2. Buckets of anchors' hashes report which ones have a context twice.  A window without
   such a context is unique to its document.
3. Distinct segments of the reported hashes go to the bucket of their hash.  A bucket is a
   shard: its segments are suffix-sorted with common-prefix values (``induced``:
   recursive induction with disk-backed queues), and neighbours that share ``SPAN`` bytes
   form a group with the least id among its documents.
   A segment that has no context of another content is not sorted: its windows are in no
   other segment.  Segments count as equal by their bytes.
   A bucket of more than ``SORT_BYTES`` is not sorted: where a common passage begins or
   ends, one hash has another segment in every document.  Its windows are dealt on by
   their own hash, each pack sending the distinct ones with their least ids.
4. Each pack takes back one bit for each window of its segments and removes the bytes.

Only hashes, distinct segments or windows, and bits are shuffled beside the packs; a
passage that many documents share is reduced to one segment in every pack.  Nothing is
collected on the driver but the corpus size and the numbers of the oversized buckets.

Defined cases: a null text is an empty one; shorter texts than the span are kept whole;
rows with equal ids do not remove from each other; null ids count as greater than all
others; repeated rows give one result row each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import slices, stored, text_buffer, tidied, tidied_group
from ledgerline.llm.decontamination import _P, _P_INV, _powers, mixed
from ledgerline.llm.induced import sorted_suffixes

SPAN, GRAM = 50, 16
#: Bytes of text in a pack and, on average, behind a bucket.
PACK_BYTES, BUCKET_BYTES = 8 << 20, 8 << 20
#: Bytes of segments that one bucket sorts at most; they take about 30 times as much memory.
SORT_BYTES = 32 << 20
#: Bytes of a hash's segments in a pack are told as a power of this, rounded up.
_GROWTH = 1.1
#: Bytes of queues that a suffix sort holds before it goes to disk.
SORT_MEMORY = 128 << 20
_STEP = 1 << 15
_HIGH, _ODD = np.uint64(0xFFFFFFFF00000000), np.uint64(0xD6E8FEB86659FD93)
_LAST = (1 << 63) - 1

PACK = "pid long, ids binary, known binary, offsets binary, size long, data binary"


def packs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of about ``PACK_BYTES`` of text each, compressed, stored in the shared folder."""
    def pack(batches):
        import zstandard
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, limit=PACK_BYTES):
                data, offsets = text_buffer(batch.column("text"))
                ids = batch.column("id")
                known = np.array(ids.is_valid())
                yield pa.record_batch([
                    pa.array([(part << 32) | n], pa.int64()), pa.array([ids.fill_null(_LAST).to_numpy().astype("<i8").tobytes()]),
                    pa.array([known.tobytes()]), pa.array([offsets.astype("<i8").tobytes()]), pa.array([data.size], pa.int64()),
                    pa.array([zstandard.ZstdCompressor(3).compress(data.tobytes())])],
                    names=["pid", "ids", "known", "offsets", "size", "data"])
                n += 1

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(tidied(pack), PACK), "packs")


class Pack:
    """A pack's rows and, by hash order, its segments."""

    def __init__(self, row: dict, span: int, gram: int, buckets: int):
        import zstandard
        self.ids, self.known = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["known"], bool)
        self.offsets = np.frombuffer(row["offsets"], "<i8")
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=row["size"]) if row["size"] else b"", np.uint8)
        self.span = span
        self.start, self.count, h, key, left, right = windows(self.data, self.offsets, span, gram)
        ids = np.repeat(self.ids, np.diff(np.searchsorted(self.start, self.offsets)))
        # by hash, then by context; only the order rests on the mixed low half
        order = np.argsort((h & _HIGH) | (mixed(left ^ (right * _ODD)) >> np.uint64(32)))
        self.start, self.count, h = self.start[order], self.count[order], h[order] & _HIGH
        self.key, self.left, self.right = key[order], left[order], right[order]
        self.id = ids[order]
        self.first = borders(h)
        self.hash = h[self.first]
        self.bucket = bucket_of(self.hash, buckets)
        #: Where each context (hash, left and right key) begins.
        self.context = borders(h, self.left, self.right)

    def several(self) -> np.ndarray:
        """Of each hash, whether documents with different ids have a context of it here."""
        if not self.first.size:
            return np.zeros(0, bool)
        differ = np.minimum.reduceat(self.id, self.context) != np.maximum.reduceat(self.id, self.context)
        return np.logical_or.reduceat(differ, np.searchsorted(self.context, self.first))

    def sizes(self) -> np.ndarray:
        """Of each hash, the bytes of its segments here as a power."""
        if not self.first.size:
            return np.zeros(0, np.uint8)
        return size_powers(np.add.reduceat(self.count + self.span - 1, self.first), self.span)

    def share(self, flags: np.ndarray) -> None:
        """Keep the segments of flagged hashes and find the distinct ones: ``of`` segment ->
        distinct one; ``seg_start, seg_size, seg_least, seg_key, seg_left, seg_right,
        seg_bucket`` by bucket."""
        each = np.diff(np.append(self.first, self.start.size))
        on = np.repeat(flags, each)
        bucket, h = np.repeat(self.bucket, each)[on], np.repeat(self.hash, each)[on]
        self.start, self.count, self.id = self.start[on], self.count[on], self.id[on]
        size, key = self.count + self.span - 1, self.key[on]
        order, first, self.of = distinct_parts(self.data, self.start, size, bucket, h | (key >> np.uint64(32)))
        one = order[first]
        self.seg_start, self.seg_size, self.seg_bucket = self.start[one], size[one], bucket[one]
        self.seg_key, self.seg_left, self.seg_right = key[one], self.left[on][one], self.right[on][one]
        self.seg_least = np.minimum.reduceat(self.id[order], first) if first.size else first

    def deal(self, a: int, b: int, parts: int) -> tuple[np.ndarray, ...]:
        """Windows of the distinct segments ``a..b`` by their own hashes.  Of each: its
        distinct one, its segment's least id; of each distinct one, by part: the part, two
        hashes, the least id."""
        n = self.seg_size[a:b] - self.span + 1
        start = np.repeat(self.seg_start[a:b] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        own = np.repeat(self.seg_least[a:b], n)
        k1, k2 = content_keys(self.data, start, np.full(start.size, self.span))
        order = np.lexsort((k2, k1))  # parts rise with the first hash
        first, of = distinct(k1, k2, order)
        one = order[first]
        return of, own, bucket_of(k1[one], parts), k1[one], k2[one], np.minimum.reduceat(own[order], first)


def windows(data: np.ndarray, offsets: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each segment, in text order: start, number of windows, hash, key of its content,
    keys of its left and right context (0: none).

    The anchor of a window is its first string of ``gram`` bytes with the least hash; a
    segment is a run of windows with one anchor.  Every window reaches ``half`` bytes before
    its anchor or ``span - half`` from its beginning, so a window that is in two segments
    gives both the same left or the same right key."""
    if not gram <= span <= _STEP:
        raise ValueError(f"a span of {span} bytes: at least {gram}, at most {_STEP}")
    n = data.size - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), *np.zeros((4, 0), np.uint64)
    a = offsets[:-1]
    b = np.maximum(a, offsets[1:] - span + 1)
    # a row's windows begin in [a, b); those from b to the row's end would cross it
    inside = np.repeat(np.arange(2 * a.size) % 2 == 0, np.stack([b - a, offsets[1:] - b], 1).ravel())[:n]
    edge = np.zeros(n, bool)
    edge[a[a < b]] = True
    edge[b[b < n]] = True
    half, longest = (span - gram) // 2, 2 * span - gram
    power, inverse = _powers(_P, _STEP + longest + 1), _powers(_P_INV, _STEP + longest + 1)
    spread, place = inverse * _ODD, np.arange(_STEP + span, dtype=np.uint32)
    parts, lo = [], 0
    while lo < n:
        hi = min(n, lo + _STEP)
        part = data[lo: min(data.size, hi + longest)]
        sums = np.zeros(part.size + 1, np.uint64)
        np.cumsum(part.astype(np.uint64) * power[: part.size], out=sums[1:])
        grams = hi - lo + span - gram
        m = (sums[gram: gram + grams] - sums[:grams]) * spread[:grams]
        # 16 bits of the hash before the place within the step, which is below 2 ** 16
        m = (m.view("<u4")[1::2] & np.uint32(0xFFFF0000)) | place[:grams]
        have, want = 1, span - gram + 1
        while have < want:
            step = min(have, want - have)
            m = np.minimum(m[:-step], m[step:])
            have += step
        border = edge[lo:hi].copy()
        border[0] = True
        border[1:] |= (m[1:] != m[:-1]) & inside[lo + 1: hi]
        at = np.flatnonzero(border)
        end = np.append(at[1:], hi - lo)
        if hi < n and inside[hi - 1] and not edge[hi] and at.size > 1:
            # the last segment may go on: the next step begins with it
            at, end, hi = at[:-1], end[:-1], lo + int(at[-1])
        on = inside[lo + at]
        at, end = at[on], end[on]
        p = (m[at] & np.uint32(0xFFFF)).astype(np.int64)

        # hashes of what is between two places: all begin at the segment, the anchor or the left key
        top, low = inverse.take(p), sums.take(p)
        whole = sums.take(p + gram)
        key = mixed((whole - sums.take(at)) * inverse.take(at) * _ODD + (sums.take(end + span - 1) - low) * top) + (end - at).astype(np.uint64)
        before = np.maximum(p - half, 0)
        left = mixed((whole - sums.take(before)) * inverse.take(before)) | np.uint64(1)
        left[p - at < half] = 0
        right = mixed((sums.take(np.minimum(p + span - half, part.size)) - low) * top) | np.uint64(1)
        right[p - end >= half] = 0
        parts.append((at + lo, end - at, mixed((whole - low) * top), key, left, right))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def borders(*values: np.ndarray) -> np.ndarray:
    """Where a run of equal values (in all arrays) begins."""
    if not values[0].size:
        return np.zeros(0, np.int64)
    new = np.ones(values[0].size, bool)
    new[1:] = False
    for v in values:
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def cut_keys(values: np.ndarray, n: int) -> bytes:
    """The low ``n`` bytes of each value; a value other than 0 does not become 0."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes()


def whole_keys(parts: list[bytes], n: int) -> np.ndarray:
    low = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, n)
    value = np.zeros((low.shape[0], 8), np.uint8)
    value[:, :n] = low
    return value.view("<u8").ravel()


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key other than 0 is there more than once."""
    order = np.argsort(keys)
    x = keys[order]
    same = np.append(False, (x[1:] == x[:-1]) & (x[1:] != 0))
    same[:-1] |= same[1:]
    out = np.empty(keys.size, bool)
    out[order] = same[: keys.size]
    return out


def size_powers(size: np.ndarray, span: int) -> np.ndarray:
    return np.clip(np.ceil(np.log(size / span) / np.log(_GROWTH)), 0, 255).astype(np.uint8)


def size_bounds(power: np.ndarray, span: int) -> np.ndarray:
    """Bytes, at most a tenth above the told size."""
    return np.ceil(span * _GROWTH ** power.astype(float) + 1e-6)


def parts_of(total: int, limit: int) -> int:
    """Parts of an oversized bucket: a window takes more bytes dealt than in a segment."""
    return -(-4 * total // limit)


def distinct(k1: np.ndarray, k2: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of keys in ``order``: where each distinct one begins there, and each key's distinct one."""
    x, y = k1[order], k2[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])) if order.size else np.zeros(0, bool)
    of = np.empty(order.size, np.int64)
    of[order] = np.cumsum(new) - 1
    return np.flatnonzero(new), of


def distinct_parts(data: np.ndarray, start: np.ndarray, size: np.ndarray, bucket: np.ndarray | None = None,
                   keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of ``data`` grouped by bucket and content: their order, where each distinct one
    begins there, and each part's distinct one.  Hashes (``keys``, which rise with the bucket,
    or those of the contents) only order the parts; should different contents have equal
    hashes, the bytes themselves are taken as keys."""
    bucket = np.zeros(start.size, np.int64) if bucket is None else bucket
    k1, k2 = content_keys(data, start, size) if keys is None else (keys, np.zeros(start.size, np.uint64))
    for exact in (False, True):
        order = np.argsort(k1) if keys is not None and not exact else np.lexsort((k2, k1, bucket))
        first = borders(bucket[order], k1[order], k2[order])
        of = np.empty(order.size, np.int64)
        of[order] = np.repeat(np.arange(first.size), np.diff(np.append(first, order.size)))
        if same_content(data, start, size, order[first][of]):
            break
        seen: dict[bytes, int] = {}
        k1 = np.array([seen.setdefault(data[a: a + n].tobytes(), len(seen)) for a, n in zip(start.tolist(), size.tolist(), strict=True)], np.uint64)
        k2 = np.zeros(k1.size, np.uint64)
    return order, first, of


def same_content(data: np.ndarray, start: np.ndarray, size: np.ndarray, other: np.ndarray) -> bool:
    """Whether each part has the bytes of the part whose number ``other`` gives."""
    i = np.flatnonzero(other != np.arange(start.size))
    if not np.array_equal(size[i], size[other[i]]):
        return False
    if not i.size:
        return True
    word = 8 if int(size[i].min()) >= 8 else 1
    # every place of the data as a word of 8 bytes; the last word of a part ends with it
    data = np.ascontiguousarray(data)
    words = np.ndarray((data.size - word + 1,), f"<u{word}", data, strides=(1,))
    group = 1 << 15
    for j in (i[a: a + group] for a in range(0, i.size, group)):
        x, y, last = start[j], start[other[j]], size[j] - word
        for k in range(0, int(last.max()) + word, word):
            at = np.minimum(k, last)
            if not np.array_equal(words[x + at], words[y + at]):
                return False
            if k + word < int(last.max()) + word and k >= 64:
                on = last > k
                x, y, last = x[on], y[on], last[on]
    return True


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The parts ``data[start:start + size]`` back to back."""
    ends = np.append(0, np.cumsum(size))
    out, group = np.empty(int(ends[-1]), data.dtype), 1 << 14
    for i in range(0, start.size, group):
        edge = ends[i: i + group + 1]
        at = np.repeat(start[i: i + group] - edge[:-1], np.diff(edge))
        at += np.arange(int(edge[0]), int(edge[-1]))
        data.take(at, out=out[int(edge[0]): int(edge[-1])], mode="clip")
    return out


def content_keys(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each part of ``data``."""
    keys = np.zeros((2, start.size), np.uint64)
    group = 1 << 13
    for i in range(0, start.size, group):
        s, z = start[i: i + group], size[i: i + group]
        part = gathered(data, s, z).astype(np.uint64) + np.uint64(1)
        begin = np.cumsum(z) - z
        within = np.arange(part.size) - np.repeat(begin, z)
        for j, p in enumerate((_P, 0xC2B2AE3D27D4EB4F)):
            keys[j, i: i + group] = np.add.reduceat(part * _powers(p, int(z.max()))[within], begin)
    return mixed(keys[0] + size.astype(np.uint64)), mixed(keys[1] + size.astype(np.uint64))


def equal_runs(values: np.ndarray) -> list[tuple[int, int]]:
    """``(start, end)`` of the runs of equal values."""
    if not values.size:
        return []
    edges = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
    return list(zip([0, *edges], [*edges, values.size], strict=True))


def _rows(table: pa.Table) -> list[dict]:
    return table.to_pylist()


def least_ids(data: np.ndarray, size: np.ndarray, least: np.ndarray, span: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct segments back to back in ``data``: where each begins in the sorted text,
    and for each position there the least id of all windows equal to the one at it."""
    begin = np.cumsum(size + 1) - (size + 1)
    text = np.zeros(int((size + 1).sum()), np.uint16)
    inside = np.ones(text.size, bool)
    inside[begin + size] = False
    text[inside] = data.astype(np.uint16) + 1
    found = np.repeat(least, size + 1)
    held = np.zeros(0, np.int64)
    for _, pos, lcp in sorted_suffixes(text, span, memory, zero_ends=True):
        pos = pos.astype(np.int64)
        new = np.flatnonzero(lcp < span)
        # what came before the block's first new group belongs to the held one
        head = int(new[0]) if new.size else pos.size
        held = np.concatenate([held, pos[:head]])
        if not new.size:
            continue
        if held.size > 1:
            found[held] = found[held].min()
        groups = np.append(new, pos.size)
        several = np.flatnonzero(np.diff(groups[:-1]) > 1)
        if several.size:
            # groups that end inside the block
            part = pos[: groups[-2]] if groups.size > 1 else pos
            low = np.minimum.reduceat(found[part], new[:-1]) if new.size > 1 else np.zeros(0, np.int64)
            length = np.diff(groups[:-1])
            found[part[new[0]:]] = np.repeat(low, length)
        held = pos[groups[-2]:]
    if held.size > 1:
        found[held] = found[held].min()
    return begin, found


def shard(rows: list[dict], span: int, memory: int) -> list[bytes]:
    """Bits of one bucket: per row (a pack's distinct segments), for each window whether a
    smaller id than the pack's own has it."""
    import zstandard
    sizes = [np.frombuffer(r["sizes"], "<i8") for r in rows]
    leasts = [np.frombuffer(r["least"], "<i8") for r in rows]
    unpack = zstandard.ZstdDecompressor()
    data = np.frombuffer(b"".join(unpack.decompress(r["data"], max_output_size=int(s.sum())) for r, s in zip(rows, sizes, strict=True)), np.uint8)
    size, least = np.concatenate(sizes), np.concatenate(leasts)
    key, left, right = (whole_keys([r[c] for r in rows], n) for c, n in (("marks", 6), ("lefts", 4), ("rights", 4)))
    start = np.cumsum(size) - size
    order, first, of = distinct_parts(data, start, size, keys=key)
    one = order[first]
    start, size, least = start[one], size[one], np.minimum.reduceat(least[order], first)
    # a segment that has no context of another content shares no window with another segment
    alone = ~(repeated(left[one]) | repeated(right[one]))
    begin = np.empty(one.size, np.int64)
    begin[~alone], found = least_ids(gathered(data, start[~alone], size[~alone]), size[~alone], least[~alone], span, memory)
    n = size[alone] - span + 1
    begin[alone] = found.size + np.cumsum(n) - n
    found = np.append(found, np.repeat(least[alone], n))
    out, edges, own, group = [], np.cumsum([0, *(x.size for x in sizes)]), np.concatenate(leasts), 1 << 9
    every = np.concatenate(sizes) - span + 1
    for i in range(0, len(rows), group):  # few operations a row: a bucket has one of every pack
        edge = edges[i: i + group + 1]
        a, b = int(edge[0]), int(edge[-1])
        below = gathered(found, begin[of[a:b]], every[a:b]) < np.repeat(own[a:b], every[a:b])
        ends = np.append(0, np.cumsum(every[a:b]))[edge - a].tolist()
        out += [np.packbits(below[x:y]).tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
    return out


def window_shard(rows: list[dict]) -> list[bytes]:
    """Bits of one part of an oversized bucket: per row (a pack's distinct windows),
    whether a smaller id than the pack's least has the window."""
    keys = np.concatenate([np.frombuffer(r["data"], "<u8") for r in rows]).reshape(-1, 2)
    leasts = [np.frombuffer(r["least"], "<i8") for r in rows]
    least = np.concatenate(leasts)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    first, of = distinct(keys[:, 0], keys[:, 1], order)
    below = np.minimum.reduceat(least[order], first)[of] < least
    edges = np.cumsum([0, *(x.size for x in leasts)]).tolist()
    return [np.packbits(below[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def outgoing(p: Pack, pid: int, hot: dict[int, int]) -> list[dict]:
    """A pack's distinct segments by bucket (part -1); of oversized buckets the distinct
    windows by part."""
    import zstandard
    squeeze, rows = zstandard.ZstdCompressor(3), []
    edge = np.append(0, np.cumsum(p.seg_size))
    data = memoryview(gathered(p.data, p.seg_start, p.seg_size))
    columns = {"sizes": (8, p.seg_size.astype("<i8").tobytes()), "least": (8, p.seg_least.astype("<i8").tobytes()),
               **{c: (n, cut_keys(keys, n)) for c, n, keys in (("marks", 6, p.seg_key), ("lefts", 4, p.seg_left), ("rights", 4, p.seg_right))}}
    for a, b in equal_runs(p.seg_bucket):
        bucket = int(p.seg_bucket[a])
        row = {"bucket": bucket, "pid": pid}
        if bucket not in hot:
            rows.append(row | {"part": -1, "data": squeeze.compress(data[edge[a]: edge[b]])} | {c: x[n * a: n * b] for c, (n, x) in columns.items()})
            continue
        _, _, part, k1, k2, least = p.deal(a, b, hot[bucket])
        keys = np.stack([k1, k2], 1).astype("<u8")
        rows += [row | {"part": int(part[i]), "sizes": b"", "marks": b"", "lefts": b"", "rights": b"", "least": least[i:j].astype("<i8").tobytes(), "data": keys[i:j].tobytes()}
                 for i, j in equal_runs(part)]
    return rows


def returned(p: Pack, answers: list[dict], hot: dict[int, int]) -> np.ndarray:
    """The bits of all windows of a pack's distinct segments, in their order."""
    size = p.seg_size - p.span + 1
    edge = np.append(0, np.cumsum(size))
    bits = np.zeros(int(edge[-1]), bool)
    by = {(r["bucket"], r["part"]): np.frombuffer(r["bits"], np.uint8) for r in answers}
    for a, b in equal_runs(p.seg_bucket):
        bucket, n = int(p.seg_bucket[a]), int(edge[b] - edge[a])
        if bucket not in hot:
            bits[edge[a]: edge[b]] = np.unpackbits(by[bucket, -1], count=n)
            continue
        of, own, part, _, _, least = p.deal(a, b, hot[bucket])
        below = np.concatenate([np.unpackbits(by[bucket, int(part[i])], count=j - i) for i, j in equal_runs(part)]).astype(bool)
        bits[edge[a]: edge[b]] = below[of] | (least[of] < own)
    return bits


def removed(pack: Pack, bits: np.ndarray) -> np.ndarray:
    """Mask of the pack's bytes that go.  ``bits``: of each window of each distinct segment,
    whether an id below the pack's least one has it."""
    gone = np.zeros(pack.data.size, bool)
    size = pack.seg_size - pack.span + 1
    begin = np.cumsum(size) - size
    above = pack.id > pack.seg_least[pack.of]
    group = 1 << 16
    for a in range(0, pack.start.size, group):
        n = pack.count[a: a + group]
        ends = np.cumsum(n)
        within = np.arange(int(ends[-1])) - np.repeat(ends - n, n)
        flagged = bits[within + np.repeat(begin[pack.of[a: a + group]], n)] | np.repeat(above[a: a + group], n)
        gone[(within + np.repeat(pack.start[a: a + group], n))[flagged]] = True
    # a window that goes takes its bytes with it
    have = 1
    while have < pack.span:
        step = min(have, pack.span - have)
        gone[step:] |= gone[:-step].copy()
        have += step
    return gone


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM,
                   bucket_bytes: int = BUCKET_BYTES, memory: int = SORT_MEMORY, texts: bool = False,
                   sort_bytes: int = SORT_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row; with ``texts`` also
    ``kept`` (the remaining bytes)."""
    all_packs = packs(df, id_col, text_col)
    total = all_packs.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))

    def list_hashes(batches):
        for batch in batches:
            for row in batch.to_pylist():
                p = Pack(row, span, gram, buckets)
                several, sizes, runs = p.several(), p.sizes(), equal_runs(p.bucket)
                # a hash's contexts are context[of[i]:of[i + 1]]
                of = np.append(np.searchsorted(p.context, p.first), p.context.size)
                left, right, number = cut_keys(p.left[p.context], 5), cut_keys(p.right[p.context], 5), np.diff(of).astype("<u4")
                # one batch for all buckets: their number grows with the input
                yield pa.record_batch([pa.array([p.bucket[a] for a, _ in runs], pa.int64()), pa.array([row["pid"]] * len(runs), pa.int64()),
                                       pa.array([left[5 * of[a]: 5 * of[b]] for a, b in runs], pa.binary()),
                                       pa.array([right[5 * of[a]: 5 * of[b]] for a, b in runs], pa.binary()),
                                       pa.array([number[a:b].tobytes() for a, b in runs], pa.binary()),
                                       pa.array([np.packbits(several[a:b]).tobytes() for a, b in runs], pa.binary()),
                                       pa.array([sizes[a:b].tobytes() for a, b in runs], pa.binary())],
                                      names=["bucket", "pid", "lefts", "rights", "contexts", "several", "sizes"])

    def find_shared(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        again = repeated(whole_keys([r["lefts"] for r in rows], 5)) | repeated(whole_keys([r["rights"] for r in rows], 5))
        number = [np.frombuffer(r["contexts"], "<u4") for r in rows]
        every = np.concatenate(number).astype(np.int64)
        again = np.logical_or.reduceat(again, np.cumsum(every) - every)
        on = again | np.concatenate([np.unpackbits(np.frombuffer(r["several"], np.uint8), count=x.size).view(bool) for r, x in zip(rows, number, strict=True)])
        total = int(size_bounds(np.frombuffer(b"".join(r["sizes"] for r in rows), np.uint8)[on], span).sum())
        edge = np.cumsum([0, *(x.size for x in number)]).tolist()
        out = [np.packbits(on[a:b]).tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
        return pa.table([group.column("pid"), group.column("bucket"), pa.array(out, pa.binary()), pa.array([total] * len(out), pa.int64())],
                        names=["pid", "bucket", "bits", "total"])

    def with_shared(pack: dict, answers: list[dict]) -> Pack:
        p = Pack(pack, span, gram, buckets)
        size = np.bincount(p.bucket, minlength=buckets) if p.bucket.size else np.zeros(buckets, int)
        flags = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=int(size[r["bucket"]])).view(bool)
                 for r in sorted(answers, key=lambda r: r["bucket"])]
        p.share(np.concatenate(flags) if flags else np.zeros(0, bool))
        return p

    def send_segments(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = [r for pack in _rows(left) for r in outgoing(with_shared(pack, _rows(right)), pack["pid"], hot)]
        return pa.Table.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("pid", pa.int64()), ("sizes", pa.binary()),
                                                     ("least", pa.binary()), ("marks", pa.binary()), ("lefts", pa.binary()), ("rights", pa.binary()), ("data", pa.binary())]))

    def sort_shard(group: pa.Table) -> pa.Table:
        rows = _rows(group)
        bits = shard(rows, span, memory) if rows[0]["part"] < 0 else window_shard(rows)
        return pa.table([group.column("pid"), group.column("bucket"), group.column("part"), pa.array(bits, pa.binary())],
                        names=["pid", "bucket", "part", "bits"])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {c: [] for c in names}
        answers = _rows(right)
        for pack in _rows(left):
            p = with_shared(pack, [r for r in answers if not r["sorted"]])
            gone = removed(p, returned(p, [r for r in answers if r["sorted"]], hot))
            starts = gone.copy()
            starts[1:] &= ~gone[:-1]
            borders = p.offsets[:-1][p.offsets[:-1] < gone.size]
            starts[borders] = gone[borders]
            for c, flags in (("n_removed", gone), ("n_spans", starts)):
                out[c] += np.diff(np.append(0, np.cumsum(flags))[p.offsets]).tolist()
            rest = p.data[~gone].tobytes()
            ends = np.append(0, np.cumsum(~gone))[p.offsets].tolist()
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                kept = rest[a:b]
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if texts:
                    out["kept"].append(kept)
            out["doc_id"] += [i if k else None for i, k in zip(p.ids.tolist(), p.known.tolist(), strict=True)]
            out["n_bytes"] += np.diff(p.offsets).tolist()
        return pa.table({c: pa.array(out[c], types[c]) for c in names})

    types = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(),
             "kept_sha256": pa.string(), **({"kept": pa.binary()} if texts else {})}
    names = list(types)
    lists = all_packs.mapInArrow(tidied(list_hashes), "bucket long, pid long, lefts binary, rights binary, contexts binary, several binary, sizes binary")
    shared = stored(lists.groupBy("bucket").applyInArrow(tidied_group(find_shared), "pid long, bucket long, bits binary, total long"), "shared-hashes")
    hot = {r.bucket: parts_of(r.total, sort_bytes) for r in shared.where(F.col("total") > sort_bytes).select("bucket", "total").distinct().collect()}
    segments = (all_packs.groupBy("pid").cogroup(shared.groupBy("pid"))
                .applyInArrow(tidied_group(send_segments), "bucket long, part long, pid long, sizes binary, least binary, marks binary, lefts binary, rights binary, data binary"))
    flags = stored(segments.groupBy("bucket", "part").applyInArrow(tidied_group(sort_shard), "pid long, bucket long, part long, bits binary"), "window-bits")
    answers = (shared.select("pid", "bucket", F.lit(-1).cast("long").alias("part"), "bits", F.lit(False).alias("sorted"))
               .unionByName(flags.withColumn("sorted", F.lit(True))))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")
    return all_packs.groupBy("pid").cogroup(answers.groupBy("pid")).applyInArrow(tidied_group(cut), schema)
