"""Operator 6 and its suffix sorting against their definitions."""

import hashlib
import random

import numpy as np
import pytest
import zstandard

from ledgerline.llm import induced as M
from ledgerline.llm import substring_dedup as D
from ledgerline.llm.substring_dedup import remove_repeats
from tests.llm.helpers import EDGE_TEXTS, empty, frame


def naive_order(strings, cap):
    """Suffixes by content, ends of strings by position, with capped common prefixes."""
    suffixes, at = [], 0
    for k, s in enumerate(strings):
        suffixes += [(s[i:], k, at + i) for i in range(len(s))]
        at += len(s) + 1
    suffixes.sort(key=lambda x: ([c + 1 for c in x[0]] + [0], x[1]))
    out = []
    for j, (s, _, p) in enumerate(suffixes):
        before = suffixes[j - 1][0] if j and suffixes[j - 1][0][:1] == s[:1] else b""
        n = next((i for i, (a, b) in enumerate(zip(s, before)) if a != b), min(len(s), len(before)))
        out.append((p, min(n, cap)))
    return out


@pytest.mark.parametrize("chunk,in_memory,memory", [(1, 1, 0), (3, 4, 64), (7, 1, 1 << 20), (1 << 18, 1 << 22, 1 << 20)])
def test_induced_order_and_common_prefixes(monkeypatch, chunk, in_memory, memory):
    monkeypatch.setattr(M, "CHUNK", chunk)
    monkeypatch.setattr(M, "IN_MEMORY", in_memory)
    rng = random.Random(chunk)
    for _ in range(150):
        letters = rng.choice([1, 2, 3, 5])
        strings = [bytes(rng.randrange(letters) for _ in range(rng.randint(1, rng.choice([4, 40])))) for _ in range(rng.randint(1, 8))]
        strings += strings[:1] * rng.randint(0, 2)
        text = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16) for s in strings])
        by_symbol = {}
        for c, pos, lcp in M.sorted_suffixes(text, 5, memory, zero_ends=True):
            by_symbol.setdefault(c, []).extend(zip(pos.tolist(), lcp.tolist()))
        assert [x for c in sorted(by_symbol) for x in by_symbol[c]] == naive_order(strings, 5)


def brute(rows, span):
    data = [(i, (t or "").encode()) for i, t in rows]
    rank = lambda i: float("inf") if i is None else i
    least = {}
    for i, b in data:
        for p in range(len(b) - span + 1):
            w = b[p: p + span]
            least[w] = min(least.get(w, float("inf")), rank(i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - span + 1):
            if least[b[p: p + span]] < rank(i):
                gone[p: p + span] = b"\1" * span
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df, **options):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(df, **options).collect())


def test_random_documents(spark):
    rng = random.Random(9)
    words = ["alpha", "beta", "gämma", "dél", "e", "ff"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = [text(15) for _ in range(4)]
    rows = [(i, f"{text(rng.randint(0, 20))} {rng.choice(passage)} {text(rng.randint(0, 20))}") for i in range(80)]
    rows += [(i + 80, rows[i % 7][1]) for i in range(20)] + [(5, rows[9][1]), (None, passage[0]), (None, passage[0]), (-3, passage[1])]
    assert found(frame(spark, rows), bucket_bytes=500, memory=100) == brute(rows, 50)
    assert found(frame(spark, rows), span=20, gram=6, bucket_bytes=2000) == brute(rows, 20)


def crossed(n):
    """A passage in every document, with other words around it in each."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    passage = " ".join(word() for _ in range(12))
    return [(i, f"{word()} {word()} {word()} {word()} {passage} {word()} {word()} {word()} {word()}") for i in rng.sample(range(n), n)]


def test_oversized_bucket_is_dealt_by_window(spark):
    rows = crossed(150) + [(3, "x" * 90), (2, "x" * 70), (None, "y" * 60)]
    assert found(frame(spark, rows), bucket_bytes=3000, sort_bytes=500) == brute(rows, 50)
    assert found(frame(spark, rows), bucket_bytes=3000, sort_bytes=8000, memory=100) == brute(rows, 50)


def test_no_task_gets_an_oversized_bucket():
    span, limit, buckets = 50, 8000, 8
    rows, groups, plain = crossed(2000), {}, {}
    packs = []
    for at in range(0, len(rows), 200):
        data = [t.encode() for _, t in rows[at: at + 200]]
        row = {"ids": np.array([i for i, _ in rows[at: at + 200]], "<i8").tobytes(), "known": np.ones(200, bool).tobytes(),
               "offsets": np.cumsum([0, *map(len, data)]).astype("<i8").tobytes(), "size": sum(map(len, data)),
               "data": zstandard.compress(b"".join(data))}
        packs.append(D.Pack(row, span, 16, buckets))
    seen = np.concatenate([p.hash for p in packs])
    value, count = np.unique(seen, return_counts=True)
    total = np.zeros(buckets)
    flags = []
    for p in packs:
        on = p.several() | np.isin(p.hash, value[count > 1])
        each = np.add.reduceat(p.count + span - 1, p.first)
        told = D.size_bounds(p.sizes(), span)
        assert (told >= each).all() and (told <= each * 1.1 + 2).all()
        total += np.bincount(p.bucket[on], weights=told[on], minlength=buckets)
        flags.append(on)
    hot = {b: D.parts_of(int(t), limit) for b, t in enumerate(total.tolist()) if t > limit}
    for p, on in zip(packs, flags):
        p.share(on)
        for to, over in ((groups, hot), (plain, {})):
            for r in D.outgoing(p, 0, over):
                n = np.frombuffer(r["sizes"], "<i8").sum() if r["part"] < 0 else len(r["data"])
                to[r["bucket"], r["part"]] = to.get((r["bucket"], r["part"]), 0) + int(n)
    assert max(plain.values()) > 10 * limit  # the whole bucket in one task
    assert max(n for (_, part), n in groups.items() if part < 0) <= limit
    assert max(groups.values()) <= 6 * limit  # 16 bytes of keys a window


def test_edges(spark):
    rows = [(i, t if t is None or len(t) < 10_000 else t[:3000]) for i, t in enumerate(EDGE_TEXTS)] + [(100, "a" * 400), (99, "a" * 70), (101, "a" * 49)]
    assert found(frame(spark, rows)) == brute(rows, 50)
    assert remove_repeats(empty(spark)).count() == 0
    kept = {r.doc_id: bytes(r.kept).decode() for r in remove_repeats(frame(spark, rows), texts=True).collect()}
    assert kept[100] == "" and kept[99] == "a" * 70 and kept[101] == "a" * 49


def test_equal_hashes_of_different_contents(monkeypatch):
    """Contents decide where two hashes agree by chance or by design."""
    data = np.frombuffer(b"abcabdabcxyabc", np.uint8)
    start, size = np.array([0, 3, 6, 9, 11]), np.array([3, 3, 3, 2, 3])
    bucket = np.array([0, 0, 0, 0, 1])

    def classes():
        order, first, of = D.distinct_parts(data, start, size, bucket)
        assert sorted(order.tolist()) == list(range(5)) and (np.diff(bucket[order]) >= 0).all()
        assert first.size == 4 and len(set(of.tolist())) == 4
        return of[0] == of[2] and of[4] not in of[:4]

    assert classes()
    zero = np.zeros(5, np.uint64)
    monkeypatch.setattr(D, "content_keys", lambda *_: (zero, zero))
    assert classes()


def pack(texts, first=0, buckets=1):
    data = [t.encode() for t in texts]
    return D.Pack({"ids": np.arange(first, first + len(data)).astype("<i8").tobytes(), "known": np.ones(len(data), bool).tobytes(),
                   "offsets": np.cumsum([0, *map(len, data)]).astype("<i8").tobytes(), "size": sum(map(len, data)),
                   "data": zstandard.compress(b"".join(data))}, 50, 16, buckets)


def test_common_words_in_other_contexts_are_not_sorted(monkeypatch):
    """A frequent string between words that differ is neither reported nor sorted."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    texts = [f"{word(40)} on the other hand {word(40)}" for _ in range(300)]
    assert not pack(texts).several().any()
    assert pack([*texts, f"{word(40)}{texts[7][20:80]}"]).several().any()
    sorted_bytes = []
    least_ids = D.least_ids
    monkeypatch.setattr(D, "least_ids", lambda data, *rest: sorted_bytes.append(data.size) or least_ids(data, *rest))

    def flagged(texts):
        p = pack(texts)
        p.share(np.ones(p.first.size, bool))
        D.shard(D.outgoing(p, 0, {}), 50, 1 << 20)
        return sorted_bytes.pop()
    assert flagged(texts) == 0
    assert 0 < flagged([*texts, f"{word(40)}{texts[7][20:80]}"]) < 2000


def test_segments_do_not_depend_on_steps(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(200))) for _ in range(60)] + ["a" * 900, "", "xyz" * 200, "q" * 49, "r" * 50]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    whole = D.windows(data, offsets, 50, 16)
    assert int(whole[1].sum()) == sum(max(0, len(t) - 49) for t in texts) and int(whole[1].max()) <= 35
    for step in (64, 101, 640):
        monkeypatch.setattr(D, "_STEP", step)
        assert all(np.array_equal(a, b) for a, b in zip(whole, D.windows(data, offsets, 50, 16), strict=True))


def test_shared_parts_of_any_length_and_place(spark):
    rng = random.Random(12)
    text = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    part = [text("ab", 52), text("abcdefgh", 60), "ab" * 40, "c" * 70, text("abcdefgh", 200)]
    rows = []
    for i in rng.sample(range(200), 200):
        p = rng.choice(part)
        a = rng.randrange(len(p) - 47)
        rows.append((i, text("abcdefgh", rng.randrange(30)) + p[a: a + rng.randrange(47, 120)] + text("ab", rng.randrange(60))))
    assert found(frame(spark, rows), bucket_bytes=3000) == brute(rows, 50)
    assert found(frame(spark, rows), bucket_bytes=3000, sort_bytes=2000) == brute(rows, 50)
