"""Operator 10 against all pairs of shingle sets, and its connected components."""

import random
from collections import Counter

import pytest

from ledgerline.llm.components import connected_components
from ledgerline.llm.lsh_forest import jaccard_classes, keep_one_of_each, prefix_length
from tests.llm.helpers import EDGE_TEXTS, empty, frame, words


def brute(rows, size=5):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i: i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    root, links = list(range(len(rows))), Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (least[find(i)], links[i]) for i, (d, _) in enumerate(rows)}


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    rows = [text(rng.randint(1, 120)) for _ in range(40)]
    for _ in range(90):
        w = list(rng.choice(rows))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(9)}"
        rows.append(w + text(rng.randint(0, 6)))
    rng.shuffle(rows)
    return [(7 * i + 3, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("block", [3, 512])
def test_all_links_and_groups(spark, block):
    rows = corpus(block)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_classes(frame(spark, rows), block=block).collect()}
    assert got == brute(rows)


def test_edges_and_copies(spark):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)]
    out = jaccard_classes(frame(spark, rows)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in out} == {i: v for i, v in brute(rows).items()}
    copies = [(i, "the very same words in here again") for i in range(300)]
    out = jaccard_classes(frame(spark, copies)).collect()
    assert {(r.class_id, r.copy_id, r.n_links) for r in out} == {(0, 0, 299)}
    assert jaccard_classes(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = corpus(1)
    want = {c for c, _ in brute(rows).values()}
    docs = frame(spark, rows)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want)
    odd = frame(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "other words of some kind here"), (None, None), (2, None), (None, "x y")])
    assert sorted(str((r.doc_id, r.text)) for r in keep_one_of_each(odd).collect()) == sorted(
        str(x) for x in [(1, "a b c d e f g"), (1, "other words of some kind here"), (None, None), (2, None), (None, "x y")])


def test_prefix_is_shortened_to_the_recall():
    d = prefix_length(0.8)
    assert 1 - (1 - 0.8 ** d) ** 32 >= 0.99999 > 1 - (1 - 0.8 ** (d + 1)) ** 32
    assert prefix_length(1.0) == 8


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 50)] + [(5, 5)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_overlaps_of_long_sets_take_bounded_memory():
    import tracemalloc

    import numpy as np

    from ledgerline.llm import lsh_forest as L
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 1 << 64, 40_000, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, 20_000, replace=False)) for _ in range(100)]
    some = {(i, j): np.intersect1d(sets[i], sets[j]).size for i, j in ((0, 1), (5, 77), (98, 99), (4, 4))}
    tracemalloc.start()
    within, across = L.overlaps(sets, None), L.overlaps(sets[:60], sets[60:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for (i, j), n in some.items():
        assert within[i, j] == n and (i >= 60 or j < 60 or across[i, j - 60] == n)
    # the sets are 16 MB; ranking them whole takes over 130 MB
    assert peak < 80 << 20, peak >> 20


def test_components_of_many_shingles_are_cut_into_blocks(spark):
    from pyspark.sql import functions as F

    from ledgerline.llm.lsh_forest import _blocks
    rows = spark.createDataFrame([(5, 100, 9), (5, 1000, 9), (5, 10_000, 9), (1, 10_000, 9)], "size long, total long, cid long")
    got = [r[0] for r in rows.select(F.size(_blocks(F.col("size"), F.col("total"), F.col("cid"), 4, 400))).collect()]
    assert got == [2, 3, 5, 1]
