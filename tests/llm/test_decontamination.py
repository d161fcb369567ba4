"""Operator 1 against a word-by-word definition."""

import hashlib
import random

import numpy as np
import pytest

from ledgerline.llm import decontamination as D
from tests.llm.helpers import EDGE_TEXTS, empty, frame, words


def brute(docs, items):
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            b = words(t)
            n = min(13, len(b))
            spans = {tuple(b[j: j + n]) for j in range(len(b) - n + 1)} if n else set()
            for j in range(len(w) - n + 1 if n else 0):
                if tuple(w[j: j + n]) in spans:
                    hit.update(range(j, j + n))
                    if item is not None:
                        found.add(str(item))
        listed = ",".join(sorted(found))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def check(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(frame(spark, docs), bench).collect()
    want = brute(docs, items)
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want[r.doc_id], r.doc_id


def test_random_texts(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "C", "dé", "E1", "fff"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(25)] + [(3, text(20)), (None, "z " * 13), (99, None), (98, "--")]
    docs = [(i, text(rng.randint(0, 40))) for i in range(60)]
    docs += [(100 + k, f"{text(5)} {t}; {text(200)}") for k, (_, t) in enumerate(items)]
    docs += [(200 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(300, "z! " * 40)]
    check(spark, docs, items)


def test_passage_in_many_documents_and_no_benchmark(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"x{i} {passage} y") for i in range(200)]
    check(spark, docs, [(1, passage), (2, passage.upper() + " more")])
    none = spark.createDataFrame([], "item_id long, text string")
    assert {(r.n_hit, r.contaminated) for r in D.contamination(frame(spark, docs), none).collect()} == {(0, False)}
    assert D.contamination(empty(spark), none).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_every_shared_span_shares_a_kept_hash(seed):
    rng = np.random.default_rng(seed)
    span = rng.integers(0, 5, 13).astype(np.uint64)
    one = np.concatenate([rng.integers(0, 5, 9).astype(np.uint64), span, rng.integers(0, 5, 4).astype(np.uint64)])
    two = np.concatenate([rng.integers(0, 5, 2).astype(np.uint64), span])
    assert D.kept(one, 13)[9] == D.kept(two, 13)[2]


def test_drop_keeps_clean_rows_and_columns(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = frame(spark, [(1, passage), (2, "clean text"), (3, None), (4, passage + " w" * 1000), (1, passage), (None, "clean too")])
    kept = D.drop_contaminated(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["2", "3", "4", "None"]
