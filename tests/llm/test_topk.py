"""Operator 4 against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import topk_products as M


def brute(rows, k):
    usable = {(i, tuple(np.floor(64 * np.array(v, float)))) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, q in usable:
        if i % 20 == 0:
            scores = sorted((-sum(int(a) * int(b) for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def found(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    return sorted(tuple(r) for r in M.top_k_products(df, F.col("vec_id") % 20 == 0, k).collect())


@pytest.mark.parametrize("spread,dim", [(0.01, 3), (2.0, 4)])
def test_random_vectors(spark, monkeypatch, spread, dim):
    monkeypatch.setattr(M, "BLOCK", 40)
    monkeypatch.setattr(M, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(dim)
    rows = [(i, (rng.normal(size=dim) * 10 ** rng.uniform(-spread, spread)).tolist()) for i in range(500)]
    rows += [(500 + i, rows[3][1]) for i in range(150)]
    assert found(spark, rows) == brute(rows, 20)


def test_one_id_with_several_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(20, rng.normal(size=3).tolist()) for _ in range(10)] + [(i, rng.normal(size=3).tolist()) for i in range(101, 137)] + [(0, [9.0, 9.0, 9.0])]
    got = found(spark, rows)
    assert got == brute(rows, 20) and sum(r[0] == 20 for r in got) == 200


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.0, -0.0]), (40, None), (60, []), (80, [1.0, None]), (100, [float("nan"), 1.0]), (120, [float("inf"), 0.0]),
            (1, [1.0, 2.0]), (2, [-0.0, 0.0]), (3, [3.0]), (None, [1.0, 1.0]), (1, [1.0, 2.0]), (4, [-5.0, 1.0]), (140, [2.0]), (5, [0.015, -0.001])]
    assert found(spark, rows, 3) == brute(rows, 3)
    assert found(spark, [(1, [1.0])]) == [] and found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def test_products_beyond_doubles_are_exact():
    q, p = np.array([[2.0**40 + 1, 3.0]]), np.array([[2.0**20 + 1, 1.0], [2.0**60, 0.0]])
    assert M.products(q, p).tolist() == [[(2**40 + 1) * (2**20 + 1) + 3, (1 << 63) - 1]]
