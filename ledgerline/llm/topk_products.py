"""Operator 4, exact top-k inner products with norm buckets.

Equal vectors are one class that keeps its ``k + 1`` least ids (no query can need
more).  Classes are grouped by length into buckets and cut into blocks.  A first pass
over the longest block gives each query a floor for its k-th score.  Then every block
of queries meets the blocks of a stripe from the longest down, raising the floors as
it goes.  The local threshold of a block is the cosine that floor asks for at the
block's greatest length:

* above 1, no vector of the block can reach the floor and the query skips it;
* from ``SHARP`` on, coordinate pruning: only vectors whose coordinate on the query's
  strongest axis lies in the range that this cosine leaves;
* below, length pruning: only the block's longest vectors, down to the length that
  could still reach the floor.

What is left is verified by exact products.  Queries are a stated set and meet all
rows in blocks; no pairs of single rows are formed.

Defined cases: vectors that are null, empty, or hold a null or non-finite component,
and rows with a null id, take no part; vectors only meet others of their dimension;
a row repeated with the same id and vector counts once; rows of the query's own id
are never its candidates; products are exact, and a score beyond a 64-bit integer is
set to that type's end; no queries or no candidates give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

BUCKETS, BLOCK, QUERY_BLOCK, STRIPES = 32, 2048, 4096, 64
#: Local cosine threshold from which coordinate pruning pays.
SHARP = 0.75
_MAX = (1 << 63) - 1


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """``id, vec`` with vec = floor(scale * x) as whole-numbered doubles; unusable rows dropped."""
    x = F.col(vec_col)
    usable = F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # + 0.0 makes one class of 0.0 and -0.0
    steps = F.transform(x, lambda v: F.rint(scale * v.cast("double") - F.pmod(scale * v.cast("double"), F.lit(1.0))) + F.lit(0.0))
    return df.where(usable).select(F.col(id_col).cast("long").alias("id"), steps.alias("vec"))


def _pack(kind: int):
    """One row per block: matrix by falling length, lengths, classes, their ids."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["norm", "cid"], ascending=[False, True])
        m = np.array(pdf["vec"].tolist(), np.float64)
        small = np.abs(m).max(initial=0) < 1 << 15
        return pd.DataFrame({"dim": [int(pdf["dim"].iloc[0])], "block": [int(pdf["block"].iloc[0])], "kind": [kind],
                             "top": [float(pdf["norm"].iloc[0])], "rows": [len(pdf)], "small": [bool(small)],
                             "matrix": [m.astype("<i2" if small else "<f8").tobytes()],
                             "norms": [pdf["norm"].to_numpy("<f8").tobytes()], "cids": [pdf["cid"].to_numpy("<i8").tobytes()],
                             "ids": [[np.asarray(x, np.int64).tolist() for x in pdf["ids"]] if kind else [[]]],
                             "floors": [pdf["floor"].to_numpy("<f8").tobytes() if "floor" in pdf else b""]})
    return pack


PACKED = ("dim int, block long, kind int, top double, rows long, small boolean, matrix binary, norms binary, "
          "cids binary, ids array<array<long>>, floors binary")


class Block:
    def __init__(self, row):
        n = int(row.rows)
        self.matrix = np.frombuffer(row.matrix, "<i2" if row.small else "<f8").reshape(n, -1).astype(np.float64)
        self.norms, self.cids = np.frombuffer(row.norms, "<f8"), np.frombuffer(row.cids, "<i8")
        self.ids, self.top = row.ids, float(row.top)
        self.floors = np.frombuffer(row.floors, "<f8").copy() if len(row.floors) else np.full(n, -np.inf)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact inner products as int64 (beyond that type: its ends)."""
    if not q.size or not p.size:
        return np.zeros((len(q), len(p)), np.int64)
    if np.abs(q).max() * np.abs(p).max() * q.shape[1] < 1 << 53:
        return (q @ p.T).astype(np.int64)
    exact = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in p] for x in q]
    return np.array([[max(-_MAX - 1, min(_MAX, v)) for v in row] for row in exact], np.int64)


class Best:
    """Per query of a block, the best ``keep`` (score, id) so far and the floor."""

    def __init__(self, queries: Block, keep: int):
        self.q, self.keep = queries, keep
        self.found = [[] for _ in queries.cids]
        self.floors = queries.floors

    def offer(self, i: int, scores: np.ndarray, at: np.ndarray, block: Block, firsts: np.ndarray) -> None:
        """Candidates ``at`` of a block with their scores for query ``i``."""
        good = np.flatnonzero(scores >= self.floors[i])
        if good.size > self.keep:
            # ties to the least id: a class beyond the best ``keep`` by (score, least id) cannot be needed
            good = good[np.lexsort((firsts[at[good]], -scores[good]))[: self.keep]]
        if not good.size:
            return
        rows = self.found[i]
        for k in good.tolist():
            s = int(scores[k])
            rows.extend((-s, v) for v in block.ids[at[k]])
        rows.sort()
        del rows[self.keep:]
        if len(rows) == self.keep:
            self.floors[i] = max(self.floors[i], -rows[-1][0])


def meet(best: Best, block: Block) -> None:
    """Offer a block's vectors to all queries, pruned by their local thresholds."""
    q = best.q
    firsts = np.array([min(x) for x in block.ids], np.int64)
    with np.errstate(divide="ignore", invalid="ignore"):
        need = best.floors / q.norms  # length a candidate needs at least, where the floor is above 0
        need = np.where((best.floors > 0) & (q.norms > 0), need * (1 - 1e-9), np.where(best.floors > 0, np.inf, 0.0))
        local = np.minimum(need / block.top if block.top > 0 else np.where(need > 0, np.inf, 0.0), 2.0)
    sharp = np.flatnonzero((local >= SHARP) & (local <= 1))
    flat = np.flatnonzero(local < SHARP)
    if flat.size:
        # length pruning: the block is sorted by falling length
        upto = np.searchsorted(-block.norms, -need[flat], side="right")
        most = int(upto.max())
        scores = products(q.matrix[flat], block.matrix[:most])
        for i, row, n in zip(flat.tolist(), scores, upto.tolist(), strict=True):
            best.offer(i, row[:n], np.arange(n), block, firsts)
    if sharp.size:
        unit = block.matrix / np.where(block.norms > 0, block.norms, 1)[:, None]
        for i in sharp.tolist():
            axis = int(np.argmax(np.abs(q.matrix[i])))
            c = q.matrix[i, axis] / q.norms[i]
            spread = np.sqrt(max(0.0, (1 - local[i] ** 2) * (1 - c * c))) + 1e-9
            x = unit[:, axis]
            # cosines of at least ``local`` leave this coordinate no other room
            low = c * local[i] - spread if c < local[i] else -1.0
            high = c * local[i] + spread if -c < local[i] else 1.0
            if c >= local[i]:
                high = 1.0
            elif -c >= local[i]:
                low = -1.0
            at = np.flatnonzero((x >= low) & (x <= high) & (block.norms >= need[i]))
            best.offer(i, products(q.matrix[i: i + 1], block.matrix[at])[0], at, block, firsts)


def _search(keep: int):
    """Rows of one stripe after another: its queries, then its blocks from the longest."""
    def search(frames):
        best, key = None, None

        def done():
            rows = [(int(c), -s, v) for c, found in zip(best.q.cids.tolist(), best.found, strict=True) for s, v in found]
            return pd.DataFrame(rows, columns=["qcid", "score", "vec_id"]).astype("int64")

        for frame in frames:
            for row in frame.itertuples():
                if (row.dim, row.qblock, row.stripe) != key:
                    if best is not None:
                        yield done()
                    best, key = None, (row.dim, row.qblock, row.stripe)
                if row.kind == 0:
                    best = Best(Block(row), keep)
                elif best is not None:
                    meet(best, Block(row))
        if best is not None:
            yield done()
    return search


FOUND = "qcid long, score long, vec_id long"


def _stripes(queries: DataFrame, blocks: DataFrame, n: int, keep: int) -> DataFrame:
    """Every query block with every block of its dimension, dealt to ``n`` stripes."""
    sent = queries.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("qblock", F.col("block"))
    per_dim = queries.groupBy("dim").agg(F.collect_set("block").alias("qblocks"))
    met = (blocks.join(per_dim, "dim").withColumn("stripe", F.pmod("block", F.lit(n)).cast("int"))
           .withColumn("qblock", F.explode("qblocks")).drop("qblocks"))
    rows = sent.unionByName(met)
    dealt = rows.repartition("dim", "qblock", "stripe").sortWithinPartitions("dim", "qblock", "stripe", "kind", F.desc("top"), "block")
    return dealt.mapInPandas(_search(keep), FOUND)


def top_k_products(df: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
                   vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest inner products of
    floor(scale * x) vectors over all rows but its own, ties to the smaller id."""
    rows = whole_vectors(df.withColumn("__query", F.coalesce(is_query, F.lit(False))), id_col, vec_col, scale)
    rows = rows.distinct()
    asked = whole_vectors(df.where(F.coalesce(is_query, F.lit(False))), id_col, vec_col, scale).distinct()

    # rows of a query's own id can take up that many places of its list
    keep = k + (asked.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1)

    # at most k + 1 ids of each class; the limit is applied before rows are shuffled
    order = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("cid"), "vec", "ids", F.size("vec").alias("dim"),
                                    norm.alias("norm")), "vectors")

    # length buckets, numbered from the longest; blocks of about BLOCK classes in each
    cuts = sorted(set(classes.agg(F.percentile_approx("norm", [i / BUCKETS for i in range(1, BUCKETS)], 10_000)).first()[0] or []))
    bucket = F.lit(0)
    for c in cuts:
        bucket = bucket + (F.col("norm") <= c).cast("int")
    placed = classes.withColumn("bucket", bucket)
    counts = {r["bucket"]: r["n"] for r in placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    base, per_bucket = 0, {}
    for b in sorted(counts):
        per_bucket[b] = (base, -(-counts[b] // BLOCK))
        base += per_bucket[b][1]
    first, many = (F.element_at(F.create_map(*[F.lit(x) for b, v in per_bucket.items() for x in (b, v[i])]), F.col("bucket")) for i in (0, 1))
    placed = placed.withColumn("block", (first + F.pmod(F.xxhash64("cid"), many)).cast("long"))
    blocks = stored(placed.groupBy("dim", "block").applyInPandas(_pack(1), PACKED), "blocks")

    wanted = stored(asked.select("vec").distinct().join(classes, "vec").select("cid", "vec", "dim", "norm", "ids"), "queries")
    n_queries = wanted.count()
    split = F.pmod(F.xxhash64("cid"), F.lit(max(1, -(-n_queries // QUERY_BLOCK)))).alias("block")
    queries = wanted.select("cid", "vec", "dim", "norm", "ids", split)

    # floors from the longest block of each dimension
    longest = blocks.groupBy("dim").agg(F.max_by("block", F.struct("top", "block")).alias("block"))
    seeds = _stripes(queries.groupBy("dim", "block").applyInPandas(_pack(0), PACKED), blocks.join(longest, ["dim", "block"]), 1, keep)
    floors = (seeds.groupBy("qcid").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("s")).where(F.col("c") >= keep)
              .select(F.col("qcid").alias("cid"), F.col("s").cast("double").alias("floor")))
    floored = queries.join(floors, "cid", "left").fillna({"floor": float("-inf")})
    found = _stripes(floored.groupBy("dim", "block").applyInPandas(_pack(0), PACKED), blocks, min(STRIPES, base), keep)

    best = Window.partitionBy("qcid").orderBy(F.desc("score"), "vec_id")
    top = (found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= keep).groupBy("qcid")
           .agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("top")))
    each = asked.join(wanted.select("vec", F.col("cid").alias("qcid")), "vec").join(top, "qcid")
    own = F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("id")), 1, k)
    return (each.select(F.col("id").alias("query_id"), F.posexplode(own).alias("pos", "t"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score")))
