"""Operator 10, n-gram Jaccard join by MinHash bands and exact verification.

Texts are sets of ``SHINGLE``-word shingles (words as in operator 1; a shorter text is
one shingle of all its words).  Texts with the same words in the same order are one
class and go through the join once.

Signatures have ``TREES`` bands.  All bands match on the longest prefix, of at most
``DEPTH`` values, that finds a pair at the threshold with probability ``RECALL`` over all
bands (5 values at 0.8); the length is computed once, the tries of a forest are not
sorted nor shortened level by level.  Classes that share a band fall into one candidate
component; in a component, *every* pair is verified on the exact shingle sets, so a pair
missed by all bands is still found where other texts connect it.

Candidate components over ``BLOCK`` classes or ``BLOCK_SHINGLES`` shingles are cut into blocks by a hash, and each pair
of blocks is a task of its own; a task gives link counts and a spanning forest, never
the pairs themselves.  Sets are shipped once per block pair, and only for classes that
have a candidate; a Bloom filter keeps all other texts out of the shuffle.

Defined cases: a null or wordless text has no shingles, no links and its own class;
repeated rows are copies of each other; null ids are allowed (they sort last as a
class's name); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bloom import bloom_of, may_hold
from ledgerline.llm.common import id_field, slices, stored, text_buffer, tidied
from ledgerline.llm.components import connected_components
from ledgerline.llm.decontamination import grams, mixed, windows_in, words_of

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 32, 8, 0.99999
#: Classes of one block and, on average, shingles of one; shingle columns multiplied, and
#: shingles ranked, at once.
BLOCK, BLOCK_SHINGLES, COLUMNS, RANKED = 512, 1 << 21, 8192, 1 << 19
SEED = 20_240_229


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Longest matched prefix that reaches the recall, shortening from ``depth``."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows back to back (with repeats) and their ``rows + 1`` offsets."""
    n_words = np.diff(first)
    full = grams(hashes, size)
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    offsets = np.append(0, np.cumsum(counts))
    if not (n_words[n_words > 0] < size).any():
        return full[windows_in(first, hashes.size, size)], offsets
    out = np.zeros(offsets[-1], np.uint64)
    long = np.repeat(n_words >= size, counts)
    out[long] = full[windows_in(first, hashes.size, size)] if full.size else full
    for r in np.flatnonzero((n_words > 0) & (n_words < size)).tolist():
        out[offsets[r]] = grams(hashes[first[r]:first[r + 1]], int(n_words[r]))[0]
    return out, offsets


def signatures(sh: np.ndarray, offsets: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Per row with shingles, the hash of each tree's prefix of ``depth`` minima."""
    some = np.flatnonzero(np.diff(offsets))
    starts = offsets[some]
    low = (sh >> np.uint64(32)).astype(np.uint32)
    rng = np.random.default_rng(SEED)
    seeds = rng.integers(0, 1 << 32, (trees, depth, 2), dtype=np.uint32) | np.uint32(1)
    out = np.zeros((some.size, trees), np.uint64)
    for t in range(trees):
        for d in range(depth):
            x = (low ^ seeds[t, d, 0]) * seeds[t, d, 1]
            x ^= x >> np.uint32(15)
            least = np.minimum.reduceat(x, starts) if some.size else x[:0]
            out[:, t] = mixed(out[:, t] * np.uint64(31) + least.astype(np.uint64) + np.uint64(t + 1))
    return out


def _word_keys(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's word sequence."""
    n_words = np.diff(first)
    at = (np.arange(hashes.size) - np.repeat(first[:-1], n_words)).astype(np.uint64)
    some, keys = np.flatnonzero(n_words), []
    for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        x = mixed(hashes + at * np.uint64(c))
        out = np.zeros(n_words.size, np.uint64)
        if some.size:
            out[some] = np.add.reduceat(x, first[some])
        keys.append(mixed(out + n_words.astype(np.uint64)))
    return keys[0], keys[1]


def forest(df: DataFrame, id_col: str, text_col: str, size: int, trees: int, depth: int) -> DataFrame:
    """``id, text_md5, k1, k2, shingles, tries`` per row; keys and tries null without shingles."""
    field = id_field(df, id_col, "id")
    schema = T.StructType([field, T.StructField("md5", T.StringType()), T.StructField("k1", T.LongType()),
                           T.StructField("k2", T.LongType()), T.StructField("shingles", T.LongType()),
                           T.StructField("tries", T.ArrayType(T.LongType()))])

    def sign(batches):
        for whole in batches:
            for batch in slices(whole):
                _, _, _, hashes, first = words_of(*text_buffer(batch.column("text")))
                sh, offsets = shingles(hashes, first, size)
                some = np.diff(offsets) > 0
                sig = signatures(sh, offsets, trees, depth).view(np.int64)
                k1, k2 = (pa.array(k.view(np.int64), mask=~some) for k in _word_keys(hashes, first))
                ends = np.append(0, np.cumsum(some * trees)).astype(np.int32)
                tries = pa.ListArray.from_arrays(pa.array(ends), pa.array(sig.ravel()), mask=pa.array(~some))
                yield pa.record_batch([batch.column("id"), batch.column("md5"), k1, k2, pa.array(np.diff(offsets), pa.int64()), tries], names=schema.names)

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.withColumn("md5", F.md5(F.col("text").cast("binary"))).mapInArrow(tidied(sign), schema)


def shingle_sets(rows: DataFrame, size: int) -> DataFrame:
    """``cid, sets``: distinct shingle hashes of each text, sorted, as 8-byte integers."""
    def cut(batches):
        for whole in batches:
            for batch in slices(whole):
                _, _, _, hashes, first = words_of(*text_buffer(batch.column("text")))
                sh, offsets = shingles(hashes, first, size)
                out = [np.unique(sh[a:b]).tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.record_batch([batch.column("cid"), pa.array(out, pa.binary())], names=["cid", "sets"])

    return rows.select("cid", "text").mapInArrow(tidied(cut), "cid long, sets binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of every left set with every right one (or every left
    one): shared shingles become columns of a 0/1 matrix, multiplied in runs.  The sorted
    sets are taken by ranges of some ``RANKED`` shingles, which bounds the memory."""
    sets = left + (right or [])
    parts = -(-sum(s.size for s in sets) // RANKED)
    if parts <= 1:
        return _range_overlaps(sets, len(left), right is not None)
    cuts = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
    edges = [np.concatenate([[0], np.searchsorted(s, cuts), [s.size]]) for s in sets]
    out = 0
    for k in range(parts):
        out += _range_overlaps([s[e[k]: e[k + 1]] for s, e in zip(sets, edges, strict=True)], len(left), right is not None)
    return out


def _range_overlaps(sets: list[np.ndarray], n: int, two: bool) -> np.ndarray:
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = count[column] > 1
    row, column = row[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((n, len(sets) - n if two else n), np.int64)
    width = int(column[-1]) + 1 if column.size else 0
    for lo in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, width - lo)), np.float32)
        m[row[a:b], column[a:b] - lo] = 1
        out += (m[:n] @ (m[n:] if two else m).T).astype(np.int64)
    return out


def verified(threshold: float):
    """Group function: link counts and spanning forest of one pair of blocks."""
    def verify(group: pa.Table) -> pa.Table:
        cid = group.column("cid").to_numpy()
        size = group.column("n").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for chunk in group.column("sets").chunks for s in chunk]
        second = group.column("second").to_numpy(zero_copy_only=False).astype(bool)
        within = not second.any()
        at = [np.flatnonzero(~second), np.flatnonzero(second)]
        if within:
            at[1] = at[0]
        left, right = [sets[i] for i in at[0]], [sets[i] for i in at[1]]
        links, root = np.zeros(cid.size, np.int64), list(range(cid.size))
        if left and right:
            common = overlaps(left, None if within else right)
            n1, n2 = np.array([len(s) for s in left]), np.array([len(s) for s in right])
            ok = (1 + threshold) * common >= threshold * (n1[:, None] + n2) - 1e-9
            if within:
                np.fill_diagonal(ok, False)
            links[at[0]] += ok @ size[at[1]]
            if not within:
                links[at[1]] += ok.T @ size[at[0]]

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, row in zip(at[0].tolist(), ok, strict=True):
                for j in at[1][row].tolist():
                    a, b = find(i), find(j)
                    if a != b:
                        root[max(a, b)] = min(a, b)
            roots = [find(x) for x in range(cid.size)]
        else:
            roots = root
        return pa.table([pa.array(cid), pa.array(cid[roots]), pa.array(links)], names=["cid", "root", "links"])
    return verify


def _blocks(size: Column, total: Column, cid: Column, block: int, block_shingles: int = BLOCK_SHINGLES) -> Column:
    """``i, j, second``: the block pairs of a class, by the classes and shingles of its component."""
    n = F.greatest(F.ceil(size / block), F.least(F.ceil(total / block_shingles), size)).cast("int")
    own = F.pmod(F.xxhash64(cid), n).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda x: F.struct(
        F.least(own, x).alias("i"), F.greatest(own, x).alias("j"), (own > x).alias("second")))


def jaccard_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL,
                    block: int = BLOCK) -> DataFrame:
    """``doc_id, class_id, copy_id, n_links`` per row: the least id of the row's connected
    group under links of Jaccard similarity ``threshold`` or more, the least id with the
    same words in the same order, and the number of other rows it links to."""
    field = id_field(df, id_col)
    rows = stored(forest(df, id_col, text_col, size, trees, prefix_length(threshold, trees, depth, recall)), "forest")
    known = rows.where(F.col("k1").isNotNull())
    least = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("md5").alias("md5")))
    classes = known.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), least.alias("rep"), F.max("shingles").alias("shingles"),
                                          F.max("tries").alias("tries"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("cid"), "k1", "k2", "n", "shingles",
                                    F.col("rep.id").alias("id"), F.col("rep.md5").alias("md5"), "tries"), "classes")

    # classes that share a prefix: a star around the least of each
    leaves = classes.select("cid", F.posexplode("tries").alias("tree", "prefix"))
    shared = leaves.groupBy("tree", "prefix").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1")
    edges = leaves.join(shared.drop("c"), ["tree", "prefix"]).where("cid != hub").select("cid", "hub").distinct()
    candidates = connected_components(edges, "cid", "hub")
    found = candidates.join(classes.select(F.col("cid").alias("node"), "n", "shingles", "id", "md5"), "node")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.sum("shingles").alias("total"))
    placed = stored(found.join(sizes, "component")
                    .select(F.col("node").alias("cid"), "component", "size", "total", "n", F.col("id").alias("rep_id"), "md5"), "candidates")

    # the sets of one row of each such class
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("text_md5", F.md5(F.col("text").cast("binary")))
    passes = may_hold(df, bloom_of(placed.select(F.xxhash64(F.struct("rep_id"), "md5").alias("tag")), "tag"),
                      F.xxhash64(F.struct("id"), F.col("text_md5")))
    picked = (texts.where(passes).join(placed.select("cid", "rep_id", "md5"), (F.col("text_md5") == F.col("md5")) & F.col("id").eqNullSafe(F.col("rep_id")))
              .select("cid", "text"))
    sets = shingle_sets(picked, size).dropDuplicates(["cid"])
    parts = (sets.join(placed.select("cid", "component", "size", "total", "n"), "cid")
             .select("cid", "component", "n", "sets", F.explode(_blocks(F.col("size"), F.col("total"), F.col("cid"), block)).alias("p"))
             .select("cid", "component", "n", "sets", "p.*"))
    checked = stored(parts.groupBy("component", "i", "j").applyInArrow(verified(threshold), "cid long, root long, links long"), "links")

    # rows of a class: its own copies and those of linked classes
    links = checked.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = connected_components(checked.select("cid", "root"), "cid", "root").withColumnRenamed("node", "cid")
    named = classes.select("cid", "k1", "k2", "n", "id").join(links, "cid", "left").join(groups, "cid", "left")
    named = named.withColumn("group", F.coalesce("component", "cid"))
    heads = (named.where("component is not null").groupBy("group")
             .agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id")))["id"].alias("head")))
    named = (named.join(heads, "group", "left")
             .select("k1", "k2", F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("head")).alias("class_id"),
                     F.col("id").alias("copy_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    out = rows.select("id", "k1", "k2").join(named, ["k1", "k2"], "left")
    alone = F.col("k1").isNull()
    return out.select(F.col("id").alias(field.name), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with one row of each group of near copies: the one with the least id (of
    several rows with that id, the least hash of the text; of equal rows, any)."""
    digest = F.md5(F.col(text_col).cast("binary"))
    keyed = df.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), digest.alias("md5")).alias("key"),
                      F.col(text_col).alias("text"))
    found = jaccard_classes(keyed, "key", "text", **options)
    name = lambda key: F.concat_ws(":", F.coalesce(key["id"].cast("string"), F.lit("-")), F.coalesce(key["md5"], F.lit("-")))
    heads = found.select(name(F.col("class_id")).alias("__key")).distinct()
    own = name(F.struct(F.col(id_col).alias("id"), digest.alias("md5")))
    return df.withColumn("__key", own).join(heads, "__key", "left_semi").dropDuplicates(["__key"]).select(df.columns)
