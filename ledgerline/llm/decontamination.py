"""Operator 1, benchmark decontamination by winnowing.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased.  Both
sides hash every ``K``-gram of words and keep, for each sliding window of ``W``
neighbouring hashes, the smallest one.  ``K + W - 1`` is the span length, so any shared
span of that many words shares a kept hash.  Kept hashes of the benchmark fill a bounded
Bloom filter (``bloom``), which only saves work: a window of a text that holds none of them
cannot be shared.  The windows that pass are joined with the benchmark's whole windows,
word by word; fingerprint positions are not joined and hits are not extended.  Items
shorter than the span are one window of their own length.

Defined cases: a null text has no words and is not hit; null or wordless items have
no window; an item row with a null id marks words but is not listed; repeated item
ids count once; repeated documents give one result row each; an empty benchmark hits
nothing and an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bloom import bloom_of, may_hold
from ledgerline.llm.common import id_field, slices, stored, text_buffer, tidied

SPAN = 13
K, W = 7, 7
#: Bytes that word hashes are computed over at once.
SEGMENT = 1 << 19

_CODE = np.arange(256)
_UPPER = (_CODE >= 0x41) & (_CODE <= 0x5A)
_LOWER = np.where(_UPPER, _CODE | 0x20, _CODE).astype(np.uint8)
_WORD = ((_CODE >= 0x30) & (_CODE <= 0x39)) | ((_CODE >= 0x61) & (_CODE <= 0x7A)) | (_CODE >= 0x80)

_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_Q = np.uint64(0xD6E8FEB86659FD93)


def _powers(p: int, n: int) -> np.ndarray:
    out = np.full(n, p, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POW = _INV = np.zeros(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes spread over all bits, so that the smallest is as good as random."""
    h = (h ^ (h >> np.uint64(32))) * _Q
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) ^ (h >> np.uint64(32))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; start, end and hash of every word; first word of each row (and
    the number of words at the end).  Words never cross rows."""
    global _POW, _INV
    low = _LOWER[data]
    inside = _WORD[low]
    border = np.zeros(data.size + 1, bool)
    border[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.zeros(starts.size, np.uint64)
    i = 0
    while i < starts.size:
        lo = starts[i]
        to = max(i + 1, int(np.searchsorted(ends, lo + SEGMENT, side="right")))
        size = int(ends[to - 1] - lo)
        if _POW.size < size:
            _POW, _INV = _powers(_P, max(size, SEGMENT)), _powers(_P_INV, max(size, SEGMENT))
        sums = np.empty(size + 1, np.uint64)
        sums[0] = 0
        np.cumsum((low[lo: lo + size].astype(np.uint64) + np.uint64(1)) * _POW[:size], out=sums[1:])
        a, b = starts[i:to] - lo, ends[i:to] - lo
        hashes[i:to] = (sums[b] - sums[a]) * _INV[a]
        i = to
    return low, starts, ends, mixed(hashes), np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on (the last ``n - 1`` have none)."""
    out = np.zeros(max(0, hashes.size - n + 1), np.uint64)
    for j in range(n):
        out = out * _Q + hashes[j: j + out.size]
    return mixed(out + np.uint64(n))


def kept(hashes: np.ndarray, span: int) -> np.ndarray:
    """Fingerprint of the ``span``-word window from each word on: the least ``K``-gram
    hash inside, or the hash of all words of a shorter window."""
    if span < K + W - 1:
        return grams(hashes, span)
    g = grams(hashes, K)
    size = max(0, hashes.size - span + 1)
    out = g[:size].copy()
    for j in range(1, span - K + 1):
        np.minimum(out, g[j: j + size], out=out)
    return out


def windows_in(first: np.ndarray, n_words: int, span: int) -> np.ndarray:
    """Flags of the word positions where a window lies within one row."""
    a, b = first[:-1], np.maximum(first[:-1], first[1:] - span + 1)
    change = np.bincount(a, minlength=n_words + 1) - np.bincount(b, minlength=n_words + 1)
    return np.cumsum(change)[: max(0, n_words - span + 1)] > 0


def span_text(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int, n: int) -> str:
    return b" ".join([low[a:b].tobytes() for a, b in zip(starts[i: i + n].tolist(), ends[i: i + n].tolist(), strict=True)]).decode()


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                      span: int = SPAN) -> DataFrame:
    """Distinct windows ``fp, n, words`` with the ids of their items, stored in the
    shared folder."""
    def cut(batches):
        for whole in batches:
            for batch in slices(whole):
                low, starts, ends, hashes, first = words_of(*text_buffer(batch.column("text")))
                row, fp, n, words = [], [], [], []
                for r, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    size = min(span, b - a)
                    if size:
                        of = kept(hashes[a:b], size).view(np.int64).tolist()
                        row += [r] * len(of)
                        fp += of
                        n += [size] * len(of)
                        words += [span_text(low, starts, ends, a + i, size) for i in range(len(of))]
                yield pa.record_batch([batch.column("item").take(pa.array(row, pa.int64())), pa.array(fp, pa.int64()),
                                       pa.array(n, pa.int32()), pa.array(words, pa.string())], names=["item", "fp", "n", "words"])

    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(tidied(cut), "item string, fp long, n int, words string")
    return stored(found.groupBy("fp", "n", "words").agg(F.collect_set("item").alias("items")), "benchmark-windows")


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN,
                  share: int = 20) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items`` per row.  A
    document is contaminated when ``share * n_hit >= n_words`` and it is hit at all."""
    spark = df.sparkSession
    windows = benchmark_windows(benchmark, item_col, item_text_col, span)
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most ``span`` values
    shared = spark.sparkContext.broadcast(bloom_of(windows, "fp"))
    field = id_field(df, id_col)
    out = T.StructType([T.StructField("id", field.dataType), T.StructField("row", T.LongType()), T.StructField("n_words", T.LongType()),
                        T.StructField("start", T.IntegerType()), T.StructField("fp", T.LongType()),
                        T.StructField("n", T.IntegerType()), T.StructField("words", T.StringType())])

    def candidates(batches):
        passes = shared.value.may_hold
        for whole in batches:
            for batch in slices(whole):
                low, starts, ends, hashes, first = words_of(*text_buffer(batch.column("text")))
                ids = batch.column("row").to_numpy(zero_copy_only=False)
                n_words = np.diff(first)
                of_row, at, fps = [np.arange(ids.size)], [np.full(ids.size, -1)], [ids]
                ns, words = [np.zeros(ids.size, int)], [""] * ids.size
                for n in lengths:
                    fp = kept(hashes, n)
                    if not fp.size:
                        continue
                    # neighbouring windows mostly keep the same hash: test each run once
                    run = np.flatnonzero(np.append(True, fp[1:] != fp[:-1]))
                    hit = np.repeat(passes(fp[run]), np.diff(np.append(run, fp.size)))
                    found = np.flatnonzero(hit & windows_in(first, hashes.size, n))
                    if found.size:
                        of = np.searchsorted(first, found, side="right") - 1
                        of_row.append(of)
                        at.append(found - first[of])
                        fps.append(fp[found].view(np.int64))
                        ns.append(np.full(found.size, n))
                        words += [span_text(low, starts, ends, i, n) for i in found.tolist()]
                of = np.concatenate(of_row)
                yield pa.record_batch([batch.column("id").take(pa.array(of)), pa.array(ids[of], pa.int64()), pa.array(n_words[of], pa.int64()),
                                       pa.array(np.concatenate(at), pa.int32()), pa.array(np.concatenate(fps), pa.int64()),
                                       pa.array(np.concatenate(ns), pa.int32()), pa.array(words, pa.string())], names=out.names)

    # every document also sends one row without a window (n = 0), spread by its row number
    numbered = (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
                .withColumn("row", F.monotonically_increasing_id()))
    joined = numbered.mapInArrow(tidied(candidates), out).join(windows, ["fp", "n", "words"], "left")
    hit = F.when(F.col("items").isNotNull(), F.struct(F.col("start").cast("long").alias("a"),
                                                      (F.col("start") + F.col("n")).cast("long").alias("b")))
    per_row = joined.groupBy("row", "id").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.collect_set(hit)).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.aggregate("hits", F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n")),
                          lambda s, h: F.struct(F.greatest(s["to"], h["b"]).alias("to"),
                                                (s["n"] + F.greatest(F.lit(0), h["b"] - F.greatest(s["to"], h["a"]))).alias("n")))["n"]
    judged = per_row.select(F.col("id").alias(field.name), "n_words", covered.alias("n_hit"),
                            F.size("items").cast("long").alias("n_items"),
                            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "items")
    contaminated = (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))
    return judged.withColumn("contaminated", contaminated)


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``df`` without the rows whose text is contaminated (a null text stays)."""
    key = F.sha2(F.col(text_col).cast("binary"), 256)
    keyed = df.select(key.alias("key"), F.col(text_col).alias("text"))
    found = contamination(keyed, benchmark, "key", "text", **options)
    bad = stored(found.where("contaminated").select(F.col("doc_id").alias("__bad")).distinct(), "contaminated")
    # only texts that may be among them are joined
    tag = F.xxhash64(F.coalesce(key, F.lit("")))
    passes = may_hold(df, bloom_of(bad.select(F.xxhash64("__bad").alias("tag")), "tag"), tag)
    marked = df.withColumn("__may", passes)
    asked = marked.where("__may").drop("__may").join(bad, key == F.col("__bad"), "left_anti")
    return marked.where(~F.col("__may")).drop("__may").unionByName(asked)
