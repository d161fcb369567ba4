"""Bloom filters of 64-bit keys, at most ``MOST_BITS`` bits on any input.

They only save work: what passes is decided by an exact join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import tidied

#: 16 bits a key up to 32 MB; beyond that more keys pass in vain.
LEAST_BITS, MOST_BITS, BITS_A_KEY = 1 << 16, 1 << 28, 16


class Bloom:
    def __init__(self, bits: int):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.bytes = np.zeros(bits >> 3, np.uint8)

    def positions(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = keys.view(np.uint64)
        return ((u * np.uint64(0xD6E8FEB86659FD93)) >> self.shift), ((u * np.uint64(0x9E3779B97F4A7C15)) >> self.shift)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(keys.size, bool)
        for at in self.positions(keys):
            out &= ((self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        return out


def bloom_of(df: DataFrame, col: str) -> Bloom:
    """Filter of a column of longs.  Tasks send the bits they set; at most one row for
    each byte of the filter reaches the driver."""
    n = df.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_KEY * n).bit_length()))
    out = Bloom(bits)

    def set_bits(batches):
        for batch in batches:
            at = np.unique(np.concatenate(out.positions(batch.column("key").to_numpy(zero_copy_only=False)))).astype(np.int64)
            yield pa.record_batch([pa.array(at >> 3), pa.array((1 << (at & 7)).astype(np.int32))], names=["byte", "bit"])

    found = (df.select(F.col(col).cast("long").alias("key")).where("key is not null").mapInArrow(tidied(set_bits), "byte long, bit int")
             .groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow())
    out.bytes[found["byte"].to_numpy()] = found["bits"].to_numpy()
    return out


def may_hold(df: DataFrame, bloom: Bloom, key: Column) -> Column:
    """Column form for rows of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(bloom)

    @F.arrow_udf("boolean")
    def run(col: pa.Array) -> pa.Array:
        return pa.array(shared.value.may_hold(col.to_numpy(zero_copy_only=False)))
    return run(key)
