"""Operator 8, token-id files: a concatenated id array with Elias-Fano document borders.

One file holds the ids of a run of documents in ascending id order::

    magic, number of documents, null ids, ids, bytes per id       five little-endian uint64
    document borders (running end of each document), Elias-Fano
    document ids above the smallest, Elias-Fano
    ids, 2 bytes each where the vocabulary allows it, else 4

An Elias-Fano section keeps the low ``k`` bits of each value packed and the rest as a
unary bit vector with the bit position of every 256th one, about ``2 + log2(max / n)``
bits a value; ``EliasFano.select`` finds one value without reading the others, and
``values`` a run of them from the stored positions at its ends.  ``TokenFile`` reads a
document, or runs of ``READ_DOCS`` documents, by selects on the borders and ranged reads
of the ids; the query's offsets come from it, without a table of 64-bit borders.

Files are written by tasks into the cluster's shared folder under names no other
attempt uses.  The manifest table, written by Spark's own committer, names the files
that count, so lost executors and repeated tasks leave nothing wrong behind.

Defined cases: a null text has the end id only; null document ids come first; rows
with equal ids are ordered by a hash of their text; an empty table gives no file and
no rows.
"""

from __future__ import annotations

import io
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import scratch, slices, stored, tidied
from ledgerline.llm.pieces import byte_level

MAGIC = 0x314B4F5446454C31
#: Every so many-th one has its bit position stored.
SAMPLE = 256
#: Ids of one file at most, but for a longer single document.
FILE_IDS = 1 << 24
#: Documents whose borders are selected at once.
READ_DOCS = 1 << 12


class EliasFano:
    """A non-decreasing sequence of non-negative integers in near-minimal space."""

    def __init__(self, n: int, k: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.k, self.low, self.high, self.samples = n, k, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = values.astype(np.uint64)
        n = v.size
        top = int(v[-1]) if n else 0
        k = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.packbits(((v[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(),
                          bitorder="little") if k else np.zeros(0, np.uint8)
        ones = (v >> np.uint64(k)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, k, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32 if bits.size < 2**32 else np.uint64))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.k, self.low.size, self.high.size, self.samples.itemsize], "<u8")
        return b"".join([head.tobytes(), self.low.tobytes(), self.high.tobytes(), self.samples.astype(f"<u{self.samples.itemsize}").tobytes()])

    @classmethod
    def read(cls, raw: memoryview) -> tuple[EliasFano, memoryview]:
        """The sequence at the front of ``raw`` and what follows it."""
        n, k, n_low, n_high, width = np.frombuffer(raw[:40], "<u8").tolist()
        at = 40
        low = np.frombuffer(raw[at: at + n_low], np.uint8)
        high = np.frombuffer(raw[at + n_low: at + n_low + n_high], np.uint8)
        at += n_low + n_high
        n_samples = -(-n // SAMPLE) * width
        return cls(n, k, low, high, np.frombuffer(raw[at: at + n_samples], f"<u{width}")), raw[at + n_samples:]

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(i.size, np.uint64)
        for b in range(self.k):
            at = i * self.k + b
            out |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """The ``i``-th value: from the nearest stored position, count ones forward."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start, need = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = start >> 3, start & 7
        step = 64
        window = np.unpackbits(self.high[byte: byte + step], bitorder="little")[skip:]
        ones = np.flatnonzero(window)
        while ones.size <= need:
            step *= 2
            ones = np.flatnonzero(np.unpackbits(self.high[byte: byte + step], bitorder="little")[skip:])
        upper = start + int(ones[need]) - i
        return (upper << self.k) | int(self._low(np.array([i]))[0])

    def values(self, a: int, b: int) -> np.ndarray:
        """The values ``a <= i < b``, as int64: only the upper bits between the stored
        positions around them are looked at."""
        if not 0 <= a <= b <= self.n:
            raise IndexError((a, b))
        if a == b:
            return np.zeros(0, np.int64)
        block, after = a // SAMPLE, -(-b // SAMPLE)
        first = int(self.samples[block])
        end = int(self.samples[after]) if after < self.samples.size else 8 * self.high.size
        bits = np.unpackbits(self.high[first >> 3: -(-end // 8)], bitorder="little")[first & 7:]
        i = np.arange(a, b)
        upper = first + np.flatnonzero(bits)[a - block * SAMPLE: b - block * SAMPLE] - i
        return ((upper.astype(np.uint64) << np.uint64(self.k)) | self._low(i)).astype(np.int64)

    def all(self) -> np.ndarray:
        """Every value, as int64."""
        return self.values(0, self.n)


def file_bytes(doc_ids: list, counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """One file.  ``doc_ids`` ascending with nulls first; ``counts`` ids per document."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if known.size else 0
    head = np.array([MAGIC, len(doc_ids), len(doc_ids) - known.size, ids.size, width], "<u8").tobytes()
    return b"".join([head, np.array([least], "<i8").tobytes(), EliasFano.of(np.cumsum(counts)).to_bytes(),
                     EliasFano.of(known - least).to_bytes(), ids.astype(f"<u{width}").tobytes()])


class TokenFile:
    """A file opened for random access; the ids stay in it until they are asked for."""

    def __init__(self, file):
        self.file = file
        magic, self.docs, self.nulls, self.total, self.width = np.frombuffer(file.read(40), "<u8").tolist()
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        self.least = int(np.frombuffer(file.read(8), "<i8")[0])
        self.borders, self.known = self._section(), self._section()
        self.at = file.tell()

    def _section(self) -> EliasFano:
        head = self.file.read(40)
        n, _, n_low, n_high, width = np.frombuffer(head, "<u8").tolist()
        return EliasFano.read(memoryview(head + self.file.read(n_low + n_high + -(-n // SAMPLE) * width)))[0]

    def doc_ids(self, a: int, b: int) -> list:
        """Ids of the documents ``a <= i < b``; nulls come first."""
        lead = max(0, min(b, self.nulls) - a)
        known = self.known.values(max(a, self.nulls) - self.nulls, max(b, self.nulls) - self.nulls)
        return [None] * lead + (known + self.least).tolist()

    def start(self, i: int) -> int:
        """Ids in the file before document ``i``."""
        return self.borders.select(i - 1) if i else 0

    def ids(self, a: int, b: int) -> np.ndarray:
        self.file.seek(self.at + a * self.width)
        return np.frombuffer(self.file.read((b - a) * self.width), f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i``, by two selects and one ranged read."""
        end = self.borders.select(i)
        return self.ids(self.start(i), end)

    def runs(self, size: int | None = None):
        """``(document ids, starts, ends, token ids)`` of runs of documents."""
        size = size or READ_DOCS
        for a in range(0, self.docs, size):
            b = min(self.docs, a + size)
            base, ends = self.start(a), self.borders.values(a, b)
            yield self.doc_ids(a, b), np.append(base, ends[:-1]), ends, self.ids(base, int(ends[-1]))


def read_file(raw: bytes) -> tuple[list, EliasFano, np.ndarray]:
    """Document ids, borders and ids of a file."""
    f = TokenFile(io.BytesIO(raw))
    return f.doc_ids(0, f.docs), f.borders, f.ids(0, f.total)


def _store(uri: str):
    """File system and path of a folder's URI, for use inside tasks."""
    from pyarrow import fs
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    elif uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_token_files(df: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of all rows as files under ``folder`` and return the manifest
    ``part, run, path, docs, ids`` (also kept as a table in the shared folder).

    Rows are dealt by ranges of (id, text hash), so that a repeated id can fill
    several files and no task holds more than its share.
    """
    spark = df.sparkSession
    folder = folder or scratch(spark, "token-files")
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h"))

    def write(batches):
        from pyspark import TaskContext
        coder = byte_level(tokenizer)
        width = 2 if max(coder.width.size - 1, end_id) < 1 << 16 else 4
        part, run = TaskContext.get().partitionId(), 0
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        docs, counts, ids, held = [], [], [], 0

        def flush():
            path = f"{base}/part-{part:06d}-{run:04d}-{uuid.uuid4().hex}.ids"
            all_counts = np.concatenate(counts)
            all_ids = np.concatenate(ids)
            with store.open_output_stream(path) as out:
                out.write(file_bytes(docs, all_counts, all_ids, width))
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([run], pa.int32()), pa.array([path]),
                                    pa.array([len(docs)], pa.int64()), pa.array([all_ids.size], pa.int64())],
                                   names=["part", "run", "path", "docs", "ids"])

        for whole in batches:
            for batch in slices(whole):
                n, flat = coder.batch(batch.column("text"))
                flat = np.insert(flat.astype(f"u{width}"), np.cumsum(n), end_id)
                docs += batch.column("id").to_pylist()
                counts.append(n + 1)
                ids.append(flat)
                held += flat.size
                if held >= FILE_IDS:
                    yield flush()
                    run, held = run + 1, 0
                    docs, counts, ids = [], [], []
        if docs:
            yield flush()

    return stored(rows.mapInArrow(tidied(write), "part int, run int, path string, docs long, ids long"), "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files;
    ``start`` counts the ids of all documents before it."""
    # one row a file: running sums over the manifest alone
    order = Window.orderBy("part", "run").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0)))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def read(batches):
        store, _ = _store(folder)
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with store.open_input_file(path) as f:
                    for docs, starts, ends, ids in TokenFile(f).runs():
                        edges = (ends - starts[0]).tolist()
                        crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip([0, *edges[:-1]], edges, strict=True)]
                        yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(starts + base, pa.int64()),
                                               pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())], names=schema.names)

    return placed.select("path", "base").repartition(F.col("path")).mapInArrow(tidied(read), schema)


def token_file_digests(df: DataFrame, tokenizer: str, end_id: int = 0,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all rows as token-id files in the shared folder and read them back."""
    spark = df.sparkSession
    folder = scratch(spark, "token-files")
    return read_token_files(spark, write_token_files(df, tokenizer, folder, end_id, id_col, text_col), folder)
