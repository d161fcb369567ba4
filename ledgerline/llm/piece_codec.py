"""Operator 5, SentencePiece encoding and decoding with a distinct-chunk table.

Pieces of the model cannot cross a blank's marker, so every marked word is segmented
once (``pieces.PieceTable``, one table per task, bounded) and its ids are
joined back by position in each text.  Ids are decoded by the library.

Defined cases: a null text is an empty one (begin and end only, decoded to an empty
text); repeated rows and ids give one result row each; null ids are kept; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import id_field, slices, texts, tidied
from ledgerline.llm.pieces import sentence_pieces


def _coded(batch: pa.RecordBatch, model: str):
    """Per row of the batch: its ids with begin and end, as uint32."""
    coder = sentence_pieces(model)
    counts, ids = coder.batch(batch.column("text"))
    ends = np.cumsum(counts)
    return np.insert(ids, np.repeat(np.append(0, ends), 2)[1:-1],
                     np.tile(np.array([coder.bos, coder.eos], ids.dtype), len(counts))), ends + 2 * np.arange(1, len(counts) + 1)


def encode_pieces(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int, begin and end ids included)."""
    schema = T.StructType([id_field(df, id_col), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def encode(batches):
        for whole in batches:
            for batch in slices(whole):
                ids, ends = _coded(batch, model)
                yield pa.record_batch([batch.column("id"), pa.ListArray.from_arrays(
                    pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int32)))], names=schema.names)

    return texts(df, id_col, text_col).mapInArrow(tidied(encode), schema)


def decode_pieces(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: the library's ``decode`` of each row's ids (null ids: null text)."""
    schema = T.StructType([id_field(df, id_col), T.StructField("text", T.StringType())])

    def decode(batches):
        lib = sentence_pieces(model).lib
        for batch in batches:
            yield pa.record_batch([batch.column("id"), pa.array(
                [None if x is None else lib.decode(x) for x in batch.column("ids").to_pylist()], pa.string())],
                names=schema.names)

    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(tidied(decode), schema)


def piece_digests(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encodes, then decodes, each text;
    digests of the ids (little-endian unsigned 32-bit) and of the decoded text (UTF-8)."""
    schema = T.StructType([id_field(df, id_col), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def digest(batches):
        lib = sentence_pieces(model).lib
        for whole in batches:
            for batch in slices(whole):
                ids, ends = _coded(batch, model)
                raw, begin, of_ids, of_text = ids.astype("<u4"), 0, [], []
                for end in ends.tolist():
                    row = raw[begin:end]
                    of_ids.append(hashlib.sha256(row).hexdigest())
                    of_text.append(hashlib.sha256(lib.decode(row.tolist()).encode()).hexdigest())
                    begin = end
                yield pa.record_batch([batch.column("id"), pa.array(np.diff(ends, prepend=0), pa.int64()),
                                       pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=schema.names)

    return texts(df, id_col, text_col).mapInArrow(tidied(digest), schema)
