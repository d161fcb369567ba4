"""Operator 2, token counts: batch encoding in Arrow functions that return lengths only.

Rows are worked on in batches balanced by bytes; texts are split at boundaries that
the tokenizer never crosses (``pieces``), so that one very long text costs no more
memory than many short ones and each distinct piece is encoded once per task.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows and
ids give one result row each; null ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.common import id_field, slices, text_lengths, texts, tidied
from ledgerline.llm.pieces import byte_level


def token_counts(df: DataFrame, tokenizer: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row; ``tokenizer`` is the path of a
    ``tokenizers`` file."""
    schema = T.StructType([id_field(df, id_col), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches):
        coder = byte_level(tokenizer)
        for whole in batches:
            for batch in slices(whole):
                n, _ = coder.batch(batch.column("text"), ids_wanted=False)
                yield pa.record_batch([batch.column("id"), pa.array(text_lengths(batch.column("text")), pa.int64()),
                                       pa.array(n, pa.int64()), pa.array(n > limit)], names=schema.names)

    return texts(df, id_col, text_col).mapInArrow(tidied(count), schema)
