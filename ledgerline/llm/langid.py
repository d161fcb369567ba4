"""Operator 9, language ID by compression with per-language zstandard dictionaries.

For each language a raw-content dictionary is cut from a bounded sample of labelled
texts.  Every whole text is reduced to its lower-cased words, compressed in blocks
with each dictionary, and given the language with the smallest sum; a narrow margin
to the second language is rejected.  A short text is compressed behind a lead-in from
the dictionary's own end and the lead-in's size is taken off, since zstandard stores
very short inputs as they are.

Bounds: the sample is at most ``SAMPLE_ROWS`` texts a language (by a hash of the id,
short ones first), of a longer one a block of ``SAMPLE_BYTES`` characters from a place
given by the hash; a dictionary is at most
``DICT_BYTES``.  Everything else covers all rows.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and
rejected; equal sizes go to the language that sorts first, with score 0; with one
learned language its score is 1; with none every text is ``und``; rows with a null id
are not learned from and not held out.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import AFTER_TASK, id_field, slices, texts, tidied

SAMPLE_ROWS = 300
SAMPLE_BYTES = 6_000
DICT_BYTES = 1 << 17
#: Block of a text that is compressed at once, and the length under which a lead-in is used.
BLOCK, SHORT, LEAD = 2048, 400, 512
#: Margins below this are rejected.
NARROW = 0.005

#: Numbers that count as word characters (``½``, ``²``, ``Ⅷ``) are no letters.
NUMBERS = frozenset(c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha())
WORD = re.compile(r"[^\W\d_]+")


def words_only(text: str | None) -> bytes:
    if not text:
        return b""
    text = text.lower()
    if not text.isascii():
        for c in NUMBERS.intersection(text):
            text = text.replace(c, " ")
    return " ".join(WORD.findall(text)).encode()


def held_out(id_col: str):
    """True where crc32 of the id as text has remainder 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_dictionaries(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang") -> dict[str, bytes]:
    """Raw-content dictionary of each language of the rows that are not held out."""
    rows = (texts(df, id_col, text_col, F.col(lang_col).cast("string").alias("lang"))
            .where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out("id"))
            .select("lang", F.xxhash64(F.col("id").cast("string")).alias("h"), (F.length("text") > SAMPLE_BYTES).alias("long"),
                    "text"))
    start = F.pmod("h", F.greatest(F.length("text") - SAMPLE_BYTES, F.lit(0)) + 1) + 1
    rows = rows.withColumn("text", F.col("text").substr(start.cast("int"), F.lit(SAMPLE_BYTES)))
    pick = Window.partitionBy("lang").orderBy("long", "h", "text")
    sample = rows.withColumn("n", F.row_number().over(pick)).where(F.col("n") <= SAMPLE_ROWS)

    def dictionary(pdf):
        import pandas as pd
        joined = b" ".join(map(words_only, pdf.sort_values("n")["text"]))[:DICT_BYTES]
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "content": [joined]})

    found = sample.groupBy("lang").applyInPandas(dictionary, "lang string, content binary")
    return {r["lang"]: bytes(r["content"]) for r in found.collect()}


class Compressors:
    """Per language: one compressor for blocks, one for short texts, the lead-in."""

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z
        self.by = {}
        for lang in sorted(dictionaries):
            content = dictionaries[lang]

            def compressor(level, content=content, **more):
                params = z.ZstdCompressionParameters.from_level(level, dict_size=len(content), source_size=BLOCK, **more)
                return z.ZstdCompressor(dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT),
                                        compression_params=params)
            short = compressor(12, min_match=3)
            lead = content[-LEAD:] + b" "
            self.by[lang] = (compressor(6).compress, short.compress, lead, len(short.compress(lead)))

    def sizes(self, words: bytes) -> list[tuple[int, str]]:
        """Compressed bytes and language, smallest first."""
        if len(words) < SHORT:
            out = [(max(1, len(short(lead + words)) - base), lang) for lang, (_, short, lead, base) in self.by.items()]
        else:
            blocks = [words[i: i + BLOCK] for i in range(0, len(words), BLOCK)]
            out = [(sum(len(c(b)) for b in blocks), lang) for lang, (c, *_) in self.by.items()]
        return sorted(out)


_READY: dict[int, tuple[dict, Compressors]] = {}


def _compressors(dictionaries: dict[str, bytes]) -> Compressors:
    key = hash(tuple(sorted(dictionaries.items())))
    if key not in _READY or _READY[key][0] != dictionaries:
        _READY.clear()
        _READY[key] = (dictionaries, Compressors(dictionaries))
    return _READY[key][1]


AFTER_TASK.append(_READY.clear)


def predict_language(df: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
                     keep: list[str] | None = None, narrow: float = NARROW) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` per row, and the columns ``keep`` as
    ``kept_<name>``.

    ``score`` is one less the best size over the second best.
    """
    keep = keep or []
    schema = T.StructType([id_field(df, id_col), T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("rejected", T.BooleanType()), *[T.StructField(f"kept_{c}", df.schema[c].dataType) for c in keep]])
    # at most DICT_BYTES a language
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)

    def predict(batches):
        known = _compressors(shared.value)
        for whole in batches:
            for batch in slices(whole):
                langs, scores = [], []
                for text in batch.column("text").to_pylist():
                    words = words_only(text)
                    ranked = known.sizes(words) if words else []
                    if not ranked:
                        langs.append("und")
                        scores.append(0.0)
                        continue
                    langs.append(ranked[0][1])
                    scores.append(1 - ranked[0][0] / ranked[1][0] if len(ranked) > 1 else 1.0)
                rejected = [s < narrow or x == "und" for s, x in zip(scores, langs, strict=True)]
                yield pa.record_batch([batch.column("id"), batch.column("held"), pa.array(langs, pa.string()),
                                       pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_()),
                                       *[batch.column(f"kept_{c}") for c in keep]], names=schema.names)

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                     held_out(id_col).alias("held"), *[F.col(c).alias(f"kept_{c}") for c in keep])
    return rows.mapInArrow(tidied(predict), schema)


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``df`` without the rows whose language is rejected."""
    known = learn_dictionaries(df, id_col, text_col, lang_col)
    out = predict_language(df, known, id_col, text_col, keep=df.columns)
    return out.where(~F.col("rejected")).select([F.col(f"kept_{c}").alias(c) for c in df.columns])


def language_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict every row."""
    return predict_language(df, learn_dictionaries(df, id_col, text_col, lang_col), id_col, text_col)
