"""Corpus pipeline over ``documents``: each stage's rows are written as Parquet in the
cluster's shared folder and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, table
from ledgerline.llm.decontamination import drop_contaminated
from ledgerline.llm.langid import keep_identified
from ledgerline.llm.lsh_forest import keep_one_of_each
from ledgerline.llm.piece_codec import piece_digests
from ledgerline.llm.queries import PIECE_BPE, tokenizer_path
from ledgerline.llm.secret_scan import redacted


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents whose language is rejected go."""
    return keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of near copies the document with the least id stays."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents contaminated by the benchmark go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: every span found is replaced by ``[SECRET]``; ``n_chars`` follows."""
    clean = docs.withColumn("text", redacted(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: every remaining text is encoded and decoded."""
    return piece_digests(docs, tokenizer_path(PIECE_BPE))


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminate),
    ("secret scan", secrets),
    ("SentencePiece", encode),
]

#: No SQL for compression, MinHash and tokenizer stages; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
