"""Directory scans of the raw feeds (B1, B5's CSV side) and report sinks."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import strip

BILLING_CSV_SCHEMA = T.StructType([
    T.StructField("billing_date", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("plan_id", T.StringType()),
])


class NoInputFiles(RuntimeError):
    """The directory exists but no file matches the glob."""


def relative_name(path_col):
    """``<folder>/<file name>`` of a file path, so hashes do not depend on where
    the feed folder is mounted (the folder name is kept: events/..., billing/...)."""
    # the metadata column gives an encoded path; a plus sign in a name is a plus sign
    plain = F.url_decode(F.replace(path_col, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(plain, r"([^/]+/[^/]+)$", 1)


def _pick_files(spark: SparkSession, reader, root: str, glob: str, limit_files: int):
    """What to load: the folder itself, or its first ``limit_files`` files by name (from
    the file index; no data is read)."""
    probe = reader.option("pathGlobFilter", glob).load(root)
    files = sorted(unquote(f) for f in probe.inputFiles())
    if not files:
        raise NoInputFiles(f"no files matched {root}/{glob}")
    if limit_files and limit_files > 0:
        return sorted(files, key=lambda p: p.rsplit("/", 1)[-1])[:limit_files]
    return root


def scan_jsonl(spark: SparkSession, root: str, glob: str = "*.jsonl",
               limit_files: int = 0) -> DataFrame:
    """Raw JSON lines of every matching file: ``(source_file, value)``.

    Blank lines are skipped; ``source_file`` is ``<folder>/<file name>``.  A missing ``root`` raises Spark's
    PATH_NOT_FOUND; an empty match raises :class:`NoInputFiles`.
    """
    files = _pick_files(spark, spark.read.format("text"), root, glob, limit_files)
    df = spark.read.format("text").option("pathGlobFilter", glob).load(files)
    return (df.select(relative_name(F.col("_metadata.file_path")).alias("source_file"),
                      F.col("value"))
              .where(strip(F.col("value")) != ""))


def scan_billing_csv(spark: SparkSession, root: str, glob: str = "*.csv",
                     limit_files: int = 0) -> DataFrame:
    """Billing CSV rows (header line, all strings) with ``source_file``."""
    files = _pick_files(spark, spark.read.format("csv").option("header", "true")
                        .schema(BILLING_CSV_SCHEMA), root, glob, limit_files)
    df = spark.read.option("pathGlobFilter", glob).csv(files, header=True, schema=BILLING_CSV_SCHEMA)
    return df.select(relative_name(F.col("_metadata.file_path")).alias("source_file"),
                     "billing_date", "user_id", "event", "plan_id")
