"""Writes a feed as the files it is named after: ``<folder>/<name>``, one per name.

Spark's writers choose part file names; each name's only part is moved to the name by the
file system's own rename (a driver step per file, no data passes it).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.files import BILLING_CSV_SCHEMA


def _land(rows: DataFrame, folder: str, fmt: str, **options) -> None:
    """Write ``file`` plus data columns below ``folder``."""
    spark = rows.sparkSession
    parts = f"{folder}.parts"
    # a file is whole in one task, as one file has to be
    rows.repartition("file").write.partitionBy("file").format(fmt).options(**options).save(parts)
    path = spark._jvm.org.apache.hadoop.fs.Path
    base = path(parts)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for status in fs.listStatus(base):
        if not status.isDirectory():
            continue
        name = unquote(status.getPath().getName().split("=", 1)[1])
        written = [s.getPath() for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith("part-")]
        if len(written) != 1 or not fs.rename(written[0], path(path(folder), name)):
            raise OSError(f"{name} did not land below {folder}")
    fs.delete(base, True)


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumn("file", F.regexp_extract("source_file", r"([^/]+)$", 1))


def land_event_files(lines: DataFrame, folder: str) -> None:
    """JSONL files of ``(source_file, value)`` lines, each with a blank line as feeds have."""
    named = _named(lines).select("file", "value")
    blank = named.select("file").distinct().select("file", F.lit("  ").alias("value"))
    _land(named.unionByName(blank), folder, "text")


def land_billing_files(rows: DataFrame, folder: str) -> None:
    """CSV files with a header line; a null is an empty field, blanks stay."""
    _land(_named(rows).select("file", *BILLING_CSV_SCHEMA.names), folder, "csv", header=True,
          ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
