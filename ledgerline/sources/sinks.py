"""Writers: repeat-safe table appends, full refreshes and small report files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLD_REPORT_SCHEMA = T.StructType([
    T.StructField("fold", T.IntegerType()),
    T.StructField("test_day", T.DateType()),
    T.StructField("rows_test", T.LongType()),
    T.StructField("positives_test", T.LongType()),
    T.StructField("skipped", T.BooleanType()),
    T.StructField("pr_auc", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
])


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table's folder holds anything but markers.  Only the folder is
    asked; a table that is there but cannot be read, or a storage error, raises."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/[!_.]*")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern)
    return found is not None and len(found) > 0


def append_by(df: DataFrame, path: str, column: str) -> None:
    """Append to a table partitioned by ``column``.  Rows are first rebalanced by it, so
    a partition gets a few files of the advisory size: not one from every task, and a
    large partition is split over tasks."""
    df.hint("rebalance", column).write.mode("append").partitionBy(column).parquet(path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a new folder and read it back: later readers take only the columns
    they need, compressed, where a checkpoint holds whole rows."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_folder(path: str) -> str:
    """A new folder name beside ``path``."""
    return f"{path.rstrip('/')}__{uuid.uuid4().hex[:12]}"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """The table at ``new`` takes the place of the one at ``path`` by renames; the old
    one is deleted at the end, or comes back when the new one cannot be renamed."""
    (source, fs), (target, _) = _folder(spark, new), _folder(spark, path)
    old, _ = _folder(spark, fresh_folder(path))
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"cannot move {path} away")
    if not fs.rename(source, target):
        if replaced:
            fs.rename(old, target)
        raise OSError(f"cannot move {new} to {path}")
    if replaced:
        fs.delete(old, True)


def switch_location(spark: SparkSession, table: str, folder: str) -> None:
    """Point a catalog table of Parquet files at ``folder`` (created when missing):
    readers see the old files or the new ones, also where a rename is a copy."""
    location = folder.replace("\\", "\\\\").replace("'", "\\'")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")


def write_report_csv(df: DataFrame, path: str) -> None:
    """A result-sized report as one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def write_report_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def read_fold_report(spark: SparkSession, path: str) -> DataFrame:
    """The fold CSV report read back with its explicit schema (no inference)."""
    return spark.read.option("header", "true").schema(FOLD_REPORT_SCHEMA).csv(path)
