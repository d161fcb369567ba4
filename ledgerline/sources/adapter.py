"""Stand-in raw input built from the driver tables.

The library's jobs start from raw records: one JSON text line per event with the
file it came from, and one CSV row (all strings) per billing record.  The driver
supplies TPC-H-like tables plus an ``events`` table, so this module only
reshapes those rows into that raw form: it renames, reformats and injects the
kinds of defects real feeds carry (missing fields, late and early arrival,
redelivery, repeated lines, schema drift, padded fields, an unknown billing
event).  It does none of the jobs' work: no parsing, hashing, validation,
dedup or aggregation happens here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the stand-in mapping (also used by the DuckDB oracle text).
EVENT_TYPE_RENAMES = {"view": "page_view", "click": "feature_use", "error": "support_ticket"}
DRIFT_DAY = "2024-01-16"            # props gain a `ui_variant` key from this day on
BILLING_EPOCH = "1995-01-01"        # order dates are folded onto a 60-day billing calendar
BILLING_FIRST_DAY = "2024-01-01"
BILLING_DAYS = 60
EVENT_STATUS = {"O": "start", "P": "upgrade", "F": "cancel"}
PLAN_BY_PRIORITY = {"1-URGENT": "team", "2-HIGH": "pro", "3-MEDIUM": "basic", "5-LOW": "free"}


def _q(c: Column) -> Column:
    """JSON string literal of a plain id-like value, or JSON null."""
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _map(c: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(default if default is not None else F.lit(None).cast("string"))


def raw_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event feed: ``(source_file string, value string)``, one JSON line each."""
    ev = _dealt(spark.read.parquet(f"{sf_dir}/events.parquet")
                .select("event_id", "ts", "user_id", "event_type", "props"))
    n = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    us = F.unix_micros(ts)
    received = (F.when(n % 83 == 0, F.lit(None).cast("timestamp"))
                .when(n % 20 == 0, F.timestamp_micros(us + (F.lit(10) + n % 350) * 60_000_000))
                .when(n % 211 == 0, F.timestamp_micros(us - 5_000_000))
                .when(n % 37 == 0, F.timestamp_micros(us + 600_000))
                .when(n % 41 == 0, F.timestamp_micros(us + 400_000))
                .otherwise(ts))
    user = F.when(n % 89 == 0, F.lit(None).cast("string")) \
        .otherwise(F.concat(F.lit("usr_"), F.lpad(F.col("user_id").cast("string"), 5, "0")))
    etype = F.when(n % 97 == 0, F.lit(None).cast("string")) \
        .otherwise(_map(F.col("event_type"), EVENT_TYPE_RENAMES, F.col("event_type")))
    variant = F.when(n % 2 == 0, F.lit("A")).otherwise(F.lit("B"))
    props = F.when(ts >= F.lit(DRIFT_DAY).cast("timestamp"),
                   F.regexp_replace(F.col("props"), r"\}$",
                                    F.concat(F.lit(', "ui_variant": "'), variant, F.lit('"}')))) \
        .otherwise(F.col("props"))
    base = ev.select(
        n.alias("n"), ts.alias("ts"),
        F.concat(F.lit("evt_"), n.cast("string")).alias("event_id"),
        received.alias("received_ts"), user.alias("user_id"),
        F.concat(F.lit("dev_"), (F.col("user_id") % 7).cast("string")).alias("device_id"),
        F.concat(F.lit("sess_"), F.col("user_id").cast("string"), F.lit("_"),
                 (n % 7).cast("string")).alias("session_id"),
        etype.alias("event_type"), props.alias("props"))

    def line(received_col: Column) -> Column:
        parts = [F.lit('{"event_id": '), _q(F.col("event_id")),
                 F.lit(', "event_ts": '), _q(_iso(F.col("ts"))),
                 F.lit(', "received_ts": '), _q(_iso(received_col)),
                 F.lit(', "user_id": '), _q(F.col("user_id")),
                 F.lit(', "device_id": '), _q(F.col("device_id")),
                 F.lit(', "session_id": '), _q(F.col("session_id")),
                 F.lit(', "event_type": '), _q(F.col("event_type"))]
        with_props = F.concat(*parts, F.lit(', "props": '), F.col("props"), F.lit("}"))
        return F.when(F.col("n") % 61 == 0, F.concat(*parts, F.lit("}"))).otherwise(with_props)

    day = F.date_format(F.col("ts"), "yyyy-MM-dd")
    # Copies of each event: 0 = the line in its daily file, 1 = the same line
    # repeated in that file, 2 = a redelivery one hour later in another file.
    copies = F.array(F.lit(0))
    copies = F.when(F.col("n") % 101 == 0, F.array_append(copies, F.lit(1))).otherwise(copies)
    copies = F.when(F.col("n") % 50 == 0, F.array_append(copies, F.lit(2))).otherwise(copies)
    redelivered = F.col("_copy") == 2
    later = F.when(F.col("received_ts").isNull(), F.col("received_ts")) \
        .otherwise(F.timestamp_micros(F.unix_micros(F.col("received_ts")) + 3_600_000_000))
    rows = base.select("*", F.explode(copies).alias("_copy"))
    return rows.select(
        F.concat(F.lit("events/"), day,
                 F.when(redelivered, F.lit("_redelivery.jsonl")).otherwise(F.lit(".jsonl")))
        .alias("source_file"),
        line(F.when(redelivered, later).otherwise(F.col("received_ts"))).alias("value"))


def raw_billing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw billing feed: ``(source_file, billing_date, user_id, event, plan_id)``,
    all strings as a CSV reader returns them (an empty field is null)."""
    o = _dealt(spark.read.parquet(f"{sf_dir}/orders.parquet")
               .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"))
    k = F.col("o_orderkey")
    offset = F.datediff(F.to_date(F.col("o_orderdate")), F.lit(BILLING_EPOCH).cast("date")) % BILLING_DAYS
    day = F.date_format(F.date_add(F.lit(BILLING_FIRST_DAY).cast("date"), offset), "yyyy-MM-dd")
    rows = o.select(
        F.concat(F.lit("billing/"), day, F.lit(".csv")).alias("source_file"),
        F.when(k % 53 == 0, F.concat(F.lit(" "), day, F.lit(" "))).otherwise(day).alias("billing_date"),
        F.concat(F.lit("usr_"), F.lpad(F.col("o_custkey").cast("string"), 5, "0")).alias("user_id"),
        F.when(k % 101 == 0, F.lit("refund"))
         .otherwise(_map(F.col("o_orderstatus"), EVENT_STATUS)).alias("event"),
        _map(F.col("o_orderpriority"), PLAN_BY_PRIORITY).alias("plan_id"),
        # some rows appear twice in their file
        F.explode(F.array_repeat(F.lit(1), F.when(k % 103 == 0, 2).otherwise(1))).alias("_c"))
    return rows.drop("_c")


def _dealt(df: DataFrame) -> DataFrame:
    """Spread a driver table over the cluster's cores, as a scan of a folder of many
    feed files would (the driver tables are single small files, which would
    otherwise scan as one partition).  Round-robin, not by a key: one file or
    one mass-repeated line may hold a third of all rows.  The few columns of the table
    are dealt, not the lines made of them, which take several times as many bytes; the
    lines are then made on all cores."""
    try:
        n = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - a session without a local SparkContext
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    return df.repartition(max(2, n))
