"""Wiring of one data set: raw feeds -> bronze -> silver -> staging -> marts.

Each layer is a function of the DataFrames below it (the lineage graph of the
source system's `ref()`s becomes plain function composition).  A ``Lake``
builds every relation once per instance, so queries composed from it share the
same plan fragments (Spark then reuses their exchanges).  ``materialize``
writes the marts that are read several times to Parquet under the session's
checkpoint folder and reads them back, cutting lineage.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import bronze as B
from ledgerline.operators import marts as M
from ledgerline.operators import monitor as MON
from ledgerline.operators import silver as S
from ledgerline.operators import staging as G
from ledgerline.session import checkpoint_dir, use_utc
from ledgerline.sources import adapter, landing, sinks


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str,
                 ingestion_ts: str = B.DEFAULT_INGESTION_TS,
                 empty_as_null: bool = True,
                 raw_events: DataFrame | None = None,
                 raw_billing: DataFrame | None = None):
        use_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.ingestion_ts = ingestion_ts
        self.empty_as_null = empty_as_null
        self._raw_events = raw_events
        self._raw_billing = raw_billing

    # ---- raw feeds -------------------------------------------------------
    @cached_property
    def raw_event_lines(self) -> DataFrame:
        if self._raw_events is not None:
            return self._raw_events
        return adapter.raw_event_lines(self.spark, self.sf_dir)

    @cached_property
    def raw_billing_rows(self) -> DataFrame:
        if self._raw_billing is not None:
            return self._raw_billing
        return adapter.raw_billing_rows(self.spark, self.sf_dir)

    # ---- the feeds as files ----------------------------------------------
    @cached_property
    def feed_folder(self) -> str:
        """A fresh folder of the shared checkpoint folder for landed feed files."""
        return f"{checkpoint_dir(self.spark)}/feeds/{uuid.uuid4().hex}"

    @cached_property
    def events_folder(self) -> str:
        landing.land_event_files(self.raw_event_lines, f"{self.feed_folder}/events")
        return f"{self.feed_folder}/events"

    @cached_property
    def billing_folder(self) -> str:
        landing.land_billing_files(self.raw_billing_rows, f"{self.feed_folder}/billing")
        return f"{self.feed_folder}/billing"

    # ---- bronze ----------------------------------------------------------
    @cached_property
    def parsed_events(self) -> DataFrame:
        # raw lines come from a scan (B1), which has already dropped blank lines
        return B.parse_event_lines(self.raw_event_lines, self.ingestion_ts)

    @cached_property
    def bronze_events(self) -> DataFrame:
        return B.append_new(self.parsed_events, None)

    @cached_property
    def parsed_billing(self) -> DataFrame:
        return B.parse_billing_rows(self.raw_billing_rows, self.ingestion_ts,
                                    empty_as_null=self.empty_as_null)

    @cached_property
    def bronze_billing(self) -> DataFrame:
        return B.append_new(self.parsed_billing, None)

    # ---- silver ----------------------------------------------------------
    @cached_property
    def silver_events(self) -> DataFrame:
        return S.silver_events(self.bronze_events)

    @cached_property
    def events_quarantine(self) -> DataFrame:
        return S.events_quarantine(self.bronze_events)

    @cached_property
    def silver_billing(self) -> DataFrame:
        return S.silver_billing(self.bronze_billing)

    @cached_property
    def billing_quarantine(self) -> DataFrame:
        return S.billing_quarantine(self.bronze_billing)

    # ---- staging ---------------------------------------------------------
    @cached_property
    def stg_events(self) -> DataFrame:
        return G.stg_events(self.silver_events)

    @cached_property
    def stg_billing(self) -> DataFrame:
        return G.stg_billing(self.silver_billing)

    # ---- marts -----------------------------------------------------------
    @cached_property
    def fct_events_daily(self) -> DataFrame:
        return M.fct_events_daily(self.stg_events)

    @cached_property
    def fct_billing_daily(self) -> DataFrame:
        return M.fct_billing_daily(self.stg_billing)

    @cached_property
    def billing_bounds(self):
        """First and last billing day, evaluated once per lake."""
        return M.billing_bounds_literal(self.stg_billing)

    @cached_property
    def day_bounds(self):
        """First and last day of the daily marts, evaluated once per lake."""
        return MON.bounds_literal(MON.feed_bounds(self.stg_events, self.stg_billing))

    @cached_property
    def fct_subscriptions_daily(self) -> DataFrame:
        return M.fct_subscriptions_daily(self.stg_billing, self.billing_bounds)

    @cached_property
    def gold_churn_labels_daily(self) -> DataFrame:
        return M.gold_churn_labels_daily(self.fct_subscriptions_daily)

    @cached_property
    def gold_user_features_daily(self) -> DataFrame:
        _, last_day = self.billing_bounds
        return M.gold_user_features_daily(self.fct_subscriptions_daily, self.stg_events,
                                          last_day=last_day)

    @cached_property
    def gold_churn_by_plan_daily(self) -> DataFrame:
        return M.gold_churn_by_plan_daily(self.gold_user_features_daily)

    # ---- persistence -----------------------------------------------------
    def materialize(self, name: str) -> DataFrame:
        """Write a relation to Parquet in the shared checkpoint folder and swap
        in the re-read table (cuts lineage; survives executor loss)."""
        out = self.store(getattr(self, name), name)
        self.__dict__[name] = out
        return out

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` to the shared checkpoint folder and read it back."""
        return sinks.stored(df, f"{checkpoint_dir(self.spark)}/ledgerline/{name}-{uuid.uuid4().hex}")


# Table layout of a built lake: partition columns chosen for pruning (days for
# the time-filtered layers, the source file for bronze's repeat check).
LAYOUT = {
    "bronze_events": ["source_file"],
    "bronze_billing": ["source_file"],
    "silver_events": ["event_day"],
    "events_quarantine": [],
    "silver_billing": ["billing_date"],
    "billing_quarantine": [],
    "fct_events_daily": [],
    "fct_billing_daily": [],
    "fct_subscriptions_daily": ["date_day"],
    "gold_churn_labels_daily": ["date_day"],
    "gold_user_features_daily": ["date_day"],
    "gold_churn_by_plan_daily": [],
}


def build(lake: Lake, base: str, tables: list[str] | None = None) -> dict[str, str]:
    """Write the layers of ``lake`` as Parquet tables under ``base`` (full
    refresh per table; quarantine before silver) and return their paths."""
    from pyspark.sql import functions as F
    out = {}
    for name in tables or list(LAYOUT):
        df = getattr(lake, name)
        if name == "silver_events":
            df = df.withColumn("event_day", F.to_date("event_ts"))
        path = f"{base}/{name}"
        if LAYOUT[name]:
            df = df.hint("rebalance", *LAYOUT[name])
        df.write.mode("overwrite").partitionBy(*LAYOUT[name]).parquet(path)
        out[name] = path
    return out
