"""ledgerline: SaaS telemetry and billing analytics on Spark.

Raw daily event (JSONL) and billing (CSV) records are loaded repeat-safely into
bronze, validated and deduplicated into silver, and turned into daily facts, a
dense per-user subscription timeline, 7-day churn labels, trailing behavioural
features, data-quality checks, monitoring queries and a walk-forward churn
model.  Everything is DataFrame / SQL / pyspark.ml / Structured Streaming.
"""

__version__ = "0.1.0"
