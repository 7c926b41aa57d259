"""The supplied tables in the roles of the engine's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ["signup", "purchase", "error", "view", "click"]
RANK_SQL = "CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 WHEN 'view' THEN 3 WHEN 'click' THEN 4 ELSE 99 END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as evidence: (entity_key, seq, source, value, as_of); every third row has no date."""
    e = table(spark, sf_dir, "events")
    dated = F.when(F.col("event_id") % 3 != 0, F.year("ts") * 12 + F.month("ts"))
    return e.select(F.col("user_id").alias("entity_key"), F.col("event_id").alias("seq"), F.col("event_type").alias("source"), "value", dated.alias("as_of"))


EVIDENCE_SQL = f"""ev AS (SELECT user_id AS entity_key, event_id AS seq, event_type AS source, value,
  CASE WHEN event_id % 3 <> 0 THEN CAST(year(ts) * 12 + month(ts) AS INTEGER) END AS as_of, {RANK_SQL} AS rk FROM events)"""
