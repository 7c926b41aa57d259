"""Rounds of work until every group has what it is to have: what a round does depends on what the last one qualified."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def until_reached(
    goals: DataFrame, work: Callable[[DataFrame, int], DataFrame | None], qualified: Callable[[DataFrame], DataFrame], path: str, schema: str, most: int = 10_000
) -> tuple[DataFrame, DataFrame]:
    """(rows, log) after the rounds that the goals (group, target) need.

    ``qualified`` counts what the rows so far qualify: (group, have).  Groups below their target are open; ``work`` gives the rows
    that the open groups (group, target, have) gain in a round, None where nothing is left to ask.  A round's rows are written
    to ``path`` before they are counted, so a round that is lost is done again and those before it are not.  It ends when no group
    is open or a round adds nothing; ``most`` rounds without either are an error.  log: (round, group, have, target), of every round
    and group that was open in it, with what it had then.
    """
    spark = goals.sparkSession
    log_schema = "round int, group_key string, have long, target long"
    for turn in range(1, most + 1):
        rows = spark.read.schema(schema).parquet(*[f"{path}/rows/{k}" for k in range(1, turn)]) if turn > 1 else spark.createDataFrame([], schema)
        have = qualified(rows).select(F.col("group").cast("string").alias("_g"), F.col("have").alias("_have"))
        counted = goals.join(have, F.col("group").cast("string") == F.col("_g"), "left").select("group", "target", F.coalesce("_have", F.lit(0)).cast("long").alias("have"))
        open_path = f"{path}/open/{turn}"
        counted.where("have < target").write.mode("overwrite").parquet(open_path)
        open_groups = spark.read.schema(counted.schema).parquet(open_path)
        added = work(open_groups, turn) if open_groups.limit(1).count() else None
        if added is not None:
            added.write.mode("overwrite").parquet(f"{path}/rows/{turn}")
            if spark.read.schema(schema).parquet(f"{path}/rows/{turn}").limit(1).count():
                continue
        opened = [spark.read.schema(counted.schema).parquet(f"{path}/open/{k}").select(F.lit(k).alias("round"), F.col("group").cast("string").alias("group_key"), "have", "target") for k in range(1, turn + 1)]
        log = opened[0]
        for part in opened[1:]:
            log = log.unionByName(part)
        return rows, log.select(*[c.split()[0] for c in log_schema.split(", ")])
    raise RuntimeError(f"goals are not reached after {most} rounds that all added rows")
