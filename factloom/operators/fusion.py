"""Evidence fusion: one value per entity and field out of rows that disagree.

Evidence rows carry ``seq`` (order of arrival); every ordering ends with it, so
results do not depend on partitioning.  Priorities are small fixed tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN_RANK = 99


def rank_of(source: Column, order: Sequence[str]) -> Column:
    """Place in ``order``; unknown sources come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in order]), source), F.lit(0)) - 1, F.lit(UNKNOWN_RANK)).cast("int")


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under a total order (top-1 is pushed below the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_at", F.row_number().over(w)).where("_at = 1").drop("_at")


def dedup_first(evidence: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Set semantics: the earliest row of each key stays."""
    return first_of(evidence, keys, [F.col(seq)])


def pick_priority(evidence: DataFrame, order: Sequence[str], entity: str = "entity_key", value: str = "value") -> DataFrame:
    """Best value by source priority, with the number of rows and of rows that disagree."""
    ranked = evidence.withColumn("_rank", rank_of(F.col("source"), order))
    # rows of one value are counted before the entity's rows meet; the earliest of the best rank decides
    per = ranked.groupBy(entity, value).agg(F.min(F.struct("_rank", "seq", "source")).alias("_first"), F.count("*").alias("_n"), F.collect_set("source").alias("_sources"))
    said = F.sum(F.when(F.col(value).isNotNull(), F.col("_n")).otherwise(0))
    best = per.groupBy(entity).agg(
        F.min_by(value, "_first").alias(value), F.min("_first").alias("_first"), F.sum("_n").alias("n"), (said - F.min_by("_n", "_first")).alias("conflicts"),
        F.array_distinct(F.flatten(F.collect_list("_sources"))).alias("_sources"),
    )
    return best.select(
        entity, value, F.col("_first.source").alias("source"), "n", F.when(F.col(value).isNull(), 0).otherwise(F.col("conflicts")).cast("long").alias("conflicts"), F.size("_sources").cast("long").alias("sources"))


def pick_newest_tiered(evidence: DataFrame, first_tiers: Sequence[str], order: Sequence[str], entity: str = "entity_key", as_of: str = "as_of") -> DataFrame:
    """Fixed sources first in their order; among the others the newest, then the priority."""
    tier = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in first_tiers]), F.col("source")), F.lit(0)) - 1, F.lit(len(first_tiers)))
    newest = F.when(tier == len(first_tiers), F.coalesce(F.col(as_of), F.lit(-1)))
    rows = evidence.withColumn("_tier", tier).withColumn("_newest", newest).withColumn("_rank", rank_of(F.col("source"), order))
    return first_of(rows, [entity], [F.col("_tier"), F.desc_nulls_last("_newest"), F.col("_rank"), F.col("seq")]).drop("_tier", "_newest", "_rank")


def rejected_sources(claims: DataFrame, adopted: DataFrame, entity: str = "entity_key", claim: str = "region") -> DataFrame:
    """(entity, source) whose own claim contradicts the adopted one; the adopted source is exempt."""
    kept = adopted.select(F.col(entity).alias("_e"), F.col(claim).alias("_claim"), F.col("source").alias("_source"))
    hit = (F.col(entity) == F.col("_e")) & (F.col(claim) != F.col("_claim")) & (F.col("source") != F.col("_source"))
    return claims.join(kept, hit).select(entity, "source").distinct()


def threshold(value: Column, source: Column, limit: float, estimates: Sequence[str], low: float, high: float) -> Column:
    """value >= limit, but unknown for an estimate between low and high."""
    return F.when(value.isNull() | (source.isin(list(estimates)) & value.between(low, high)), None).otherwise(value >= limit)


def status(flags: Sequence[Column], missing: Column) -> Column:
    """excluded where a flag is false; OK where nothing is missing; else to check."""
    out = F.lit(False)
    for f in flags:
        out = out | F.coalesce(~f, F.lit(False))
    return F.when(out, "excluded").when(F.size(missing) == 0, "OK").otherwise("check")


def missing(named: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in named.items()]))


def worst(results: Column, severity: Sequence[str]) -> Column:
    """The most severe of an array of results."""
    order = F.array(*[F.lit(s) for s in severity])
    return F.element_at(order, F.array_max(F.transform(results, lambda r: F.array_position(order, r).cast("int"))))


def replace_source(evidence: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``keys`` in ``fresh`` take the place of the old ones."""
    return evidence.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)
