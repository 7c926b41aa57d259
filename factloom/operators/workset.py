"""Work sets: order, limit, cut-off, calendars, incremental recomputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folders import new_folder


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Global places under a total order without one task for all rows.

    Rows are range-partitioned by the order and ranked inside their partition;
    the partitions' sizes, one number each, give what lies before them.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    # written once: the bounds of ranges come from a sample, so two computations of them need not agree
    path = new_folder(spark, "numbered")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a partition
    inside = ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return inside.join(F.broadcast(before), F.col("_part") == F.col("_p")).withColumn(name, F.col("_at") + F.col("_before")).drop("_part", "_p", "_at", "_before")


def until_target(rows: DataFrame, group: str, rank: str, found: str, target: int) -> DataFrame:
    """Sources in their order until a group's running total has reached the target."""
    w = Window.partitionBy(group).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum(found).over(w), F.lit(0).cast("long"))).where(F.col("before") < target)


def round_of(rows: DataFrame, done: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The next n rows that are not done, under a total order."""
    return rows.join(done, keys, "left_anti").orderBy(*order).limit(n)


def decide(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """The result of the first rule that holds."""
    out = None
    for condition, result in rules:
        out = F.when(condition, result) if out is None else out.when(condition, result)
    return out.otherwise(otherwise)


def weekdays(today: DataFrame, column: str, days: int) -> DataFrame:
    """Days back from ``column``, weekends left out."""
    all_days = today.select(F.explode(F.sequence(F.date_sub(column, days - 1), F.col(column))).alias("day"))
    return all_days.where(~F.dayofweek("day").isin(1, 7))


def jst_today(now: Column) -> Column:
    """The day in Japan at a moment given in UTC."""
    return F.to_date(F.from_utc_timestamp(now, "Asia/Tokyo"))


def changed(rows: DataFrame, previous: DataFrame, key: str, inputs: list[str]) -> DataFrame:
    """Rows whose inputs have another signature than at the last run."""
    mark = F.sha2(F.to_json(F.struct(*inputs)), 256)
    old = previous.select(F.col(key).alias("_k"), F.col("sig").alias("_s"))
    return rows.withColumn("sig", mark).join(old, (F.col(key) == F.col("_k")) & (F.col("sig") == F.col("_s")), "left_anti")


def lacks(rows: DataFrame, evidence: DataFrame, key: str, sources: list[str]) -> DataFrame:
    """Entities without evidence from any of the sources."""
    return rows.join(evidence.where(F.col("source").isin(sources)).select(key), key, "left_anti")


def only_missing(missing: Column, prefix: str) -> Column:
    """True where all that is missing starts with the prefix."""
    return (F.size(missing) > 0) & F.forall(missing, lambda m: F.startswith(m, F.lit(prefix)))


def fresh_prefix(rows: DataFrame, group: str, page: str, name: str, order: list[Column]) -> DataFrame:
    """Rows of a list's pages up to the first page that shows no new name, each name at its first sighting.

    A page is read on only while it adds something, so the pages that count are the longest prefix of pages with a new name;
    a page that shows nothing, or that is not there, ends it as well.  First sightings are minima per (list, name) and pages are
    counted per (list, page): no list is ordered in one task.
    """
    place = F.struct(*[F.col(page).alias("p"), *[c.alias(f"o{k}") for k, c in enumerate(order)]])
    others = [c for c in rows.columns if c not in (group, name)]
    first = rows.groupBy(group, name).agg(F.min_by(F.struct(*others), place).alias("_first")).select(group, name, "_first.*").select(rows.columns)
    pages = first.select(group, page).distinct()
    # pages with something new that follow on one another from a list's first page: place and number run alike
    first_page = rows.groupBy(group).agg(F.min(page).alias("_start"))
    w = Window.partitionBy(group).orderBy(page)
    run = pages.join(first_page, group).withColumn("_at", F.row_number().over(w)).where(F.col(page) - F.col("_start") + 1 == F.col("_at"))
    return first.join(run.select(F.col(group).alias("_g"), F.col(page).alias("_p")), (F.col(group) == F.col("_g")) & (F.col(page) == F.col("_p")), "left_semi")


def paged_window(rows: DataFrame, group: str, page: str, order: list[Column], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` + 1 to ``offset`` + ``limit`` of every list by (page, order): places within a page behind the sum of the pages before it."""
    sizes = rows.groupBy(group, page).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    met = before.where(F.col("_before") < offset + limit).select(F.col(group).alias("_g"), F.col(page).alias("_p"), "_before")
    kept = rows.join(met, F.col(group).eqNullSafe(F.col("_g")) & F.col(page).eqNullSafe(F.col("_p"))).drop("_g", "_p")
    at = F.col("_before") + F.row_number().over(Window.partitionBy(group, page).orderBy(*order))
    return kept.withColumn("_at", at).where(F.col("_at").between(offset + 1, offset + limit)).drop("_at", "_before")
