"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0..1: its target volume
times a piecewise linear rate (knots below).  The integral of the rate is the
source's cumulative token demand; a document that starts after ``c`` tokens of
its source gets the time at which the demand reaches ``c`` (the integral
inverted), and the mix is the documents sorted by that time.

Targets: weights share the whole volume; a target stops at ``cap`` times its
source's size and the excess is shared again by weight until none is above.
That fixed point is found in one pass over sources sorted by size / weight.

A source is read in md5 order of its document ids, as often as its target asks
for; the last document is cut so that the words taken equal the target's whole
number.  Order within a source is by hash cell, so running sums meet only the
rows of one cell in a task, however large a source is.

Defined cases: a null text has size 0; a null source is a source of its own and
comes last; repeated rows are separate documents; an empty table gives an empty
result; a document of size 0 takes 0; columns of the input beyond those named
are not read by the query, and ``mixed_documents`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WORD = "[^\\x20\\x09-\\x0D]+"
CELLS = 256
#: Rate of a source over time, by its weight: heavier sources come later.  Each integrates to 1.
SCHEDULES = {1: (1.5, 0.5), 2: (1.0, 1.0), 3: (0.5, 1.5)}


def source_targets(sized: DataFrame, cap: float = 3.0, source: str = "source") -> DataFrame:
    """(source, source_size, weight, target) from rows with ``size``; one row per source."""
    per = sized.groupBy(source).agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))  # one row per source
    weighed = per.withColumn("weight", ((rank - 1) % 3 + 1).cast("long"))
    by_room = Window.orderBy((F.col("source_size") / F.col("weight")), F.col(source).asc_nulls_last())
    upto, rest = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.lit(cap) * F.coalesce(F.sum("source_size").over(upto), F.lit(0))) / F.sum("weight").over(rest)
    # sources are capped from the smallest size / weight on; the first that is not gives the level for all after it
    staged = weighed.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.lit(cap) * F.col("source_size"))
    settled = F.min(F.when(F.col("free"), F.struct(F.col("source_size") / F.col("weight"), F.col("level")))).over(Window.partitionBy())
    share = settled["level"] * F.col("weight")
    return staged.withColumn("target", F.when(share.isNull() | (share > F.lit(cap) * F.col("source_size")), F.lit(cap) * F.col("source_size")).otherwise(share)).select(
        source, "source_size", "weight", F.col("target").cast("double").alias("target")
    )


def time_of(share, early: float, late: float):
    """Inverse of the integral of a rate that runs linearly from ``early`` to ``late``."""
    slope = (late - early) / 2
    if slope == 0:
        return share / F.lit(early)
    return (F.sqrt(F.lit(early * early) + F.lit(4 * slope) * share) - F.lit(early)) / F.lit(2 * slope)


def training_time(share, weight, schedules=SCHEDULES):
    out = None
    for w, (early, late) in sorted(schedules.items()):
        out = (F.when(weight == w, time_of(share, early, late)) if out is None else out.when(weight == w, time_of(share, early, late)))
    return out.otherwise(share)


def plan_mix(docs: DataFrame, keys: list[str], source: str = "source", text: str = "text", cap: float = 3.0, cells: int = CELLS) -> DataFrame:
    """docs' ``keys`` with size, source_size, target, weight, before (tokens of the source ahead), taken, position."""
    spark = docs.sparkSession
    sized = docs.select(
        *keys, source, F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(keys[0]).cast("string"), F.lit(""))).alias("draw"),
    ).withColumn("cell", F.floor(F.conv(F.substring("draw", 1, 4), 16, 10).cast("int") / F.lit(65536 // cells)).cast("int"))
    sized = common.stored(sized, "mix-sizes")
    per_cell = common.stored(sized.groupBy(source, "cell").agg(F.sum("size").alias("size")), "mix-cells")
    targets = common.stored(source_targets(per_cell, cap, source), "mix-targets")
    ahead = per_cell.select(
        F.col(source).alias("c_source"), F.col("cell").alias("c_cell"),
        F.coalesce(F.sum("size").over(Window.partitionBy(source).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("cell_before"),
    ).join(targets.withColumnRenamed(source, "t_source"), F.col("c_source").eqNullSafe(F.col("t_source"))).drop("t_source")
    ahead = common.stored(ahead, "mix-ahead")
    inside = Window.partitionBy(source, "cell").orderBy("draw", *keys, "size").rowsBetween(Window.unboundedPreceding, -1)
    run = sized.withColumn("in_cell", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = run.join(ahead, F.col(source).eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell")))
    before = F.col("cell_before") + F.col("in_cell")
    want = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = want - passes * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    share = F.when(F.col("target") > 0, F.least(F.lit(1.0), before / F.col("target")))
    return rows.select(
        *keys, source, "size", "source_size", "target", "weight", before.alias("before"),
        (passes * F.col("size") + last).cast("long").alias("taken"),
        (passes + F.when(last > 0, 1).otherwise(0)).cast("int").alias("passes"),
        F.when(passes + F.when(last > 0, 1).otherwise(0) > 0, training_time(share, F.col("weight"))).alias("position"),
    )


def mixed_documents(docs: DataFrame, columns: list[str] | None = None, **how) -> DataFrame:
    """Whole documents in training order, one row per time a document is taken.

    A document is repeated for every pass over its source that takes it or a part of it.
    Rows that share an id, or have none, are documents of their own.
    """
    columns = columns or docs.columns
    docs, key = common.keyed(docs, "mix"), common.ROW_KEY
    plan = plan_mix(docs, [key], **how).where("passes > 0")
    shown = plan.select(
        F.col(key).alias("mix_key"), "weight", "before", "target", "source_size", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)).alias("turn")
    )
    share = F.least(F.lit(1.0), (F.col("before") + F.col("turn") * F.col("source_size")) / F.col("target"))
    timed = shown.select("mix_key", "turn", training_time(share, F.col("weight")).alias("mix_position"))
    timed = common.stored(timed.distinct(), "mix-timed")
    return (
        docs.join(timed, docs[key].eqNullSafe(F.col("mix_key")))
        .repartitionByRange(common.partitions(docs.sparkSession), "mix_position", "mix_key", "turn")
        .sortWithinPartitions("mix_position", "mix_key", "turn")
        .select(*[docs[c] for c in columns])
    )


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return plan_mix(docs, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "position").orderBy("position", "doc_id")


SQL_SIZES = """sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM {table}),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM per),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM per) - 3.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
free AS (SELECT arg_min(level, source_size::DOUBLE / weight) AS level FROM levels WHERE level * weight <= 3.0 * source_size),
targets AS (
  SELECT source, source_size, weight,
         CASE WHEN free.level IS NULL OR free.level * weight > 3.0::DOUBLE * source_size THEN 3.0::DOUBLE * source_size ELSE free.level * weight END AS target
  FROM levels, free),
runs AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.weight, CAST(round(t.target) AS BIGINT) AS want,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mix AS (
  SELECT *, CASE WHEN source_size > 0 THEN want // source_size ELSE 0 END AS whole FROM runs),
taken AS (
  SELECT *, greatest(0, least(size, want - whole * source_size - ahead)) AS last, least(1.0::DOUBLE, ahead / target) AS share FROM mix)"""

SQL = (
    "WITH "
    + SQL_SIZES.format(table="documents")
    + """
SELECT doc_id, size, source_size, target, CAST(whole * size + last AS BIGINT) AS taken,
       CASE WHEN whole + (last > 0)::INT > 0 THEN
         CASE weight WHEN 1 THEN (sqrt(2.25::DOUBLE + -2.0::DOUBLE * share) - 1.5::DOUBLE) / -1.0::DOUBLE
                     WHEN 2 THEN share
                     ELSE (sqrt(0.25::DOUBLE + 2.0::DOUBLE * share) - 0.5::DOUBLE) / 1.0::DOUBLE END END AS position
FROM taken"""
)
