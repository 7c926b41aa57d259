"""Resumable progress of sources: the fold over runs, skipping, and the circuit breaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EMPTY_LIST = "一覧から1社も取れなかった（ページ構造の変更・遮断画面・空の一覧のいずれか）"


def apply_run(prev: Column, found: Column, errors: Column, last_page: Column, at: Column) -> Column:
    """The record of a list after one more run (``prev`` null: the first).

    Nothing found and an error, or nothing at the very first place, is a failure and the place stays; nothing later is the end;
    else the place moves on: to the next page, or by what was found.
    """
    p = lambda name, default: F.coalesce(prev[name], F.lit(default))
    error = F.substring(F.regexp_replace(F.try_element_at(errors, F.lit(1)), "^\\s*!\\s*", ""), 1, 200)
    nothing, bad = found == 0, F.size(errors) > 0
    fresh = (p("found", 0) == 0) & (p("nextPage", 1) == 1) & (p("offset", 0) == 0)
    failed = nothing & (bad | fresh)
    moved = ~nothing
    return F.struct(
        F.when(moved & last_page.isNotNull(), last_page + 1).otherwise(p("nextPage", 1)).cast("int").alias("nextPage"),
        F.when(moved & last_page.isNull(), p("offset", 0) + found).otherwise(p("offset", 0)).cast("int").alias("offset"),
        (p("found", 0) + F.when(moved, found).otherwise(0)).cast("int").alias("found"), (p("exhausted", False) | (nothing & ~failed)).alias("exhausted"),
        F.when(failed, p("failures", 0) + 1).otherwise(0).cast("int").alias("failures"), F.when(failed & ~bad, EMPTY_LIST).otherwise(error).alias("lastError"),
        F.when(failed, at).alias("failedAt"), (p("runs", 0) + 1).cast("int").alias("runs"), at.alias("lastAt"),
    )


def fold(runs: DataFrame) -> DataFrame:
    """Records of keys after all of their runs (key, seq, found, errors, last_page, at) in the order of seq, as ``apply_run`` gives them one by one.

    The rule takes no list of runs: a list is at its very first place until a run finds something, so which runs failed
    follows from the first run that did, and the failures at the end are the runs behind the last that was none.  Two
    rounds of partial aggregates do for a key of any length.
    """
    bad, nothing = F.size("errors") > 0, F.col("found") == 0
    at = lambda holds: F.when(holds, F.col("seq"))
    error = F.substring(F.regexp_replace(F.try_element_at("errors", F.lit(1)), "^\\s*!\\s*", ""), 1, 200)
    paged = ~nothing & F.col("last_page").isNotNull()
    per = runs.groupBy("key").agg(
        F.min(at(~nothing)).alias("_first"), F.max(at(~nothing)).alias("_last"), F.max(at(nothing & ~bad)).alias("_empty"), F.max("seq").alias("_end"), F.max_by(F.col("last_page") + 1, at(paged)).alias("_next"),
        F.sum(F.when(~nothing & F.col("last_page").isNull(), F.col("found")).otherwise(0)).alias("_offset"), F.sum("found").alias("found"), F.count("*").alias("runs"), F.max_by(F.struct("at", error.alias("error"), bad.alias("bad")), "seq").alias("_run"))
    ended = F.coalesce(F.col("_empty") > F.col("_first"), F.lit(False))
    per = per.withColumn("_ended", ended).withColumn("_fine", F.greatest("_last", F.when(ended, F.col("_empty"))))
    failing = per.where("_fine IS NULL OR _fine < _end").select(F.col("key").alias("_k"), F.col("_fine").alias("_f"))
    lately = runs.join(failing, F.col("key") == F.col("_k")).where("_f IS NULL OR seq > _f").groupBy("_k").agg(F.count("*").alias("_failures"))
    done = per.join(lately, F.col("key") == F.col("_k"), "left")
    failed = F.col("_failures").isNotNull()
    return done.select(
        "key", F.coalesce("_next", F.lit(1)).cast("int").alias("nextPage"), F.col("_offset").cast("int").alias("offset"), F.col("found").cast("int").alias("found"), F.col("_ended").alias("exhausted"), F.coalesce("_failures", F.lit(0)).cast("int").alias("failures"),
        F.when(failed & ~F.col("_run.bad"), EMPTY_LIST).otherwise(F.col("_run.error")).alias("lastError"), F.when(failed, F.col("_run.at")).alias("failedAt"), F.col("runs").cast("int").alias("runs"), F.col("_run.at").alias("lastAt"))


def apply_runs(records: DataFrame, runs: DataFrame) -> DataFrame:
    """Records (key, ...) after one run each (key, found, errors, last_page, at); new keys start, others stay as they are."""
    old = records.select(F.col("key").alias("_k"), F.struct(*[c for c in records.columns if c != "key"]).alias("_prev"))
    met = runs.join(old, F.col("key") == F.col("_k"), "left")
    new = met.select("key", apply_run(F.col("_prev"), F.col("found"), F.col("errors"), F.col("last_page"), F.col("at")).alias("r")).select("key", "r.*")
    return records.join(runs.select("key"), "key", "left_anti").select(new.columns).unionByName(new)


def key_of(category: Column, source: Column, url: Column, keyword: Column) -> Column:
    """The key of a list's record: category, source, and its url or keyword."""
    return F.concat_ws("|", category, source, F.coalesce(url, keyword))


def skip_reason(record: Column, now: Column, refresh: bool = False, retry_failed: bool = False, hours: int = 24, least: int = 2) -> Column:
    """exhausted, failing or null (read it)."""
    cooling = skips(record["failures"], record["failedAt"], now, hours, least)
    out = F.lit(None).cast("string")
    if not retry_failed:
        out = F.when(cooling, "failing").otherwise(out)
    return out if refresh else F.when(F.coalesce(record["exhausted"], F.lit(False)), "exhausted").otherwise(out)


def skips(failures: Column, failed_at: Column, now: Column, hours: int = 24, least: int = 2) -> Column:
    """Two failures or more, the last within the cooldown."""
    return (failures >= least) & (failed_at > now - F.expr(f"INTERVAL {hours} HOURS"))


def trips(log: DataFrame, host: str, seq: str, refused: Column, succeeded: Column | None = None, run: int = 3) -> DataFrame:
    """Hosts with ``run`` refusals without a success between them, and the request at which the breaker trips first.

    Only a success starts the count anew; other failures neither count nor reset (without ``succeeded``: whatever is no refusal is one).
    """
    w = Window.partitionBy(host).orderBy(seq)
    fine = ~refused if succeeded is None else succeeded
    marked = log.withColumn("_bad", refused).withColumn("_island", F.sum(F.when(fine, 1).otherwise(0)).over(w))
    inside = Window.partitionBy(host, "_island").orderBy(seq)
    counted = marked.where("_bad").withColumn("_n", F.row_number().over(inside))
    return counted.where(F.col("_n") == run).groupBy(host).agg(F.min(seq).alias("tripped_at"))


def retry_wait(status: Column, attempt: Column, retries: int = 2) -> Column:
    """Seconds to wait before the next attempt; null for none."""
    final = (attempt >= retries) | ((status < 500) & ~status.isin(400, 429))
    return F.when(final, None).when(status.isNotNull(), 6 * (attempt + 1)).otherwise(2 * (attempt + 1))
