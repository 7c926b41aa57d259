"""State, review and incremental queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import progress, review, verify, workset
from .tables import evidence, table

Q, S = {}, {}


def query(name, sql=None):
    def keep(f):
        Q[name], S[name] = f, sql
        return f

    return keep


def runs(spark, d):
    """events as runs of lists: errors find nothing; the pages of every second list are counted."""
    e, bad = table(spark, d, "events"), F.col("event_type") == "error"
    return e.select(
        F.col("user_id").alias("key"), F.col("event_id").alias("seq"), F.when(bad | (F.col("event_type") == "view"), 0).otherwise(F.floor("value")).cast("int").alias("found"),
        F.when(bad, F.array(F.lit("! HTTP 500"))).otherwise(F.array().cast("array<string>")).alias("errors"), F.when(F.col("user_id") % 2 == 0, F.col("event_id") % 30).cast("int").alias("last_page"), F.col("ts").cast("timestamp").alias("at"))


@query("progress_fold", """WITH RECURSIVE r AS (SELECT user_id AS key, CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS found, event_type = 'error' AS bad, CASE WHEN user_id % 2 = 0 THEN CAST(event_id % 30 AS INTEGER) END AS last_page,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
s AS (SELECT key, 0::BIGINT AS n, 1 AS page, 0 AS off, 0 AS found, false AS exhausted, 0 AS failures, NULL::VARCHAR AS error FROM (SELECT DISTINCT key FROM r)
  UNION ALL SELECT s.key, s.n + 1, CASE WHEN r.found > 0 AND r.last_page IS NOT NULL THEN r.last_page + 1 ELSE s.page END, CASE WHEN r.found > 0 AND r.last_page IS NULL THEN s.off + r.found ELSE s.off END, s.found + r.found,
    s.exhausted OR (r.found = 0 AND NOT (r.bad OR (s.found = 0 AND s.page = 1 AND s.off = 0))), CASE WHEN r.found = 0 AND (r.bad OR (s.found = 0 AND s.page = 1 AND s.off = 0)) THEN s.failures + 1 ELSE 0 END,
    CASE WHEN r.bad THEN 'HTTP 500' WHEN r.found = 0 AND s.found = 0 AND s.page = 1 AND s.off = 0 THEN 'empty' END FROM s JOIN r ON r.key = s.key AND r.n = s.n + 1)
SELECT key, page AS next_page, off AS start, found, exhausted, failures, CAST(n AS INTEGER) AS runs, error FROM s QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC) = 1""")
def _(spark, d):
    got = progress.fold(runs(spark, d))
    return got.select("key", F.col("nextPage").alias("next_page"), F.col("offset").alias("start"), "found", "exhausted", "failures", "runs", F.when(F.col("lastError") == progress.EMPTY_LIST, "empty").otherwise(F.col("lastError")).alias("error"))


@query("incremental_recompute", """SELECT d.doc_id, d.n_chars, l.quality FROM documents d JOIN labels l USING (doc_id) WHERE NOT (d.doc_id % 3 <> 0 AND l.quality = 1)""")
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    known = rows.where("doc_id % 3 <> 0").select("doc_id", "n_chars", F.lit(1).cast(rows.schema["quality"].dataType).alias("quality"))
    old = known.select("doc_id", F.sha2(F.to_json(F.struct("doc_id", "n_chars", "quality")), 256).alias("sig"))
    return workset.changed(rows, old, "doc_id", ["doc_id", "n_chars", "quality"]).select("doc_id", "n_chars", "quality")


@query("review_override", """WITH r AS (SELECT doc_id // 2 AS key, doc_id AS seq, CASE toxic WHEN 1 THEN 'NG' ELSE CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'OK' END END AS said FROM labels),
l AS (SELECT key, said FROM r WHERE said IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq DESC) = 1)
SELECT d.doc_id, CASE l.said WHEN 'OK' THEN 'OK (human)' WHEN 'NG' THEN 'NG' ELSE CASE WHEN n_chars > 2000 THEN 'OK' ELSE 'check' END END AS result FROM documents d LEFT JOIN l ON d.doc_id = l.key""")
def _(spark, d):
    said = F.when(F.col("toxic") == 1, "×").when(F.col("doc_id") % 5 != 0, "○")
    rows = table(spark, d, "labels").select(F.floor(F.col("doc_id") / 2).alias("key"), F.col("doc_id").alias("seq"), said.alias("verdict"))
    last = review.decisions(rows, "key", "seq", ["verdict"]).select("key", "decision")
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") > 2000, "OK").otherwise("check").alias("rule"))
    return docs.join(last, F.col("doc_id") == F.col("key"), "left").select("doc_id", verify.with_human(F.col("rule"), F.col("decision")).alias("result"))


@query("evidence_replace_source", """SELECT user_id AS entity_key, event_type AS source, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total FROM events
  WHERE event_type <> 'view' OR user_id % 2 = 1 GROUP BY ALL UNION ALL SELECT user_id, 'view', CAST(1 AS BIGINT), CAST(7 AS BIGINT) FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 0)""")
def _(spark, d):
    from ..operators import fusion

    old = evidence(spark, d).select("entity_key", "source", F.floor("value").alias("whole"))
    fresh = old.where("entity_key % 2 = 0").select("entity_key").distinct().select("entity_key", F.lit("view").alias("source"), F.lit(7).cast("long").alias("whole"))
    now = fusion.replace_source(old, fresh, ["entity_key", "source"])
    return now.groupBy("entity_key", "source").agg(F.count("*").alias("n"), F.sum("whole").alias("total"))
