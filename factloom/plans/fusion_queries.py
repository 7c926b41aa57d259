"""Fusion, dedup, ranking and work-set queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import fusion, resolve, workset
from .tables import EVIDENCE_SQL, ORDER, evidence, table

Q, S = {}, {}


def query(name, sql):
    def keep(f):
        Q[name], S[name] = f, sql
        return f

    return keep


@query("fusion_pick_priority", f"""WITH {EVIDENCE_SQL}, r AS (
  SELECT *, row_number() OVER w AS place, first_value(value) OVER w AS best FROM ev WINDOW w AS (PARTITION BY entity_key ORDER BY rk, seq))
SELECT entity_key, max(value) FILTER (place = 1) AS value, max(source) FILTER (place = 1) AS source, count(*) AS n,
  count(*) FILTER (value <> best) AS conflicts, count(DISTINCT source) AS sources FROM r GROUP BY entity_key""")
def _(spark, d):
    return fusion.pick_priority(evidence(spark, d), ORDER)


@query("fusion_pick_newest_tiered", f"""WITH {EVIDENCE_SQL}, r AS (
  SELECT *, CASE source WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS tier FROM ev WHERE source <> 'signup' OR value > 10)
SELECT entity_key, seq, source, value, as_of FROM r
QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY tier, CASE WHEN tier = 2 THEN coalesce(as_of, -1) END DESC NULLS LAST, rk, seq) = 1""")
def _(spark, d):
    rows = evidence(spark, d).where("source <> 'signup' OR value > 10")
    return fusion.pick_newest_tiered(rows, ["signup", "purchase"], ORDER)


@query("fusion_conflicts", f"""WITH {EVIDENCE_SQL}, r AS (SELECT *, first_value(value) OVER (PARTITION BY entity_key, source ORDER BY seq) AS best FROM ev)
SELECT entity_key, source, count(DISTINCT value) FILTER (value <> best) AS others, count(*) FILTER (value <> best) AS rows FROM r GROUP BY entity_key, source""")
def _(spark, d):
    w = Window.partitionBy("entity_key", "source").orderBy("seq")
    rows = evidence(spark, d).withColumn("best", F.first("value").over(w))
    differs = F.col("value") != F.col("best")
    return rows.groupBy("entity_key", "source").agg(F.count_distinct(F.when(differs, F.col("value"))).alias("others"), F.count_if(differs).alias("rows"))


@query("fusion_status_tristate", f"""WITH {EVIDENCE_SQL},
p AS (SELECT entity_key, value, source FROM ev QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY CASE source WHEN 'view' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END, seq) = 1),
f AS (SELECT p.entity_key, p.value, p.source, CASE WHEN p.source = 'view' AND p.value BETWEEN 10 AND 40 THEN NULL ELSE p.value >= 20 END AS big,
  (SELECT count(*) FROM ev e WHERE e.entity_key = p.entity_key AND e.source = 'error') AS errors,
  (SELECT max(as_of) FROM ev e WHERE e.entity_key = p.entity_key) AS newest FROM p)
SELECT entity_key, value, source, big, concat_ws(',', CASE WHEN big IS NULL THEN 'size' END, CASE WHEN newest IS NULL THEN 'date' END, CASE WHEN errors = 0 THEN 'errors' END) AS missing,
  CASE WHEN big IS FALSE THEN 'excluded' WHEN big IS NULL OR newest IS NULL OR errors = 0 THEN 'check' ELSE 'OK' END AS status FROM f""")
def _(spark, d):
    ev = evidence(spark, d)
    best = fusion.first_of(ev.withColumn("_r", fusion.rank_of(F.col("source"), ["view", "purchase"])), ["entity_key"], [F.col("_r"), F.col("seq")])
    more = ev.groupBy("entity_key").agg(F.count_if(F.col("source") == "error").alias("errors"), F.max("as_of").alias("newest"))
    big = fusion.threshold(F.col("value"), F.col("source"), 20, ["view"], 10, 40)
    rows = best.select("entity_key", "value", "source").join(more, "entity_key").withColumn("big", big)
    rows = rows.withColumn("lacks", fusion.missing({"size": F.col("big").isNull(), "date": F.col("newest").isNull(), "errors": F.col("errors") == 0}))
    return rows.select("entity_key", "value", "source", "big", F.array_join("lacks", ",").alias("missing"), fusion.status([F.col("big")], F.col("lacks")).alias("status"))


@query("fusion_rejected_sources", f"""WITH {EVIDENCE_SQL}, c AS (SELECT e.*, CAST(e.value AS BIGINT) % 3 AS region FROM ev e),
a AS (SELECT entity_key, source, region FROM c QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY rk, seq) = 1),
bad AS (SELECT DISTINCT c.entity_key, c.source FROM c JOIN a ON c.entity_key = a.entity_key AND c.region <> a.region AND c.source <> a.source)
SELECT entity_key, count(*) AS kept, max(value) AS most FROM ev e WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.entity_key = e.entity_key AND b.source = e.source) GROUP BY entity_key""")
def _(spark, d):
    claims = evidence(spark, d).withColumn("region", F.rint("value").cast("long") % 3)  # halves to the even number, as the SQL's cast does
    adopted = fusion.first_of(claims.withColumn("_r", fusion.rank_of(F.col("source"), ORDER)), ["entity_key"], [F.col("_r"), F.col("seq")])
    bad = fusion.rejected_sources(claims, adopted)
    return claims.join(bad, ["entity_key", "source"], "left_anti").groupBy("entity_key").agg(F.count("*").alias("kept"), F.max("value").alias("most"))


@query("evidence_dedup_first", f"""WITH {EVIDENCE_SQL} SELECT entity_key, seq, source, CAST(floor(value) AS BIGINT) AS whole FROM ev
QUALIFY row_number() OVER (PARTITION BY entity_key, source, CAST(floor(value) AS BIGINT) ORDER BY seq) = 1""")
def _(spark, d):
    rows = evidence(spark, d).select("entity_key", "seq", "source", F.floor("value").alias("whole"))
    return fusion.dedup_first(rows, ["entity_key", "source", "whole"])


@query("best_official", """WITH p AS (SELECT page_id, url, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^(www|m|blog)[.]', '') AS site,
  CASE WHEN regexp_matches(url, '^https://www[.]') THEN 0 WHEN starts_with(url, 'https://') AND NOT regexp_matches(url, '^https://(m|blog)[.]') THEN 1 WHEN starts_with(url, 'https://') THEN 2 ELSE 3 END AS rk FROM pages)
SELECT site, page_id, url, rk FROM p QUALIFY row_number() OVER (PARTITION BY site ORDER BY rk, page_id) = 1""")
def _(spark, d):
    from ..functions import urls

    p = table(spark, d, "pages")
    u = F.col("url")
    rk = F.when(u.rlike("^https://www[.]"), 0).when(u.startswith("https://") & ~u.rlike("^https://(m|blog)[.]"), 1).when(u.startswith("https://"), 2).otherwise(3)
    rows = p.select(F.regexp_replace(urls.host(u), "^(www|m|blog)[.]", "").alias("site"), "page_id", "url", rk.alias("rk"))
    return fusion.first_of(rows, ["site"], [F.col("rk"), F.col("page_id")])


@query("ratio_outlier_check", f"""WITH {EVIDENCE_SQL}, f AS (SELECT * FROM ev WHERE value > 0 QUALIFY row_number() OVER (PARTITION BY entity_key, source ORDER BY seq) = 1),
a AS (SELECT entity_key, source, value FROM f QUALIFY row_number() OVER (PARTITION BY entity_key ORDER BY rk, seq) = 1),
r AS (SELECT a.entity_key, a.source, max(greatest(a.value, f.value) / least(a.value, f.value)) AS ratio FROM a JOIN f ON a.entity_key = f.entity_key AND a.source <> f.source GROUP BY a.entity_key, a.source)
SELECT entity_key, source, ratio, CASE WHEN ratio < 1.5 THEN 'OK' WHEN ratio >= 3 AND source <> 'signup' THEN 'NG' ELSE 'note' END AS result FROM r""")
def _(spark, d):
    firsts = fusion.dedup_first(evidence(spark, d).where("value > 0"), ["entity_key", "source"])
    best = fusion.first_of(firsts.withColumn("_r", fusion.rank_of(F.col("source"), ORDER)), ["entity_key"], [F.col("_r"), F.col("seq")])
    met = best.select("entity_key", "source", F.col("value").alias("v")).join(firsts.select("entity_key", F.col("source").alias("other"), "value"), "entity_key").where("source <> other")
    per = met.groupBy("entity_key", "source").agg(F.max(F.greatest("v", "value") / F.least("v", "value")).alias("ratio"))
    return per.withColumn("result", F.when(F.col("ratio") < 1.5, "OK").when((F.col("ratio") >= 3) & (F.col("source") != "signup"), "NG").otherwise("note"))


@query("topk_per_category", """WITH o AS (SELECT c_mktsegment, c_custkey, c_name, count(DISTINCT o_orderpriority) AS sources, sum(o_totalprice) AS total FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL)
SELECT c_mktsegment, c_custkey, sources, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY sources DESC, c_name, c_custkey) AS INTEGER) AS place FROM o
QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY sources DESC, c_name, c_custkey) <= 15""")
def _(spark, d):
    met = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    per = met.groupBy("c_mktsegment", "c_custkey", "c_name").agg(F.count_distinct("o_orderpriority").alias("sources"))
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("sources"), "c_name", "c_custkey")
    return per.withColumn("place", F.row_number().over(w)).where("place <= 15").select("c_mktsegment", "c_custkey", "sources", "place")


@query("collated_report_order", """SELECT p_partkey, p_name, row_number() OVER (ORDER BY CASE WHEN p_size >= 40 THEN 0 WHEN p_size >= 10 THEN 1 ELSE 2 END, p_name, p_partkey) AS place FROM part""")
def _(spark, d):
    severity = F.when(F.col("p_size") >= 40, 0).when(F.col("p_size") >= 10, 1).otherwise(2)
    rows = table(spark, d, "part").select("p_partkey", "p_name", severity.alias("severity"))
    return workset.numbered(rows, ["severity", "p_name", "p_partkey"], "place").select("p_partkey", "p_name", "place")


@query("collated_names", """WITH n AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN upper(p_name) ELSE p_name END AS name FROM part)
SELECT p_partkey, name, row_number() OVER (ORDER BY name COLLATE NOCASE, p_partkey) AS place FROM n""")
def _(spark, d):
    name = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    rows = table(spark, d, "part").select("p_partkey", F.collate(name, "UTF8_LCASE").alias("name"))
    return workset.numbered(rows, ["name", "p_partkey"], "place").select("p_partkey", F.collate("name", "UTF8_BINARY").alias("name"), "place")


@query("cumulative_cutoff", f"""WITH {EVIDENCE_SQL}, n AS (SELECT entity_key % 10 AS category, source, rk, count(*) AS found FROM ev WHERE value > 30 GROUP BY ALL),
r AS (SELECT *, coalesce(sum(found) OVER (PARTITION BY category ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
SELECT category, source, found, CAST(before AS BIGINT) AS before FROM r WHERE before < 100""")
def _(spark, d):
    rows = evidence(spark, d).where("value > 30").withColumn("category", F.col("entity_key") % 10).withColumn("rk", fusion.rank_of(F.col("source"), ORDER))
    per = rows.groupBy("category", "source", "rk").agg(F.count("*").alias("found"))
    return workset.until_target(per, "category", "rk", "found", 100).select("category", "source", "found", "before")


@query("workset_round", """WITH t AS (SELECT o_custkey, count(*) AS orders, max(o_totalprice) AS most FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_mktsegment, orders FROM customer JOIN t ON c_custkey = o_custkey
WHERE c_nationkey < 20 AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c_custkey AND o.o_orderstatus = 'P')
ORDER BY (c_mktsegment = 'BUILDING') DESC, orders DESC, c_custkey LIMIT 50""")
def _(spark, d):
    orders = table(spark, d, "orders")
    per = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    rows = table(spark, d, "customer").where("c_nationkey < 20").join(per, "c_custkey")
    done = orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return workset.round_of(rows, done, ["c_custkey"], [F.desc(F.col("c_mktsegment") == "BUILDING"), F.desc("orders"), F.col("c_custkey")], 50).select("c_custkey", "c_mktsegment", "orders")


@query("sample_split", """WITH t AS (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS most FROM orders GROUP BY o_custkey),
c AS (SELECT c_mktsegment, o_custkey, n, most, CASE c_mktsegment WHEN 'BUILDING' THEN 12 ELSE 1000000 END AS cap FROM t JOIN customer ON c_custkey = o_custkey)
SELECT c_mktsegment, count(*) FILTER (n <= cap AND most > 300000) AS passing, count(*) FILTER (NOT (n <= cap AND most > 300000)) AS others, max(n) FILTER (n <= cap) AS largest FROM c GROUP BY c_mktsegment""")
def _(spark, d):
    per = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("most"))
    rows = per.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    cap = F.when(F.col("c_mktsegment") == "BUILDING", 12).otherwise(1_000_000)
    passes = (F.col("n") <= cap) & (F.col("most") > 300_000)
    return rows.groupBy("c_mktsegment").agg(F.count_if(passes).alias("passing"), F.count_if(~passes).alias("others"), F.max(F.when(F.col("n") <= cap, F.col("n"))).alias("largest"))


@query("status_summary", f"""WITH {EVIDENCE_SQL} SELECT source, count(*) AS rows, count(*) FILTER (value >= 20) AS passing, count(*) FILTER (as_of IS NULL) AS undated,
  count(DISTINCT entity_key) AS entities FROM ev GROUP BY source""")
def _(spark, d):
    return evidence(spark, d).groupBy("source").agg(
        F.count("*").alias("rows"), F.count_if(F.col("value") >= 20).alias("passing"), F.count_if(F.col("as_of").isNull()).alias("undated"), F.count_distinct("entity_key").alias("entities")
    )


@query("array_set_ops", f"""WITH {EVIDENCE_SQL}, l AS (SELECT entity_key, list_sort(list(DISTINCT source)) AS s FROM ev WHERE value > 25 GROUP BY entity_key)
SELECT entity_key, len(s) AS kinds, len(list_intersect(s, ['click', 'view'])) AS listed, len(list_filter(s, lambda x: x NOT IN ('click', 'view'))) = 0 AS only_lists, array_to_string(s, ',') AS names FROM l""")
def _(spark, d):
    per = evidence(spark, d).where("value > 25").groupBy("entity_key").agg(F.sort_array(F.collect_set("source")).alias("s"))
    lists = F.array(F.lit("click"), F.lit("view"))
    return per.select(
        "entity_key", F.size("s").cast("long").alias("kinds"), F.size(F.array_intersect("s", lists)).cast("long").alias("listed"),
        (F.size(F.array_except("s", lists)) == 0).alias("only_lists"), F.array_join("s", ",").alias("names"),
    )


@query("latest_filing", """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def _(spark, d):
    return resolve.latest(table(spark, d, "orders"), "o_custkey", [F.col("o_orderdate")], "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("filing_chain", """WITH l AS (SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1),
q AS (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS units, count(*) AS lines FROM lineitem GROUP BY l_orderkey)
SELECT c_custkey, o_orderkey, units, lines FROM customer LEFT JOIN l ON c_custkey = o_custkey LEFT JOIN q ON o_orderkey = l_orderkey""")
def _(spark, d):
    last = resolve.latest(table(spark, d, "orders"), "o_custkey", [F.col("o_orderdate")], "o_orderkey").select("o_custkey", "o_orderkey")
    lines = table(spark, d, "lineitem").join(last.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")  # lines of the latest orders only
    facts = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("long").alias("units"), F.count("*").alias("lines"))
    met = table(spark, d, "customer").join(last, F.col("c_custkey") == F.col("o_custkey"), "left").join(facts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return met.select("c_custkey", "o_orderkey", "units", "lines")


@query("registry_unique_match", """WITH m AS (SELECT s_suppkey, c_custkey, count(*) OVER (PARTITION BY s_suppkey) AS n FROM supplier JOIN customer ON s_nationkey = c_nationkey AND c_acctbal BETWEEN s_acctbal - 150 AND s_acctbal + 150)
SELECT s_suppkey, c_custkey FROM m WHERE n = 1""")
def _(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), "s_acctbal")
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    near = F.col("c_acctbal").between(F.col("s_acctbal") - 150, F.col("s_acctbal") + 150)
    return resolve.unique_match(s, c, ["nation"], "s_suppkey", near).select("s_suppkey", "c_custkey")


@query("registry_ranked_match", """WITH m AS (SELECT s_suppkey, c_custkey, count(*) OVER (PARTITION BY s_suppkey) AS same_name,
  row_number() OVER (PARTITION BY s_suppkey ORDER BY (c_mktsegment = 'BUILDING') DESC, c_acctbal DESC, c_custkey) AS place FROM supplier JOIN customer ON s_nationkey = c_nationkey)
SELECT s_suppkey, c_custkey, same_name FROM m WHERE place = 1""")
def _(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", F.col("c_nationkey").alias("nation"))
    order = [F.desc(F.col("c_mktsegment") == "BUILDING"), F.desc("c_acctbal"), F.col("c_custkey")]
    return resolve.ranked_match(s, c, ["nation"], "s_suppkey", order).select("s_suppkey", "c_custkey", "same_name")


@query("entity_upsert_by_name", """SELECT regexp_replace(lower(p_name), '[ .,()-]', '', 'g') AS key, arg_min(p_name, p_partkey) AS name, min(p_partkey) AS first_seq, count(*) AS sightings FROM part GROUP BY 1""")
def _(spark, d):
    from ..functions import text

    return resolve.upsert(table(spark, d, "part"), text.normalize_name(F.col("p_name")), "p_name", "p_partkey")


@query("entity_merge_by_domain", """WITH p AS (SELECT page_id, url, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^www[.]', '') AS domain FROM pages)
SELECT page_id, domain, first_value(page_id) OVER (PARTITION BY domain ORDER BY page_id) AS canonical FROM p""")
def _(spark, d):
    from ..functions import urls

    p = table(spark, d, "pages").select("page_id", urls.domain(F.col("url")).alias("domain"))
    return resolve.canonical_by_domain(p, "domain", "page_id", "page_id").select("page_id", "domain", "canonical")


@query("identity_decision", """WITH o AS (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS kinds, count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY o_custkey)
SELECT c_custkey, CASE WHEN n_name IS NOT NULL AND f > 0 THEN 'OK' WHEN f = 0 AND kinds >= 2 THEN 'NG' WHEN kinds >= 2 THEN 'OK' ELSE 'check' END AS identity
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 3 LEFT JOIN o ON c_custkey = o_custkey""")
def _(spark, d):
    per = table(spark, d, "orders").groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("kinds"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    met = table(spark, d, "customer").join(table(spark, d, "nation").where("n_regionkey < 3"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return met.select("c_custkey", workset.decide([(F.col("n_name").isNotNull() & (F.col("f") > 0), "OK"), ((F.col("f") == 0) & (F.col("kinds") >= 2), "NG"), (F.col("kinds") >= 2, "OK")], "check").alias("identity"))


@query("weekday_calendar", """WITH r AS (SELECT CAST(max(o_orderdate) AS DATE) AS today FROM orders), d AS (SELECT CAST(today - CAST(i AS INTEGER) AS DATE) AS day FROM r, range(0, 401) t(i)),
o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
SELECT strftime(d.day, '%Y-%m-%d') AS day, coalesce(orders, 0) AS orders FROM d LEFT JOIN o ON d.day = o.day WHERE isodow(d.day) < 6""")
def _(spark, d):
    orders = table(spark, d, "orders")
    days = workset.weekdays(orders.agg(F.max(F.to_date("o_orderdate")).alias("today")), "today", 401)
    per = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    return days.join(per, "day", "left").select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("orders", F.lit(0).cast("long")).alias("orders"))
