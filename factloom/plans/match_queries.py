"""Queries over picking rows of registries and listings, choosing what is asked next, and when it is verified again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, config, enrich, progress, resolve, workset
from .record_queries import _CATEGORIES, _LABELS, _OTHERS, _sql_list
from .tables import table

Q, S = {}, {}


def query(name, sql=None):
    def keep(f):
        Q[name], S[name] = f, sql
        return f

    return keep


_PLACE = "CASE {k} % 4 WHEN 0 THEN '東京都港区' WHEN 1 THEN '大阪府大阪市' WHEN 2 THEN '神奈川県横浜市' END"


def place(k):
    return F.when(k % 4 == 0, "東京都港区").when(k % 4 == 1, "大阪府大阪市").when(k % 4 == 2, "神奈川県横浜市")


def suppliers(spark, d, names):
    """Suppliers as entities, by the name of one of so many companies."""
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(k.alias("entity_key"), F.concat(F.lit("株式会社Company"), k % names, F.lit("（旧社名）")).alias("name"))


def known(spark, d):
    """The addresses that every second supplier is known by."""
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").where("s_suppkey % 2 = 0 AND s_nationkey % 4 < 3").select(k.alias("entity_key"), F.array(place(F.col("s_nationkey"))).alias("addresses"))


_KNOWN = f"SELECT s_suppkey AS e, s_suppkey % 60 AS name, CASE WHEN s_suppkey % 2 = 0 THEN {_PLACE.format(k='s_nationkey')} END AS known FROM supplier"


@query("filer_picked", f"""WITH s AS ({_KNOWN}), c AS (SELECT c_custkey, c_custkey % 1470 AS name, {_PLACE.format(k='c_nationkey')} AS address FROM customer WHERE c_custkey % 5 > 0),
m AS (SELECT s.e, known, c.*, count(*) OVER (PARTITION BY s.e) AS same_name FROM s JOIN c USING (name)), f AS (SELECT * FROM m WHERE CASE WHEN known IS NOT NULL THEN coalesce(known = address, false) ELSE same_name = 1 END)
SELECT e AS entity_key, c_custkey, known IS NOT NULL AS by_address FROM f QUALIFY count(*) OVER (PARTITION BY e) = 1""")
def _(spark, d):
    k = F.col("c_custkey")
    filers = table(spark, d, "customer").select(F.concat(F.lit("COMPANY "), k % 1470, F.lit("㈱")).alias("name"), F.when(k % 5 > 0, "内国法人・組合").otherwise("個人").alias("kind"), k, place(F.col("c_nationkey")).alias("address"))
    return resolve.pick_filer(resolve.by_name(suppliers(spark, d, 60), filers), known(spark, d)).select("entity_key", "c_custkey", "by_address")


@query("listing_entry_picked", f"""WITH s AS ({_KNOWN}), r AS (SELECT o_orderkey, o_orderkey % 997 AS name, o_custkey % 1201 AS other, CASE WHEN o_orderkey % 6 > 0 THEN {_PLACE.format(k='o_orderkey')} END AS place FROM orders WHERE o_orderkey % 4 > 0),
n AS (SELECT DISTINCT o_orderkey, place, unnest([name, other]) AS name FROM r)
SELECT s.e AS entity_key, min(o_orderkey) AS entry FROM s JOIN n USING (name) WHERE known IS NULL OR place IS NULL OR left(place, 3) = left(known, 3) GROUP BY 1""")
def _(spark, d):
    k = F.col("o_orderkey")
    title = F.concat(F.lit("Company"), k % 997, F.lit("（株）【株式会社company"), F.col("o_custkey") % 1201, F.lit("／グループ】[2027]"))
    rows = table(spark, d, "orders").select(title.alias("name"), F.when(k % 6 > 0, place(k)).alias("place"), F.when(k % 4 > 0, k.cast("string")).alias("ref"), k.alias("pos"))
    return resolve.pick_listing(suppliers(spark, d, 60), rows, known(spark, d)).select("entity_key", F.col("pos").alias("entry"))


_ENTRIES = f"r AS (SELECT o_orderkey, o_orderkey % 607 AS name, {_PLACE.format(k='o_custkey')} AS place FROM orders WHERE o_orderkey % 3 = 1)"


def entries(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").where("o_orderkey % 3 = 1").select(F.concat(F.lit("company"), k % 607).alias("name"), place(F.col("o_custkey")).alias("place"), k.alias("pos"))


@query("entry_by_prefecture", f"""WITH s AS ({_KNOWN}), {_ENTRIES},
m AS (SELECT s.e, known, r.*, row_number() OVER (PARTITION BY s.e ORDER BY o_orderkey) AS at FROM s JOIN r USING (name)), f AS (SELECT * FROM m WHERE known IS NULL OR coalesce(left(place, 3) = left(known, 3), false)),
a AS (SELECT e, o_orderkey, row_number() OVER (PARTITION BY e ORDER BY known IS NULL AND coalesce(left(place, 3) = '東京都', false) DESC, o_orderkey) AS at FROM f),
b AS (SELECT e, o_orderkey, row_number() OVER (PARTITION BY e ORDER BY known IS NULL AND coalesce(left(place, 3) = '東京都', false) DESC, o_orderkey) AS at FROM f WHERE f.at <= 3)
SELECT a.e AS entity_key, a.o_orderkey AS any_row, b.o_orderkey AS of_three FROM a LEFT JOIN b ON b.e = a.e AND b.at = 1 WHERE a.at = 1""")
def _(spark, d):
    met = resolve.by_name(suppliers(spark, d, 60), entries(spark, d))
    every = resolve.pick_by_prefecture(met, known(spark, d), "place").select("entity_key", F.col("pos").alias("any_row"))
    three = resolve.pick_by_prefecture(met, known(spark, d), "place", most=3).select(F.col("entity_key").alias("_e"), F.col("pos").alias("of_three"))
    return every.join(three, F.col("entity_key") == F.col("_e"), "left").drop("_e")


@query("index_pages", """WITH l AS (SELECT c_custkey % 300 AS name, c_custkey, c_nationkey FROM customer), i AS (SELECT name, c_custkey AS ref FROM l QUALIFY row_number() OVER (PARTITION BY name ORDER BY c_nationkey DESC, c_custkey DESC) = 1)
SELECT s_suppkey, ref FROM supplier JOIN i ON i.name = s_suppkey * 2 % 450""")
def _(spark, d):
    k = F.col("c_custkey")
    listed = table(spark, d, "customer").select(F.concat(F.lit("ｃｏｍｐａｎｙ　"), k % 300, F.lit(" Inc.")).alias("name"), k.alias("ref"), F.col("c_nationkey").alias("page"), k.alias("pos"))
    ents = table(spark, d, "supplier").select(F.concat(F.lit("company"), F.col("s_suppkey") * 2 % 450).alias("entity_key"), "s_suppkey")
    return resolve.from_index(ents, resolve.name_index(listed, ["page", "pos"])).select("s_suppkey", "ref")


_ORDERS = {"a": ["view", "bizmaps", "click", "error"], "b": ["click", "signup", "edinet", "view", "purchase"]}
_ORDER_ROWS = ", ".join(f"('{c}', '{s}', {i})" for c, order in _ORDERS.items() for i, s in enumerate(order))


@query("discovery_plan", f"""WITH p(category, source, place) AS (VALUES {_ORDER_ROWS}), f AS (SELECT CASE user_id % 2 WHEN 0 THEN 'a' ELSE 'b' END AS category, event_type AS source, count(*) FILTER (event_id % 3 > 0) AS targets, count(DISTINCT user_id) AS qualified, (SELECT count(DISTINCT user_id) FROM events) AS users FROM events GROUP BY ALL),
g AS (SELECT p.*, qualified, CASE WHEN source IN ('bizmaps', 'indeed', 'doda', 'mynavi') THEN 'blocked' WHEN source IN ('edinet', 'careertasu', 'openwork', 'gbizinfo', 'mynavi_shinsotsu') THEN 'enrich only' WHEN source = 'signup' THEN 'not implemented' WHEN coalesce(targets, 0) = 0 THEN 'no targets' END AS gate FROM p LEFT JOIN f USING (category, source)),
r AS (SELECT *, coalesce(sum(CASE WHEN gate IS NULL THEN qualified ELSE 0 END) OVER (PARTITION BY category ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT category, source, CAST(place AS INTEGER) AS place, gate, CAST(before AS BIGINT) AS before FROM r WHERE before < 400""")
def _(spark, d):
    e = table(spark, d, "events").withColumn("category", F.when(F.col("user_id") % 2 == 0, "a").otherwise("b"))
    found = e.groupBy("category", F.col("event_type").alias("source")).agg(F.count_if(F.col("event_id") % 3 > 0).alias("targets"), F.countDistinct("user_id").alias("qualified"))
    return enrich.discovery_plan(found, 400, ["view", "click", "error", "purchase"], _ORDERS)


@query("stage_targets", """WITH u AS (SELECT user_id, list(DISTINCT event_type) AS s, count(*) AS n FROM events GROUP BY user_id), b AS (SELECT *, n % 3 > 0 AS site, n % 4 > 1 AS heads, n % 5 > 2 AS firm, CASE n % 6 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS tokyo, n % 7 = 0 AS none FROM u)
SELECT user_id, coalesce(tokyo, true) AND NOT list_contains(s, 'view') AND site AS official, coalesce(tokyo, true) AND NOT list_contains(s, 'click') AND (NOT site OR NOT heads) AS salesnow,
  coalesce(tokyo, true) AND NOT list_contains(s, 'error') AND NOT heads AND NOT none AS gbizinfo, coalesce(tokyo, true) AND NOT list_contains(s, 'signup') AND NOT firm AND NOT none AS mynavi, coalesce(tokyo, true) AS edinet FROM b""")
def _(spark, d):
    names = {"view": "official", "click": "salesnow", "error": "gbizinfo", "signup": "mynavi", "purchase": "grip"}
    source = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("event_type")]
    n = F.col("n")
    per = table(spark, d, "events").groupBy("user_id").agg(F.collect_set(source).alias("sources"), F.count("*").alias("n")).select(
        "user_id", "sources", (n % 3 > 0).alias("has_official"), (n % 4 > 1).alias("has_employees"), (n % 5 > 2).alias("firm_employees"), F.when(n % 6 == 1, None).otherwise(n % 6 > 0).alias("tokyo"),
        F.lit(False).alias("needs_corporate"), F.lit(False).alias("no_salesnow"), (n % 7 == 0).alias("no_gbiz"), (n % 7 == 0).alias("no_mynavi"))
    out = per.select("user_id")
    for stage in ("official", "salesnow", "gbizinfo", "mynavi", "edinet"):
        asked = enrich.stage_targets(per, stage, [F.col("user_id")], employees_only=stage == "mynavi").select(F.col("user_id").alias("_u"))
        out = out.join(asked, F.col("user_id") == F.col("_u"), "left").withColumn(stage, F.col("_u").isNotNull()).drop("_u")
    return out


@query("employee_bottlenecks", """SELECT doc_id FROM labels WHERE toxic = 0 AND doc_id % 3 < 2 AND doc_id % 5 > 0 AND doc_id % 7 > 0""")
def _(spark, d):
    k, item = F.col("doc_id"), config.ITEMS
    missing = F.when(k % 3 == 0, F.array(F.lit(item["employees"]))).when(k % 3 == 1, F.array(F.lit(item["estimate"]))).otherwise(F.array(F.lit(item["employees"]), F.lit(item["contact"])))
    rows = table(spark, d, "labels").select(
        k, F.when(F.col("toxic") == 0, config.STATUS["check"]).otherwise(config.STATUS["OK"]).alias("status"), missing.alias("missing"), F.array(F.when(k % 5 > 0, "ad_agency").otherwise("sns_agency")).alias("seeds"),
        F.array(F.when(k % 7 > 0, config.LABELS["ad_agency"]).otherwise("x")).alias("categories"))
    return enrich.employee_bottlenecks(rows, "ad_agency").select("doc_id")


@query("lookup_flags", """SELECT c_custkey, CASE WHEN o.n IS NULL THEN NULL ELSE o.n % 3 = 0 END AS matched, CASE WHEN o.n % 3 = 1 THEN true END AS no_match FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def _(spark, d):
    n = F.col("n")
    found = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")).select("c_custkey", F.when(n % 3 == 0, "match").when(n % 3 == 1, "none").otherwise("error").alias("outcome"))
    return enrich.lookup_flags(table(spark, d, "customer"), found, "c_custkey")


@query("retry_waits", """WITH r AS (SELECT event_id, CASE event_type WHEN 'click' THEN 429 WHEN 'view' THEN 403 WHEN 'error' THEN 503 WHEN 'signup' THEN 400 END AS status, CAST(event_id % 4 AS INTEGER) AS attempt FROM events)
SELECT event_id, CASE WHEN attempt >= 2 OR (status < 500 AND status NOT IN (400, 429)) THEN NULL WHEN status IS NOT NULL THEN 6 * (attempt + 1) ELSE 2 * (attempt + 1) END AS wait FROM r""")
def _(spark, d):
    kind = F.col("event_type")
    status = F.when(kind == "click", 429).when(kind == "view", 403).when(kind == "error", 503).when(kind == "signup", 400)
    return table(spark, d, "events").select("event_id", progress.retry_wait(status, (F.col("event_id") % 4).cast("int")).alias("wait"))


@query("verified_again", """SELECT doc_id, d.n_chars % 3 <> l.quality OR (toxic = 1 AND doc_id % 4 < 2) OR (doc_id % 6 = 0 AND doc_id % 4 >= 2) OR doc_id % 11 = 0 AS again FROM documents d JOIN labels l USING (doc_id)""")
def _(spark, d):
    k = F.col("doc_id")
    said = F.when(k % 4 == 0, "HTTP 503").when(k % 4 == 1, "net::ERR_FAILED").when(k % 4 == 2, "HTTP 404").otherwise("robots.txt disallows /x")
    contact = checks.outcome(F.when(F.col("toxic") == 1, "NG").otherwise("OK"), checks.told("closed", why=said))
    stored = F.struct(contact.alias("contact"), (k % 6 == 0).alias("access_failed"))
    rows = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")
    old = F.when(k % 11 > 0, F.col("quality").cast("string"))
    here, there = F.lit("here"), F.when(k % 4 < 2, "here").otherwise("there")
    return rows.select("doc_id", checks.needs_verify((F.col("n_chars") % 3).cast("string"), old, stored, here, there).alias("again"))


_WORDS = list(dict.fromkeys(w for core in _CATEGORIES.values() for w in [*core["main"], *core["weak"]]))


@query("early_stops", f"""SELECT doc_id, source IN ('src0', 'src1', 'src2') AND length(coalesce(lang, '') || '  ' || coalesce(text, '')) >= 200 AND len(list_filter({_sql_list(_WORDS)}, lambda w: contains(coalesce(lang, '') || '  ' || coalesce(text, ''), w))) = 0 AS stopped FROM documents""")
def _(spark, d):
    rule = checks.Industry(_CATEGORIES, _LABELS, _OTHERS)
    sources = F.when(F.col("source").isin("src0", "src1", "src2"), F.array(F.lit("official"), F.lit("wantedly"), F.lit("green"))).when(F.col("source") == "src3", F.array(F.lit("official"))).otherwise(F.array(F.lit("wantedly"), F.lit("boxil")))
    return table(spark, d, "documents").select("doc_id", rule.early_stop(F.col("lang"), F.lit(""), F.col("text"), checks.only_job_lists(sources)).alias("stopped"))


@query("checks_of_category", """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN CASE toxic WHEN 1 THEN 'NG' ELSE 'OK' END END AS industry, CASE WHEN doc_id % 9 > 0 THEN CASE quality WHEN 1 THEN 'OK' ELSE 'check' END END AS contact FROM labels""")
def _(spark, d):
    k = F.col("doc_id")
    one = F.map_from_arrays(F.array(F.when(k % 2 == 0, "ad_agency").otherwise("sns_agency")), F.array(checks.outcome(F.when(F.col("toxic") == 1, "NG").otherwise("OK"), "x")))
    fine = checks.outcome("OK", "y")
    stored = F.when(k % 9 > 0, F.struct(one.alias("industry"), fine.alias("employees"), checks.outcome(F.when(F.col("quality") == 1, "OK").otherwise("check"), "z").alias("contact"), fine.alias("identity")))
    got = table(spark, d, "labels").select("doc_id", checks.checks_for(stored, "ad_agency").alias("c"))
    return got.select("doc_id", F.col("c.industry.result").alias("industry"), F.col("c.contact.result").alias("contact"))


@query("first_evidence", """SELECT user_id AS entity_key, event_id AS seq, value FROM events WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def _(spark, d):
    ev = table(spark, d, "events").select(F.col("user_id").alias("entity_key"), F.col("event_id").alias("seq"), F.col("event_type").alias("field"), "value")
    return enrich.first_evidence(ev, "view").select("entity_key", "seq", "value")


@query("firm_headcount_lacking", """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))""")
def _(spark, d):
    ev = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("source"))
    return workset.lacks(table(spark, d, "customer").select("c_custkey"), ev, "c_custkey", ["1-URGENT", "2-HIGH"])
