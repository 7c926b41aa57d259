"""Queries against their SQL on small tables that hold what the supplied ones don't."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from factloom.operators import resolve, robots
from factloom.plans import catalog

from .conftest import canonical


def equal(spark, tmp_path, name, **tables):
    """Does a query give its SQL's rows over ``tables`` (rows, schema)?"""
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = canonical(catalog.queries()[name](spark, str(tmp_path)).toPandas())
    assert got == canonical(c.sql(catalog.oracle_sql()[name]).df())


def test_claims_of_halves_are_rounded_as_the_sql_does(spark, tmp_path):
    t = dt.datetime(2026, 1, 1)
    rows = [(0, 1, t, "signup", 0.5), (1, 1, t, "view", 3.0), (2, 2, t, "signup", 2.5), (3, 2, t, "click", 3.0), (4, 3, t, "purchase", 1.5), (5, 3, t, "error", 2.0)]
    equal(spark, tmp_path, "fusion_rejected_sources", events=(rows, "event_id long, user_id long, ts timestamp, event_type string, value double"))


def test_pages_that_share_an_address_are_all_looked_up(spark, tmp_path):
    rows = [(k, f"https://a.jp/{k // 3}", "x" * (k + 1)) for k in range(12)]
    equal(spark, tmp_path, "snapshot_lookup", pages=(rows, "page_id long, url string, html string"))


def test_a_robots_report_does_not_hang_on_the_order_of_rows(spark):
    def shuffled(batches):
        import os
        import random

        for b in batches:
            yield b.sample(frac=1, random_state=random.Random(os.urandom(8)).randrange(1 << 30))

    files = spark.createDataFrame([("https://a.jp", "200", "User-agent: *\nDisallow: /x", None)], "origin string, status string, text string, error string")
    sites = spark.createDataFrame([("a", "https://a.jp")], "source string, origin string")
    used = spark.range(0, 400, 1, 2).select(F.lit("a").alias("source"), F.concat(F.lit("https://a.jp/"), F.when(F.col("id") % 2 == 0, "x").otherwise("y"), "id").alias("url"))
    used = used.mapInPandas(shuffled, "source string, url string")
    spark.conf.set("spark.sql.exchange.reuse", "false")  # each reading of the addresses is one of its own
    try:
        checks = robots.report(files, used, sites).first()["checks"]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert len(checks) == 400 and all(c["allowed"] == ("/y" in c["url"]) for c in checks)


def joined(frame):
    """Rows that a frame's joins made."""
    frame.collect()

    def walk(node):
        name = node.nodeName()
        own = node.metrics().apply("numOutputRows").value() if "Join" in name else 0
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        below = node.children()
        return own + sum(walk(below.apply(k)) for k in range(below.size()))

    return walk(frame._jdf.queryExecution().executedPlan())


def test_rows_of_a_frequent_name_are_not_paired_with_its_entities(spark):
    k = F.col("id")
    place = F.when(k % 3 == 0, "東京都港区").when(k % 3 == 1, "大阪府大阪市")
    ents = spark.range(300).select(k.alias("entity_key"), F.lit("甲社").alias("name"))
    known = spark.range(0, 300, 2).select(k.alias("entity_key"), F.array(F.coalesce(place, F.lit("神奈川県横浜市"))).alias("addresses"))
    rows = spark.range(300).select(F.lit("株式会社甲社").alias("name"), place.alias("address"), place.alias("place"), k.alias("seq"), k.alias("pos"), k.alias("employees"), F.lit("内国法人・組合").alias("kind"), k.cast("string").alias("ref"))
    met = resolve.by_name(ents, rows)
    for got in (resolve.pick_registry(met, known), resolve.pick_filer(met, known), resolve.pick_listing(ents, rows, known), resolve.pick_by_prefecture(met, known, "place"), resolve.pick_by_prefecture(met, known, "place", most=3)):
        assert joined(got) < 3000  # pairs would be 90000


def test_sources_of_a_domain_stay_once_in_order(spark):
    ents = spark.range(200).select(F.col("id").alias("entity_key"), F.col("id").cast("string").alias("name"), F.col("id").alias("seq"), F.lit("a.jp").alias("domain"),
        F.array(F.struct(F.lit("x").alias("source"), (F.col("id") * 7 % 50).cast("string").alias("url"))).alias("sources"), F.array(F.lit("k")).alias("seeds"))
    one, _ = resolve.merged_by_domain(ents, spark.createDataFrame([], "entity_key long, seq long"))
    got = one.first()
    assert [s["url"] for s in got["sources"]] == [str(k * 7 % 50) for k in range(50)] and len(got["seeds"]) == 200 and got["name"] == "0"
    assert "array_position" not in one._jdf.queryExecution().analyzed().toString()  # a list looked through for each of its own entries
