"""Stores that outlive a run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from factloom.sources import readers, sinks, stores


def test_a_table_is_replaced_by_what_was_read_from_it(spark, tmp_path):
    table = stores.VersionedTable(spark, str(tmp_path / "t"), "key string, n long")
    assert table.read().count() == 0
    table.replace(spark.createDataFrame([("a", 1), ("b", 2)], "key string, n long"))
    table.replace(table.read().select("key", (F.col("n") * 10).alias("n")))
    table.merge(spark.createDataFrame([("b", 5), ("c", 7), ("c", 6), (None, 1)], "key string, n long"), ["key"])
    assert {tuple(r) for r in table.read().collect()} == {("a", 10), ("b", 5), ("c", 7), (None, 1)}
    assert {tuple(r) for r in table.read(1).collect()} == {("a", 1), ("b", 2)}
    table.vacuum()
    assert table.read().count() == 4 and len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("generation")]) == 1


def test_a_run_that_dies_before_the_switch_leaves_the_old_state(spark, tmp_path):
    table = stores.VersionedTable(spark, str(tmp_path / "t"), "n long")
    table.replace(spark.range(3).toDF("n"))
    table.write(spark.range(9).toDF("n"))  # and no switch
    assert table.read().count() == 3
    with pytest.raises(Exception):
        table.replace(spark.range(5).selectExpr("if(id = 4, raise_error('dead'), id) AS n"))
    assert table.read().count() == 3
    folder, since = table.write(spark.range(4).toDF("n")), table.generation()
    table.replace(spark.range(6).toDF("n"))  # another writer was first
    with pytest.raises(FileExistsError):
        table.switch(folder, since)
    assert table.read().count() == 6
    sinks.write_state(table.read(), str(tmp_path / "t"))
    assert table.read().count() == 6 and table.generation() == 3


SNAPSHOT = "url string, fetchedAt timestamp, status int, text string"


def test_snapshots_come_from_the_store_first(spark, tmp_path):
    store = stores.SnapshotStore(spark, str(tmp_path / "s"), SNAPSHOT)
    fetched = []

    def fetch(urls):
        fetched.append(sorted(r["url"] for r in urls.collect()))
        return urls.select("url", F.lit(dt.datetime(2026, 1, len(fetched))).alias("fetchedAt"), F.lit(200).alias("status"), F.concat(F.lit("t-"), "url").alias("text"))

    urls = spark.createDataFrame([(f"https://a.jp/{k}",) for k in range(12)] + [("https://a.jp/1",)], "url string")
    first = store.through(urls.where("url < 'https://a.jp/5'"), fetch)
    assert not any(r["cached"] for r in first.collect()) and len(fetched) == 1
    every = store.through(urls, fetch)
    assert every.count() == 12 and fetched[1] == sorted(f"https://a.jp/{k}" for k in range(5, 10)) and every.where("cached").count() == len(fetched[0])
    store.through(urls, fetch)
    assert len(fetched) == 2
    store.add(urls.limit(1).select("url", F.lit(dt.datetime(2027, 1, 1)).alias("fetchedAt"), F.lit(200).alias("status"), F.lit("new").alias("text")))
    assert [r["text"] for r in store.lookup(urls.limit(1)).collect()] == ["new"]


def test_a_lookup_reads_the_asked_partitions_only(spark, tmp_path):
    store = stores.SnapshotStore(spark, str(tmp_path / "s"), SNAPSHOT)
    store.add(spark.range(600).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(None).cast("timestamp").alias("fetchedAt"), F.lit(200).alias("status"), F.lit("x").alias("text")))
    asked = store.lookup(spark.createDataFrame([("u1",), ("u2",)], "url string"))
    plan = asked._jdf.queryExecution().executedPlan().toString()
    digits = [r[0] for r in store.keyed(spark.createDataFrame([("u1",), ("u2",)], "url string")).select("digits").collect()]
    assert f"digits#" in plan and f"IN ({','.join(digits)})" in plan.split("PartitionFilters: [")[1].split("]")[0] and asked.count() == 2


def test_a_day_of_the_listing_is_read_once(spark, tmp_path):
    days = [dt.date(2026, 1, 1) + dt.timedelta(k) for k in range(60)]
    rows = []
    for k, day in enumerate(days):
        for c in range(k % 4):
            rows.append((day, f"D{k}-{c}", f"E{(k * 7 + c) % 11}", "0", f"2025-{k % 12 + 1:02d}-28", f"{day} 09:0{c}", "120", "030000", "010", "1" if c == 2 and k % 3 == 0 else "0"))
    listing = spark.createDataFrame(rows, "day date, docID string, edinetCode string, secCode string, periodEnd string, submitDateTime string, docTypeCode string, formCode string, ordinanceCode string, withdrawalStatus string").cache()
    store, asked = stores.DailyListing(spark, str(tmp_path / "l"), window=20), []

    def fetch(of):
        asked.append(sorted(r["day"] for r in of.collect()))
        return listing.join(of, "day", "left_semi")

    for at in (30, 30, 31, 45, 58):
        today = days[at]
        got = {tuple(r) for r in store.refresh(F.lit(today), fetch).collect()}
        inside = listing.where((F.col("day") <= F.lit(today)) & (F.col("day") >= F.date_sub(F.lit(today), 20)) & ~F.dayofweek("day").isin(1, 7))
        assert got == {tuple(r) for r in readers.newest(readers.annual_reports(inside, "day")).collect()}
    assert asked[1] == [d for d in (days[30],) if d.weekday() < 5] and asked[2] == [d for d in (days[30], days[31]) if d.weekday() < 5]
    assert asked[3] == [d for d in days[31:46] if d.weekday() < 5]
