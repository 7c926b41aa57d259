import datetime as dt

from pyspark.sql import functions as F

from factloom.operators import extract, fusion, progress, resolve, review, robots, workset


def test_newest_tiered(spark):
    rows = [("a", 0, "official", 10, 1), ("a", 1, "jobs", 20, 9), ("b", 0, "jobs", 5, None), ("b", 1, "maps", 6, 3), ("c", 0, "official", 1, 1), ("c", 1, "human", 2, None), ("d", 0, "maps", 1, None), ("d", 1, "jobs", 2, None)]
    ev = spark.createDataFrame(rows, "entity_key string, seq long, source string, value int, as_of int")
    got = {r["entity_key"]: r["value"] for r in fusion.pick_newest_tiered(ev, ["human", "official"], ["human", "official", "jobs", "maps"]).collect()}
    assert got == {"a": 10, "b": 6, "c": 2, "d": 2}


def test_fusion_does_not_depend_on_partitioning(spark):
    rows = [(i % 5, i, "abc"[i % 3], float(i % 7)) for i in range(100)]
    ev = spark.createDataFrame(rows, "entity_key long, seq long, source string, value double")
    one = sorted(map(tuple, fusion.pick_priority(ev.coalesce(1), ["b", "a"]).collect()))
    assert one == sorted(map(tuple, fusion.pick_priority(ev.orderBy(F.rand(3)).repartition(7), ["b", "a"]).collect()))


def test_dedup_is_idempotent_and_merge_settles(spark):
    ev = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2)], "k string, seq long")
    once = fusion.dedup_first(ev, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, fusion.dedup_first(once, ["k"]).collect())) == [("a", 0), ("b", 2)]
    e = spark.createDataFrame([("x", "d", 1), ("y", "d", 0), ("z", None, 2)], "key string, domain string, seq long")
    got = {r["key"]: r["canonical"] for r in resolve.canonical_by_domain(e, "domain", "key", "seq").collect()}
    assert got == {"x": "y", "y": "y", "z": "z"}


def test_robots(spark):
    text = "# all\nUser-agent: *\nDisallow: /private\nAllow: /private/open\nDisallow: /*.pdf$\nDisallow:\n\nUser-agent: A\nUser-agent: B\nDisallow: /\n"
    rules = robots.parse(spark.createDataFrame([("o", text)], "origin string, text string"))
    asks = spark.createDataFrame([(0, "o", "/private/x"), (1, "o", "/private/open/y"), (2, "o", "/a.pdf"), (3, "o", "/a.pdf?x"), (4, "p", "/")], "i int, origin string, path string")
    got = {r["i"]: r["allowed"] for r in robots.allowed(asks, rules, "origin", "path", "i").collect()}
    assert got == {0: False, 1: True, 2: False, 3: True, 4: True}
    own = {r["i"]: r["allowed"] for r in robots.allowed(asks, rules, "origin", "path", "i", "b").collect()}
    assert own[1] is False and own[4] is True
    status = spark.createDataFrame([("200",), ("404",), ("302",), ("error",)], "s string").select(robots.policy(F.col("s")).alias("p"))
    assert [r["p"] for r in status.collect()] == ["rules", "free", "closed", "closed"]


def test_progress_and_breaker(spark):
    t = dt.datetime(2024, 1, 1)
    runs = [(1, 0, 5, [], 1, t), (1, 1, 0, [], None, t), (2, 0, 0, ["! x"], None, t), (2, 1, 0, [], None, t), (2, 2, 3, ["! y"], None, t)]
    df = spark.createDataFrame(runs, "key long, seq long, found int, errors array<string>, last_page int, at timestamp")
    got = {r["key"]: (r["nextPage"], r["offset"], r["found"], r["exhausted"], r["failures"], r["lastError"], r["runs"]) for r in progress.fold(df).collect()}
    assert got == {1: (2, 0, 5, True, 0, None, 2), 2: (1, 3, 3, False, 0, "y", 3)}
    log = spark.createDataFrame([("h", i, s) for i, s in enumerate([403, 403, 200, 429, 405, 403, 403])] + [("g", 0, 403)], "host string, seq long, status int")
    assert [tuple(r) for r in progress.trips(log, "host", "seq", F.col("status").isin(403, 405, 429)).collect()] == [("h", 5)]


def test_review(spark):
    rows = spark.createDataFrame([("a", 0, "○", ""), ("a", 1, "×", "1,200"), ("b", 0, "", ""), ("z", 0, "ok", "")], "id string, seq long, industry string, employees string")
    ents = spark.createDataFrame([("a",), ("b",)], "id string")
    assert tuple(review.counts(rows, ents, "id", ["industry", "employees"]).first()) == (2, 1, 1)
    got = {(r["id"], r["field"]): (r["decision"], r["correction"]) for r in review.decisions(rows, "id", "seq", ["industry", "employees"]).collect()}
    assert got == {("a", "industry"): ("NG", None), ("a", "employees"): (None, 1200), ("z", "industry"): ("OK", None)}


def test_workset(spark):
    rows = spark.range(500).select(((F.col("id") * 7919) % 500).alias("v"))
    assert [r["place"] for r in workset.numbered(rows, ["v"], "place").orderBy("v").collect()] == list(range(1, 501))
    old = spark.createDataFrame([(1, 5)], "k int, v int").select("k", F.sha2(F.to_json(F.struct("k", "v")), 256).alias("sig"))
    now = spark.createDataFrame([(1, 5), (2, 5)], "k int, v int")
    assert [r["k"] for r in workset.changed(now, old, "k", ["k", "v"]).collect()] == [2]


def test_first_exact_match_of_a_page_of_results(spark):
    ents = spark.createDataFrame([("a", "株式会社Ａ"), ("b", "乙"), ("c", "丙")], "entity_key string, name string")
    found = [("a", 0, "A商事", "u0"), ("a", 1, "A（株）\n東京", ""), ("a", 2, "(株)a\n東京", "u2"), ("a", 3, "㈱A", "u3"), ("b", 0, "丙", "u4")]
    got = resolve.first_exact(ents, spark.createDataFrame(found, "entity_key string, pos int, title string, url string"))
    assert [tuple(r) for r in got.collect()] == [("a", "u2")]
