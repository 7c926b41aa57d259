"""Rounds, pages that end a list, windows over pages, robots rules by literal heads."""

import random
import re

import pytest
from pyspark.sql import functions as F

from factloom.operators import robots, rounds, workset


def test_rounds_go_on_until_each_goal_is_reached_or_nothing_is_added(spark, tmp_path):
    supply = spark.createDataFrame([(g, turn, k) for g, per in (("a", 3), ("b", 1), ("c", 0), ("d", 2)) for turn in range(1, 5) for k in range(per)], "group string, turn int, k int")
    goals = spark.createDataFrame([("a", 3), ("b", 3), ("c", 1), ("d", 100), ("e", 0)], "group string, target long")
    asked = []

    def work(open_groups, turn):
        asked.append(sorted(r["group"] for r in open_groups.collect()))
        return supply.where(F.col("turn") == turn).join(open_groups.select("group"), "group", "left_semi") if turn <= 4 else None

    rows, log = rounds.until_reached(goals, work, lambda r: r.groupBy("group").agg(F.count("*").alias("have")), str(tmp_path / "r"), "group string, turn int, k int")
    assert {r["group"]: r["count"] for r in rows.groupBy("group").count().collect()} == {"a": 3, "b": 3, "d": 8}
    assert asked == [["a", "b", "c", "d"], ["b", "c", "d"], ["b", "c", "d"], ["c", "d"], ["c", "d"]]
    assert sorted((r["round"], r["group_key"], r["have"]) for r in log.where("group_key = 'b'").collect()) == [(1, "b", 0), (2, "b", 1), (3, "b", 2)]
    none, log = rounds.until_reached(goals.where("target = 0"), work, lambda r: r.groupBy("group").agg(F.count("*").alias("have")), str(tmp_path / "n"), "group string, turn int, k int")
    assert none.count() == 0 and log.count() == 0 and len(asked) == 5
    with pytest.raises(RuntimeError):
        rounds.until_reached(goals, lambda o, t: supply.limit(1), lambda r: r.groupBy("group").agg(F.lit(0).alias("have")), str(tmp_path / "e"), "group string, turn int, k int", most=3)


def test_pages_count_while_they_add_something(spark):
    rng = random.Random(3)
    rows = [(g, page, pos, rng.randint(0, 9 + 3 * g)) for g in range(6) for page in range(1 + g % 2, 9) for pos in range(rng.choice([0, 2, 3])) if not (g == 4 and page == 3)]
    want = []
    for g in {r[0] for r in rows}:
        seen, page = set(), min(r[1] for r in rows if r[0] == g)
        while True:
            fresh = {}
            for r in sorted(r for r in rows if r[:2] == (g, page)):
                if r[3] not in seen:
                    fresh.setdefault(r[3], r)
            if not fresh:
                break
            want += fresh.values()
            seen |= set(fresh)
            page += 1
    df = spark.createDataFrame(rows, "g int, page int, pos int, name int").repartition(3)
    assert sorted(map(tuple, workset.fresh_prefix(df, "g", "page", "name", [F.col("pos")]).select("g", "page", "pos", "name").collect())) == sorted(want)


def test_windows_over_pages_equal_one_order(spark):
    rng = random.Random(1)
    rows = [(g, page, pos) for g in range(3) for page in range(6) for pos in range(rng.randint(0, 5))]
    df = spark.createDataFrame(rows, "g int, page int, pos int").repartition(4)
    for offset, limit in ((0, 4), (3, 6), (100, 2), (0, 1000)):
        want = [r for g in range(3) for r in sorted(x for x in rows if x[0] == g)[offset : offset + limit]]
        assert sorted(map(tuple, workset.paged_window(df, "g", "page", [F.col("pos")], offset, limit).select("g", "page", "pos").collect())) == want


def test_rules_met_by_their_heads_decide_as_all_patterns_do(spark):
    rng = random.Random(7)
    patterns = ["/", "/a", "/a/", "/a/b", "/a/*", "/*/b", "*", "*b$", "/a$", "/a/*c", "/c?x=*", "/b/*$", "/a.b", "$", "/*?y=1"]
    rules = [(o, "*", rng.random() < 0.4, p) for o in "xyz" for p in rng.sample(patterns, 6)]
    paths = ["/" + "/".join(rng.choice(["a", "b", "c", "a.b", "c?x=1", "?y=1", ""]) for _ in range(rng.randint(0, 3))) for _ in range(120)]
    asks = [(k, rng.choice("xyzw"), p) for k, p in enumerate(paths)]

    def decides(origin, path):
        best = None
        for _, _, allow, p in (r for r in rules if r[0] == origin):
            body = re.escape(p[:-1] if p.endswith("$") else p).replace("\\*", ".*")
            if re.match(body + ("$" if p.endswith("$") else ""), path):
                best = max(best or (-1, False), (len(p), allow))
        return best is None or best[1]

    df = spark.createDataFrame(rules, "origin string, agent string, allow boolean, pattern string")
    got = robots.allowed(spark.createDataFrame(asks, "i int, origin string, path string"), df, "origin", "path", "i")
    assert {r["i"]: r["allowed"] for r in got.collect()} == {i: decides(o, p) for i, o, p in asks}
    joins = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x and "RLIKE" in x.upper()]
    assert len(joins) == 1 and "_start" in joins[0] and "_head" in joins[0]  # expressions are tried on what met by its head


def test_crawl_counts_on_all_levels(spark):
    log = spark.createDataFrame([("h", False, True, False, 200, None), ("h", True, False, False, None, None), ("g", False, False, False, None, None), ("g", False, True, True, None, None), ("g", False, True, False, 500, None), ("g", False, True, False, None, "timeout")], "host string, cached boolean, ok boolean, tripped boolean, status int, error string")
    named = log.select("host", robots.outcome(F.col("cached"), F.col("ok"), F.col("tripped"), F.col("status"), F.col("error")).alias("outcome"))
    got = {(r["level"], r["host"], r["outcome"]): r["requests"] for r in robots.crawl_counts(named).collect()}
    assert got["all", None, None] == 6 and got["outcome", None, "blocked"] == 2 and got["host", "g", None] == 4 and got["host and outcome", "h", "cached"] == 1 and got["host and outcome", "g", "failed"] == 2
