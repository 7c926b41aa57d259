"""The audit against every order applied on its own."""

import itertools
import re

from pyspark.sql import functions as F

from factloom.llm import audit

from .helpers import DOCS, documents, empty

LABELS = "doc_id long, quality int, toxic int"


def fixture(spark):
    df, rows = documents(spark)
    extra = [(900 + k, t, "en", s, 0) for k, (t, s) in enumerate([
        ("UP " * 60, "s1"), ("UP " * 60, ""), ("one two # three", None), (" ".join(f"w{i}" for i in range(80)), "new"), (" ".join(f"w{i}" for i in range(80)), "new"), ("É" * 20 + "A", "s1"), ("AA " + "b" * 37, "s1"), ("a\x1fb " * 60, "s2"), ("x y " * 55, "s2")])]
    extra += [(None, "one two # three", "en", None, 0), (None, None, "en", "s1", 0), (3, "again", "en", "s3", 0)]
    more = spark.createDataFrame(extra, DOCS)
    for c in [c for c in df.columns if c not in more.columns]:
        more = more.withColumn(c, F.lit("y"))
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 960, 3)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (6, None, None)]
    return df.unionByName(more).withColumn("part", F.lit("z")).withColumn("fails", F.lit(1)), [*rows, *extra], labels


def brute(rows, labels):
    word = re.compile("[^\x20\x09-\x0d]+")
    firsts = {}
    for i, t, *_ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    docs = []
    for i, t, _, s, _ in rows:
        t = t or ""
        ws = word.findall(t)
        fails = {"A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and firsts[t] < i}
        mine = [y for y in labels if i is not None and y[0] == i]
        docs.append((s or "", fails, any(y[1] == 1 for y in mine), any(y[2] == 1 for y in mine)))
    out = {}
    for part in {d[0] for d in docs}:
        mine, removed = [d for d in docs if d[0] == part], dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in alive if d[1][f]]
                alive = [d for d in alive if not d[1][f]]
                removed[f] += len(gone)
                alone = sum(d[1][f] and sum(d[1].values()) == 1 for d in mine)
                out[part, order, step] = [len(alive), len(gone), sum(d[1][f] for d in mine) - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def test_against_every_order(spark, tmp_path):
    docs, rows, labels = fixture(spark)
    flags = audit.flagged(docs, spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, audit.audit(flags).collect())) == brute(rows, labels)


def test_each_unordered_state_is_visited_once(spark):
    rows = spark.createDataFrame([("p", k, True, False) for k in range(32)], "part string, fails int, good boolean, toxic boolean")
    edges = audit.edges(rows, 5)
    assert edges.count() == 80 and edges.select("state", "filter").distinct().count() == 80
    assert {r["state"]: r["alive"] for r in edges.select("state", "alive").distinct().collect()} == {s: 2 ** (5 - s.bit_count()) for s in range(31)}
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_empty_table_has_no_parts(spark):
    assert audit.audit(audit.flagged(empty(spark), spark.createDataFrame([], LABELS))).count() == 0
