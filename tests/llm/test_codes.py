"""Codes against plain Lloyd rounds in whole numbers, and the bounds on their own."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from factloom.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(n=400, d=32, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32) * 0.3
    x[50:120] = x[3]  # copies, also among the first entries
    x[5] = x[4]
    x[130:160] = np.round(x[130:160], 1)  # ties
    rows = [(i * 3 % 1009, v.tolist(), [None, 0, 1, 1][i % 4]) for i, v in enumerate(x)]
    rows[200] = (rows[200][0], None, 1)
    rows[201] = (rows[201][0], [float("nan")] * d, 1)
    rows[202] = (rows[202][0], [None] + [0.0] * (d - 1), 0)
    rows[203] = (rows[203][0], [float("inf")] * d, 0)
    rows[204] = (rows[204][0], [0.0] * d, None)
    rows[205] = (None, rows[205][1], None)
    rows.append(rows[7])
    return rows


def brute(rows, parts=16, entries=64, rounds=2):
    live = [(i, [math.floor(256 * c) for c in v], y) for i, v, y in rows if v is not None and None not in v and all(map(math.isfinite, v))]
    live.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(live[0][1]) // parts
    cut = [[tuple(v[p * w : p * w + w]) for p in range(parts)] for _, v, _ in live]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, x: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(rounds):
        at = [[near(p, c[p]) for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, a in zip(cut, at) if a[p] == e]
                if mine:
                    books[p][e] = tuple(sum(x) // len(mine) for x in zip(*mine))
    out = []
    for (i, _, y), c in zip(live, cut):
        code = [near(p, c[p]) for p in range(parts)]
        out.append((i, y, bytes(code).hex(), sum(far(c[p], books[p][code[p]]) for p in range(parts))))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def key(r):
    return tuple((v is None, v or 0) for v in r)


def coded(df):
    return codes.compress(df.selectExpr("vec_id AS id", "label", "embedding AS v")).select("id", "label", F.lower(F.hex("code")).alias("code"), "error", "codebooks_sha256")


def test_against_plain_rounds(spark):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "'x' AS id", "'y' AS v", "1 AS code", "2 AS error")
    got = coded(df).collect()
    want, sha = brute(rows)
    assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(want, key=key)
    assert {r["codebooks_sha256"] for r in got} == {sha}


def test_query_sums_errors_over_labels(spark, tmp_path):
    rows = table(260, 16, 3)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = codes.op11_codes(spark, str(tmp_path)).collect()
    want, sha = brute(rows)
    sums = {y: sum(e for _, z, _, e in want if z == y) for _, y, _, _ in want}
    assert sorted([tuple(r) for r in got], key=key) == sorted([(i, c, e, sums[y], sha) for i, y, c, e in want], key=key)


def test_defined_cases(spark):
    assert coded(spark.createDataFrame([], SCHEMA)).count() == 0
    few = [(3, [0.5] * 16, 1), (1, [0.25] * 16, 1), (2, [0.0] * 16, None)]
    got = {r["id"]: (r["code"], r["error"]) for r in coded(spark.createDataFrame(few, SCHEMA)).collect()}
    assert got == {1: ("00" * 16, 0), 2: ("01" * 16, 0), 3: ("02" * 16, 0)}
    odd = [(1, [], 0), (2, [], 0), (3, [0.5, 1.0, -1.0], 0), (4, [1e6] * 3, 0), (5, [0.25] * 16, 0)]  # lengths of their own; one beyond the range
    got = {r["id"]: (r["code"], r["error"], r["codebooks_sha256"]) for r in coded(spark.createDataFrame(odd, SCHEMA)).collect()}
    assert set(got) == {1, 2, 3, 5} and got[1] == got[2] == ("00" * 16, 0, hashlib.sha256(b"").hexdigest())
    assert got[3][:2] == ("00" * 16, 0) and got[3][2] == hashlib.sha256(b"128,256,-256").hexdigest()


def test_bounds_leave_most_parts_unscanned_and_change_nothing():
    rng = np.random.default_rng(0)
    centres = rng.integers(-300, 300, (20, 4))
    x = (centres[rng.integers(0, 20, 3000)] + rng.integers(-9, 10, (3000, 4))).astype(np.int64)
    book = x[:64].copy()
    at, upper, lower = codes.scan(x, book)
    scanned = []
    for _ in range(5):
        new = book.copy()
        for e in range(len(book)):
            if (at == e).any():
                new[e] = x[at == e].sum(0) // (at == e).sum()
        at, upper, lower, n = codes.follow(x, at, upper, lower, new, codes.Moves(book, new))
        far = codes.distances(x, new)
        assert (at == far.argmin(1)).all()  # the lower index where distances tie
        exact = np.sqrt(far.astype(float))
        assert (upper >= exact[np.arange(len(x)), at]).all()
        exact[np.arange(len(x)), at] = np.inf
        assert (lower <= exact.min(1)).all()
        scanned.append(n)
        book = new
    assert scanned[-1] < len(x) / 2


def test_ties_are_scanned():
    x = np.array([[0]])
    old, new = np.array([[-4], [5]]), np.array([[-4], [4]])
    at, upper, lower = codes.scan(x, old)
    assert codes.follow(x, at, upper, lower, new, codes.Moves(old, new))[0].tolist() == [0]
    old, new = np.array([[5], [-4]]), np.array([[4], [-4]])  # the other entry comes level, with the lower index
    at, upper, lower = codes.scan(x, old)
    assert at.tolist() == [1] and codes.follow(x, at, upper, lower, new, codes.Moves(old, new))[0].tolist() == [0]
