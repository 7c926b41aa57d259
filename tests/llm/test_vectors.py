import numpy as np

from factloom.llm import embdup, search, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, n=600, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[50:90] = x[10]  # copies
    x[100:140] = x[20] + rng.normal(size=(40, d)).astype(np.float32) * 0.1
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    rows[300] = (300, None, 1)
    rows[301] = (301, [0.0] * d, 1)
    rows[302] = (302, [float("nan")] * d, 1)
    rows[303] = (303, [None] * d, 1)
    rows[304] = (304, rows[304][1], None)
    rows.append(rows[7])
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "'y' AS v", "1 AS cell"), rows


def good(v):
    return v is not None and None not in v and np.isfinite(v).all() and any(v)


def test_search(spark):
    df, rows = table(spark)
    part = vectors.taking_part(df.selectExpr("vec_id AS id", "embedding AS v"))
    got = search.nearest(part, part.where("id % 20 = 0")).collect()
    live = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if good(v)]
    ids, x = np.array([i for i, _ in live]), np.stack([v for _, v in live])
    found = wanted = 0
    for q in {i for i in ids if i % 20 == 0}:
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        score = (x * x[ids == q][0]).sum(1)
        exact = dict(zip(ids.tolist(), score.tolist()))
        assert [m[0] for m in mine] == list(range(1, 21)) and all(s == exact[i] and i != q for _, i, s in mine)
        assert [m[1:] for m in mine] == sorted((m[1:] for m in mine), key=lambda m: (-m[1], m[0]))
        best = {ids[k] for k in [k for k in np.lexsort((ids, -score)) if ids[k] != q][:20]}
        found, wanted = found + len(best & {m[1] for m in mine}), wanted + 20
    assert found >= 0.9 * wanted
    none = part.where("false")
    assert search.nearest(none, none).count() == 0
    few = part.where("id < 5")
    assert search.nearest(few, few).count() == 20


def test_recall_of_the_stopping_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 16))
    index = vectors.MultiIndex(x)
    share = search.visited_share(index, x, 20, 0.97)
    assert 0 < share < 1
    total = lambda q: [(a, b) for a, b, _ in vectors.multi_sequence(*(-(book @ p) for book, p in zip(index.books, (q[:8], q[8:]))))]
    cells = index.cells(x)
    hit = 0
    for q in x[::100]:
        best, passed, seen = set(np.argsort(-(x @ q))[1:21]), 0, set()
        for a, b in total(q):
            mine = np.flatnonzero(cells == a * len(index.books[1]) + b)
            seen |= set(mine)
            passed += len(mine)
            if passed >= share * len(x):
                break
        hit += len(best & seen)
    assert hit / (40 * 20) >= 0.9


def test_near_duplicates(spark):
    df, rows = table(spark)
    got = sorted(map(tuple, embdup.near_duplicates(df).collect()))
    n, root = len(rows), list(range(len(rows)))
    links = [0] * n

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if good(v) else None for _, v, _ in rows]
    for a in range(n):
        for b in range(a + 1, n):
            if unit[a] is not None and unit[b] is not None and rows[a][2] is not None and rows[a][2] == rows[b][2] and unit[a] @ unit[b] >= 0.93:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)), key=lambda k: (rows[k][0], k))
                root[y] = x
    want = sorted((rows[k][0], links[k], rows[find(k)][0], rows[find(k)][0] == rows[k][0]) for k in range(n))
    assert sum(links) > 100 and got == want
    assert embdup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_multi_sequence_is_in_order():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    got = list(vectors.multi_sequence(a, b))
    assert [t for _, _, t in got] == sorted((a[:, None] + b).reshape(-1)) and len({(i, j) for i, j, _ in got}) == 35


def test_vectors_of_other_lengths_and_repeated_ids(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist(), i % 2) for i in range(60)] + [(100, [1.0] * 9, 0), (101, [1.0] * 9, 0)]
    x = np.array(rows[0][1])
    rows += [(7, (x * 3).tolist(), 0), (7, (x * 5 + 0.01).tolist(), 0), (3, x.tolist(), 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    part = vectors.taking_part(df.selectExpr("vec_id AS id", "embedding AS v"))
    got = search.nearest(part, part.where("id IN (0, 100)")).collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 100] == [101] and sum(r["query_id"] == 0 for r in got) == 20
    out = embdup.near_duplicates(df.selectExpr("vec_id", "embedding", "concat('label ', label) AS label")).collect()
    assert len(out) == len(rows)
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in out if r["vec_id"] == 100] == [(1, 100, True)]
    linked = [r for r in out if r["component_id"] == 0]
    assert sorted(r["vec_id"] for r in linked) == [0, 3, 7, 7] and {r["n_links"] for r in linked} == {3} and [r["vec_id"] for r in linked if r["kept"]] == [0]


def test_search_leaves_most_of_a_clustered_table_unread():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(150, 32))
    x = centres[rng.integers(0, 150, 20_000)] + rng.normal(size=(20_000, 32)) * 0.3
    index = vectors.MultiIndex(x, vectors.centroids_for(len(x)))
    assert search.visited_share(index, x, 20, search.RECALL) < 0.2
