"""A search's cells on shelves: what a query visits, what it is sent, and what it finds there."""

import numpy as np

from factloom.llm import search, vectors


def test_front_is_a_step_of_the_multi_sequence():
    rng = np.random.default_rng(3)
    for turn in range(60):
        a, b = rng.integers(0, 12, 7) / 4 if turn % 2 else rng.normal(size=7), rng.normal(size=1 + turn % 6)
        held = rng.integers(0, 9, (len(a), len(b)))
        needed = int(rng.integers(1, held.sum() + 5))
        seen = search.front(-a, -b, held, needed)
        walk, passed = [], 0
        for i, j, total in vectors.multi_sequence(-a, -b):
            walk.append((i, j))
            passed += held[i, j]
            if passed >= needed:
                break
        assert all(seen[i, j] for i, j in walk)
        others = [-a[i] - b[j] for i, j in zip(*np.nonzero(seen)) if (i, j) not in walk]
        assert all(abs(t - total) < 1e-9 for t in others)


def test_shelves_hold_every_cell_once_and_split_large_ones(monkeypatch):
    monkeypatch.setattr(search, "SHELF", 100)
    held = np.array([[40, 0, 60, 1], [350, 30, 80, 0], [5, 100, 7, 2]])
    shelves = search.Shelves(held)
    cells = np.repeat(np.arange(12), held.reshape(-1))
    at = shelves.of(cells, np.arange(len(cells)))
    count = np.bincount(at, minlength=len(shelves.ranges))
    assert (count > 0).all() and len(set(at[cells == 4])) == 4 and np.delete(count, np.unique(at[cells == 4])).max() <= 100
    assert all(shelves.ranges[s][0] <= c < shelves.ranges[s][1] for s, c in zip(at, cells))
    assert all(len(set(at[cells == c])) == 1 for c in set(cells.tolist()) - {4})


def test_a_query_is_sent_once_to_a_shelf(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 8))
    index = vectors.MultiIndex(x, 12)
    held = np.bincount(index.cells(x), minlength=144).reshape(12, 12)
    shelves = search.Shelves(held)
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:300])], "id long, v array<double>").repartition(1)
    share = spark.sparkContext.broadcast
    sent = asked.mapInArrow(search._asked(share(index), share(shelves), 4000), "q_shelf int, q_low int, q_ids binary, q_vs binary, q_bits binary").collect()
    assert len(shelves.ranges) == 2 and sum(len(r["q_ids"]) // 8 for r in sent) <= 600 < 300 * np.count_nonzero(held) / 4


def test_met_equals_brute_force_with_ties():
    rng = np.random.default_rng(5)
    rows = rng.integers(-2, 3, (900, 6)).astype(float)
    ids = rng.permutation(900)
    asked, x = ids[:400], rows[:400]
    seen = rng.random((400, 900)) < 0.4
    seen[7] = False
    got = {}
    for q, r, score in search.met(asked, x, seen, ids, rows, 5):
        for i, j, s in zip(q, r, score):
            got.setdefault(int(i), []).append((float(s), int(ids[j])))
    for i in range(400):
        want = sorted((-(rows[j] * x[i]).sum(), ids[j]) for j in range(900) if seen[i, j] and ids[j] != asked[i])[:5]
        assert [(-s, n) for s, n in got.get(i, [])] == want
