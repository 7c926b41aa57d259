"""Approximate nearest neighbours by an inverted multi-index, largest inner product first.

The share of rows that a query visits is measured, not guessed: on the sample
that fits the codebooks, queries of it search it by brute force, and the share
of rows that the multi-sequence traversal must pass to meet ``RECALL`` of the
true neighbours becomes the stopping rule.  Cells are scored by the sum of both
halves' inner products with the centroids.  Visited rows are scored in double
precision on the original vectors, those that may be among the nearest a second
time in one order of summing.

Cells lie in order on shelves of ``SHELF`` rows.  A query goes once to every shelf
that holds a cell of its traversal, with one bit a cell, and a task meets some
hundred queries with a shelf at once: what is moved grows as queries x shelves.

Defined cases: fewer than k candidates give all; ties go to the smaller id;
vectors that are null, zero or hold null or non-finite components, and rows
without an id, take no part; vectors of different lengths are searched apart; repeated ids are separate
rows, of which a query skips those with its own id; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

NEIGHBOURS = 20
RECALL = 0.97
PROBES = 256
CELL_ROWS = 40
SHELF = 4096
ASKED = 2048
SLICE = 256


def visited_share(index: vectors.MultiIndex, sample: np.ndarray, k: int, recall: float) -> float:
    """The share of rows, in the order of traversal, that holds ``recall`` of the k nearest."""
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1.0
    cells = index.cells(sample)
    size = np.bincount(cells, minlength=len(index.books[0]) * len(index.books[1]))
    step = max(1, len(sample) // PROBES)
    needed = []
    for i in range(0, len(sample), step):
        q = sample[i]
        score = sample @ q
        score[i] = -np.inf
        best = np.argpartition(-score, k)[:k]
        a, b = (book @ part.T for book, part in zip(index.books, index.halves(q[None])))
        total = (a + b.T).reshape(-1)
        order = np.argsort(-total, kind="stable")
        passed = np.empty(len(size))
        passed[order] = np.cumsum(size[order])
        needed.append(passed[cells[best]])
    return float(min(1.0, np.quantile(np.concatenate(needed), recall) / len(sample)))


def front(left: np.ndarray, right: np.ndarray, held: np.ndarray, needed: int) -> np.ndarray:
    """True for the cells that ``vectors.multi_sequence`` passes until they hold ``needed`` rows, and those level with the last.

    Each step of the traversal is a staircase over both sorted lists; the step is found by halving sums.
    """
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    low, high = left[a], right[b]
    passed = np.zeros((len(a), len(b) + 1), np.int64)
    np.cumsum(held[a][:, b], axis=1, out=passed[:, 1:])
    at = np.arange(len(a))
    stairs, under = np.full(len(a), len(b)), np.zeros(len(a), np.int64)
    lo, hi = low[0] + high[0], low[-1] + high[-1]
    while (stairs - under).sum() > 1:
        middle = lo + (hi - lo) / 2
        step = np.searchsorted(high, middle - low, "right")
        enough = passed[at, step].sum() >= needed
        if middle in (lo, hi):
            stairs = np.minimum(stairs, step) if enough else stairs
            break
        if enough:
            hi, stairs = middle, step
        else:
            lo, under = middle, step
    out = np.zeros(held.shape, bool)
    out[np.ix_(a, b)] = np.arange(len(b)) < stairs[:, None]
    return out


class Shelves:
    """Cells in order on shelves of at most ``SHELF`` rows; a cell with more has shelves of its own, and rows are dealt to them by id."""

    def __init__(self, held: np.ndarray):
        self.held = held
        flat = held.reshape(-1)
        self.parts, self.first = np.maximum(-(-flat // SHELF), 1), np.zeros(len(flat), np.int64)
        self.ranges: list[tuple[int, int]] = []  # the cells from .. to of every shelf
        room = 0
        for cell in np.flatnonzero(flat):
            if self.parts[cell] > 1 or flat[cell] > room:
                self.first[cell], room = len(self.ranges), SHELF if self.parts[cell] == 1 else 0
                self.ranges += [(int(cell), int(cell) + 1)] * int(self.parts[cell])
            else:
                self.first[cell] = len(self.ranges) - 1
                self.ranges[-1] = (self.ranges[-1][0], int(cell) + 1)
            room -= int(flat[cell]) if self.parts[cell] == 1 else 0

    def of(self, cells: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return self.first[cells] + (common.mix(ids.astype(common.U64)) % self.parts[cells].astype(common.U64)).astype(np.int64)


def _packed(x: np.ndarray) -> bytes:
    """Vectors in single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        short = x.astype("<f4")
    return (short if (short == x).all() else x.astype("<f8")).tobytes()


def _shelved(shelves):
    def run(batches):
        for batch in batches:
            ids, x, cells = batch.column("id").to_numpy(zero_copy_only=False), vectors.matrix(batch.column("v")), batch.column("cell").to_numpy()
            shelf = shelves.value.of(cells, ids)
            order = np.argsort(shelf, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(shelf[order])) + 1):
                if len(mine):
                    cell = [[int(shelf[mine[0]])], [cells[mine].astype(np.int32).tobytes()], [ids[mine].astype(np.int64).tobytes()], [_packed(x[mine])]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cell, (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["shelf", "cells", "ids", "vs"])

    return run


def _asked(index, shelves, needed: int):
    def run(batches):
        own, layout = index.value, shelves.value
        for batch in batches:
            for at in range(0, len(batch), ASKED):
                part = batch.slice(at, ASKED)
                ids, x = part.column("id").to_numpy(zero_copy_only=False), vectors.matrix(part.column("v"))
                order = np.argsort(own.cells(x), kind="stable")  # neighbours visit the same cells
                ids, x = ids[order], x[order]
                left, right = (-(half @ book.T) for half, book in zip(own.halves(x), own.books))
                seen = np.stack([np.packbits(front(a, b, layout.held, needed)) for a, b in zip(left, right)])
                for shelf, (lo, hi) in enumerate(layout.ranges):
                    bits = np.unpackbits(seen[:, lo // 8 : -(-hi // 8)], axis=1)[:, lo % 8 : lo % 8 + hi - lo]
                    who = np.flatnonzero(bits.any(axis=1))
                    if len(who):
                        cell = [[shelf], [lo], [ids[who].astype(np.int64).tobytes()], [_packed(x[who])], [np.packbits(bits[who], axis=1).tobytes()]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(cell, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["q_shelf", "q_low", "q_ids", "q_vs", "q_bits"]
                        )

    return run


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def met(asked: np.ndarray, x: np.ndarray, seen: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """(query's place, row's place, score): the k nearest rows of every query among those that it sees, nearest first."""
    size = np.sqrt((x * x).sum(axis=1))
    for lo in range(0, len(x), SLICE):
        some = seen[lo : lo + SLICE]
        use = np.flatnonzero(some.any(axis=0))
        if not len(use):
            continue
        own, mine = x[lo : lo + SLICE], rows[use]
        near = own @ mine.T
        good = some[:, use] & (ids[use] != asked[lo : lo + SLICE, None])
        near[~good] = -np.inf
        if len(use) > k:
            least = np.partition(near, len(use) - k, axis=1)[:, len(use) - k]
            slack = 1e-12 * size[lo : lo + SLICE] * np.sqrt((mine * mine).sum(axis=1).max())
            good &= near >= (least - slack)[:, None]
        q, r = np.nonzero(good)
        score = np.concatenate([(mine[r[i : i + 65536]] * own[q[i : i + 65536]]).sum(axis=1) for i in range(0, len(q), 65536)] or [np.zeros(0)])  # one order of summing, so that equal vectors tie
        order = np.lexsort((ids[use[r]], -score, q))
        q, r, score = q[order], r[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top = rank < k
        yield lo + q[top], use[r[top]], score[top]


def _scored(k: int, width: int):
    def run(batches):
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def told():
            for lo in range(0, len(kept), 1000):
                part = list(kept.items())[lo : lo + 1000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q for q, _ in part], pa.int64()), pa.array([v[0] for _, v in part], pa.list_(pa.int64())), pa.array([v[1] for _, v in part], pa.list_(pa.float64()))],
                    ["query_id", "ids", "scores"],
                )
            kept.clear()

        def vectors_of(body: bytes, n: int) -> np.ndarray:
            return np.frombuffer(body, "<f4" if len(body) == 4 * n * width else "<f8").reshape(n, width).astype(np.float64)

        for batch in batches:
            for r in batch.to_pylist():
                members = r["members"]
                cells = np.concatenate([np.frombuffer(m["cells"], np.int32) for m in members])
                ids = np.concatenate([np.frombuffer(m["ids"], np.int64) for m in members])
                rows = np.concatenate([vectors_of(m["vs"], len(m["ids"]) // 8) for m in members])
                asked = np.frombuffer(r["q_ids"], np.int64)
                bits = np.frombuffer(r["q_bits"], np.uint8).reshape(len(asked), -1)
                seen = np.unpackbits(bits, axis=1)[:, cells - r["q_low"]].astype(bool)
                for q, row, score in met(asked, vectors_of(r["q_vs"], len(asked)), seen, ids, rows, k):
                    cuts = np.flatnonzero(np.diff(q)) + 1
                    for i, j in zip(np.r_[0, cuts], np.r_[cuts, len(q)]):
                        if i == j:
                            continue
                        name, found, close = int(asked[q[i]]), ids[row[i:j]], score[i:j]
                        if name in kept:
                            found, close = np.concatenate([kept[name][0], found]), np.concatenate([kept[name][1], close])
                            top = best(found, close, k)
                            found, close = found[top], close[top]
                        kept[name] = found, close
            if len(kept) > 20_000:
                yield from told()
        yield from told()

    return run


def nearest(rows: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` against ``rows``, both (id, v)."""
    parts = [_nearest(part, queries.where(F.size("v") == n), n, count, k, recall) for n, part, count in vectors.by_length(rows)]
    if not parts:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionByName, parts)


def _nearest(rows: DataFrame, queries: DataFrame, width: int, count: int, k: int, recall: float) -> DataFrame:
    """``nearest`` among vectors of one length."""
    spark = rows.sparkSession
    index, sample = vectors.codebooks(rows, vectors.centroids_for(count, CELL_ROWS))
    share = visited_share(index, sample, k, recall)
    shared = spark.sparkContext.broadcast(index)
    celled = common.stored(common.mapped(rows.select("id", "v"), vectors.celled(shared), f"id long, v {rows.schema['v'].dataType.simpleString()}, cell int"), "search-celled")
    held = np.zeros((len(index.books[0]), len(index.books[1])), np.int64)
    for r in celled.groupBy("cell").count().collect():  # MOST_CENTROIDS squared at most
        held.flat[r["cell"]] = r["count"]
    shelves = spark.sparkContext.broadcast(Shelves(held))
    needed = max(int(np.ceil(share * count)), k + 1)
    asked = queries.select("id", "v").repartition(max(1, queries.count() // ASKED), "id")
    asked = common.mapped(asked, _asked(shared, shelves, needed), "q_shelf int, q_low int, q_ids binary, q_vs binary, q_bits binary")
    packed = common.mapped(celled, _shelved(shelves), "shelf int, cells binary, ids binary, vs binary")
    packed = packed.groupBy("shelf").agg(F.collect_list(F.struct("cells", "ids", "vs")).alias("members"))
    both = asked.join(packed, F.col("q_shelf") == F.col("shelf")).select("q_low", "q_ids", "q_vs", "q_bits", "members")
    found = common.mapped(both, _scored(k, width), "query_id long, ids array<long>, scores array<double>")
    pairs = found.select("query_id", F.arrays_zip("scores", "ids").alias("pairs"))
    merged = pairs.groupBy("query_id").agg(F.flatten(F.collect_list("pairs")).alias("pairs"))
    ranked = F.slice(F.array_sort(F.transform("pairs", lambda p: F.struct((-p["scores"]).alias("far"), p["ids"].alias("id")))), 1, k)
    return merged.select("query_id", F.posexplode(ranked).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )


def op6_search(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v"))
    rows = common.stored(vectors.taking_part(table), "search-rows")
    return nearest(rows, rows.where("id % 20 = 0"))
