"""An inverted multi-index over vector halves, for search and for near-duplicates.

The two halves of every vector are quantised by their own codebook (k-means on a
bounded sample of ``SAMPLE`` vectors), so the cells are pairs of centroids.  A
query walks the cells by the multi-sequence method: both halves' centroids are
sorted by their own score and a heap yields pairs by the sum, best first.

The codebooks grow with the rows, so that a cell holds about ``CELL_ROWS`` rows as
far as ``MOST_CENTROIDS`` go: the driver sees one count a cell, a bounded number.

Vectors are kept in blocks of at most ``BLOCK`` rows of one cell, so a cell that
holds a third of all rows is many blocks, and a query meets blocks, not rows.
Vectors that are null, zero or hold null or non-finite components take no part;
vectors of different lengths never meet: each length is a table of its own.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SAMPLE = 20_000
CELL_ROWS = 200
LEAST_CENTROIDS, MOST_CENTROIDS = 4, 512
BLOCK = 256


def usable(column):
    """True for vectors that take part."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(column.isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    k = min(k, len(distinct))
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        near = ((distinct**2).sum(1)[:, None] - 2 * distinct @ centres.T + (centres**2).sum(1)).argmin(1)
        for c in range(k):
            mine = distinct[near == c]
            if len(mine):
                centres[c] = mine.mean(0)
    return centres


class MultiIndex:
    """The two codebooks; a cell is a pair of centroids."""

    def __init__(self, sample: np.ndarray, centroids: int = 16):
        self.half = sample.shape[1] // 2
        self.books = [k_means(part, centroids) for part in self.halves(sample)]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per half: the centroid of each row."""
        return tuple(((book**2).sum(1) - 2 * part @ book.T).argmin(1) for part, book in zip(self.halves(x), self.books))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.nearest(x)
        return a * len(self.books[1]) + b

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(
            np.sqrt(np.maximum((part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1), 0)) for part, book in zip(self.halves(x), self.books)
        )


def multi_sequence(left: np.ndarray, right: np.ndarray):
    """Pairs (i, j, left[i] + right[j]) by rising sum."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, seen = [(left[a[0]] + right[b[0]], 0, 0)], {(0, 0)}
    while heap:
        total, i, j = heapq.heappop(heap)
        yield a[i], b[j], total
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (left[a[p]] + right[b[q]], p, q))


def celled(index):
    def run(batches):
        for batch in batches:
            cells = index.value.cells(matrix(batch.column("v")))
            yield batch.append_column("cell", pa.array(cells.astype(np.int32)))

    return run


def blocks(rows: DataFrame, index, extra: tuple[str, ...] = (), block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rows (id, v, extra ...) packed by (extra, cell, block), and the blocks that each (extra, cell) has.

    Rows are dealt to the blocks of their cell by hash, so a cell that holds a
    third of all rows is many blocks and no task sees it whole.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = common.stored(common.mapped(rows, celled(index), f"{fields}, cell int"), "vectors-celled")
    counted = placed.groupBy(*extra, "cell").agg(F.count("*").alias("rows"))
    cells = common.stored(counted.withColumn("blocks", F.ceil(F.col("rows") / block).cast("int")), "vectors-cells")
    dealt = cells.select(*[F.col(c).alias(f"c_{c}") for c in extra], F.col("cell").alias("c_cell"), "blocks")
    same = F.col("cell") == F.col("c_cell")
    for c in extra:
        same = same & F.col(c).eqNullSafe(F.col(f"c_{c}"))
    salted = placed.join(dealt, same).withColumn("block", F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks")).cast("int"))
    others = [f.name for f in rows.schema.fields if f.name not in extra]
    packed = salted.groupBy(*extra, "cell", "block").agg(*[F.collect_list(F.struct(*others)).alias("members")])
    return packed.select(*extra, "cell", "block", *[F.col(f"members.{c}").alias(c) for c in others]), cells


def centroids_for(rows: int, cell_rows: int = CELL_ROWS) -> int:
    return int(min(max(np.sqrt(rows / cell_rows), LEAST_CENTROIDS), MOST_CENTROIDS))


def codebooks(rows: DataFrame, centroids: int, sample: int = SAMPLE) -> tuple[MultiIndex, np.ndarray] | tuple[None, None]:
    """A MultiIndex fitted on at most ``sample`` rows (id, v), drawn by hash, and those rows."""
    drawn = rows.select("v", F.xxhash64("id", F.lit(3)).alias("draw"), "id").orderBy("draw", "id").limit(sample).select("v").toArrow()
    points = matrix(drawn.column("v"))
    return (MultiIndex(points, centroids), points) if len(points) else (None, None)


def taking_part(rows: DataFrame) -> DataFrame:
    """Rows (id, v, ...) that take part."""
    return rows.where("id IS NOT NULL").where(usable(F.col("v")))


def by_length(rows: DataFrame) -> list[tuple[int, DataFrame, int]]:
    """``rows`` cut by the length of their vectors, as (length, rows, number of rows)."""
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows")).orderBy("n").collect()  # one row for each length
    return [(r["n"], rows.where(F.size("v") == r["n"]), r["rows"]) for r in sizes]
