"""Near-duplicate vectors by an inverted multi-index, verified by cosine.

Vectors are brought to length one.  Equal vectors of one label collapse to their
smallest id and a count.  Every class walks the product grid of both halves'
codebooks, nearest cells first, and stops after ``reach`` cells, a number that
is measured on the sample: points moved to just the cosine limit must be met
with ``RECALL``.  A block of one cell and the queries that visit it meet as two
matrices; what leaves is one count a vector and a spanning forest of the links,
never the links themselves.  A link seen from one side only is counted at both.

Defined cases: null labels and vectors that are null, zero or hold null or
non-finite components link with nothing and stay, and so do vectors of different
lengths; rows that share an id are vectors of their own (equal ones link as equal
vectors do, the component is the smallest id of its rows, and each row whose id
that is stays); a null id is kept, links with nothing and has a null component;
labels may be of any type that has a text; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vectors

LIMIT = 0.93
CELL_ROWS = 64
RECALL = 0.995


def reach(index: vectors.MultiIndex, sample: np.ndarray, limit: float, recall: float, seed: int = 11) -> int:
    """Cells to visit so that a point at the cosine limit from a sample point is met."""
    rng = np.random.default_rng(seed)
    x = sample[:2000]
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
    moved = limit * x + np.sqrt(1 - limit * limit) * noise
    total = sums(index, x)
    mine = total[np.arange(len(x)), index.cells(moved)]
    return int(np.quantile((total <= mine[:, None]).sum(1), recall))


def sums(index: vectors.MultiIndex, x: np.ndarray) -> np.ndarray:
    """Summed squared distances of each row to every cell."""
    a, b = index.distances(x)
    return (a[:, :, None] ** 2 + b[:, None, :] ** 2).reshape(len(x), -1)


def _unit(batches):
    """Vectors of length one; a batch may hold vectors of several numbers of components, none of none."""
    for batch in batches:
        at = batch.schema.get_field_index("v")
        size = np.asarray(batch.column(at).value_lengths().to_numpy(zero_copy_only=False), np.int64)
        x = np.asarray(batch.column(at).flatten().to_numpy(zero_copy_only=False), np.float64)
        first = np.cumsum(size) - size
        for scale in (lambda v: np.maximum.reduceat(np.abs(v), first), lambda v: np.sqrt(np.add.reduceat(v * v, first))):
            x = x / np.repeat(scale(x), size) if len(x) else x
        yield batch.set_column(at, "v", pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.array(x)))


def _walks(index, cells: int):
    """For every block: the farthest sum each member visits, and the block's members by visited cell."""

    def run(batches):
        own = index.value
        width = len(own.books[1])
        for batch in batches:
            for r in batch.to_pylist():
                x = np.array(r["v"])
                left, right = (d**2 for d in own.distances(x))
                far, visits = [], {}
                for i in range(len(x)):
                    limit = None
                    for n, (a, b, total) in enumerate(vectors.multi_sequence(left[i], right[i])):
                        if n >= cells and total > limit:
                            break
                        limit = total if n < cells else limit
                        visits.setdefault(int(a * width + b), []).append(i)
                    far.append(limit)
                far = np.array(far)
                ids, times = np.array(r["id"], np.int64), np.array(r["times"], np.int64)
                for cell, who in visits.items():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["label"]], pa.string()), pa.array([r["cell"]], pa.int32()), pa.array([cell], pa.int32()),
                         pa.array([ids[who].tobytes()], pa.binary()), pa.array([times[who].tobytes()], pa.binary()), pa.array([x[who].tobytes()], pa.binary())],
                        ["q_label", "from_cell", "q_cell", "q_ids", "q_times", "q_vs"],
                    )

    return run


def local_forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a bipartite 0/1 matrix: the smallest row of each one's component (rows, columns)."""
    n, m = hit.shape
    rows = np.arange(n)
    while True:
        cols = np.where(hit, rows[:, None], n).min(axis=0)
        back = np.where(hit, cols[None, :], n).min(axis=1)
        better = np.minimum(rows, back)
        if (better == rows).all():
            return rows, cols
        rows = better


def _linked(index, cells: int, limit: float):
    def run(batches):
        own = index.value
        for batch in batches:
            counts: dict[int, int] = {}
            edges = set()
            for r in range(len(batch)):
                q = np.frombuffer(batch.column("q_ids")[r].as_buffer(), np.int64)
                q_times = np.frombuffer(batch.column("q_times")[r].as_buffer(), np.int64)
                x = np.frombuffer(batch.column("q_vs")[r].as_buffer(), np.float64).reshape(len(q), -1)
                ids, times = np.asarray(batch.column("id")[r].values), np.asarray(batch.column("times")[r].values)
                y = vectors.matrix(batch.column("v")[r].values)
                hit = (x @ y.T >= limit) & (q[:, None] != ids[None, :])
                i, j = np.nonzero(hit)
                if not len(i):
                    continue
                for who, n in zip(q, hit @ times):
                    if n:
                        counts[int(who)] = counts.get(int(who), 0) + int(n)
                # links that the other side does not see for itself
                seen = np.unique(j)
                total = sums(own, y[seen])
                least = np.partition(total, min(cells, total.shape[1]) - 1, axis=1)[:, min(cells, total.shape[1]) - 1]
                blind = total[:, batch.column("from_cell")[r].as_py()] > least
                for c, n in zip(seen[blind], q_times @ hit[:, seen[blind]]):
                    counts[int(ids[c])] = counts.get(int(ids[c]), 0) + int(n)
                root_of_row, root_of_col = local_forest(hit)
                for c in seen:
                    edges.add((int(q[root_of_col[c]]), int(ids[c])))
                for a in np.unique(i):
                    if root_of_row[a] != a:
                        edges.add((int(q[root_of_row[a]]), int(q[a])))
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64()), pa.nulls(len(counts), pa.int64())], ["a", "n", "b"]
                )
            if edges:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e[0] for e in edges], pa.int64()), pa.nulls(len(edges), pa.int64()), pa.array([e[1] for e in edges], pa.int64())], ["a", "n", "b"]
                )

    return run


def _links(units: DataFrame, count: int, limit: float, recall: float) -> DataFrame:
    """(a, n, b): counts of links of a vector (n) and edges of a forest (b) among vectors of one length."""
    spark = units.sparkSession
    index, sample = vectors.codebooks(units, vectors.centroids_for(count, CELL_ROWS))
    cells = reach(index, sample, limit, recall)
    shared = spark.sparkContext.broadcast(index)
    packed, _ = vectors.blocks(units, shared, ("label",))
    packed = common.stored(packed, "embdup-blocks")
    walks = common.mapped(packed.repartition(common.partitions(spark)), _walks(shared, cells), "q_label string, from_cell int, q_cell int, q_ids binary, q_times binary, q_vs binary")
    met = walks.join(packed, (F.col("q_label") == F.col("label")) & (F.col("q_cell") == F.col("cell")))
    return common.mapped(met.select("from_cell", "q_ids", "q_times", "q_vs", "id", "times", "v"), _linked(shared, cells, limit), "a long, n long, b long")


def near_duplicates(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", limit: float = LIMIT, recall: float = RECALL) -> DataFrame:
    """(key, n_links, component_id, kept) for every row of ``table``."""
    spark = table.sparkSession
    named = table.select(table[key].cast("long").alias("vec"), table[vector].alias("v"), table[label].cast("string").alias("label"))
    rows = common.keyed(named, "embdup", "vec").withColumnRenamed(common.ROW_KEY, "id")
    hashed = rows.select("vec", "id", "v", "label", F.xxhash64("v").alias("h1"), F.xxhash64("v", F.lit(1)).alias("h2"))
    part = vectors.taking_part(hashed.where("label IS NOT NULL AND vec IS NOT NULL"))
    classes = common.stored(part.groupBy("label", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("times")), "embdup-classes")
    heads = part.join(classes.select("rep", "times"), F.col("id") == F.col("rep")).select("id", F.col("v").cast("array<double>").alias("v"), "label", "times")
    units = common.stored(common.mapped(heads, _unit, "id long, v array<double>, label string, times long"), "embdup-units")
    found = spark.createDataFrame([], "a long, n long, b long")
    for _, same, _ in vectors.by_length(units):
        largest = same.groupBy("label").count().agg(F.max("count")).first()[0]
        found = found.unionByName(common.stored(_links(same, largest, limit, recall), "embdup-found"))
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("n_id")).agg(F.sum("n").alias("n"))
    label_of = common.components(found.where("b IS NOT NULL").select("a", "b"), "embdup").withColumnRenamed("id", "l_id")
    settled = classes.join(counts, F.col("rep") == F.col("n_id"), "left").join(label_of, F.col("rep") == F.col("l_id"), "left").select(
        F.col("label").alias("s_label"), F.col("h1").alias("s1"), F.col("h2").alias("s2"),
        (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("component", "rep").alias("group"),
    )
    settled = common.stored(settled, "embdup-settled")
    same = (F.col("label") == F.col("s_label")) & (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")) & F.col("vec").isNotNull()
    out = hashed.drop("v").join(settled, same, "left").select("vec", "id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("group", "id").alias("group"))
    # where ids repeat, rows have keys of their own: the component takes the smallest id of its rows
    if hashed.where("id <> vec OR vec IS NULL").limit(1).count():
        out = common.stored(out, "embdup-rows")
        least = out.groupBy(F.col("group").alias("g")).agg(F.min("vec").alias("component_id"))
        out = out.join(least, F.col("group") == F.col("g"))
    else:
        out = out.withColumn("component_id", F.col("group"))
    return out.select(F.col("vec").alias(key), "n_links", "component_id", F.coalesce(F.col("vec") == F.col("component_id"), F.lit(True)).alias("kept"))


def op8_embdup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """WITH RECURSIVE live AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM live a JOIN live b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS id, vec_id AS spot FROM embeddings UNION SELECT r.id, e.b FROM reach r JOIN links e ON e.a = r.spot),
least AS (SELECT id, min(spot) AS component_id FROM reach GROUP BY id), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept FROM embeddings e JOIN least ON id = e.vec_id LEFT JOIN counts ON a = e.vec_id"""
