"""Vectors as short codes: a codebook for each of a vector's parts, trained by whole-number Lloyd rounds with Hamerly's bounds.

Components become whole numbers, so all distances are exact and a code never depends
on the order of summing.  A round assigns every part to its nearest entry and moves
the entries to the floors of their parts' means.

After the first round, which scans all entries, a part keeps two bounds beside its
entry: its distance to that entry, at most ``upper``, and to every other entry, at
least ``lower``.  When the entries move, ``upper`` grows by the move of its own entry
and ``lower`` shrinks by the largest move of any other.  While ``upper`` is strictly
below ``lower``, or below half the way from its entry to the nearest other one, the
entry is still the only nearest and nothing is scanned; else ``upper`` is measured
anew, and only where the bounds still fail all entries are scanned, ties to the lower
index.  Bounds are stored as 32-bit floats rounded outwards, so a tie never passes as
strict.

Every round is written (numbers, codes, bounds) and the one before deleted, so a lost
executor costs one round.  The sums of a round are one row for each entry and position
and task, added up by Spark; the driver sees one codebook.

Defined cases: vectors that are null, hold null or non-finite components, or components
beyond ``LARGEST`` (whose squares leave 64 bits) are dropped; zero and empty vectors are kept; vectors of other lengths
have codebooks of their own; a length that the parts do not divide is cut at
``floor(k * length / parts)``; ids that are null come after all others when the first
entries are chosen, equal ids are ordered by their vectors, and repeated rows are rows
of their own; fewer vectors than entries make a smaller codebook; sums of errors beyond
64 bits are null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 65_535.0
ROWS = 4096


def usable(column):
    """True for vectors that are coded."""
    return F.coalesce(column.isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(LARGEST))), F.lit(False))


def whole(flat: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(np.asarray(flat, np.float64) * scale).astype(np.int64)


def lists(column, width: int) -> np.ndarray:
    """Rows of a list column of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def listed(values: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), kind))


def upward(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(x).astype(np.float32), np.float32(np.inf))


def downward(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.asarray(x).astype(np.float32), np.float32(-np.inf))


def cuts(width: int, parts: int) -> list[slice]:
    return [slice(k * width // parts, (k + 1) * width // parts) for k in range(parts)]


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries, as whole numbers."""
    return (x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)


class Moves:
    """What the bounds of one part need to know of its codebook: how far entries went, and half the way to the nearest other."""

    def __init__(self, old: np.ndarray, new: np.ndarray):
        moved = np.sqrt(((new - old) ** 2).sum(1).astype(np.float64))
        self.own = moved * (1 + 1e-12)
        ranked = np.argsort(-moved, kind="stable")
        self.other = np.full(len(new), self.own[ranked[0]])
        self.other[ranked[0]] = self.own[ranked[1]] if len(new) > 1 else 0.0
        between = distances(new, new).astype(np.float64)
        np.fill_diagonal(between, np.inf)
        self.half = np.sqrt(between.min(1)) * (0.5 - 1e-12)


def scan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry (ties to the lower index), and the bounds."""
    far = distances(x, book)
    at = far.argmin(1)
    mine = np.arange(len(x))
    upper = upward(np.sqrt(far[mine, at].astype(np.float64)))
    if len(book) == 1:
        return at, upper, np.full(len(x), np.inf, np.float32)
    far[mine, at] = np.iinfo(np.int64).max
    return at, upper, downward(np.sqrt(far.min(1).astype(np.float64)))


def follow(x: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray, book: np.ndarray, moves: Moves) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The assignment after the entries moved; the last figure counts the rows that were scanned."""
    upper = upward(upper.astype(np.float64) + moves.own[at])
    lower = downward(lower.astype(np.float64) - moves.other[at])
    at = at.copy()
    loose = np.flatnonzero(~(upper < np.maximum(lower, moves.half[at])))
    if len(loose):
        gap = x[loose] - book[at[loose]]
        upper[loose] = upward(np.sqrt((gap * gap).sum(1).astype(np.float64)))
        loose = loose[~(upper[loose] < np.maximum(lower[loose], moves.half[at[loose]]))]
    if len(loose):
        at[loose], upper[loose], lower[loose] = scan(x[loose], book)
    return at, upper, lower, len(loose)


_STATE = "v array<int>, code binary, upper array<float>, lower array<float>"


def _first(books, width: int, scale: int):
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                x = whole(lists(part.column("v"), width), scale)
                found = [scan(x[:, cut], book) for cut, book in zip(cuts(width, len(books)), books)]
                yield _state(part, x, found)

    return run


def _next(books, moves, width: int):
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                x = lists(part.column("v"), width).astype(np.int64)
                code, upper, lower = _coded(part.column("code"), len(books)), lists(part.column("upper"), len(books)), lists(part.column("lower"), len(books))
                found = [follow(x[:, cut], code[:, k], upper[:, k], lower[:, k], books[k], moves[k])[:3] for k, cut in enumerate(cuts(width, len(books)))]
                yield _state(part, x, found)

    return run


def _coded(column: pa.Array, parts: int) -> np.ndarray:
    return common.utf8(column)[0].reshape(-1, parts).astype(np.int64)


def _state(part: pa.RecordBatch, x: np.ndarray, found) -> pa.RecordBatch:
    code, upper, lower = (np.stack([f[k] for f in found], 1) for k in range(3))
    body = code.astype(np.uint8)
    columns = [part.column("id"), part.column("label"), listed(x.astype(np.int32), pa.int32()), pa.array([row.tobytes() for row in body], pa.binary()), listed(upper, pa.float32()), listed(lower, pa.float32())]
    return pa.RecordBatch.from_arrays(columns, ["id", "label", "v", "code", "upper", "lower"])


def _sums(parts: int, entries: int, width: int):
    """Of a task: rows (part, entry, position, total), position -1 for the number of rows."""

    def run(batches):
        total, count = np.zeros((entries, width), np.int64), np.zeros((parts, entries), np.int64)
        some = False
        for batch in batches:
            x, code = lists(batch.column("v"), width).astype(np.int64), _coded(batch.column("code"), parts)
            some = some or len(x) > 0
            for k, cut in enumerate(cuts(width, parts)):
                order = np.argsort(code[:, k], kind="stable")
                used, first = np.unique(code[order, k], return_index=True)
                if len(used) and cut.stop > cut.start:
                    total[used, cut] += np.add.reduceat(x[order][:, cut], first, axis=0)
                count[k] += np.bincount(code[:, k], minlength=entries)
        if some:
            for k, cut in enumerate(cuts(width, parts)):
                used = np.flatnonzero(count[k])
                size = cut.stop - cut.start
                body = np.concatenate([total[used, cut], count[k][used][:, None]], 1)
                spot = np.tile(np.r_[np.arange(size), -1], len(used))
                columns = [pa.array(np.full(body.size, k, np.int32)), pa.array(np.repeat(used, size + 1).astype(np.int32)), pa.array(spot.astype(np.int32)), pa.array(body.ravel())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "position", "total"])

    return run


def moved(books: list[np.ndarray], state: DataFrame, width: int) -> list[np.ndarray]:
    """The codebooks after a round; an entry without parts stays."""
    sums = common.mapped(state.select("v", "code"), _sums(len(books), len(books[0]), width), "part int, entry int, position int, total long")
    found = sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total")).collect()  # the size of a codebook
    counts = {(r["part"], r["entry"]): r["total"] for r in found if r["position"] < 0}
    new = [b.copy() for b in books]
    for r in found:
        if r["position"] >= 0:
            new[r["part"]][r["entry"], r["position"]] = r["total"] // counts[r["part"], r["entry"]]
    return new


def _errors(books, width: int):
    def run(batches):
        for batch in batches:
            x, code = lists(batch.column("v"), width).astype(np.int64), _coded(batch.column("code"), len(books))
            gap = x.copy()
            for k, cut in enumerate(cuts(width, len(books))):
                gap[:, cut] -= books[k][code[:, k]]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("code"), pa.array((gap * gap).sum(1))], ["id", "label", "code", "error"])

    return run


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()


def train(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error) of rows (id, label, v) of one length, and the codebooks, one array of entries for each part."""
    head = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "label"))
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow()
    first = whole(lists(seeds.column("v"), width), scale)
    books = [first[:, cut].copy() for cut in cuts(width, parts)]
    state = common.Stored(common.mapped(rows, _first(books, width, scale), f"{head}, {_STATE}"), "codes-0")
    for turn in range(1, rounds + 1):
        new = moved(books, state.df, width)
        steps = [Moves(a, b) for a, b in zip(books, new)]
        after = common.Stored(common.mapped(state.df, _next(new, steps, width), f"{head}, {_STATE}"), f"codes-{turn}")
        state.drop()
        state, books = after, new
    told = common.Stored(common.mapped(state.df.select("id", "label", "v", "code"), _errors(books, width), f"{head}, code binary, error long"), "codes-told")
    state.drop()
    return told.df, books


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(id, label, code, error, codebooks_sha256) of rows (id, label, v) that can be coded; ``code`` has one byte a part."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index must fit a byte")
    rows = common.stored(rows.select("id", "label", F.col("v").cast("array<double>").alias("v")).where(usable(F.col("v"))), "codes-rows")
    widths = [r[0] for r in rows.select(F.size("v")).distinct().collect()]  # one for each length of vectors
    done = []
    for width in sorted(widths):
        told, books = train(rows.where(F.size("v") == width), width, parts, entries, rounds, scale)
        done.append(told.withColumn("codebooks_sha256", F.lit(digest(books))))
    if not done:
        return rows.select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"), F.lit(None).cast("string").alias("codebooks_sha256"))
    return functools.reduce(DataFrame.unionByName, done)


def op11_codes(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("long").alias("id"), "label", F.col("embedding").alias("v"))
    coded = compress(table)
    sums = coded.groupBy(F.col("label").alias("l_label")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("l_label"))).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256"
    )


def _sql() -> str:
    """Plain Lloyd rounds over components in rows."""
    steps, book = [], "book0"
    near = "SELECT n, part, min(d * 64 + entry) % 64 AS entry, min(d * 64 + entry) // 64 AS d FROM (SELECT c.n, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d FROM comps c JOIN {0} b ON c.part = b.part AND c.pos = b.pos GROUP BY ALL) GROUP BY ALL"
    for k in (1, 2):
        steps.append(f"near{k} AS MATERIALIZED ({near.format(book)})")
        steps.append(
            f"book{k} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN "
            f"(SELECT c.part, a.entry, c.pos, floor(sum(c.x) / count(*))::BIGINT AS x FROM comps c JOIN near{k} a ON c.n = a.n AND c.part = a.part GROUP BY ALL) m "
            "ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)"
        )
        book = f"book{k}"
    steps.append(f"last AS MATERIALIZED ({near.format(book)})")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding AS v, row_number() OVER (ORDER BY vec_id NULLS LAST) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comps AS MATERIALIZED (SELECT n, (i * 16) // w AS part, i AS pos, floor(256 * v[i + 1]::DOUBLE)::BIGINT AS x FROM (SELECT n, v, len(v) AS w, unnest(range(len(v))) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, n - 1 AS entry, pos, x FROM comps WHERE n <= 64),
{", ".join(steps)},
told AS (SELECT n, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last GROUP BY n),
summed AS (SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error FROM told JOIN kept USING (n))
SELECT *, (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM {book}) AS codebooks_sha256 FROM summed
"""


SQL = _sql()
