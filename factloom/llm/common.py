"""Shared pieces: materialised intermediates, a byte-level text kernel, components.

The text kernel reads Arrow string buffers in place and hashes words or byte
windows with numpy, so a text never becomes a Python string.  Hashes are 64-bit
polynomial fingerprints of the bytes: the prefix sum ``H`` of
``table[byte] * P**i`` gives the fingerprint of any span as
``mix((H[end] - H[start]) * P**-start)``.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
MASK64 = (1 << 64) - 1
#: Two independent fingerprints: bases and byte codes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BYTE_CODES = tuple(np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1) for seed in (20240229, 20240301))
SLICE_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IS_LETTER = np.zeros(256, bool)
IS_LETTER[ord("a") : ord("z") + 1] = True
IS_LETTER[ord("0") : ord("9") + 1] = True
IS_LETTER[0x80:] = True


# ---------------------------------------------------------------- materialising


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.  Only a local session that names none (tests) gets one made."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="factloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = f"file://{folder}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Stored:
    """A written intermediate: survives lost executors and cuts the lineage."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/factloom/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    return Stored(df, name).df


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, where they don't have it on their path."""
    sc = spark.sparkContext
    if getattr(sc, "_factloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="factloom-")) / "factloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, f"factloom/{source.relative_to(package)}")
    sc.addPyFile(str(archive))
    sc._factloom_shipped = True


def trim() -> None:
    """Give freed memory back: Python workers live on, beside other tasks' workers."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


#: Bytes of an Arrow batch that goes to a Python worker.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow with the package shipped, small batches (where the session sets no size) and memory given back at the end."""
    spark = df.sparkSession
    ship(spark)
    if _BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))

    def run(batches):
        yield from function(batches)
        trim()

    return df.mapInArrow(run, schema)


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    ranked = np.sort(values)
    return ranked[np.r_[True, ranked[1:] != ranked[:-1]]] if len(ranked) else ranked


def free_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner delete the shuffle files of finished, unreferenced jobs."""
    import gc
    import time

    for _ in range(2):  # handles of this process first, then what they held in the JVM
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


#: Rows of tasks that one group adds up.
FAN = 1024


def added_up(sent: DataFrame, function, schema: str, key: str = "block") -> DataFrame:
    """Sums of what every task sent for a ``key``, in two levels: ``FAN`` tasks at a time, then those sums.

    ``function`` adds the rows of a table (one key) to one row with the same columns, so no group holds
    more than ``FAN`` rows of tasks, or one for each ``FAN`` of them.
    """
    level = sent.withColumn("level", (F.spark_partition_id() / FAN).cast("int"))

    def first(table: pa.Table) -> pa.Table:
        return function(table.drop_columns(["level"]))

    return level.groupBy(key, "level").applyInArrow(first, schema).groupBy(key).applyInArrow(function, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ------------------------------------------------------------------ text kernel


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    k, factor = 1, base
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * U64(factor)
        factor = factor * factor & MASK64
        k *= 2
    return out


_pow_cache: dict[int, list[np.ndarray]] = {}


def powers(n: int, kind: int = 0) -> tuple[np.ndarray, np.ndarray]:
    if kind not in _pow_cache or len(_pow_cache[kind][0]) < n:
        size = max(n, SLICE_BYTES + (1 << 12))
        _pow_cache[kind] = [_powers(size, _BASES[kind]), _powers(size, pow(_BASES[kind], -1, 1 << 64))]
    return _pow_cache[kind][0][:n], _pow_cache[kind][1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        empty = pa.scalar(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "", column.type)
        column = column.fill_null(empty)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``most`` bytes (one document at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def prefix_hash(data: np.ndarray, kind: int = 0) -> np.ndarray:
    pw, _ = powers(len(data) + 1, kind)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE_CODES[kind][data] * pw[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int = 0) -> np.ndarray:
    _, inverse = powers(len(prefix), kind)
    return mix((prefix[end] - prefix[start]) * inverse[start])


def token_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes for which ``inside`` holds, never across documents: start, end, document."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    before[first] = False
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` in order, and their documents."""
    start, end, doc = token_spans(data, offsets, ~IS_SPACE[data])
    if not len(start):
        return np.zeros(0, U64), doc
    return span_hash(prefix_hash(LOWER[data]), start, end), doc


# ------------------------------------------------------------------- components


def components(edges: DataFrame, name: str = "components", max_rounds: int = 500) -> DataFrame:
    """(id, component): the smallest id reachable over undirected ``edges`` (a, b).

    Min-label hooking with pointer jumping: the smallest label that a vertex hears
    from its neighbours goes to the vertex and to the owner of its own label, so a
    whole region moves at once.  Labels only fall and stay inside the component;
    rounds go on until none changes, and then all ends of edges agree.  Meeting the
    bound ``max_rounds`` is an error, never a result.

    Every round is written, so a lost executor costs one round; messages to a
    vertex are minima, combined before the shuffle.
    """
    both = Stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        f"{name}-edges",
    )
    label = Stored(both.df.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")), f"{name}-0")
    for turn in range(1, max_rounds + 1):
        told = both.df.join(label.df, F.col("b") == F.col("id")).groupBy(F.col("a").alias("at")).agg(F.min("component").alias("heard"))
        sent = told.join(label.df, F.col("at") == F.col("id")).select(F.explode(F.array("id", "component")).alias("to"), "heard")
        least = sent.groupBy("to").agg(F.min("heard").alias("heard"))
        nearer = label.df.join(least, F.col("id") == F.col("to")).select("id", F.col("component").alias("old"), F.least("component", "heard").alias("component"))
        step = Stored(nearer, f"{name}-{turn}n")
        up = step.df.select(F.col("id").alias("up_id"), F.col("component").alias("up"))
        jumped = step.df.join(up, F.col("component") == F.col("up_id")).select("id", F.least("component", "up").alias("component"), "old")
        now = Stored(jumped, f"{name}-{turn}")
        changed = now.df.where("component <> old").limit(1).count()
        label.drop()
        step.drop()
        label = now
        if not changed:
            break
    else:
        raise RuntimeError(f"{name}: components still change after {max_rounds} rounds")
    both.drop()
    return label.df.select("id", "component")


# --------------------------------------------------------------------- row keys


ROW_KEY = "row_key"


def prints(text: str = "text") -> list:
    """128 bits that tell texts apart, as ``row_print`` and ``row_second``."""
    return [F.xxhash64(text).alias("row_print"), F.xxhash64(text, F.lit(1)).alias("row_second")]


def keyed(docs: DataFrame, name: str, key: str = "doc_id") -> DataFrame:
    """``docs`` with a long ``ROW_KEY`` of its own on every row.

    Rows whose ``key`` is null or also on another row are written with new keys above
    all others; every other row has its ``key``.
    """
    ids = docs.select(docs[key].cast("long").alias("k"))
    shared = stored(ids.groupBy("k").count().where("k IS NULL OR count > 1").select("k"), f"{name}-shared")
    plain = docs.withColumn(ROW_KEY, docs[key].cast("long"))
    if shared.limit(1).count() == 0:
        return plain
    top = ids.agg(F.coalesce(F.max("k"), F.lit(0))).first()[0]
    odd = docs.join(shared, docs[key].cast("long").eqNullSafe(F.col("k")), "left_semi")
    odd = stored(odd.withColumn(ROW_KEY, F.lit(top + 1) + F.monotonically_increasing_id()), f"{name}-odd")
    return plain.join(shared, F.col(ROW_KEY).eqNullSafe(F.col("k")), "left_anti").unionByName(odd)


# ---------------------------------------------------------------------- bitmaps


BITMAP_BITS = 1 << 25
_BITMAP_BLOCK = 1 << 15


def _bitmap_block(table: pa.Table) -> pa.Table:
    bits = np.zeros(_BITMAP_BLOCK, bool)
    bits[table.column("bit").to_numpy()] = True
    return pa.table({"block": table.column("block")[:1], "body": pa.array([np.packbits(bits).tobytes()], pa.binary())})


def bitmap_slot(column):
    return F.pmod(F.xxhash64(column, F.lit(9)), F.lit(BITMAP_BITS))


def bitmap(df: DataFrame, column: str):
    """A broadcast bitmap of ``BITMAP_BITS`` bits (4 MB at any input) over the ids of ``column``.

    A pre-filter only: ids that share a bit pass, and an exact join follows.
    """
    spark = df.sparkSession
    ship(spark)
    slot = df.select(bitmap_slot(F.col(column)).alias("slot")).distinct()
    parts = slot.select((F.col("slot") / _BITMAP_BLOCK).cast("int").alias("block"), (F.col("slot") % _BITMAP_BLOCK).cast("int").alias("bit"))
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in parts.groupBy("block").applyInArrow(_bitmap_block, "block int, body binary").collect():
        at = r["block"] * _BITMAP_BLOCK // 8
        bits[at : at + _BITMAP_BLOCK // 8] = np.frombuffer(r["body"], np.uint8)
    return spark.sparkContext.broadcast(bits)


def in_bitmap(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)
