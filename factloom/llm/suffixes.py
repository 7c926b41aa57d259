"""Exact substring removal: suffixes sampled by a difference cover, named, merged, compared.

A byte goes if a window of ``WINDOW`` bytes over it also starts in a document of
smaller id.  Order among suffixes matters only down to the window, so names are
fingerprints: equal prefixes get equal names wherever they are computed, and
sorting names brings equal prefixes together.

1. Sample: the positions of a difference cover modulo 31 ({0,1,3,8,12,18}: every
   residue is a difference of two members).  Of two equal windows in any two
   places, some shift below 31 is sampled in both, so 20 bytes from there agree.
2. Names of the sampled suffixes (their first 20 bytes) are sorted over all
   documents; those that no other document has are dropped.
3. Merge: every suffix whose window holds a repeated sampled name is named by its
   whole window, sorted with the others, and compared with its neighbours: the
   earliest document among equal prefixes keeps its bytes.

Equal texts need none of that: all but the one of smallest id lose every byte.

Documents are range-sorted by id into chunks first, so that the order of chunks
is the order of ids; a chunk and a bucket of the sort exchange one row of sorted
names and one row of bits (``chunks``).  A name that a third of all documents
hold is still one entry per chunk.  A sampled name only finds candidates; the name of
a window decides, and its length in bits follows the input: at most 64 up to 2**33
bytes, from there on 64 and as many bytes more of an independent fingerprint as
the input asks for (one up to 2**37 bytes), so that the expected number of false
matches stays below 0.1 at any size.

Defined cases: a null text is empty; a null id comes before all others; rows
that share an id are not compared with each other; texts shorter than a window
lose nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks, common
from .common import U64

WINDOW = 50
COVER = (0, 1, 3, 8, 12, 18)
MODULUS = 31
GRAM = WINDOW - MODULUS + 1
WIDE_BYTES = 1 << 33
_NULL_ID = -(1 << 63)
_NOTHING = (np.zeros(0, np.int64), np.zeros(0, U64))


def _sampled(off: np.ndarray, data: np.ndarray, copies: np.ndarray, bits: int):
    """(positions, names) of the sampled suffixes of documents that hold a window and are not copies."""
    positions, names = [], []
    for lo, hi in common.slices(off):
        a, b = off[lo], off[hi]
        if b - a < WINDOW:
            continue
        size = np.diff(off[lo : hi + 1])
        usable = np.where((size >= WINDOW) & ~copies[lo:hi], size - GRAM + 1, 0)
        n = (usable + MODULUS - 1) // MODULUS * len(COVER)
        first = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(first, n)
        rel = step // len(COVER) * MODULUS + np.array(COVER)[step % len(COVER)]
        keep = rel < np.repeat(usable, n)
        pos = (np.repeat(off[lo:hi] - a, n) + rel)[keep]
        prefix = common.prefix_hash(data[a:b])
        names.append(common.span_hash(prefix, pos, pos + GRAM) >> U64(64 - bits))
        positions.append(pos + a)
    if not names:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(positions), np.concatenate(names)


def _further(wide: int) -> str:
    """The type of ``wide`` further bits."""
    return f"u{wide // 8}"


def further_bits(total: int) -> int:
    """Bits of a window's name beyond 64 for so many bytes of text: none below ``WIDE_BYTES``, then 8, 16, 32 or 64."""
    need = math.ceil(2 * math.log2(max(total, 2))) - 2 - 64
    return 0 if total < WIDE_BYTES else next(k for k in (8, 16, 32, 64) if need <= k)


def _windows(off: np.ndarray, data: np.ndarray, live: np.ndarray, repeated: np.ndarray, bits: int, wide: int):
    """(positions, names, ``wide`` further bits) of the windows over which a repeated sampled suffix starts."""
    mark = np.zeros(len(data) + 2, np.int8)  # at most the cover's size is open at once
    first = repeated - MODULUS + 1
    mark[first[first > 0]] += 1
    mark[0] += (first <= 0).sum()
    mark[repeated + 1] -= 1
    wanted = np.cumsum(mark[: len(data)], dtype=np.int8) > 0
    del mark
    size = np.diff(off)
    tail = np.where(live > 0, np.minimum(size, WINDOW - 1), size)  # no window starts in the last bytes of a document, or in a copy
    ends = np.repeat(off[1:], tail)
    wanted[ends - 1 - (np.arange(len(ends)) - np.repeat(np.cumsum(tail) - tail, tail))] = False
    positions, names, more = [], [], []
    for lo, hi in common.slices(off):
        a, b = off[lo], off[hi]
        pos = np.flatnonzero(wanted[a:b])
        if len(pos):
            names.append(common.span_hash(common.prefix_hash(data[a:b]), pos, pos + WINDOW) >> U64(64 - bits))
            if wide:
                more.append((common.span_hash(common.prefix_hash(data[a:b], 1), pos, pos + WINDOW, 1) >> U64(64 - wide)).astype(_further(wide)))
            positions.append(pos + a)
    if not names:
        return _NOTHING[0], _NOTHING[1], _NOTHING[1].astype(_further(wide)) if wide else None
    return np.concatenate(positions), np.concatenate(names), np.concatenate(more) if wide else None


def _grouped(names: np.ndarray, more: np.ndarray | None = None):
    """Sort once: (first member of each distinct name, order, group of each ordered place, first place of each group)."""
    order = np.argsort(names) if more is None else np.lexsort((more, names))
    ranked = names[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]] if len(ranked) else np.zeros(0, bool)
    if more is not None and len(ranked):
        new[1:] |= more[order][1:] != more[order][:-1]
    start = np.flatnonzero(new)
    return order[start], order, np.cumsum(new) - 1, start


def _candidates(ids, off, data, copies, answers, bits1, bits2, wide):
    pos, names = _sampled(off, data, copies, bits1)
    if not len(pos):
        return _NOTHING[0], _NOTHING[1], _NOTHING[1].astype(_further(wide)) if wide else None
    _, order, group, start = _grouped(names)
    doc = ids[np.searchsorted(off, pos[order], "right") - 1]
    local = np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start)
    repeated = (chunks.heard(answers) | local)[group]
    return _windows(off, data, np.where(copies, 0, np.diff(off)), np.sort(pos[order[repeated]]), bits2, wide)


def _rows(batch):
    for i in range(len(batch)):  # one chunk at a time in memory
        r = batch.slice(i, 1).to_pylist()[0]
        ids, off, data = chunks.opened(r["ids"], r["offs"], r.pop("body"))
        yield r, ids, off, data, np.frombuffer(r["copies"], bool)


def _first_messages(bits: int, buckets: int):
    def run(batches):
        for batch in batches:
            for r, _, off, data, copies in _rows(batch):
                yield chunks.messages(r["chunk_id"], common.sorted_distinct(_sampled(off, data, copies, bits)[1]), bits, buckets)

    return run


def _second_messages(bits1: int, bits2: int, wide: int, buckets: int):
    def run(batches):
        for batch in batches:
            for r, ids, off, data, copies in _rows(batch):
                _, names, more = _candidates(ids, off, data, copies, r["first"], bits1, bits2, wide)
                if more is None:
                    yield chunks.messages(r["chunk_id"], common.sorted_distinct(names), bits2, buckets)
                else:
                    first = _grouped(names, more)[0]
                    yield chunks.messages(r["chunk_id"], names[first], bits2, buckets, more[first])

    return run


def _removed(bits1: int, bits2: int, wide: int, with_text: bool):
    def run(batches):
        for batch in batches:
            for r, ids, off, data, copies in _rows(batch):
                pos, names, more = _candidates(ids, off, data, copies, r["first"], bits1, bits2, wide)
                cover = np.zeros(len(data) + WINDOW + 1, np.int8)  # at most WINDOW are open at once
                if len(pos):
                    _, order, group, start = _grouped(names, more)
                    doc = ids[np.searchsorted(off, pos[order], "right") - 1]
                    least = np.minimum.reduceat(doc, start)
                    goes = chunks.heard(r["second"])[group] | (doc > least[group])
                    gone = pos[order[goes]]
                    cover[gone] += 1  # positions are distinct
                    cover[gone + WINDOW] -= 1
                out = np.cumsum(cover[: len(data)], dtype=np.int8) > 0
                n, removed, spans, sums, texts = np.diff(off), [], [], [], []
                for i in range(len(ids)):
                    a, b = off[i], off[i + 1]
                    mine = out[a:b]
                    if copies[i] and b - a >= WINDOW:
                        mine[:] = True
                    k = int(mine.sum())
                    removed.append(k)
                    spans.append(int((mine[1:] & ~mine[:-1]).sum() + mine[0]) if k else 0)
                    left = data[a:b][~mine].tobytes() if k else data[a:b].tobytes()
                    sums.append(hashlib.sha256(left).hexdigest())
                    if with_text:
                        texts.append(left)
                arrays = [pa.array(ids), pa.array(n), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sums)]
                names_ = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    arrays.append(pa.array(texts, pa.binary()))
                    names_.append("kept")
                made = pa.RecordBatch.from_arrays(arrays, names_)
                step = max(1, int(len(ids) * (1 << 23) / max(len(data), 1))) if with_text else len(ids) or 1
                for k in range(0, len(ids), step):
                    yield made.slice(k, step)

    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False, wide: bool | int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes) of every row.

    Names have ``further_bits`` more than 64 from ``WIDE_BYTES`` on, or as many as ``wide`` gives (64 where it is true).
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(docs[key].cast("long"), F.lit(_NULL_ID)).alias("id"), docs[text].alias("text"))
    # equal texts: all but the smallest id are copies, named by a marker row that the range sort puts before them
    printed = rows.select("id", F.xxhash64("text").alias("print"), F.xxhash64("text", F.lit(1)).alias("second"), F.octet_length("text").alias("n"))
    least = printed.where(F.col("n") >= WINDOW).groupBy("print", "second", "n").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    least = common.stored(least.where("rows > 1").select("print", "second", "n", "first"), "repeats-equal")
    copies = common.stored(printed.join(least, ["print", "second", "n"]).where("id > first").select("id", "print"), "repeats-copies")
    texts = rows.select("id", F.xxhash64("text").alias("print"), "text", F.lit(False).alias("mark"))
    texts = texts.unionAll(copies.select("id", "print", F.lit(None).cast("string").alias("text"), F.lit(True).alias("mark")))
    ranged = texts.repartitionByRange(common.partitions(spark), "id").sortWithinPartitions("id", F.desc("mark"))
    table = common.Stored(chunks.chunked(ranged), "repeats-chunks")
    del ranged, texts, copies, least, printed
    common.free_shuffles(spark)
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    scale = math.log2(max(total, 2))
    wide = further_bits(total) if wide is None else 64 if wide is True else int(wide)
    bits1, bits2 = min(60, max(32, math.ceil(scale) + 9)), min(64, max(40, math.ceil(2 * scale) - 2))
    buckets = 2 * common.partitions(spark)
    sent = common.mapped(table.df, _first_messages(bits1, buckets), chunks.SENT)
    first = common.stored(chunks.ask(sent, earlier=False).withColumnRenamed("answers", "first").withColumnRenamed("chunk_id", "f_id"), "repeats-first")
    del sent
    common.free_shuffles(spark)
    # chunks with their answers take the place of the chunks: joined on the way, they would lie beside the messages once more
    known = common.stored(table.df.join(first, F.col("chunk_id") == F.col("f_id"), "left").drop("f_id"), "repeats-known")
    table.drop()
    del first
    common.free_shuffles(spark)
    sent = common.mapped(known, _second_messages(bits1, bits2, wide, buckets), chunks.SENT)
    second = common.stored(chunks.ask(sent, earlier=True).withColumnRenamed("answers", "second").withColumnRenamed("chunk_id", "s_id"), "repeats-second")
    del sent
    common.free_shuffles(spark)
    known = known.join(second, F.col("chunk_id") == F.col("s_id"), "left").drop("s_id")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    out = common.mapped(known, _removed(bits1, bits2, wide, with_text), schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")))


def op3_suffixes(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: All strings of a window, as hex digits; texts in blocks first, so that a string is not cut out of a whole text.
SQL = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
b AS (SELECT doc_id, n, o, substr(h, 2 * o + 1, 1098) AS h FROM (SELECT *, unnest(range(0, greatest(n, 1), 500)) AS o FROM d)),
w AS MATERIALIZED (SELECT doc_id, o + i AS i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, least(500, n - 49 - o))) AS i FROM b)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT w.doc_id, w.i FROM w JOIN f ON w.s = f.s AND w.doc_id > f.first),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM g),
k AS (SELECT doc_id, i, count(*) FILTER (before IS NULL OR i - before > 50) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM r),
spans AS MATERIALIZED (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS z FROM k GROUP BY 1, 2),
gone AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY 1),
edges AS (SELECT doc_id, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans UNION ALL SELECT d.doc_id, n, coalesce((SELECT max(z) FROM spans s WHERE s.doc_id = d.doc_id), 0) FROM d),
kept AS (SELECT e.doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY since) AS h FROM edges e JOIN d ON d.doc_id = e.doc_id GROUP BY 1)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN gone ON gone.doc_id = d.doc_id
"""
