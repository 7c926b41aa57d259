"""Chunks of documents and compact set messages between chunks and hash buckets.

A chunk holds some MB of whole documents in one row.  To learn which of its
fingerprints other chunks have, it sends every bucket of the hash space one row,
the sorted distinct fingerprints as deltas in byte planes, and gets one row of
bits back.  A fingerprint so costs about log2(space / chunk's count) bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import U64

CHUNK_BYTES = 1 << 22
CHUNK = "chunk_id long, ids binary, copies binary, offs binary, body binary"


def squeeze(data) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def encode_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 as zstd over the byte planes of their deltas."""
    deltas = np.empty(len(values), "<u8")
    if len(values):
        deltas[0], deltas[1:] = values[0], values[1:] - values[:-1]
    width = max(1, (int(deltas.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = deltas.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + squeeze(np.ascontiguousarray(planes).tobytes())


def decode_sorted(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(unsqueeze(data[1:]), np.uint8).reshape(width, -1)
    deltas = np.zeros((planes.shape[1], 8), np.uint8)
    deltas[:, :width] = planes.T
    return np.cumsum(deltas.reshape(-1).view("<u8"), dtype=U64)


def _chunked(most: int):
    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids, copies, texts, size, marked = [], [], [], 0, set()

        def row():
            offs = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(t) for t in texts], out=offs[1:])
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(copies, bool).tobytes()], pa.binary()), pa.array([offs.tobytes()], pa.binary()), pa.array([squeeze(b"".join(texts))], pa.binary())],
                ["chunk_id", "ids", "copies", "offs", "body"],
            )

        for batch in batches:
            keys = batch.column("id").to_numpy(zero_copy_only=False)
            prints, marks = batch.column("print").to_pylist(), batch.column("mark").to_pylist()
            data, off = common.utf8(batch.column("text"))
            for i in range(len(batch)):
                if size >= most and keys[i] != ids[-1]:
                    yield row()
                    number, ids, copies, texts, size = number + 1, [], [], [], 0
                if marks[i]:
                    marked = {m for m in marked if m[0] == keys[i]} | {(keys[i], prints[i])}
                    continue
                copies.append((keys[i], prints[i]) in marked)
                ids.append(keys[i])
                texts.append(data[off[i] : off[i + 1]].tobytes())
                size += len(texts[-1])
        if ids:
            yield row()

    return run


def chunked(rows: DataFrame, most: int = CHUNK_BYTES) -> DataFrame:
    """(chunk_id, ids, copies, offs, body) of rows (id long, print, text, mark), in the order of the partitions and their rows.

    A row with ``mark`` is no document: it says of the documents with its id and
    print that follow it that they are copies.
    """
    return common.mapped(rows, _chunked(most), CHUNK)


def opened(ids: bytes, offs: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(offs, np.int64), np.frombuffer(unsqueeze(body), np.uint8)


def bucket_width(bits: int, buckets: int) -> int:
    return ((1 << bits) + buckets - 1) // buckets


def messages(chunk: int, values: np.ndarray, bits: int, buckets: int, more: np.ndarray | None = None) -> pa.RecordBatch:
    """(bucket, chunk_id, body, more) for ascending distinct ``values`` below 2**bits; ``more`` has further bits of each, in numbers of any one width."""
    width = bucket_width(bits, buckets)
    cuts = np.searchsorted(values, np.arange(1, buckets, dtype=U64) * U64(width)) if buckets > 1 else np.zeros(0, np.int64)
    cuts = np.r_[0, cuts, len(values)]
    used = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
    body = [encode_sorted(values[cuts[b] : cuts[b + 1]] - U64(b * width)) for b in used]
    rest = [None if more is None else more[cuts[b] : cuts[b + 1]].tobytes() for b in used]
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([chunk] * len(used), pa.int64()), pa.array(body, pa.binary()), pa.array(rest, pa.binary())], ["bucket", "chunk_id", "body", "more"]
    )


#: Messages of ``messages``.
SENT = "bucket int, chunk_id long, body binary, more binary"


def _answered(earlier: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("chunk_id")
        parts = [decode_sorted(b.as_buffer().to_pybytes()) for b in table.column("body")]
        sizes = np.array([len(p) for p in parts])
        values = np.concatenate(parts)
        del parts
        if table.column("more").null_count:
            order = np.argsort(values)
            ranked = values[order]
            new = np.r_[True, ranked[1:] != ranked[:-1]]
        else:
            width = len(table.column("more")[0].as_buffer()) // sizes[0]
            more = np.concatenate([np.frombuffer(b.as_buffer(), f"u{width}") for b in table.column("more")])
            order = np.lexsort((more, values))
            ranked, more = values[order], more[order]
            new = np.r_[True, (ranked[1:] != ranked[:-1]) | (more[1:] != more[:-1])]
            del more
        del values, ranked
        block = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        start, group = np.flatnonzero(new), np.cumsum(new) - 1
        hit = np.zeros(len(order), bool)
        if earlier:
            hit[order] = block > np.minimum.reduceat(block, start)[group]
        else:
            hit[order] = (np.diff(np.r_[start, len(order)]) > 1)[group]
        del order, block, group
        bits = [squeeze(np.packbits(h).tobytes()) for h in np.split(hit, np.cumsum(sizes)[:-1])]
        common.trim()
        return pa.table({"chunk_id": table.column("chunk_id"), "bucket": table.column("bucket"), "n": pa.array(sizes, pa.int64()), "bits": pa.array(bits, pa.binary())})

    return run


def ask(sent: DataFrame, earlier: bool) -> DataFrame:
    """(chunk_id, answers): for every message, which values another chunk has, or with ``earlier`` one before it."""
    common.ship(sent.sparkSession)
    told = sent.groupBy("bucket").applyInArrow(_answered(earlier), "chunk_id long, bucket int, n long, bits binary")
    return told.groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "bits"))).alias("answers"))


def heard(answers) -> np.ndarray:
    """The answers of one chunk, in the order of the values it sent."""
    if not answers:
        return np.zeros(0, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(unsqueeze(a["bits"]), np.uint8), count=a["n"]).astype(bool) for a in answers])
