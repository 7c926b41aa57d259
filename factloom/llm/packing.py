"""Best-fit packing of tokenised documents into sequences of a fixed length.

Tokens: words between white space are tokenised once each and remembered in a
bounded table, which gives the ids of the whole text because the tokenizer
itself never joins anything across white space.

Packing is bulk-synchronous best fit.  Lengths are whole numbers up to the
sequence length, so documents and gaps, sorted by size, are runs: all pieces of
one length, all open sequences with one gap.  A round takes the longest length
left, finds for it the smallest gap that holds it (the successor in the sorted
gaps), lets the pieces claim the gaps by rank (piece k of the run takes place k
of the run of gaps, so no two claim one place), updates the gaps, and repeats
until no gap holds the length; the rest open new sequences.  A round handles
whole runs: the driver sees one count per length and the list of runs, whose
size is bounded by lengths and not by rows.  Rows are ranked within (length,
salt), with as many salts as a length's pieces ask for, so a length that holds a third
of all pieces is still spread, and take their place from the table of runs.

Defined cases: a null or empty text is one piece of its end token; a text longer
than a sequence is cut, and only the last piece may be shorter; repeated rows
are packed like others; an empty table gives an empty result; a null doc_id is
kept as it is; other columns are not read.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

LENGTH = 2048
END = 0
#: A length is ranked in so many salts, and one more for each SALT_ROWS of its pieces.
SALTS, SALT_ROWS = 16, 100_000
REMEMBERED = 600_000
TOKENIZER = "word_bpe_49k.json"
#: The white space of the tokenizer (Python's own also has the bytes 1C to 1F).
_SPLIT = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class Tokenizer:
    """ids(text) for whole texts, remembering the ids of words in two generations of ``remembered`` words.

    A word of Latin letters and then ASCII marks is its letters and its marks for
    the dealt tokenizer as well, so both are looked up alone and go to the merge model
    without the steps before it; every other word takes the whole tokenizer.  Both
    shortcuts, words and their parts, are tried on probes when a tokenizer is loaded
    and are not taken where they give other ids than the tokenizer itself.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer as Loaded

        self.loaded, self.remembered, self.known, self.old = Loaded.from_file(path), remembered, {}, {}
        self.merge = self.loaded.model.tokenize
        letters = byte_letters()
        self.letters = [letters[b] for b in range(256)]
        self.by_word = self.by_part = True
        probes = [f"{a}{b}{c}" for a in ("", "t", "Te") for b in _PROBED for c in ("", "s", "s.", ",)")]
        try:
            self.by_part = all(self.ids(w).tolist() == self.encoded(w) for w in probes)
        except Exception:  # another kind of model
            self.by_part = False
        self.known, self.old = {}, {}
        self.by_word = all(self.ids(t).tolist() == self.encoded(t) for t in (" ".join(probes), "\n\n".join(probes), "\t " + "  ".join(probes) + " \u3000a\xa0"))
        self.known, self.old = {}, {}

    def encoded(self, text: str) -> list[int]:
        return self.loaded.encode(text, add_special_tokens=False).ids

    def part(self, part: str) -> bytes:
        found = self.known.get(part) or self.old.get(part)
        if found is None:
            shown = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
            found = np.array([t.id for t in self.merge(shown)], np.uint32).tobytes()
        self.known[part] = found
        return found

    def learn(self, word: str) -> None:
        found = self.old.get(word)
        if found is None:
            plain = _PLAIN.match(word)
            if plain and self.by_part:
                found = self.part(plain[1].lower())
                if plain[2]:
                    found += self.part(plain[2])
            else:
                found = np.array(self.encoded(word), np.uint32).tobytes()
        self.known[word] = found

    def ids(self, text: str) -> np.ndarray:
        if not self.by_word:
            return np.array(self.encoded(text), np.uint32)
        parts = text.split() if text.isascii() and not _ODD.search(text) else _SPLIT.split(text)
        known = self.known
        try:
            return np.frombuffer(b"".join([known[w] for w in parts]), np.uint32)
        except KeyError:
            if len(known) > self.remembered:
                self.old, self.known = known, {}
                known = self.known
            for w in {w for w in parts if w not in known}:
                self.learn(w)
            return np.frombuffer(b"".join([known[w] for w in parts]), np.uint32)


_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!\"#$%&()*+,./:;=?@\\[\\]^_`{|}~-]*)\\Z")
#: Letters and marks that the shortcuts must give the tokenizer's own ids for.
_PROBED = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)]]
#: str.split() also splits here, the tokenizer's white space does not
_ODD = re.compile("[\x1c-\x1f]")
_loaded: dict[str, Tokenizer] = {}


def _pieces(path: str, length: int, end: int, with_ids: bool):
    def run(batches):
        tok = _loaded.get(path) or _loaded.setdefault(path, Tokenizer(path))
        for batch in batches:
            doc, piece, start, size, crc, blobs = [], [], [], [], [], []
            flush = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(tok.ids(text.as_py() or ""), np.uint32(end)).astype("<u4", copy=False)
                for k in range(0, len(ids), length):
                    part = ids[k : k + length].tobytes()
                    doc.append(key)
                    piece.append(k // length)
                    start.append(k)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        blobs.append(part)
                        flush += len(part)
                if flush > 1 << 23 or len(doc) > 100_000:
                    yield _batch(doc, piece, start, size, crc, blobs, with_ids, batch.schema.field(0).type)
                    doc, piece, start, size, crc, blobs, flush = [], [], [], [], [], [], 0
            if doc:
                yield _batch(doc, piece, start, size, crc, blobs, with_ids, batch.schema.field(0).type)

    return run


def _batch(doc, piece, start, size, crc, blobs, with_ids, kind):
    arrays = [pa.array(doc, kind), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        arrays.append(pa.array(blobs, pa.binary()))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def best_fit(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int, int]]:
    """(piece length, first rank, pieces, first sequence, offset, places per sequence).

    Pieces of ``length`` ranked from ``first rank`` on fill ``places`` places each
    in consecutive sequences from ``first sequence``, from ``offset`` in the sequence.
    """
    gaps: list[int] = []  # sizes that open sequences have, sorted
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences (first, count)
    out, opened = [], 0

    def give(first: int, n: int, gap: int) -> None:
        if n and gap:
            if not runs[gap]:
                bisect.insort(gaps, gap)
            runs[gap].append((first, n))

    def fill(size: int, rank: int, left: int, first: int, n: int, gap: int) -> int:
        places = gap // size
        full = min(left // places, n)
        offset = length - gap
        if full:
            out.append((size, rank, full * places, first, offset, places))
            give(first, full, gap - places * size)
        rest = min(left - full * places, places - 1) if full < n else 0
        if rest:
            out.append((size, rank + full * places, rest, first + full, offset, rest))
            give(first + full, 1, gap - rest * size)
        give(first + full + bool(rest), n - full - bool(rest), gap)
        return full * places + rest

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                first, n = runs[gap].pop()
                if not runs[gap]:
                    gaps.pop(at)
                done = fill(size, rank, left, first, n, gap)
            else:
                places = length // size
                n = -(-left // places)
                first, opened = opened, opened + n
                done = fill(size, rank, left, first, n, length)
            rank, left = rank + done, left - done
    return out


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    rows = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    cut = common.mapped(rows, _pieces(path or tokenizer_path(), length, end, with_ids), schema)
    cut = common.stored(cut, "pack-pieces")
    # the salts of a length follow its count, so that what one task ranks does not grow
    salts = [(r["length"], SALTS + r["n"] // SALT_ROWS) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()]  # a row a length
    dealt = F.broadcast(spark.createDataFrame(salts, "s_length long, salts long"))
    cut = cut.join(dealt, F.col("length") == F.col("s_length")).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "start"), F.col("salts")).cast("int")).drop("s_length", "salts")
    per = cut.groupBy("length", "salt").agg(F.count("*").alias("n")).collect()  # SALTS rows a length, and one for each SALT_ROWS pieces
    totals: dict[int, int] = defaultdict(int)
    ahead = []
    for r in sorted(per, key=lambda r: (r["length"], r["salt"])):
        ahead.append((r["length"], r["salt"], totals[r["length"]]))
        totals[r["length"]] += r["n"]
    runs = best_fit(totals, length)
    before = spark.createDataFrame(ahead, "b_length long, b_salt int, before long")
    # split runs are found by rank: the last run of a length that starts at or before it
    starts: dict[int, list] = defaultdict(list)
    for size, rank, _, first, offset, places in sorted(runs):
        starts[size].append((rank, first, offset, places))
    table = spark.createDataFrame(
        [(size, [(rank, first, offset, places) for rank, first, offset, places in found]) for size, found in starts.items()],
        "t_length long, runs array<struct<rank:long, first:long, offset:long, places:long>>",
    )
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        cut.withColumn("in_salt", F.row_number().over(order) - 1)
        .join(F.broadcast(before), (F.col("length") == F.col("b_length")) & (F.col("salt") == F.col("b_salt")))
        .withColumn("rank", F.col("in_salt") + F.col("before"))
        .join(F.broadcast(table), F.col("length") == F.col("t_length"))
    )
    run = F.element_at(F.filter("runs", lambda r: r["rank"] <= F.col("rank")), -1)
    placed = ranked.withColumn("run", run).withColumn("step", F.col("rank") - F.col("run.rank"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids,
        (F.col("run.first") + F.floor(F.col("step") / F.col("run.places"))).cast("long").alias("sequence_id"),
        (F.col("run.offset") + F.col("step") % F.col("run.places") * F.col("length")).cast("long").alias("offset"),
    )


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
