"""Near-duplicate documents by one-permutation MinHash with star-shaped candidates.

A document's set is its distinct five-word shingles (lower-cased A-Z).  One hash
per shingle is enough: its top bits choose a bin, the smallest hash of a bin is
its value, and empty bins borrow from a filled bin found by a fixed probe
sequence (optimal densification).  Bands of rows make bucket keys.

Pair counts stay linear: equal sets collapse to their smallest id first, and a
bucket gives a star, not a clique.  A bucket's centre is its member of smallest
priority, and four priorities are dealt over the bands, so that different
buckets of one family have different centres while a large family shares few.
Further rounds put new centres into buckets that still hold several components.
In those that hold several after the rounds, blocks of members are compared with
one another on the full sets, so every pair that shares a bucket is linked, in
one component, or compared.  Every candidate link is confirmed on the full sets,
and confirmed links are merged into components.

Defined cases: null and empty texts have empty sets and no links; fewer words
than a shingle are one shingle; rows that share an id are one document; a null
id takes no part and is its own group (component null, kept); other columns are
not read.  Set sizes count distinct 64-bit fingerprints.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import U64, mix

WORDS = 5
BINS = 128
ROWS = 4
PRIORITIES = 4
ROUNDS = 3
PERCENT = 75
#: Documents and shingles, about, of a block when members of a bucket are compared with one another.
LEAF = 512
LEAF_ITEMS = 1 << 20

_COEF = mix(np.arange(1, 17, dtype=U64)) | U64(1)
_PROBE = (mix(np.arange(BINS * 64, dtype=U64)) >> U64(57)).astype(np.int64).reshape(BINS, 64)
_SHORT = U64(0x51ED270B7F4A7C15)
_NONE = np.uint32(0xFFFFFFFF)


def shingles(word: np.ndarray, doc: np.ndarray, n_docs: int, k: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each document."""
    counts = np.bincount(doc, minlength=n_docs)
    at = np.r_[0, np.cumsum(counts)]
    if len(word) >= k:
        whole = np.zeros(len(word) - k + 1, U64)
        for j in range(k):
            whole += word[j : j + len(whole)] * _COEF[j]
        whole = mix(whole)
    out = []
    for d in range(n_docs):
        n = counts[d]
        if n >= k:
            out.append(common.sorted_distinct(whole[at[d] : at[d + 1] - k + 1]))
        elif n:
            part = word[at[d] : at[d + 1]] * _COEF[:n]
            out.append(mix(part.sum(dtype=U64, keepdims=True) + np.array([n], U64) * _SHORT))
        else:
            out.append(np.zeros(0, U64))
    return out


def sketch(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """One-permutation sketches, densified; rows of empty sets stay ``_NONE``."""
    shift = U64(64 - bins.bit_length() + 1)
    out = np.full((len(sets), bins), _NONE, np.uint32)
    for d, s in enumerate(sets):
        if len(s):
            box = (s >> shift).astype(np.int64)
            first = np.flatnonzero(np.r_[True, box[1:] != box[:-1]])
            out[d, box[first]] = (s[first] >> U64(24)).astype(np.uint32) & np.uint32(0xFFFFFFFE)
    raw = out.copy()
    filled = (raw != _NONE).any(axis=1)
    for t in range(64):
        row, col = np.nonzero((out == _NONE) & filled[:, None])
        if not len(row):
            break
        out[row, col] = raw[row, _PROBE[col, t]]
    else:  # probes that met only empty bins: the document's first filled bin
        row, col = np.nonzero((out == _NONE) & filled[:, None])
        out[row, col] = raw[row, (raw[row] != _NONE).argmax(axis=1)]
    return out


def band_keys(sketches: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, bins = sketches.shape
    part = sketches.reshape(n, bins // rows, rows).astype(U64) * _COEF[:rows]
    return mix(part.sum(axis=2, dtype=U64) + mix(np.arange(bins // rows, dtype=U64) + U64(77)))


def _sketched(batches):
    for batch in batches:
        ids = batch.column(0)
        data, off = common.utf8(batch.column(1))
        for lo, hi in common.slices(off):
            word, doc = common.words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            sets = shingles(word, doc, hi - lo)
            size = np.array([len(s) for s in sets], np.int64)
            one = np.array([s.sum(dtype=U64) for s in sets], U64)
            two = np.array([np.bitwise_xor.reduce(mix(s + _SHORT)) if len(s) else U64(0) for s in sets], U64)
            keys = band_keys(sketch(sets)).view(np.int64)
            flat = pa.array(keys.reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * keys.shape[1]), flat)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array(size), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), lists],
                ["id", "n", "fp1", "fp2", "bands"],
            )


def _sets(wanted):
    """Sets of the rows whose id is in the bitmap ``wanted``, six bytes a shingle."""

    def run(batches):
        bits = wanted.value
        for batch in batches:
            batch = batch.filter(pa.array(common.in_bitmap(bits, batch.column("slot").to_numpy())))
            ids = batch.column("id")
            data, off = common.utf8(batch.column("text"))
            for lo, hi in common.slices(off):
                word, doc = common.words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                sets = shingles(word, doc, hi - lo)
                body = [s.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(body, pa.binary())], ["id", "items"])

    return run


def unpacked(body: bytes) -> np.ndarray:
    wide = np.zeros((len(body) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(body, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view(U64)


def _confirmed(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = unpacked(a.as_buffer()), unpacked(b.as_buffer())
                if len(y) < len(x):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    sketches = common.stored(common.mapped(rows, _sketched, "id long, n long, fp1 long, fp2 long, bands array<long>"), "minhash-sketches")
    real = sketches.where("n > 0 AND id IS NOT NULL")
    classes = common.stored(real.groupBy("fp1", "fp2", "n").agg(F.min("id").alias("rep")), "minhash-classes")
    heads = real.join(classes.select("rep"), F.col("id") == F.col("rep"), "left_semi")
    members = heads.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
    family = members.withColumn("priority", F.xxhash64("id", F.col("band") % PRIORITIES))
    starred = family.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min_by("id", "priority").alias("centre"), F.min_by("n", "priority").alias("centre_n")
    )
    stars = common.stored(starred.where("size > 1").select("bucket", "centre", "centre_n"), "minhash-stars")
    fits = F.lit(100) * F.least("n", "centre_n") >= F.lit(percent) * F.greatest("n", "centre_n")
    shared = common.stored(members.join(stars, "bucket").select("bucket", "band", "id", "n", "centre", "centre_n"), "minhash-shared")
    common.free_shuffles(spark)
    pair = [F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")]
    tried = common.stored(shared.where((F.col("id") != F.col("centre")) & fits).select(*pair).distinct(), "minhash-pairs-0")
    links = _confirm(rows, tried, percent)
    label = common.components(links, "minhash")
    for turn in range(1, rounds):
        named = shared.join(label.withColumnRenamed("id", "l_id"), F.col("id") == F.col("l_id"), "left").select(
            "bucket", "band", "id", "n", F.coalesce("component", "id").alias("component")
        )
        named = common.stored(named, f"minhash-named-{turn}")
        again = named.withColumn("priority", F.xxhash64("id", "band", F.lit(turn)))
        mixed = again.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min_by("id", "priority").alias("centre"), F.min_by("n", "priority").alias("centre_n"), F.min_by("component", "priority").alias("centre_component"),
        )
        stars = common.stored(mixed.where("low < high").drop("low", "high"), f"minhash-stars-{turn}")
        fresh = named.join(stars, "bucket").where((F.col("component") != F.col("centre_component")) & fits).select(*pair).distinct()
        fresh = common.stored(fresh.join(tried, ["a", "b"], "left_anti"), f"minhash-pairs-{turn}")
        if fresh.limit(1).count() == 0:
            break
        tried = tried.union(fresh)
        links = links.union(_confirm(rows, fresh, percent))
        label = common.components(links, "minhash")
    found = _finished(rows, heads, shared, label, percent)
    if found.limit(1).count():
        label = common.components(links.union(found), "minhash")
    common.free_shuffles(spark)
    settled = classes.join(label.withColumnRenamed("id", "l_id"), F.col("rep") == F.col("l_id"), "left").select(
        F.col("fp1").alias("c1"), F.col("fp2").alias("c2"), F.col("n").alias("cn"), F.coalesce("component", "rep").alias("group")
    )
    settled = common.stored(settled, "minhash-settled")
    same = (F.col("fp1") == F.col("c1")) & (F.col("fp2") == F.col("c2")) & (F.col("n") == F.col("cn"))
    group = F.coalesce("group", "id")
    return sketches.drop("bands").join(settled, same, "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), group.alias("component_id"), F.coalesce(F.col("id") == group, F.lit(True)).alias("kept")
    )


def _crossing(x: dict, y: dict, band: int, percent: int, same: bool) -> np.ndarray:
    """Pairs of two blocks that are to be compared here: other components, sizes that fit, and no earlier common bucket."""
    least = np.minimum(x["n"][:, None], y["n"])
    pairs = (x["component"][:, None] != y["component"]) & (100 * least >= percent * np.maximum(x["n"][:, None], y["n"]))
    for k in range(band):
        pairs &= x["bands"][:, k, None] != y["bands"][:, k]
    return np.triu(pairs, 1) if same else pairs


def _block_pair(table: pa.Table) -> tuple[dict, dict, bool]:
    """The two blocks that a group of rows holds; one block twice where it meets itself."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    block = table.column("block").to_numpy()
    bands = np.array(table.column("bands").combine_chunks().flatten().to_numpy()).reshape(table.num_rows, -1)
    out = []
    for b in (i, j):
        at = np.flatnonzero(block == b)
        out.append({"at": at, "bands": bands[at], **{c: table.column(c).to_numpy()[at] for c in ("id", "n", "component")}})
    return out[0], out[1], i == j


def _open_members(percent: int):
    """Members of a pair of blocks that have something to compare."""

    def run(table: pa.Table) -> pa.Table:
        x, y, same = _block_pair(table)
        pairs = _crossing(x, y, table.column("band")[0].as_py(), percent, same)
        at = np.unique(np.r_[x["at"][pairs.any(axis=1)], y["at"][pairs.any(axis=0)]]).astype(np.int64)
        return table.take(pa.array(at))

    return run


def overlaps(x: list[np.ndarray], y: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Common shingles of the sets x[i], y[j] where ``pairs`` holds."""
    out = np.zeros(pairs.shape, np.int64)
    row, col = np.nonzero(pairs)
    if len(row) < 4 * (len(x) + len(y)):
        for i, j in zip(row, col):
            a, b = (x[i], y[j]) if len(x[i]) <= len(y[j]) else (y[j], x[i])
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            out[i, j] = (b[at] == a).sum()
        return out
    sides = []
    for sets in (x, y):
        items = np.concatenate(sets)
        order = np.argsort(items, kind="stable")
        sides.append((items[order], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]))
    shared = np.intersect1d(sides[0][0], sides[1][0])
    for lo in range(0, len(shared), 2048):  # columns of the blocks' incidence matrices
        part = shared[lo : lo + 2048]
        cells = []
        for (items, owner), sets in zip(sides, (x, y)):
            i, j = np.searchsorted(items, part[0]), np.searchsorted(items, part[-1], "right")
            at = np.searchsorted(part, items[i:j])
            hit = part[at] == items[i:j]
            cell = np.zeros((len(sets), len(part)), np.float32)
            cell[owner[i:j][hit], at[hit]] = 1
            cells.append(cell)
        out += (cells[0] @ cells[1].T).astype(np.int64)
    return out


def _compared(percent: int):
    """Links of a pair of blocks, found on the full sets: one for each two components that meet here."""

    def run(table: pa.Table) -> pa.Table:
        x, y, same = _block_pair(table)
        pairs = _crossing(x, y, table.column("band")[0].as_py(), percent, same)
        body = table.column("items")
        sets = [[unpacked(body[int(k)].as_buffer()) for k in side["at"]] for side in (x, y)]
        both = overlaps(*sets, pairs)
        row, col = np.nonzero(pairs & (100 * both >= percent * (x["n"][:, None] + y["n"] - both)))
        ends = np.stack([x["component"][row], y["component"][col]])
        _, first = np.unique(np.sort(ends, axis=0), axis=1, return_index=True)
        a, b = x["id"][row[first]], y["id"][col[first]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return run


def _finished(rows: DataFrame, heads: DataFrame, shared: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Links between the components that still meet in a bucket, every such pair compared.

    A bucket's largest component (T) is cut into blocks, the rest (R) into others, and
    R meets R and T; T with itself has nothing to compare.  A pair is compared in its first
    common bucket only.  Sets go only to blocks where a pair is left.
    """
    spark = rows.sparkSession
    named = shared.join(label.withColumnRenamed("id", "l_id"), F.col("id") == F.col("l_id"), "left").select(
        "bucket", "band", "id", "n", F.coalesce("component", "id").alias("component")
    )
    per = named.groupBy("bucket", "component").agg(F.count("*").alias("times"), F.sum("n").alias("items"))
    whole = per.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.sum("times").alias("size"), F.sum("items").alias("items"),
        F.max(F.struct("times", "items", "component")).alias("top"),
    )
    # a bucket of two had its only pair tried with its centre
    blocks = lambda times, items: F.greatest(F.ceil(times / LEAF), F.ceil(items / LEAF_ITEMS), F.lit(1)).cast("int")
    mixed = common.stored(
        whole.where("parts > 1 AND size > 2").select(
            "bucket", F.col("top.component").alias("top"), blocks(F.col("top.times"), F.col("top.items")).alias("n_top"),
            blocks(F.col("size") - F.col("top.times"), F.col("items") - F.col("top.items")).alias("n_rest"),
        ),
        "minhash-mixed",
    )
    rest = F.col("component") != F.col("top")
    spot = F.xxhash64("id", "band")
    block = F.when(rest, F.pmod(spot, F.col("n_rest"))).otherwise(F.col("n_rest") + F.pmod(spot, F.col("n_top"))).cast("int")
    last = F.when(rest, F.col("n_rest") + F.col("n_top") - 1).otherwise(F.col("n_rest") - 1)
    dealt = named.join(mixed, "bucket").withColumn("block", block)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    dealt = dealt.select("bucket", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "n", "component")
    dealt = dealt.join(heads.select(F.col("id").alias("h_id"), "bands").dropDuplicates(["h_id"]), F.col("id") == F.col("h_id")).drop("h_id")
    shape = "bucket long, band int, i int, j int, block int, id long, n long, component long, bands array<long>"
    left = common.stored(dealt.groupBy("bucket", "i", "j").applyInArrow(_open_members(percent), shape), "minhash-open")
    common.free_shuffles(spark)
    wanted = common.bitmap(left.select("id").distinct(), "id")
    slotted = rows.where("id IS NOT NULL").select("id", "text", common.bitmap_slot(F.col("id")).alias("slot"))
    sets = common.stored(common.mapped(slotted, _sets(wanted), "id long, items binary"), "minhash-leaf-sets")
    full = left.join(sets.withColumnRenamed("id", "s_id"), F.col("id") == F.col("s_id")).drop("s_id")
    links = common.stored(full.groupBy("bucket", "i", "j").applyInArrow(_compared(percent), "a long, b long").distinct(), "minhash-leaf-links")
    common.free_shuffles(spark)
    return links


def _confirm(rows: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Sets are made again where the texts are read: a bitmap of the pairs' ids, of a
    fixed size, leaves out the rest, so texts are never shuffled.
    """
    wanted = common.bitmap(pairs.select(F.explode(F.array("a", "b")).alias("w_id")), "w_id")
    slotted = rows.where("id IS NOT NULL").select("id", "text", common.bitmap_slot(F.col("id")).alias("slot"))
    sets = common.stored(common.mapped(slotted, _sets(wanted), "id long, items binary"), "minhash-sets")
    left = pairs.join(sets.select(F.col("id").alias("a_id"), F.col("items").alias("a_items")), F.col("a") == F.col("a_id")).drop("a_id")
    both = left.join(sets.select(F.col("id").alias("b_id"), F.col("items").alias("b_items")), F.col("b") == F.col("b_id"))
    good = common.mapped(both.select("a", "b", "a_items", "b_items"), _confirmed(percent), "a long, b long")
    links = common.stored(good, "minhash-links")
    common.free_shuffles(rows.sparkSession)
    return links


def op7_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM words),
sizes AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM grams),
flat AS (SELECT doc_id, hash(s) AS h, s FROM (SELECT doc_id, unnest(g) AS s FROM grams)),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM flat x JOIN flat y ON x.h = y.h AND x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * c >= 75 * (s.n + t.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS spot FROM sizes UNION SELECT r.id, e.b FROM reach r JOIN both_ways e ON e.a = r.spot)
SELECT s.doc_id, s.n AS n_shingles, min(r.spot) AS component_id, s.doc_id = min(r.spot) AS kept FROM sizes s JOIN reach r ON r.id = s.doc_id GROUP BY s.doc_id, s.n"""
