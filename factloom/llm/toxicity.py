"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Fit, on a bounded sample (drawn by hash, the documented bounds): two thirds of the
labelled ids may be examples, at most ``EXAMPLES`` of either label, the others
calibrate, at most ``CALIBRATING`` of them as they come; ``SAMPLE_BYTES`` bounds
the text that is learnt from.  All words of the examples are terms.  A term
weighs (1 + log tf) * idf * evidence**2: document frequencies cover all
documents, and the evidence is the size of the term's log odds ratio between the
labels, shrunk by ``PRIOR`` rows of the overall share.  So every term counts, but
a word that says nothing about the label hardly moves the cosine.

Examples are in an inverted index cut into blocks of ``BLOCK`` examples.  A term's
postings are kept block by block with the largest weight of each block.  A
document's dot product with those maxima bounds every cosine in a block; the
blocks of the highest bounds give a k-th best cosine, and only postings of blocks
whose bound can reach it are touched after that, so the neighbours are exact and
the other postings stay unread.  Neighbours vote with weight
1 / (1 - cosine + 0.05); isotonic regression on the calibrating rows turns the
vote into a probability, and the neighbours' ids are the evidence shown.

Texts are read twice, once for document frequencies (one row of counts a task
and block of terms) and once to score; nothing but the counts is shuffled.

Defined cases: a null or empty text, or one without a known term, gets the share
of toxic rows among such calibrating rows; with no labelled rows, or none that
has a document, every score is 0; repeated labels of one id count once (the
largest); a null label or id is not learnt from; a labelled id with several
documents may give several examples; repeated documents get equal scores; a long
text is read whole, slice by slice; equal votes get equal scores, and ties
between examples go to the smaller id and then to the order of the draw; an
empty table gives an empty result; other columns, labels and ids are never
inputs of a score, and columns of ``docs`` other than ``carry`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import U64

EXAMPLES = 500
CALIBRATING = 1500
SAMPLE_BYTES = 128 << 20
PRIOR = 10.0
BLOCK = 32
NEIGHBOURS = 16
OPENED = 4
DENSE = 256
TOGETHER = 64
COUNT_BLOCK = 1 << 13
REMEMBERED = 4096
_SIEVE = 1 << 21


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, documents) of the lower-cased letter runs."""
    low = common.LOWER[data]
    start, end, doc = common.token_spans(low, off, common.IS_LETTER[low])
    return (common.span_hash(common.prefix_hash(low), start, end) if len(start) else np.zeros(0, U64)), doc


def _sampled(batches):
    """Distinct terms and their counts of whole texts."""
    for batch in batches:
        data, off = common.utf8(batch.column(0))
        for i in range(len(batch)):
            term, n = np.unique(terms(data[off[i] : off[i + 1]], np.array([0, off[i + 1] - off[i]]))[0], return_counts=True)
            kept = [batch.column(k).slice(i, 1) for k in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([term.tobytes()], pa.binary()), pa.array([n.astype(np.int64).tobytes()], pa.binary()), *kept], ["terms", "counts", *batch.schema.names[1:]]
            )


class Vocabulary:
    def __init__(self, fingerprints: np.ndarray):
        self.terms = fingerprints  # ascending
        self.maybe = np.zeros(_SIEVE, bool)
        self.maybe[(fingerprints & U64(_SIEVE - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``h`` are known, their numbers)."""
        hit = np.flatnonzero(self.maybe[(h & U64(_SIEVE - 1)).astype(np.int64)])
        at = np.searchsorted(self.terms, h[hit])
        real = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == h[hit]) if len(self.terms) else np.zeros(0, np.int64)
        return hit[real], at[real]

    def rows(self, data: np.ndarray, off: np.ndarray):
        """(terms, counts, bounds): known terms and their counts, document by document."""
        h, d = terms(data, off)
        known, at = self.find(h)
        key, n = np.unique(d[known] * np.int64(len(self.terms)) + at, return_counts=True)
        bounds = np.searchsorted(key, np.arange(len(off)) * np.int64(len(self.terms)))
        return key % max(len(self.terms), 1), n, bounds


def _counted(shared):
    """A task's document frequencies: one row for each block of the vocabulary."""

    def run(batches):
        own = shared.value
        seen, rows = np.zeros(len(own.terms), np.int64), 0
        for batch in batches:
            data, off = common.utf8(batch.column(0))
            rows += len(batch)
            for lo, hi in common.slices(off):
                seen += np.bincount(own.rows(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])[0], minlength=len(seen))
        if rows:
            starts = range(0, max(len(seen), 1), COUNT_BLOCK)
            body = [seen[b : b + COUNT_BLOCK].tobytes() for b in starts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b // COUNT_BLOCK for b in starts], pa.int32()), pa.array(body, pa.binary()), pa.array([rows] * len(body), pa.int64())], ["block", "seen", "rows"]
            )

    return run


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b.as_buffer(), np.int64) for b in table.column("seen"))
    rows = int(np.asarray(table.column("rows")).sum())
    return pa.table({"block": table.column("block")[:1], "seen": pa.array([total.tobytes()], pa.binary()), "rows": pa.array([rows], pa.int64())})


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The whole numbers of the ranges start, start + 1 ... (size of them), one range after the other."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


class BlockMaxIndex:
    """Unit vectors of examples in blocks; a term's postings by block, with the block's largest weight.

    The ``DENSE`` most frequent terms, where they are in more than a sixteenth of
    the examples, are columns of a matrix instead: their exact part of all cosines
    is one product, to which the bounds of the other terms are added.
    """

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, labels: np.ndarray, ids: np.ndarray):
        self.weight_of = weight
        vectors = [self.vector(t, n) for t, n in rows]
        # examples with the same heaviest terms share blocks, so that a block's maxima are near its members' weights
        heavy = [tuple(t[np.argsort(-w, kind="stable")[:3]]) for t, w in vectors]
        order = sorted(range(len(rows)), key=lambda i: (heavy[i], ids[i], i))
        self.labels, self.ids = labels[order], ids[order]
        self.blocks = -(-len(rows) // BLOCK)
        example = np.concatenate([np.full(len(vectors[k][0]), i) for i, k in enumerate(order)])
        term = np.concatenate([vectors[k][0] for k in order])
        parts = np.concatenate([vectors[k][1] for k in order])
        times = np.bincount(term, minlength=len(weight))
        common_terms = np.argsort(-times, kind="stable")[:DENSE]
        common_terms = common_terms[times[common_terms] * 16 > len(rows)]
        self.column = np.full(len(weight), -1, np.int64)
        self.column[common_terms] = np.arange(len(common_terms))
        dense = self.column[term] >= 0
        self.matrix = np.zeros((len(common_terms), self.blocks * BLOCK))
        self.matrix[self.column[term[dense]], example[dense]] = parts[dense]
        term, example, parts = term[~dense], example[~dense], parts[~dense]
        by_term = np.lexsort((example, term))
        self.example, self.part, term = example[by_term].astype(np.int32), parts[by_term], term[by_term]
        key = term * np.int64(self.blocks) + self.example // BLOCK
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.block, self.from_, self.size = (key[cut] % max(self.blocks, 1)), cut, np.diff(np.r_[cut, len(key)])
        self.largest = np.maximum.reduceat(self.part, cut) if len(cut) else np.zeros(0)
        self.start = np.searchsorted(term[cut], np.arange(len(weight) + 1))

    def vector(self, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(n)) * self.weight_of[t]
        return t, w / max(np.sqrt((w * w).sum()), 1e-300)

    def nearest(self, documents: list[tuple[np.ndarray, np.ndarray]], k: int):
        """Exact, for each of the documents (terms, counts): (cosines, examples) of the k nearest with a positive cosine, ties to the smaller id; and the postings read."""
        for lo in range(0, len(documents), TOGETHER):
            yield from self._together([self.vector(t, n) for t, n in documents[lo : lo + TOGETHER]], k)

    def _together(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int):
        """``nearest`` for a few documents at once: rows of small matrices."""
        term, weight = (np.concatenate([v[j] for v in vectors]) for j in (0, 1))
        row = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        column = self.column[term]
        dense = column >= 0
        left = np.zeros((len(vectors), len(self.matrix)))
        left[row[dense], column[dense]] = weight[dense]
        cos = left @ self.matrix
        term, weight, row = term[~dense], weight[~dense], row[~dense]
        size = self.start[term + 1] - self.start[term]
        entry, mine = spread(self.start[term], size), np.repeat(weight, size)
        place = np.repeat(row * self.blocks, size) + self.block[entry]  # of the entry's document and block
        bound = cos.reshape(len(vectors), self.blocks, BLOCK).max(axis=2)
        bound += np.bincount(place, weights=mine * self.largest[entry], minlength=bound.size).reshape(bound.shape)
        bound *= 1 + 1e-9
        read = np.zeros(len(vectors), np.int64)

        def score(wanted: np.ndarray) -> None:
            at = np.flatnonzero(wanted.reshape(-1)[place])
            times = self.size[entry[at]]
            posting = spread(self.from_[entry[at]], times)
            of = place[at] // self.blocks
            target = np.repeat(of * cos.shape[1], times) + self.example[posting]
            cos[:] += np.bincount(target, weights=np.repeat(mine[at], times) * self.part[posting], minlength=cos.size).reshape(cos.shape)
            read[:] += np.bincount(of, weights=times, minlength=len(read)).astype(np.int64)

        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, np.argpartition(-bound, min(self.opened(k), self.blocks) - 1, axis=1)[:, : self.opened(k)], True, axis=1)
        score(first)
        full = np.where(np.repeat(first, BLOCK, axis=1), cos, 0.0)[:, : len(self.ids)]
        least = np.partition(full, full.shape[1] - k, axis=1)[:, full.shape[1] - k] if full.shape[1] >= k else np.zeros(len(full))
        rest = ~first & (bound > 0) & (bound >= (least * (1 - 1e-9))[:, None])
        score(rest)
        full = np.where(np.repeat(first | rest, BLOCK, axis=1), cos, 0.0)[:, : len(self.ids)]
        if full.shape[1] >= k:
            least = np.partition(full, full.shape[1] - k, axis=1)[:, full.shape[1] - k]
        for i in range(len(vectors)):
            which = np.flatnonzero((full[i] > 1e-12) & (full[i] >= least[i]))
            best = np.lexsort((which, self.ids[which], -full[i][which]))[:k]
            yield full[i][which[best]], which[best], int(read[i])

    @staticmethod
    def opened(k: int) -> int:
        """Blocks that are scored before any threshold is known."""
        return max(OPENED, 2 * k // BLOCK)

    def vote(self, cos: np.ndarray, which: np.ndarray) -> float:
        w = 1 / (1.05 - np.minimum(cos, 1))
        return float((w * self.labels[which]).sum() / w.sum())

    def voted(self, documents: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[int]]]:
        """(vote or -1, ids of the three nearest) of each document."""
        found = ((cos, which) for cos, which, _ in self.nearest(documents, NEIGHBOURS))
        return [(self.vote(cos, which), self.ids[which[:3]].tolist()) if len(cos) else (-1.0, []) for cos, which in found]


class Model:
    """What scores a text: vocabulary, index and the calibrating curve (``knots`` of votes and probabilities)."""

    def __init__(self, vocabulary: Vocabulary, index: BlockMaxIndex | None):
        self.vocabulary, self.index, self.floor, self.knots = vocabulary, index, 0.0, []

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        silent = votes < 0
        self.floor = float((labels[silent].sum() + 0.05) / (silent.sum() + 1)) if len(votes) else 0.0
        self.knots = isotonic(votes[~silent], labels[~silent]) if (~silent).any() else []

    def probability(self, votes: np.ndarray) -> np.ndarray:
        """The probability between two knots runs linearly with the vote."""
        x, p = zip(*self.knots) if self.knots else ((0.0,), (self.floor,))
        return np.clip(np.where(votes < 0, self.floor, np.interp(votes, x, p)), 0, 1)


def _scored(shared):
    def run(batches):
        own = shared.value
        known: dict = {}  # equal texts that follow each other are scored once
        for batch in batches:
            data, off = common.utf8(batch.column(1))
            for lo, hi in common.slices(off):
                if own.index is not None:
                    t, n, bounds = own.vocabulary.rows(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                    documents = [(t[a:b], n[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                    keys = [(t.tobytes(), n.tobytes()) for t, n in documents]
                    if len(known) >= REMEMBERED:
                        known.clear()
                    fresh = {key: document for key, document in zip(keys, documents) if key not in known}
                    known.update(zip(fresh, own.index.voted(list(fresh.values()))))
                    votes, proofs = [known[key][0] for key in keys], [known[key][1] for key in keys]
                else:
                    votes, proofs = [-1.0] * (hi - lo), [[]] * (hi - lo)
                score = own.probability(np.array(votes))
                carried = [batch.column(k).slice(lo, hi - lo) for k in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(proofs, pa.list_(pa.int64())), *carried],
                    ["doc_id", "score", "predicted", "evidence", *batch.schema.names[2:]],
                )

    return run


def isotonic(votes: np.ndarray, labels: np.ndarray) -> list[tuple[float, float]]:
    """Knots (vote, probability), rising in both: pool adjacent violators, each pool smoothed by a tenth of a row and level over its own votes."""
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []  # first vote, last vote, labels, rows
    for v, y in zip(votes[order], labels[order]):
        pools.append([v, v, y, 1.0])
        while len(pools) > 1 and (pools[-2][1] == pools[-1][0] or pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]):
            _, v2, y2, n2 = pools.pop()
            v1, _, y1, n1 = pools[-1]
            pools[-1] = [v1, v2, y1 + y2, n1 + n2]
    knots, last = [], 0.0
    for first, end, y, n in pools:
        last = max(last, (y + 0.05) / (n + 0.1))
        knots += [(float(v), float(last)) for v in ((first, end) if first < end else (first,))]
    return knots


def evidence(n: np.ndarray, toxic: np.ndarray, share: float, prior: float = PRIOR) -> np.ndarray:
    """Size of the log odds ratio of a term in ``n`` examples, ``toxic`` of them toxic, shrunk towards the overall share."""
    if not 0 < share < 1:
        return np.ones(len(n))
    return np.abs(np.log((toxic + prior * share) / (n - toxic + prior * (1 - share))) - np.log(share / (1 - share)))


def labelled(docs: DataFrame, labels: DataFrame, examples: int, calibrating: int, most: int) -> pa.Table:
    """The sample: (terms, counts, doc_id, toxic, calibrates), at most ``most`` bytes of text (and the row that passes them)."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marks = marks.where(F.crc32(F.col("label_id").cast("string").cast("binary")) % 5 != 0).withColumn("calibrates", F.pmod(F.xxhash64("label_id", F.lit(1)), F.lit(3)) == 0)
    drawn = [marks.where(which).orderBy(F.xxhash64("label_id"), "label_id").limit(n) for which, n in (
        ("NOT calibrates AND toxic = 1", examples), ("NOT calibrates AND toxic = 0", examples), ("calibrates", calibrating))]
    picked = common.stored(drawn[0].union(drawn[1]).union(drawn[2]), "toxic-labels")
    own = docs.select(F.col("doc_id").cast("long").alias("own_id"), "text").join(F.broadcast(picked), F.col("own_id") == F.col("label_id"))  # bounded above
    seen = own.select(
        "text", F.col("own_id").alias("doc_id"), "toxic", "calibrates",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"), F.xxhash64("own_id").alias("draw"), F.xxhash64("text").alias("print"),
    )
    order = ("draw", "doc_id", "print", "bytes")
    made = common.mapped(seen, _sampled, "terms binary, counts binary, doc_id long, toxic int, calibrates boolean, bytes long, draw long, print long")
    made = common.stored(made.orderBy(*order).limit(2 * examples + calibrating), "toxic-sample")
    sizes = made.select(*order).orderBy(*order).toArrow()  # numbers of the bounded sample
    enough = int(np.searchsorted(np.cumsum(np.asarray(sizes.column("bytes"))), most)) + 1
    return made.orderBy(*order).limit(enough).toArrow().select(["terms", "counts", "doc_id", "toxic", "calibrates"])


def fitted(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, calibrating: int = CALIBRATING, most: int = SAMPLE_BYTES) -> Model:
    spark = docs.sparkSession
    table = labelled(docs, labels, examples, calibrating, most)
    term = [np.frombuffer(b.as_buffer(), U64) for b in table.column("terms")]
    count = [np.frombuffer(b.as_buffer(), np.int64) for b in table.column("counts")]
    ids, toxic = np.asarray(table.column("doc_id")), np.asarray(table.column("toxic")).astype(float)
    proves = np.asarray(table.column("calibrates")).astype(bool)
    learnt = np.flatnonzero(~proves & np.array([len(t) > 0 for t in term], bool)) if len(term) else np.zeros(0, np.int64)
    if not len(learnt):
        model = Model(Vocabulary(np.zeros(0, U64)), None)
        model.calibrate(np.full(len(toxic), -1.0), toxic)
        return model
    vocabulary = Vocabulary(common.sorted_distinct(np.concatenate([term[i] for i in learnt])))
    counts = common.mapped(docs.select("text"), _counted(spark.sparkContext.broadcast(vocabulary)), "block int, seen binary, rows long")
    sums = common.added_up(counts, _summed, "block int, seen binary, rows long").collect()  # the vocabulary of the sample
    seen = np.concatenate([np.frombuffer(r["seen"], np.int64) for r in sorted(sums, key=lambda r: r["block"])])
    idf = np.log((sums[0]["rows"] + 1) / (seen + 1)) + 1
    rows = [vocabulary.find(term[i])[1] for i in range(len(term))]
    kept = [count[i][vocabulary.find(term[i])[0]] for i in range(len(term))]
    n, hot = np.zeros(len(idf)), np.zeros(len(idf))
    for i in learnt:
        n[rows[i]] += 1
        hot[rows[i]] += toxic[i]
    weight = idf * evidence(n, hot, float(toxic[learnt].mean())) ** 2
    index = BlockMaxIndex([(rows[i], kept[i]) for i in learnt], weight, toxic[learnt], ids[learnt])
    model = Model(vocabulary, index)
    model.calibrate(np.array([v for v, _ in index.voted([(rows[i], kept[i]) for i in np.flatnonzero(proves)])]), toxic[proves])
    return model


def score_documents(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, predicted, evidence, and the long columns ``carry``) for every row of ``docs``."""
    docs = docs.select("doc_id", "text", *carry)
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    carried = "".join(f", {c} long" for c in carry)
    return common.mapped(docs, _scored(shared), f"doc_id {kind}, score double, predicted int, evidence array<long>{carried}")


def held_out(doc_id, remainder: int = 0):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == remainder


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    out = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")
