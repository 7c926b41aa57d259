"""Many keywords over many texts: an index of the keywords' rarest grams, and an exact comparison of what meets.

A chain of ``contains`` grows with the words, in the plan and in time.  Here the words are
data: of each word the gram that fewest words have is its anchor, and its size is the largest
of ``GRAMS`` that the word has room for: the whole of a word of up to 16 bytes, so that the
words that a place meets do not grow with the table.  A text's grams are looked up among the
anchors in one pass for each size, and only where an anchor stands is its word compared.
Texts stay in Arrow buffers, no gram is ever a row, and nothing is shuffled.

The words are shared with all tasks in blocks of at most ``LIMIT`` bytes; a table beyond
that takes one pass for each block.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

LIMIT, SLICE = 32 << 20, 1 << 20
#: Sizes of grams in bytes.
GRAMS = (*range(1, 17), 24, 32, 48, 64)
#: Places of a text, and words, that are compared at a time; so many places' numbers stay in a core's cache.
PLACES, MET = 1 << 17, 1 << 20
FOUND = "array<struct<word:long,n:int>>"
TOTALS = "words long, times long, first long, mark long"
ODD = np.uint64(11400714819323198485)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros after the end."""
    out = data.astype(np.uint64)
    for k in (1, 2, 4):
        out[:-k] |= out[k:] << np.uint64(8 * k)
    return out


def grams(eight: np.ndarray, size: int) -> np.ndarray:
    """The strings of ``size`` bytes that start at each place, as numbers: themselves up to 8 bytes, fingerprints beyond."""
    n = max(len(eight) - size + 1, 0)
    if size <= 8:
        return eight[:n] & np.uint64((1 << 8 * size) - 1)
    out = eight[:n]
    for at in (*range(8, size - 8, 8), size - 8):
        out = (out ^ (out >> np.uint64(32))) * ODD + eight[at : at + n]
    return out


def slot(values: np.ndarray, bits: int) -> np.ndarray:
    return (((values ^ (values >> np.uint64(32))) * ODD) >> np.uint64(64 - bits)).view(np.int64)


class KeywordIndex:
    """``words`` (not empty) by their anchors."""

    def __init__(self, words: list[bytes], ids: list[int]):
        self.ids = np.array(ids, np.int64)
        self.size = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.body = np.frombuffer(b"".join(words), np.uint8)
        self.tables = []
        eight, kind = eights(self.body), np.searchsorted(GRAMS, self.size, "right") - 1
        for g, size in enumerate(GRAMS):
            own = np.flatnonzero(kind == g)
            if not len(own):
                continue
            owner = np.repeat(own, self.size[own] - size + 1)
            first = np.cumsum(self.size[own] - size + 1) - (self.size[own] - size + 1)
            at = np.arange(len(owner)) - np.repeat(first, self.size[own] - size + 1)
            values = grams(eight, size)[self.start[owner] + at]
            _, which, often = np.unique(values, return_inverse=True, return_counts=True)
            order = np.lexsort((at, often[which], owner))
            best = order[np.r_[True, owner[order][1:] != owner[order][:-1]]]  # of each word the rarest gram
            bits = max(10, int(8 * len(best)).bit_length())  # 8 to 16 slots a word tell most grams from anchors; anchors are found by every second
            by = np.lexsort((values[best], slot(values[best], bits)))
            anchor, words_, offset = values[best][by], owner[best][by], at[best][by]
            bound = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            places = slot(anchor[bound], bits)
            seen = np.zeros(1 << bits, bool)
            seen[places] = True
            head = np.searchsorted(places >> 1, np.arange((1 << bits - 1) + 1)).astype(np.int32)
            self.tables.append((size, bits, seen, head, anchor[bound], np.r_[bound, len(anchor)], words_, offset))

    @classmethod
    def of(cls, parts: dict) -> KeywordIndex:
        """The index of its arrays, which are all that tasks are sent."""
        index = cls.__new__(cls)
        index.__dict__.update(parts)
        return index

    def find(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, word, place) of every occurrence, overlapping ones too, never across documents."""
        found = []
        for begin in range(0, len(data), PLACES):
            docs = np.repeat(np.arange(len(off) - 1), np.diff(np.clip(off, begin, begin + PLACES)))
            eight = eights(data[begin : begin + PLACES + GRAMS[-1]])
            for size, bits, seen, head, anchors, bound, words, offset in self.tables:
                values = grams(eight, size)[:PLACES]
                at = slot(values, bits)
                place = np.flatnonzero(seen[at])
                place, k = self._met(place, values[place], at[place] >> 1, head, anchors)
                doc, place, n = docs[place], place + begin, bound[k + 1] - bound[k]
                upto = np.cumsum(n)
                lo = 0
                while lo < len(place):  # what meets is compared MET at a time: frequent grams with many words meet often
                    hi = max(int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + MET, "right")), lo + 1)
                    found.append(self._same(data, off, size, words, offset, doc[lo:hi], place[lo:hi], bound[k[lo:hi]], n[lo:hi]))
                    lo = hi
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found))

    @staticmethod
    def _met(place, values, at, head, anchors):
        """(place, anchor) where a gram is an anchor: those of its slot are tried in turn."""
        k = head[at]
        same = anchors[k] == values
        met, more = [(place[same], k[same])], np.flatnonzero(~same)
        place, values, k, end = place[more], values[more], k[more] + 1, head[at[more] + 1]
        while len(place):
            same = (k < end) & (anchors[np.minimum(k, len(anchors) - 1)] == values)
            met.append((place[same], k[same]))
            more = np.flatnonzero(~same & (k + 1 < end))
            place, values, k, end = place[more], values[more], k[more] + 1, end[more]
        return tuple(np.concatenate(x) for x in zip(*met))

    def _same(self, data, off, size, words, offset, doc, place, first, n):
        """(document, word, place) of the words that stand at ``place`` in ``doc``: of each the ``n`` from ``first`` on are compared."""
        pick = first
        if (n > 1).any():
            pick, place, doc = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum()), np.repeat(place, n), np.repeat(doc, n)
        word, begin = words[pick], place - offset[pick]
        fits = (begin >= off[doc]) & (begin + self.size[word] <= off[doc + 1])
        word, begin, doc = word[fits], begin[fits], doc[fits]
        for j in range(int(self.size[word].max()) if len(word) and size > 8 else 0):  # shorter at every byte; grams of up to 8 bytes are the words
            longer = self.size[word] > j
            same = np.ones(len(word), bool)
            same[longer] = data[begin[longer] + j] == self.body[self.start[word[longer]] + j]
            word, begin, doc = word[same], begin[same], doc[same]
        return doc, word, begin

    def counts(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, word, how often without overlap), by document and word."""
        doc, word, begin = self.find(data, off)
        if not len(doc):
            return doc, word, begin
        wide, high = int(len(data)).bit_length(), int(len(self.ids)).bit_length()
        if wide + high + int(len(off)).bit_length() < 64:  # one number sorts many times faster than three
            key = np.sort((doc << wide + high) | (word << wide) | begin)
            doc, word, begin = key >> wide + high, (key >> wide) & ((1 << high) - 1), key & ((1 << wide) - 1)
        else:
            order = np.lexsort((begin, word, doc))
            doc, word, begin = doc[order], word[order], begin[order]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])]
        first = np.flatnonzero(new)
        n = np.diff(np.r_[first, len(doc)])
        close = np.flatnonzero(~new[1:] & (begin[1:] - begin[:-1] < self.size[word[1:]])) + 1
        group = np.unique(np.searchsorted(first, close, "right") - 1)
        n[group] = self._apart(begin, self.size[word[first[group]]], first[group], n[group])
        return doc[first], word[first], n

    @staticmethod
    def _apart(begin, size, first, n):
        """How many of the ``n`` places from ``first`` on are taken when a word that overlaps itself is counted from the left."""
        start = np.cumsum(n) - n
        group = np.repeat(np.arange(len(n)), n)
        reach = np.r_[0, np.cumsum(begin[first + n - 1] + size)]
        line = begin[np.repeat(first - start, n) + np.arange(len(group))] + reach[group]  # the groups one after another on one line
        after = np.r_[np.minimum(np.searchsorted(line, line + size[group]), (start + n)[group]), len(line)]
        after[:-1][after[:-1] == (start + n)[group]] = len(line)
        taken = np.r_[np.ones(len(line), np.int64), 0]
        while (after < len(line)).any():  # steps double
            taken, after = taken + taken[after], after[after]
        return taken[start]


def _hits(index, doc, word, n, rows):
    """Of each row the words that occur."""
    pairs = pa.StructArray.from_arrays([pa.array(index.ids[word]), pa.array(n.astype(np.int32))], ["word", "n"])
    return {"found": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(doc, minlength=rows))].astype(np.int32)), pairs)}


def _totals(index, doc, word, n, rows):
    """Of each row how many words occur, how often, the least word_id and the sum of word_id * n."""
    words, ids = np.bincount(doc, minlength=rows), index.ids[word]
    if len(ids) and int(n.sum()) * max(-int(ids.min()), int(ids.max())) >= 1 << 63:
        ids = ids.astype(object)  # exact; pyarrow refuses what has no place in 64 bits
    first = (np.cumsum(words) - words)[words > 0]
    times, least, mark = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, ids.dtype)
    if len(first):
        times[words > 0], least[words > 0], mark[words > 0] = (f.reduceat(x, first) for f, x in ((np.add, n), (np.minimum, index.ids[word]), (np.add, ids * n)))
    return {"words": pa.array(words), "times": pa.array(times), "first": pa.array(least, mask=words == 0), "mark": pa.array(mark, pa.int64())}


def _searched(shared, make=_hits):
    def run(batches):
        index = KeywordIndex.of(shared.value)
        for batch in batches:
            column = batch.column("text").cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
            lo = 0
            while lo < len(column):  # a slice's hits leave before the next is searched: they can be many times its text
                hi = min(max(int(np.searchsorted(offsets, offsets[lo] + SLICE, "right")) - 1, lo + 1), len(column))
                doc, word, n = index.counts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_pydict({"id": batch.column("id").slice(lo, hi - lo)} | make(index, doc, word, n, hi - lo))
                lo = hi

    return run


def _passes(texts: DataFrame, keywords: DataFrame, limit: int, make, columns: str) -> list[DataFrame]:
    """(id, columns) of texts for each block of the words; with several, an id is (id, row) and rows meet by it."""
    spark = texts.sparkSession
    kept = keywords.where("octet_length(word) > 0").select(F.col("word_id").cast("long").alias("word_id"), "word").persist()  # their size and every block are read from it
    size = kept.agg(F.coalesce(F.sum(F.octet_length("word") + 16), F.lit(0))).first()[0]
    parts, blocks = [], max(1, -(-size // limit))
    rows = texts.select("id", "text")
    if blocks > 1:  # found in several passes: what a row has meets by its place
        rows = rows.withColumn("id", F.struct("id", F.monotonically_increasing_id().alias("row")))
    kind = rows.schema["id"].dataType.simpleString()
    for k in range(blocks):
        own = kept if blocks == 1 else kept.where(F.pmod(F.xxhash64("word_id", "word"), F.lit(blocks)) == k)
        block = own.toArrow().sort_by([("word_id", "ascending"), ("word", "ascending")])  # LIMIT bytes, about
        index = KeywordIndex([w.encode() for w in block.column("word").to_pylist()], block.column("word_id").to_pylist())
        parts.append(rows.mapInArrow(_searched(spark.sparkContext.broadcast(vars(index)), make), f"id {kind}, {columns}"))
    kept.unpersist()
    return parts


def keyword_hits(texts: DataFrame, keywords: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(id, found) of texts (id, text): the words of keywords (word_id, word) that occur, and how often without overlap, by word_id.

    Null and empty words are left out, a null text holds none; rows that share an id are rows of their own.
    """
    parts = _passes(texts, keywords, limit, _hits, f"found {FOUND}")
    ordered = F.array_sort("found")
    if len(parts) == 1:
        return parts[0].select("id", ordered.alias("found"))
    every = functools.reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.flatten(F.collect_list("found")).alias("found"))
    return every.select(F.col("id.id").alias("id"), ordered.alias("found"))


def keyword_totals(texts: DataFrame, keywords: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(id, words, times, first, mark) of ``keyword_hits``, added up where they are found: how many words, how often, the least word_id, the sum of word_id * n."""
    parts = _passes(texts, keywords, limit, _totals, TOTALS)
    if len(parts) == 1:
        return parts[0]
    every = functools.reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("words").alias("words"), F.sum("times").alias("times"), F.min("first").alias("first"), F.sum("mark").alias("mark"))
    return every.select(F.col("id.id").alias("id"), "words", "times", "first", "mark")


def classes(found: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, label) of hits (id, found): labels all of whose groups have a word.  groups: (label, group, word_id)."""
    per_label = groups.groupBy("label").agg(F.countDistinct("group").alias("_needed"))
    hits = found.select("id", F.explode("found.word").alias("word_id")).join(groups, "word_id").groupBy("id", "label").agg(F.countDistinct("group").alias("_have"))
    return hits.join(per_label, "label").where(F.col("_have") == F.col("_needed")).select("id", "label")
