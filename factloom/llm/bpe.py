"""Byte-pair encoding and decoding with a given vocabulary, by an index of pair occurrences.

A task reads its partition in slices.  The words of a slice that it does not know yet
are laid out as one chain of symbols, and every pair of neighbours that the
vocabulary merges is indexed: its rank has the list of all positions where it occurs.
Active ranks are applied in ascending order, each to all of its positions at once from
left to right; a merge unlinks the right symbol and enters the pairs that it makes with
both neighbours into their lists.  Entries whose pair is gone by the time its rank
comes up are passed over.  No word is searched again for its lowest pair, so the work
follows the number of symbols (times the logarithm of the active ranks), a word of
millions of letters included.  Where a merge makes a pair of a lower rank than its
own, that pair comes first, as it does when a word is merged alone.

Words are what lies between white space: the dealt steps before merging (composition,
lower case, cutting into letters, digits and marks) never look across it.  Those steps
are the tokenizers library's own, read from the same file, so their tables are the
same (a word of Latin letters and ASCII marks is cut without them, where that gives the
same on probes); merging and decoding are done here.  A worker remembers the ids of
``REMEMBERED`` short words in two generations, and of as many pieces.

Defined cases: a null text is an empty one and has no tokens; texts are read whole at
any length; the strings of added tokens are those tokens wherever they stand in a
text; ids outside the vocabulary decode to nothing; null ids decode to the empty
text; repeated rows are encoded like others; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .packing import TOKENIZER, byte_letters, tokenizer_path

REMEMBERED, LONGEST = 500_000, 64
#: Letters of new words in one index, and bytes of texts in one slice.
BLOCK, SLICE = 1 << 18, 1 << 20
#: str.split() also splits at these, the tokenizer's white space does not.
_ODD = re.compile("[\x1c-\x1f]")
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!\"#$%&()*+,./:;=?@\\[\\]^_`{|}~-]*)\\Z")
_PROBED = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)]]
_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


class Model:
    """The tables of a vocabulary file: symbols, ranks of pairs, results of merges, strings of ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or told["decoder"] or model.get("unk_token"):
            raise ValueError("a merge vocabulary without prefixes, unknown tokens and decoder is needed")
        self.vocab, self.ending = model["vocab"], model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"]):
            raise ValueError("added tokens must stand for their own strings")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {self.vocab[a] << 32 | self.vocab[b]: k for k, (a, b) in enumerate(pairs)}
        self.merges = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in pairs]
        loaded = Tokenizer.from_file(path)
        self.normalizer, self.cutter = loaded.normalizer, loaded.pre_tokenizer
        self.markers = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.byte_letters = [letter for _, letter in sorted(byte_letters().items())]
        inside, last = np.full(1 << 9, -1, np.int32), np.full(1 << 9, -1, np.int32)
        for letter in self.byte_letters:
            inside[ord(letter)], last[ord(letter)] = self.vocab[letter], self.vocab[letter + self.ending]
        self.inside, self.last = inside, last
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        strings = {i: s for s, i in [*self.vocab.items(), *self.added.items()]}
        self.strings = [strings.get(i, "").encode() for i in range(max(strings) + 1)]
        self.known_ids = np.array([i in strings for i in range(len(self.strings))])
        probes = [f"{a}{b}{c}" for a in ("", "t", "Te") for b in _PROBED for c in ("", "s", "s.", ",)")]
        self.plain = all(self._plain(w) in (None, self._cut(w)) for w in probes)

    def _cut(self, word: str) -> list[str]:
        if self.normalizer is not None:
            word = self.normalizer.normalize_str(word)
        return [p for p, _ in self.cutter.pre_tokenize_str(word)] if self.cutter is not None else [word]

    def _plain(self, word: str) -> list[str] | None:
        """The pieces of Latin letters and the ASCII marks behind them; None for any other word."""
        found = _PLAIN.match(word)
        if not found:
            return None
        letters = found[1].lower()
        if not letters.isascii():
            letters = "".join([self.byte_letters[b] for b in letters.encode()])
        return [letters, found[2]] if found[2] else [letters]

    def pieces(self, word: str) -> list[str]:
        """A word's pieces, in the letters that stand for bytes.

        Plain words are cut here, if that gives what the vocabulary's own steps give on probes; all others by those steps.
        """
        return (self.plain and self._plain(word)) or self._cut(word)


class PairIndex:
    """Pieces laid out as one chain of symbols, and for every rank the positions of its pair."""

    def __init__(self, model: Model, pieces: list[str]):
        self.model = model
        codes = np.frombuffer("".join(pieces).encode("utf-16-le"), np.uint16)
        self.bounds = np.r_[0, np.cumsum([len(p) for p in pieces], dtype=np.int64)]
        ends = self.bounds[1:][self.bounds[1:] > self.bounds[:-1]] - 1
        symbol = model.inside[codes]
        symbol[ends] = model.last[codes[ends]]
        after, before = np.arange(1, len(symbol) + 1, dtype=np.int32), np.arange(-1, len(symbol) - 1, dtype=np.int32)
        after[ends] = -1
        before[ends[:-1] + 1] = -1
        left = np.flatnonzero(after >= 0)
        keys = symbol[left].astype(np.int64) << 32 | symbol[left + 1]
        place = np.minimum(np.searchsorted(model.pair_keys, keys), len(model.pair_keys) - 1)
        merged = model.pair_keys[place] == keys
        left, ranks = left[merged], model.pair_ranks[place[merged]]
        order = np.argsort(ranks, kind="stable")
        used, first = np.unique(ranks[order], return_index=True)
        spots = left[order].tolist()
        self.at: dict[int, list[int]] = {r: spots[a:b] for r, a, b in zip(used.tolist(), first.tolist(), [*first[1:].tolist(), len(spots)])}
        self.symbol, self.after, self.before = (array("i", x.astype(np.int32).tobytes()) for x in (symbol, after, before))
        self.active = list(self.at)
        heapq.heapify(self.active)

    def enter(self, rank: int, position: int) -> None:
        spots = self.at.get(rank)
        if spots is None:
            self.at[rank] = [position]
            heapq.heappush(self.active, rank)
        else:
            spots.append(position)

    def apply(self, rank: int) -> None:
        """Merge the pair of ``rank`` at all of its positions, from left to right."""
        symbol, after, before, ranks = self.symbol, self.after, self.before, self.model.rank
        left, right, made = self.model.merges[rank]
        spots = self.at.pop(rank)
        spots.sort()
        for k, i in enumerate(spots):
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue  # the pair is gone
            symbol[i], symbol[j] = made, -1
            beyond, ahead, sooner = after[j], before[i], False
            after[i] = beyond
            if beyond >= 0:
                before[beyond] = i
                found = ranks.get(made << 32 | symbol[beyond])
                if found is not None:
                    self.enter(found, i)
                    sooner = found < rank
            if ahead >= 0:
                found = ranks.get(symbol[ahead] << 32 | made)
                if found is not None:
                    self.enter(found, ahead)
                    sooner = sooner or found < rank
            if sooner and k + 1 < len(spots):  # a lower rank has become active: it goes first
                for later in spots[k + 1 :]:
                    self.enter(rank, later)
                return

    def tokens(self) -> list[bytes]:
        """The ids of every piece, as 32-bit numbers."""
        while self.active:
            self.apply(heapq.heappop(self.active))
        symbol = np.frombuffer(self.symbol, np.int32) if len(self.symbol) else np.zeros(0, np.int32)
        live = symbol >= 0
        body = symbol[live].tobytes()
        cut = (np.r_[0, np.cumsum(live)][self.bounds] * 4).tolist()
        return [body[a:b] for a, b in zip(cut[:-1], cut[1:])]


class Encoder:
    """The ids of whole texts."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.model, self.remembered = Model(path), remembered
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """A text's words; an added token is a word of its own."""
        markers = self.model.markers
        parts = markers.split(text) if markers is not None and markers.search(text) else [text]
        words: list[str] = []
        for part in parts:
            if part in self.model.added:
                words.append(part)
            else:
                words += [w for w in _SPACE.split(part) if w] if _ODD.search(part) else part.split()
        return words

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of ``words``; pieces that are not known go through an index, a block of letters at a time."""
        model, parts = self.model, self.parts
        cut = {w: model.pieces(w) for w in words if w not in model.added}
        unknown = sorted({p for pieces in cut.values() for p in pieces if p not in parts})  # one order, whatever the set's
        at = 0
        while at < len(unknown):
            end, size = at, 0
            while end < len(unknown) and size < BLOCK:
                size += len(unknown[end])
                end += 1
            parts.update(zip(unknown[at:end], PairIndex(model, unknown[at:end]).tokens()))
            at = end
        fresh = {w: b"".join([parts[p] for p in pieces]) for w, pieces in cut.items()}
        fresh.update({w: np.array([model.added[w]], np.int32).tobytes() for w in words if w in model.added})
        if len(parts) > self.remembered:
            self.parts = {}
        else:
            for p in [p for p in unknown if len(p) > LONGEST]:
                del parts[p]
        return fresh

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit numbers."""
        cut = [self.words(t) for t in texts]
        known, old = self.known, self.old
        every: set[str] = set()
        for words in cut:
            every.update(words)
        missing = every - known.keys()
        for w in missing & old.keys():
            known[w] = old[w]
        missing -= old.keys()
        fresh = self.learn(missing)
        known.update({w: ids for w, ids in fresh.items() if len(w) <= LONGEST})
        out = []
        for words in cut:
            try:
                out.append(b"".join([known[w] for w in words]))
            except KeyError:  # words that are too long to be remembered
                out.append(b"".join([known[w] if w in known else fresh[w] for w in words]))
        if len(known) > self.remembered:
            self.old, self.known = known, {}
        return out


_loaded: dict[str, Encoder] = {}
_models: dict[str, Model] = {}


def _encoded(path: str):
    def run(batches):
        encoder = _loaded.get(path) or _loaded.setdefault(path, Encoder(path))
        for batch in batches:
            texts = batch.column("text")
            _, offsets = common.utf8(texts)
            bodies: list[bytes] = []
            for lo, hi in common.slices(offsets, SLICE):
                bodies += encoder.encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
            sizes = np.r_[0, np.cumsum([len(b) // 4 for b in bodies], dtype=np.int64)].astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.frombuffer(b"".join(bodies), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids], ["id", "ids"])

    return run


def encode(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(id, ids) of rows (id, text)."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    kind = rows.schema["id"].dataType.simpleString()
    return common.mapped(rows.select("id", "text"), _encoded(path), f"id {kind}, ids array<int>")


def joined(flat: np.ndarray, first: np.ndarray, model_bytes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings of ids one after another, each behind a blank unless ``first`` (whether it opens its text); and their lengths.

    Every string is kept with its blank in front, at ``begin`` and with ``size``.
    """
    long = size[flat] - first
    start = begin[flat] + first
    out = np.repeat(start - (np.cumsum(long) - long), long) + np.arange(long.sum())
    return model_bytes[out], long


def _decoded(path: str):
    def run(batches):
        model = _models.get(path) or _models.setdefault(path, Model(path))
        shown = [b" " + s for s in model.strings]
        size = np.array([len(s) for s in shown], np.int64)
        begin, body = np.cumsum(size) - size, np.frombuffer(b"".join(shown), np.uint8)
        for batch in batches:
            lists = batch.column("ids")
            if lists.null_count:
                lists = pa.array([v or [] for v in lists.to_pylist()], pa.list_(pa.int32()))
            flat = lists.flatten()
            ids = flat.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.diff(np.asarray(lists.offsets.to_numpy(), np.int64))
            owner = np.repeat(np.arange(len(counts)), counts)
            held = (ids >= 0) & (ids < len(size))
            held[held] = model.known_ids[ids[held]]
            ids, owner = ids[held], owner[held]
            first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
            parts, lengths = [], np.zeros(len(counts), np.int64)
            for at in range(0, len(ids), BLOCK):
                text, long = joined(ids[at : at + BLOCK], first[at : at + BLOCK].astype(np.int64), body, begin, size)
                parts.append(text.tobytes())
                lengths += np.bincount(owner[at : at + BLOCK], long, len(counts)).astype(np.int64)
            offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
            texts = pa.StringArray.from_buffers(len(counts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(parts)))
            yield batch.append_column("decoded", texts)

    return run


def decode(rows: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(id, ids, decoded) of rows (id, ids): the tokens' strings with a blank between them, as a vocabulary without a decoder has it."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    kind = rows.schema["id"].dataType.simpleString()
    return common.mapped(rows.select("id", "ids"), _decoded(path), f"id {kind}, ids array<int>, decoded string")


def op13_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    shown = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode(encode(docs)).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), F.sha2(shown, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
