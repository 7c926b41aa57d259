"""Which of a fixed list of words a text holds, as bits.

A text is searched once, where its row is made; what follows reads the bits: whether a
group of words is hit is a mask, how many are hit a count of bits, and only a comment
turns bits back into words.  A list of any length is an array of 64-bit numbers.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import listed, once

BITS = 64


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << BITS - 1 else mask


class WordHits:
    """Bits for ``words``; every function takes and gives columns, and its size in a plan does not grow with the words."""

    def __init__(self, words):
        self.words = list(dict.fromkeys(words))
        self.place = {w: k for k, w in enumerate(self.words)}
        self.slots = -(-len(self.words) // BITS)

    def _masks(self, words) -> list[int]:
        out = [0] * self.slots
        for w in words:
            out[self.place[w] // BITS] |= 1 << self.place[w] % BITS
        return out

    def _bits(self, words: list[list[str]], holds) -> Column:
        none = F.lit(0).cast("long")
        one = lambda own: F.aggregate(F.transform(listed(own), lambda w, i: F.when(holds(w), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(none)), none, lambda a, b: a.bitwiseOR(b))
        return F.array(*[one(own) for own in words])

    def bits(self, text: Column) -> Column:
        """array<long>: the words that occur in ``text``, which is computed once."""
        slots = [self.words[k * BITS : k * BITS + BITS] for k in range(self.slots)]
        return once(F.coalesce(text, F.lit("")), lambda t: self._bits(slots, lambda w: F.contains(t, w)))

    def twice(self, text: Column, words, bits: Column | None = None) -> Column:
        """array<long>: those of ``words`` that occur twice or more, without overlap.  With the text's ``bits`` only words that it holds are searched."""
        asked = set(words)
        slots = [[w if w in asked else "" for w in self.words[k * BITS : k * BITS + BITS]] for k in range(self.slots)]
        held = bits is not None
        again = lambda t, w: F.call_function("locate", w, t, F.instr(t, w) + F.length(w)) > 0

        def slot(t: Column, own: list[str], mine: Column | None) -> Column:
            none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
            holds = lambda w, i: (F.call_function("shiftright", mine, i).bitwiseAND(one) != 0) if held else F.contains(t, w)
            hit = lambda w, i: F.when((w != "") & holds(w, i) & again(t, w), F.call_function("shiftleft", one, i)).otherwise(none)
            return F.aggregate(F.transform(listed(own), hit), none, lambda a, b: a.bitwiseOR(b))

        text = F.coalesce(text, F.lit(""))
        if not held:
            return once(text, lambda t: F.array(*[slot(t, own, None) for own in slots]))
        return once(F.struct(text.alias("t"), bits.alias("b")), lambda x: F.array(*[slot(x["t"], own, x["b"][k]) for k, own in enumerate(slots)]))

    def _masked(self, bits: Column, words) -> list[Column]:
        return [bits[k].bitwiseAND(F.lit(_signed(m)).cast("long")) for k, m in enumerate(self._masks(words)) if m]

    def any(self, bits: Column, words) -> Column:
        return functools.reduce(lambda a, b: a | b, [c != 0 for c in self._masked(bits, words)], F.lit(False))

    def count(self, bits: Column, words) -> Column:
        """How many of ``words`` are hit."""
        return functools.reduce(lambda a, b: a + b, [F.bit_count(c) for c in self._masked(bits, words)], F.lit(0))

    def found(self, bits: Column, words) -> Column:
        """The words that are hit, in the order given."""
        words = list(dict.fromkeys(words))
        place = lambda w: F.array_position(listed(self.words), w).cast("int") - 1
        hit = lambda p: F.call_function("shiftright", bits[F.floor(p / BITS).cast("int")], p % BITS).bitwiseAND(F.lit(1).cast("long")) != 0
        return F.filter(listed(words), lambda w: hit(place(w)))
