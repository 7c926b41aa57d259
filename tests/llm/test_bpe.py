"""Encoding and decoding against the tokenizers library itself, and the index against merging word by word."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from factloom.llm import bpe, packing

from .helpers import documents, empty


@pytest.fixture(scope="module")
def library():
    loaded = Tokenizer.from_file(packing.tokenizer_path())
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(packing.tokenizer_path())


def ids(encoder, text):
    import numpy as np

    return np.frombuffer(encoder.encode([text])[0], np.int32).tolist()


def test_every_character_beside_others(encoder, library):
    """White space, letters, digits, marks, composition and case: the steps before merging, for the whole of the basic plane and some beyond."""
    codes = [c for c in [*range(1, 0x10000), *range(0x1D400, 0x1D500), *range(0x1F600, 0x1F680), *range(0x11930, 0x11940)] if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"aB{chr(c)}x's {chr(c)} " for c in codes[k : k + 64]) for k in range(0, len(codes), 64)]
    for text, told in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids(encoder, text) == told.ids


@pytest.mark.parametrize("text", [
    "", " \t\n", "a", "aaaa aaa aa", "it's IT'S 'tis don'tve 'S", "<|endoftext|>", "x<|startoftext|><|endoftext|>y <|EndOfText|> <|endoftext", "née ÉCOLE é İI",
    "a\x1cb\x1d c\x85d\xa0e　f​g", "日本語の文です。混ぜるtextと１２３", "😀😀 👨‍👩‍👧", "ab" * 4000, "!" * 3000, "1234567890" * 50, "word,word;word.word-word_word", "ΣΑΣ ΟΔΟΣ"])
def test_texts(encoder, library, text):
    assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids


def by_word(ranks, symbols):
    """Plain merging: the lowest pair of the word, leftmost first, again and again."""
    symbols = list(symbols)
    while True:
        found = [(ranks[a, b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if (a, b) in ranks]
        if not found:
            return symbols
        _, k = min(found)
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]


def test_index_where_a_merge_makes_a_lower_pair_active(tmp_path, library):
    """A vocabulary whose merges make pairs of lower ranks than their own."""
    told = json.load(open(packing.tokenizer_path(), encoding="utf-8"))
    letters = list(packing.byte_letters().values())
    merges = [("abc", "d"), ("b", "c"), ("a", "bc"), ("ab", "c"), ("a", "b"), ("a", "a"), ("aa", "a"), ("c", "d"), ("d", "a"), ("da", "b")]
    vocab = {s: k for k, s in enumerate([*letters, *[c + "</w>" for c in letters]])}
    for a, b in merges:
        for s in (a, b, a + b):
            vocab.setdefault(s, len(vocab))
    told["model"] |= {"vocab": vocab, "merges": [list(m) for m in merges]}
    told["added_tokens"] = []
    path = tmp_path / "own.json"
    path.write_text(json.dumps(told), encoding="utf-8")
    encoder, loaded = bpe.Encoder(str(path)), Tokenizer.from_file(str(path))
    ranks = {m: k for k, m in enumerate(merges)}
    rng = random.Random(5)
    words = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(3000)} | {"a" * n for n in range(1, 12)}
    for word in sorted(words):
        want = [vocab[s] for s in by_word(ranks, [*word[:-1], word[-1] + "</w>"])]
        assert ids(encoder, word) == want == loaded.encode(word, add_special_tokens=False).ids


def test_query_on_the_fixture(spark, library):
    df, rows = documents(spark)
    got = bpe.decode(bpe.encode(df.select(F.col("doc_id").alias("id"), "text", F.lit("x").alias("ids")))).collect()
    want = sorted((i, e.ids, library.decode(e.ids, skip_special_tokens=False)) for (i, *_), e in zip(rows, library.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)))
    assert sorted((r["id"], list(r["ids"]), r["decoded"]) for r in got) == want
    assert bpe.decode(bpe.encode(empty(spark).selectExpr("doc_id AS id", "text"))).count() == 0


def test_decoding_defined_cases(spark, library):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [5, None, 10**9, -1, 320]), (None, [49407])], "id long, ids array<int>")
    assert {r["id"]: r["decoded"] for r in bpe.decode(rows).collect()} == {1: "", 2: "", 3: library.decode([5, 320]), None: "<|endoftext|>"}


def test_what_is_remembered_changes_nothing(encoder, library):
    small = bpe.Encoder(packing.tokenizer_path(), remembered=5)
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 90))) for _ in range(30)) for _ in range(20)]
    assert small.encode(texts) == encoder.encode(texts) == [b for t in texts for b in small.encode([t])]


def test_digests(spark, tmp_path, library):
    df, rows = documents(spark, extra=False)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted((r[0], len(e.ids), sha(" ".join(map(str, e.ids))), sha(library.decode(e.ids, skip_special_tokens=False))) for r in rows for e in [library.encode(r[1] or "", add_special_tokens=False)])
    assert sorted(map(tuple, bpe.op13_bpe(spark, str(tmp_path)).collect())) == want
