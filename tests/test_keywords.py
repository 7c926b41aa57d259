"""The keyword index against plain search."""

import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import keywords


def fixture(seed=1):
    rng = random.Random(seed)
    letters = "abcé株式"
    say = lambda n: "".join(rng.choice(letters) for _ in range(n))
    texts = [(i, say(rng.randint(0, 400))) for i in range(60)] + [(60, None), (61, ""), (5, "aaaaaa"), (62, "a"), (63, "aa" * 3000)]
    words = sorted({say(rng.randint(1, 7)) for _ in range(900)} | {"aa", "aaa", "abab", "株式会社", "never there"})
    return texts, [(k, w) for k, w in enumerate(words)] + [(10_000, ""), (10_001, None), (10_002, "aa")]


def brute(texts, words):
    return sorted((i, [(k, (t or "").count(w)) for k, w in words if w and w in (t or "")]) for i, t in texts)


@pytest.mark.parametrize("limit", [keywords.LIMIT, 4000])
def test_hits_equal_plain_search(spark, limit):
    texts, words = fixture()
    got = keywords.keyword_hits(spark.createDataFrame(texts, "id long, text string").repartition(3), spark.createDataFrame(words, "word_id long, word string"), limit=limit)
    assert sorted((r["id"], [tuple(x) for x in r["found"]]) for r in got.collect()) == brute(texts, words)


def test_the_plan_does_not_grow_with_the_words(spark):
    texts = spark.createDataFrame([(1, "xaay")], "id long, text string")
    size = lambda n: len(keywords.keyword_hits(texts, spark.range(n).select(F.col("id").alias("word_id"), F.concat(F.lit("w"), "id").alias("word")))._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(2000) - size(20)) < 20


def test_empty_tables_and_classes(spark):
    none = spark.createDataFrame([], "word_id long, word string")
    assert [tuple(r) for r in keywords.keyword_hits(spark.createDataFrame([(1, "a")], "id long, text string"), none).collect()] == [(1, [])]
    assert keywords.keyword_hits(spark.createDataFrame([], "id long, text string"), none).count() == 0
    found = keywords.keyword_hits(spark.createDataFrame([(1, "ab"), (2, "a"), (3, "c")], "id long, text string"), spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "word_id long, word string"))
    groups = spark.createDataFrame([("x", 0, 0), ("x", 1, 1), ("y", 0, 0), ("y", 0, 2)], "label string, group int, word_id long")
    assert sorted(map(tuple, keywords.classes(found, groups).collect())) == [(1, "x"), (1, "y"), (2, "y"), (3, "y")]


def test_memory_does_not_follow_the_words_of_a_gram():
    import itertools
    import tracemalloc

    import numpy as np

    words = ["".join(w).encode() for w in itertools.product("ab", repeat=12)]
    rng = random.Random(3)
    data = np.frombuffer("".join(rng.choice("ab") for _ in range(20_000)).encode(), np.uint8)
    index = keywords.KeywordIndex(words, list(range(len(words))))
    tracemalloc.start()
    doc, word, n = index.counts(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6 and len(word) > 3900


def test_hits_leave_slice_by_slice():
    import types

    import pyarrow as pa

    texts = ["ab" * 200_000] * 6 + [None, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], ["id", "text"])
    index = keywords.KeywordIndex([b"ab", b"b"], [7, 9])
    got = list(keywords._searched(types.SimpleNamespace(value=vars(index)))([batch]))
    assert len(got) > 1 and max(sum(len(texts[k] or "") for k in b.column("id").to_pylist()) for b in got) <= keywords.SLICE
    assert [r for b in got for r in b.to_pylist()] == [{"id": k, "found": [{"word": w, "n": (t or "").count(x)} for w, x in ((7, "ab"), (9, "b")) if x in (t or "")]} for k, t in enumerate(texts)]


def test_words_that_a_place_meets_do_not_follow_the_table(monkeypatch):
    import itertools

    import numpy as np

    words = ["".join(w).encode() for w in itertools.product("abcd", repeat=6)]
    rng = random.Random(4)
    data = np.frombuffer("".join(rng.choice("abcd") for _ in range(20_000)).encode(), np.uint8)
    compared, same = [], keywords.KeywordIndex._same
    monkeypatch.setattr(keywords.KeywordIndex, "_same", lambda *a: compared.append(int(a[-1].sum())) or same(*a))
    found = keywords.KeywordIndex(words, list(range(len(words)))).find(data, np.array([0, len(data)]))
    assert len(found[0]) == 19_995 == sum(compared)  # a place has one word of six bytes, however many there are


@pytest.mark.parametrize("places", [7, 100, keywords.MET])
def test_words_of_any_size_at_any_place(monkeypatch, places):
    import numpy as np

    monkeypatch.setattr(keywords, "PLACES", places, raising=False)
    rng = random.Random(5)
    say = lambda n, letters: bytes(rng.choice(letters) for _ in range(n))
    texts = [b"", say(900, b"ab"), say(1, b"ab"), b"ab" * 200, b"a" * 301, b"", say(700, b"abcd"), b"\0" * 40]
    cut = lambda t, n: [t[i : i + n] for i in range(0, len(t) - n, 97)]
    words = sorted({w for t in texts for n in (*range(1, 20), 23, 24, 25, 31, 33, 48, 63, 64, 65, 130, 300) for w in cut(t, n)} | {b"aba", b"aabaa", b"\0", b"\0\0", b"a" * 400}) + [b"ab"]
    index = keywords.KeywordIndex(words, list(range(len(words))))
    doc, word, n = index.counts(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    assert list(zip(doc.tolist(), word.tolist(), n.tolist())) == [(i, k, t.count(w)) for i, t in enumerate(texts) for k, w in enumerate(words) if w in t]


@pytest.mark.parametrize("limit", [keywords.LIMIT, 4000])
def test_totals_are_those_of_the_hits(spark, limit):
    texts, words = fixture(2)
    words = [(k - 500, w) for k, w in words]
    got = keywords.keyword_totals(spark.createDataFrame(texts, "id long, text string").repartition(3), spark.createDataFrame(words, "word_id long, word string"), limit=limit)
    want = [(i, len(found), sum(n for _, n in found), min((k for k, _ in found), default=None), sum(k * n for k, n in found)) for i, found in brute(texts, words)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_totals_of_no_words_and_of_large_ids(spark):
    texts = spark.createDataFrame([(1, "ab"), (2, None)], "id long, text string")
    said = lambda *words: sorted(tuple(r) for r in keywords.keyword_totals(texts, spark.createDataFrame(list(words), "word_id long, word string")).collect())
    assert said() == [(1, 0, 0, None, 0), (2, 0, 0, None, 0)]
    assert said((2**62, "a"), (-(2**62), "b"), (2**62, "ab")) == [(1, 3, 3, -(2**62), 2**62), (2, 0, 0, None, 0)]
    with pytest.raises(Exception, match="(?i)overflow|too (big|large)|out of bounds|convert"):
        said((2**62, "a"), (2**62, "b"))


def test_memory_does_not_follow_a_long_text():
    import tracemalloc

    import numpy as np

    data = np.frombuffer(b"the quick brown fox jumps over " * 500_000, np.uint8)
    index = keywords.KeywordIndex([b"jumps overt", b"zebra1"], [1, 2])
    tracemalloc.start()
    assert not len(index.counts(data, np.array([0, len(data)]))[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
