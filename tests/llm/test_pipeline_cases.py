"""The pipeline over empty tables, columns with clashing names, and packing of repeated and null ids."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from factloom.llm import packing
from pyspark.sql import functions as F

from .helpers import DOCS, empty

CLASHING = ["id", "row_key", "row_print", "row_second", "whole_row", "size", "n", "n_key", "g_key", "place", "c_id", "c_text", "kept", "component_id", "mix_key", "mix_position", "turn", "score", "predicted", "length", "salt", "rank", "run"]


def say(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n))


def fixture(spark):
    rng = random.Random(5)
    passage = say(rng, 25)
    rows = [(i, f"{say(rng, 30)} {passage if i % 6 == 0 else ''} {'vile slur hate scum' if i % 5 == 0 else 'mild calm kind gentle'}", "en", f"s{i % 3}", 7) for i in range(120)]
    rows += [(7, rows[7][1], "en", "s1", 7), (500, rows[8][1], "fr", None, 7), (501, None, None, "s1", 0), (502, "", "en", "s2", 0), (None, say(rng, 40) + " mild calm kind gentle", "en", "s0", 1), (503, say(rng, 9000) + " mild calm kind gentle", "en", "s0", 2)]
    return rows, [(i, 1, int(i % 5 == 0)) for i in range(120)]


def stages(spark, docs, sf):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        out.append((name, docs.columns, docs.collect()))
        docs = spark.createDataFrame(out[-1][2], docs.schema) if out[-1][2] else spark.createDataFrame([], docs.schema)
    return out


def test_clashing_names_change_nothing(spark, tmp_path):
    rows, labels = fixture(spark)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = spark.createDataFrame(rows, DOCS)
    wide = plain.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHING])
    for (name, columns, got), (_, more, wider) in zip(stages(spark, plain, str(tmp_path)), stages(spark, wide, str(tmp_path))):
        key = lambda r: (r["doc_id"], zlib.crc32((r["text"] or "-").encode())) if name != "best_fit_packing" else (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])  # noqa: E731,B023
        assert got and Counter(map(key, got)) == Counter(map(key, wider)), name
        if name != "best_fit_packing":
            assert columns == plain.columns and more == wide.columns
            assert all(r[c] == f"{c}{'-' if r['doc_id'] is None else r['doc_id']}" for r in wider for c in CLASHING)


def test_empty_tables(spark, tmp_path):
    rows, labels = fixture(spark)
    for k, found in enumerate((labels, [])):
        spark.createDataFrame(found, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        assert [len(got) for _, _, got in stages(spark, empty(spark), f"{tmp_path}/{k}")] == [0] * 5
    kept = stages(spark, spark.createDataFrame(rows[:20], DOCS), f"{tmp_path}/1")  # no labels: nothing is called toxic
    assert len(kept[0][2]) == 20 and kept[-1][2]


def test_packing_of_repeated_and_null_ids(spark):
    rng = random.Random(8)
    long = say(rng, 3000)
    rows = [(1, "a b c", "en", "s", 1)] * 3 + [(None, "a b c", "en", "s", 1)] * 2 + [(None, long, "en", "s", 1), (2, long, "en", "s", 1), (2, long, "en", "s", 1), (None, None, "en", "s", 0), (3, "", "en", "s", 0)]
    got = corpus_pipeline.pack_sequences(spark, spark.createDataFrame(rows, DOCS).repartition(3), None).collect()
    tok = packing.Tokenizer(packing.tokenizer_path())
    want = Counter()
    for i, t, *_ in rows:
        ids = np.r_[tok.ids(t or ""), 0].astype("<u4")
        for piece, start in enumerate(range(0, len(ids), packing.LENGTH)):
            part = ids[start : start + packing.LENGTH]
            want[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    spans = {}
    for r in got:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in spans.values():  # gapless and no longer than a sequence
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= packing.LENGTH
