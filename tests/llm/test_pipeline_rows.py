"""The stages over rows that repeat, share an id with other text, or have no id."""

import random
from collections import Counter

import corpus_pipeline
from factloom.llm import mixing

from .helpers import DOCS


def say(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 8))) for _ in range(n))


def test_rows_that_share_an_id(spark, tmp_path):
    rng = random.Random(21)
    passage, bad = say(rng, 30), ["vile slur hate scum", "rotten filth curse insult"]
    texts = [say(rng, 40) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, texts[3]), (3, texts[3]), (4, say(rng, 50)), (None, texts[5]), (None, say(rng, 45)), (None, say(rng, 46)), (90, ""), (90, ""), (91, "")]
    df = spark.createDataFrame([(i, t, "en", "s%d" % (k % 3), len(t)) for k, (i, t) in enumerate(rows)], DOCS)
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, df, None).collect())
    want = Counter(set(rows) - {(None, texts[5])})
    assert got == want

    ends = [say(rng, 20) for _ in range(4)]
    rows = [(0, passage + " " + ends[0]), (1, ends[1] + " " + passage), (1, ends[1] + " " + passage), (None, passage + " " + ends[2]), (None, ends[3])]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    out = corpus_pipeline.cut_repeats(spark, df, None).collect()
    whole = " ".join(r["text"] for r in out)
    assert len(out) == 4  # the repeated row loses all its bytes
    assert all(whole.count(part) == 1 for part in (passage[1:-1], *[e[1:-1] for e in ends]))

    rows = [(7, say(rng, 50)), *[(8, say(rng, 60))] * 3, (8, say(rng, 70)), (None, say(rng, 80)), (None, say(rng, 30))]
    df = spark.createDataFrame([(i, t, "en", "s%d" % (k % 2), len(t)) for k, (i, t) in enumerate(rows)], DOCS)
    sizes = Counter()
    for k, (i, t) in enumerate(rows):
        sizes["s%d" % (k % 2)] += len(t.split())
    mixed = mixing.mixed_documents(df).collect()
    per = {r["source"]: r["target"] for r in mixing.source_targets(df.selectExpr("source", "size(split(text, ' ')) AS size")).collect()}
    for s, want in per.items():
        taken = [len(r["text"].split()) for r in mixed if r["source"] == s]
        assert sum(taken) < want + max(taken) and sum(taken) <= 3 * sizes[s]

    rows = [(i, say(rng, 12) + (" " + rng.choice(bad) if i % 2 else " mild calm kind gentle")) for i in range(300)]
    rows += [(None, say(rng, 12) + " " + bad[0]), (None, say(rng, 12) + " mild calm kind gentle"), rows[1], rows[2], rows[2]]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    spark.createDataFrame([(i, 1, i % 2) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_toxic(spark, df, str(tmp_path)).collect())
    assert got == Counter(r for r in rows if "mild" in r[1])
