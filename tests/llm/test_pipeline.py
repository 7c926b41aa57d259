"""The pipeline's stages on the smallest tables: columns, what goes, and the last stage's packing."""

import __spark_entry__

import corpus_pipeline


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    from factloom.llm import common, minhash, mixing, packing, suffixes, toxicity

    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = common.stored(stage(spark, before, sf), f"test-{name}")
        now = docs.collect()
        ids = {r["doc_id"] for r in now}
        if k < 4:
            assert docs.columns == columns
        if name == "toxicity":
            bad = {r["doc_id"] for r in toxicity.score_documents(before, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
            assert ids == set(kept) - bad and all(kept[r["doc_id"]] == r["text"] for r in now)
        elif name == "minhash_near_dedup":
            assert ids == {r["doc_id"] for r in minhash.near_duplicates(before).where("kept").collect()}
        elif name == "suffix_array_dedup":
            left = {r["doc_id"]: r["kept"] for r in suffixes.remove_repeats(before, with_text=True).collect()}
            for r in now:
                assert r["text"] == bytes(left[r["doc_id"]]).decode("utf-8", "ignore") and (r["n_chars"] == len(r["text"]) or bytes(left[r["doc_id"]]).decode("utf-8", "ignore") == kept[r["doc_id"]])
            assert {i for i in left if i not in ids} == {i for i, t in left.items() if not t and kept[i]}
        elif name == "mixing":
            times = {r["doc_id"]: r["passes"] for r in mixing.plan_mix(before, ["doc_id"]).collect()}
            assert len(now) == sum(times.values()) and ids == {i for i, n in times.items() if n}
        else:
            assert docs.columns == packing.pack(before).columns and {r["doc_id"] for r in before.collect()} == ids
    assert set(__spark_entry__.queries()) >= {"pipeline"} | {f for f in __spark_entry__.queries() if f.startswith("op")}
