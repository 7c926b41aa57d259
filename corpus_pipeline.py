"""A corpus pipeline: each stage calls one operator of ``factloom.llm``.

Every stage but the last returns the columns of ``documents``; a stage works on
all rows its predecessor kept, and what it decides takes effect.

Defined cases: a null or empty text is a document without words, is never toxic on
its own account, has no near copies but rows equal to it, loses nothing, takes part
in no mix and packs as its end token where it comes that far; rows that share a
doc_id, or have none, are documents of their own in every stage (equal ones are
near copies of each other); a null source is a source; of equal ranks the smaller
id goes first, then the key that the row was given; texts are read whole at any
length; an empty table gives empty stages; columns beyond those of ``documents``
are carried along under any name, and none of them is read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from factloom.llm import common, minhash, mixing, packing, suffixes, toxicity


def packed(docs, *read):
    """The columns that a stage reads, and the whole row beside them, so that no name of the row meets a name of the stage."""
    return docs.select("doc_id", "text", *read, F.struct(*[docs[c] for c in docs.columns]).alias("whole_row"))


def drop_toxic(spark, docs, sf_dir):
    """Documents that the nearest labelled examples call toxic go; all others stay as they are.

    The vote depends on the text alone, so it goes back to the rows by the text's fingerprints.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = ("row_print", "row_second")
    rows = packed(docs).select("*", *common.prints())
    scored = toxicity.score_documents(rows.select("doc_id", "text", *names), labels, carry=names)
    toxic = common.stored(scored.where("predicted = 1").select(*names).distinct(), "pipeline-toxic")
    return rows.join(toxic, list(names), "left_anti").select("whole_row.*")


def drop_near_copies(spark, docs, sf_dir):
    """One row of each group of near copies stays, the one with the smallest id (rows without an id come last).

    Rows that repeat are near copies of each other, those without words too if their ids and texts are equal.
    """
    rows = common.keyed(packed(docs), "pipeline-near")
    groups = minhash.near_duplicates(rows, key=common.ROW_KEY).select(F.col(common.ROW_KEY).alias("n_key"), "n_shingles", "component_id")
    light = rows.select(F.col(common.ROW_KEY).alias("g_key"), F.col("doc_id").cast("long").alias("g_id"), *common.prints())
    met = light.join(groups, F.col("g_key") == F.col("n_key"))
    wordless = F.col("n_shingles") == 0  # no links: a row repeats if its id and its text do
    group = [F.when(~wordless, F.col("component_id")).alias("g"), *[F.when(wordless, F.col(c)).alias(c) for c in ("g_id", "row_print", "row_second")]]
    place = F.struct(F.col("g_id").isNull(), F.col("g_id"), F.col("g_key"))
    first = met.select(wordless.alias("w"), *group, place.alias("place")).groupBy("w", "g", "g_id", "row_print", "row_second").agg(F.min("place").alias("place"))
    kept = common.stored(first.select(F.col("place.g_key").alias("n_key")), "pipeline-kept")
    return rows.join(kept, F.col(common.ROW_KEY) == F.col("n_key"), "left_semi").select("whole_row.*")


def cut_repeats(spark, docs, sf_dir):
    """Bytes of passages that an earlier document has go; a document that loses all of its bytes goes.

    A character that is cut in two loses the rest of its bytes as well; n_chars follows the text.
    Rows that share an id, or have none, come after all others.
    """
    rows = common.keyed(packed(docs), "pipeline-repeats")
    cut = suffixes.remove_repeats(rows, key=common.ROW_KEY, with_text=True).where("n_removed > 0")
    kept = F.try_validate_utf8(F.col("kept").cast("string"))
    mended = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\\x{FFFD}", "")
    cut = cut.select(F.col("doc_id").alias("c_id"), F.coalesce(kept, mended).alias("c_text"))
    cut = common.stored(cut, "pipeline-cut")
    met = rows.join(cut, F.col(common.ROW_KEY) == F.col("c_id"), "left").where("c_id IS NULL OR length(c_text) > 0")
    text = F.when(F.col("c_id").isNull(), F.col("text")).otherwise(F.col("c_text"))
    size = F.when(F.col("c_id").isNull(), F.col("whole_row.n_chars")).otherwise(F.length("c_text").cast(docs.schema["n_chars"].dataType))
    return met.select(F.col("whole_row").withField("text", text).withField("n_chars", size).alias("whole_row")).select("whole_row.*")


def mix_sources(spark, docs, sf_dir):
    """Documents in training order, as often as their source's target takes them."""
    return mixing.mixed_documents(packed(docs, "source"), columns=["whole_row"]).select("whole_row.*")


def pack_sequences(spark, docs, sf_dir):
    """Pieces of the mixed documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Toxicity, components and tokens can't be expressed in SQL; tests/llm/test_pipeline.py uses brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.stored(docs, f"pipeline-{name}")
    return docs
