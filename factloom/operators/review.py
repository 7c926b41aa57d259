"""Human review: rows of decisions and corrections, merged as evidence that goes first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from . import checks, config, consolidate, verify
from .fusion import first_of, replace_source


def decisions(rows: DataFrame, key: str, seq: str, fields: list[str]) -> DataFrame:
    """(key, field, decision, correction): the latest row that says something; a number in a decision is a correction."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in fields]))
    said = rows.select(key, seq, pairs.alias("p")).select(key, seq, "p.field", "p.raw").where("trim(raw) <> ''")
    read = said.select(key, seq, "field", text.decision(F.col("raw")).alias("decision"), F.when(F.col("raw").rlike("^[0-9,]+$"), text.comma_int(F.col("raw"))).alias("correction"))
    return first_of(read.where("decision IS NOT NULL OR correction IS NOT NULL"), [key, "field"], [F.col(seq).desc()]).drop(seq)


def counts(rows: DataFrame, entities: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows applied, unknown and skipped; an empty row is skipped before its id is looked up."""
    empty = F.concat_ws("", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]) == ""
    met = rows.withColumn("_empty", empty).join(entities.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left")
    return met.agg(
        F.count_if(~F.col("_empty") & F.col("_k").isNotNull()).alias("applied"), F.count_if(~F.col("_empty") & F.col("_k").isNull()).alias("unknown"), F.count_if("_empty").alias("skipped")
    )


# The columns of the review sheet.
COLUMNS = {
    "id": "企業ID", "category": "カテゴリキー", "industry": "業種の判断", "employees": "従業員数の判断", "contact": "問い合わせURLの判断", "identity": "企業特定の判断",
    "employees_value": "従業員数(修正)", "contact_value": "問い合わせURL(修正)", "official_value": "公式URL(修正)", "note": "メモ",
}


def imported(sheet: DataFrame, entities: DataFrame, evidence: DataFrame, today: str, seq: str = "seq") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reviews, evidence, counts) of a review sheet (columns as in ``COLUMNS``, and ``seq``).

    reviews: entity_key and struct ``review`` (industry by category, employees, contact, identity, at, note); a later row goes before an earlier one.
    Corrections replace the evidence of source ``human`` of their field.  Rows without decision or correction are skipped before their id is looked up.
    """
    bare = lambda c: F.regexp_replace(text.nfkc(F.coalesce(F.col(c), F.lit(""))), "[,\\s名人]", "")
    marks = {c: text.decision(F.coalesce(F.col(c), F.lit(""))) for c in ("industry", "employees", "contact", "identity")}
    count = F.coalesce(F.nullif(bare("employees_value"), F.lit("")), F.when(bare("employees").rlike("^[0-9]+$"), bare("employees"))).try_cast("bigint")
    rows = sheet.select(
        seq, "id", "category", *[m.alias(f"m_{c}") for c, m in marks.items()], count.alias("v_employees"), urls.complete(F.nullif(text.trimmed(F.coalesce("contact_value", F.lit(""))), F.lit(""))).alias("v_contact"),
        urls.complete(F.nullif(text.trimmed(F.coalesce("official_value", F.lit(""))), F.lit(""))).alias("v_official"), F.nullif(F.coalesce("note", F.lit("")), F.lit("")).alias("note"),
    )
    said = F.coalesce(*[F.col(f"m_{c}") for c in marks], F.col("v_employees").cast("string"), F.col("v_contact"), F.col("v_official")).isNotNull()
    names = entities.select(F.col("entity_key").alias("_k"))
    met = rows.withColumn("said", said).join(names, F.col("id") == F.col("_k"), "left").withColumnRenamed("_k", "_own").withColumn("_norm", text.normalize_name(F.coalesce("id", F.lit(""))))
    met = met.join(names, F.col("_norm") == F.col("_k"), "left").withColumn("entity_key", F.coalesce("_own", "_k"))
    counted = met.agg(F.count_if(F.col("said") & F.col("entity_key").isNotNull()).alias("applied"), F.count_if(F.col("said") & F.col("entity_key").isNull()).alias("unknown"), F.count_if(~F.col("said")).alias("skipped"))
    live = met.where("said AND entity_key IS NOT NULL")
    last = lambda c, when=None: F.max_by(c, F.when(F.col(c).isNotNull() if when is None else when, F.col(seq)))
    by_key = live.where("m_industry IS NOT NULL AND coalesce(category, '') <> ''").groupBy("entity_key", "category").agg(last("m_industry").alias("mark")).groupBy("entity_key").agg(F.map_from_entries(F.collect_list(F.struct("category", "mark"))).alias("industry"))
    per = live.groupBy("entity_key").agg(*[last(f"m_{c}").alias(c) for c in ("employees", "contact", "identity")], last("note").alias("note"), *[last(c).alias(c) for c in ("v_employees", "v_contact", "v_official")], F.max(seq).alias("last_seq"))
    per = per.join(by_key, "entity_key", "left")
    review = F.struct(F.coalesce("industry", F.create_map().cast("map<string,string>")).alias("industry"), "employees", "contact", "identity", F.lit(today).alias("at"), "note")
    reviews = per.select("entity_key", review.alias("review"))
    cells = F.array(F.struct(F.lit("employees").alias("field"), F.col("v_employees").cast("string").alias("value")), F.struct(F.lit("contactUrl").alias("field"), F.col("v_contact").alias("value")),
                    F.struct(F.lit("officialUrl").alias("field"), F.concat(urls.origin(F.col("v_official")), F.lit("/")).alias("value")))
    snippet = F.concat(F.lit(f"人が確認({today})"), F.coalesce(F.concat(F.lit(": "), "note"), F.lit("")))
    fresh = per.select("entity_key", "last_seq", "note", F.explode(cells).alias("c")).where("c.value IS NOT NULL")
    fresh = fresh.select("entity_key", (F.lit(1 << 40) + F.col("last_seq")).cast("long").alias("seq"), "c.field", "c.value", F.lit("human").alias("source"), F.lit("").alias("url"), snippet.alias("snippet"))
    return reviews, replace_source(evidence, fresh.select(evidence.columns), ["entity_key", "field", "source"]), counted


def queue(records: DataFrame, key: str, target: int, most: int = 2) -> DataFrame:
    """What a human looks at next of one category, least effort first: empty where the category has reached its target.

    records: consolidated records with ``checks`` and ``review``.  Verified ones with one or two open results and no NG (effort: their number), and
    records to check that lack one item (effort 1.5).  ``points`` says what is open and ``reason`` why.
    """
    label = config.LABELS[key]
    have = consolidate.passing(records, key).agg((F.count("*") < target).alias("short"))
    rows = records.where(F.array_contains("seeds", key) & (F.col("status") != config.STATUS["excluded"]) & F.array_contains("categories", label) & consolidate.within_size(key))
    rows = rows.crossJoin(F.broadcast(have)).where("short").drop("short")  # one row
    rows = rows.withColumn("flat", F.when(F.col("status") == config.STATUS["OK"], checks.flat(F.col("checks"), key, F.col("review"))))
    open_ = F.array_compact(F.array(*[F.when(~F.coalesce(verify.passes(F.col("flat")[c]["result"]), F.lit(False)), F.struct(F.lit(n).alias("point"), F.col("flat")[c]["comment"].alias("comment"), F.col("flat")[c]["result"].alias("result"))) for c, n in checks.CHECKS.items()]))
    rows = rows.withColumn("open", F.when(F.col("flat").isNotNull(), open_))
    verified = F.col("flat").isNotNull() & F.size("open").between(1, most) & ~F.exists("open", lambda o: F.coalesce(o["result"] == "NG", F.lit(False)))
    lacking = F.col("flat").isNull() & (F.col("status") == config.STATUS["check"]) & (F.size("missing") == 1)
    points = F.when(verified, F.array_join(F.transform("open", lambda o: o["point"]), " / ")).otherwise(F.col("missing")[0])
    reason = F.when(verified, F.array_join(F.transform("open", lambda o: F.concat(o["point"], F.lit(": "), F.coalesce(o["comment"], F.lit("")))), " ／ ")).otherwise(F.concat(F.lit("不足項目: "), F.col("missing")[0]))
    kept = rows.where(verified | lacking).select(
        "*", F.lit(key).alias("category_key"), F.lit(label).alias("category"), F.when(verified, "検証済み").otherwise("未検証").alias("kind"), F.when(verified, F.size("open").cast("double")).otherwise(1.5).alias("effort"), points.alias("points"), reason.alias("reason"))
    return kept.drop("flat", "open")


def ordered(queue_rows: DataFrame) -> DataFrame:
    """Least effort first, then category and name in Japanese order."""
    return queue_rows.orderBy("effort", F.collate("category", "ja"), F.collate("name", "ja"), "entity_key")
