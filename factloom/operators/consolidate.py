"""One record per entity out of its evidence: fusion, tri-state flags, missing items, status, remarks.

evidence: entity_key, seq, field, value, source, url, snippet (value as text).
The consolidation is computed once for all entities: one aggregate per entity
and field for the picks, then one join per field on the entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import figures, geo, text, urls
from . import checks, config, extract, fusion


_EVIDENCE = "array<struct<seq:bigint,field:string,value:string,source:string,url:string,snippet:string>>"


def consolidate(entities: DataFrame, evidence: DataFrame, categories: dict = config.CATEGORIES, least: int = config.LEAST_EMPLOYEES, this_year: int | None = None) -> DataFrame:
    """One record per entity (key, name, sources; seeds, an array of category keys, where there are any).

    Evidence is read once: its rows are ranked per field inside one array of the entity,
    and every pick is an expression over that array.
    """
    rows = entities.withColumnRenamed("key", "entity_key")
    if "seeds" not in rows.columns:
        rows = rows.withColumn("seeds", F.array().cast("array<string>"))
    rows = rows.join(checks.gathered(evidence), "entity_key", "left")
    rows = rows.withColumn("evidence", F.coalesce("evidence", F.array().cast(_EVIDENCE)))
    of = lambda field: F.filter("evidence", lambda e: (e["field"] == field) & (F.coalesce(e["value"], F.lit("")) != ""))

    def ranked(array, order):
        return F.array_sort(F.transform(array, lambda e: F.struct(fusion.rank_of(e["source"], order).alias("rank"), e["seq"].alias("seq"), e.alias("e"))))

    rows = rows.withColumn("_address", ranked(of("address"), config.PRIORITY["address"])).withColumn("_contact", ranked(of("contactUrl"), config.PRIORITY["contactUrl"]))
    best = lambda c: F.try_element_at(F.col(c), F.lit(1))["e"]
    rows = rows.withColumn("address", best("_address")["value"]).withColumn("address_source", best("_address")["source"]).withColumn("region", geo.prefecture(F.col("address")))
    # a source whose own address is in another prefecture may mean another company: its headcounts don't count
    rejected = F.array_distinct(F.transform(F.filter(of("address"), lambda e: F.coalesce((geo.prefecture(e["value"]) != F.col("region")) & (e["source"] != F.col("address_source")), F.lit(False))), lambda e: e["source"]))
    rows = rows.withColumn("rejected", rejected)
    tier = lambda s: F.when(s == "human", 0).when(s == "official", 1).otherwise(2)

    def placed(e):
        newest = F.when(tier(e["source"]) == 2, -figures.as_of_ordinal(F.coalesce(e["snippet"], F.lit("")))).otherwise(0)
        return F.struct(tier(e["source"]).alias("tier"), newest.alias("newest"), fusion.rank_of(e["source"], config.PRIORITY["employees"]).alias("rank"), e["seq"].alias("seq"), e.alias("e"))

    counted = F.filter(of("employees"), lambda e: e["value"].try_cast("bigint").isNotNull() & ~F.array_contains(F.col("rejected"), e["source"]))
    rows = rows.withColumn("_counts", F.array_sort(F.transform(counted, placed)))
    count = best("_counts")
    rows = rows.withColumn("employees", count["value"].try_cast("bigint")).withColumn("employees_source", count["source"]).withColumn("employees_url", count["url"]).withColumn("employees_snippet", count["snippet"])
    rows = rows.withColumn("_assessed", F.when(F.col("employees").isNotNull(), checks.assess_headcount(F.col("employees_source"), F.col("employees_snippet"), this_year)))
    rows = rows.withColumn("contact_url", best("_contact")["value"])
    rows = rows.withColumn("_official", ranked(of("officialUrl"), config.OFFICIAL_PRIORITY)).withColumn("official_url", best("_official")["value"])
    other = F.array_distinct(F.transform(F.filter("_official", lambda r: urls.domain(r["e"]["value"]) != urls.domain(F.col("official_url"))), lambda r: r["e"]["value"]))
    rows = rows.withColumn("other_urls", other).withColumn("profile", F.array_join(F.transform(of("profileText"), lambda e: e["value"]), " "))
    folded = F.lower(text.nfkc(F.concat_ws(" ", "name", "profile")))
    rows = rows.withColumn("folded", folded).withColumn("categories", extract.classify(F.col("folded"), categories)).withColumn("category_keywords", extract.keywords(F.col("folded"), categories))
    rows = rows.withColumn("tokyo", F.when(F.col("address").isNotNull(), geo.in_tokyo(F.col("address"))))
    near = F.coalesce(F.col("employees_source").isin(config.ESTIMATES) & F.col("employees").between(config.LOW_ESTIMATE, config.HIGH_ESTIMATE), F.lit(False))
    rows = rows.withColumn("emp20", fusion.threshold(F.col("employees"), F.col("employees_source"), least, config.ESTIMATES, config.LOW_ESTIMATE, config.HIGH_ESTIMATE))
    item = config.ITEMS
    rows = rows.withColumn("missing", fusion.missing({
        item["url"]: F.col("official_url").isNull(), item["address"]: F.col("tokyo").isNull(), item["estimate"]: F.col("emp20").isNull() & near,
        item["employees"]: F.col("emp20").isNull() & ~near, item["category"]: F.size("categories") == 0, item["contact"]: F.col("contact_url").isNull(),
    }))
    state = fusion.status([F.col("tokyo"), F.col("emp20")], F.col("missing"))
    named = F.when(state == "excluded", config.STATUS["excluded"]).when(state == "OK", config.STATUS["OK"]).otherwise(config.STATUS["check"])
    differ = F.filter("_counts", lambda r: r["e"]["value"].try_cast("bigint") != F.col("employees"))
    stated = F.concat(F.slice("_counts", 1, 1), differ)
    seeds = F.array_distinct(F.transform("seeds", lambda k: F.coalesce(F.create_map(*[F.lit(x) for pair in config.LABELS.items() for x in pair])[k], k)))
    group, single = F.try_element_at(of("employeesConsolidated"), F.lit(1)), F.try_element_at(F.filter(of("employees"), lambda e: e["source"] == "edinet"), F.lit(1))
    members = F.try_element_at(of("wantedlyMembers"), F.lit(1))["value"]
    say = lambda *parts: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts])
    notes = F.array_compact(F.concat(
        F.array(
            F.when(F.size(differ) > 0, say("従業員数が情報源間で不一致: ", F.array_join(F.transform(stated, lambda r: say(r["e"]["source"], "=", r["e"]["value"])), ", "))),
            F.when(F.exists("_address", lambda r: geo.in_tokyo(r["e"]["value"]) != F.col("tokyo")), "所在地(東京/他)が情報源間で不一致"),
            F.when((F.size("categories") == 0) & (F.size("seeds") > 0), say("カテゴリは検索元の推定のみ: ", F.array_join(seeds, "/"))),
            F.when(F.size("other_urls") > 0, say("公式URL候補が複数: ", F.array_join(F.concat(F.array("official_url"), F.col("other_urls")), " , "))),
            F.when(F.exists(of("employees"), lambda e: F.array_contains(F.col("rejected"), e["source"])), say("住所が一致しない情報源の従業員数は不採用(同名の別会社の可能性): ", F.array_join("rejected", ", "))),
        ),
        F.coalesce(F.transform(F.col("_assessed.remarks"), lambda r: say("従業員数: ", r)), F.array().cast("array<string>")),
        F.array(
            F.when(group.isNotNull(), say("有価証券報告書の連結従業員数は", group["value"], "名", F.coalesce(say("（提出会社単体は", single["value"], "名", F.when(F.col("employees_source") == "edinet", "。これを採用").otherwise(""), "）"), F.lit("")))),
            F.when(F.size(of("earlyStop")) > 0, "公式トップにどのカテゴリの語も無く、巡回を途中で見切った"),
            F.when(F.col("employees").isNull() & members.isNotNull(), say("Wantedlyメンバー数 ", members, "人(参考・従業員数とは別物)")),
        ),
    ))
    sources = F.transform(F.col("sources"), lambda s: s["source"])
    code = F.try_element_at(of("edinetCode"), F.lit(1))
    ground = lambda c: F.struct(best(c)["source"].alias("source"), best(c)["url"].alias("url"), best(c)["snippet"].alias("snippet"))
    return rows.select(
        "entity_key", "name", "official_url", F.array_intersect(sources, F.array(*[F.lit(s) for s in config.LISTING])).alias("listed_by"), F.array_distinct(sources).alias("source_names"), "seeds", "address", "tokyo",
        "employees", "employees_source", "employees_snippet", "emp20", F.col("_assessed.as_of").alias("employees_as_of"), code["value"].alias("edinet_code"),
        F.nullif(F.regexp_extract(F.coalesce(code["snippet"], F.lit("")), "証券コード([0-9]{4,5})", 1), F.lit("")).alias("securities_code"), "categories", "category_keywords", "contact_url",
        named.alias("status"), "missing", notes.alias("notes"), F.struct(ground("_address").alias("address"), ground("_counts").alias("employees"), ground("_contact").alias("contact")).alias("grounds"),
    )


def category_keys(labels: Column, seeds: Column) -> Column:
    """Keys of the categories that a record was searched for and classified as."""
    return F.array_compact(F.array(*[F.when(F.array_contains(labels, label) & F.array_contains(seeds, key), F.lit(key)) for key, label in config.LABELS.items()]))


def qualified(records: DataFrame, key: str) -> DataFrame:
    """Records of a category that are not excluded."""
    return records.where((F.col("status") != config.STATUS["excluded"]) & F.array_contains("categories", config.LABELS[key]))


def within_size(key: str) -> Column:
    most = config.MOST_EMPLOYEES.get(key)
    return F.lit(True) if most is None else F.coalesce(F.col("employees") <= most, F.lit(True))


def passing(records: DataFrame, key: str) -> DataFrame:
    """Records of a category that pass: found for it, classified as it, within its size, OK and with four OK checks (columns checks, review)."""
    rows = records.where((F.col("status") == config.STATUS["OK"]) & F.array_contains("seeds", key) & F.array_contains("categories", config.LABELS[key]) & within_size(key))
    return rows.where(checks.all_ok(checks.flat(F.col("checks"), key, F.col("review"))))


def passing_by_category(records: DataFrame) -> DataFrame:
    """Passing records per category."""
    return records.where(F.col("status") == config.STATUS["OK"]).select(F.explode("categories").alias("category")).groupBy("category").agg(F.count("*").alias("passing"))


def sample(records: DataFrame, k: int = 15) -> DataFrame:
    """The best k passing records of each category: most discovery sources, then name."""
    rows = records.where(F.col("status") == config.STATUS["OK"]).select("*", F.explode("categories").alias("category"), F.size("listed_by").alias("score"))
    return extract.top_links(rows.withColumn("score", F.col("score") + 1), "category", "entity_key", "score", "name", k)
