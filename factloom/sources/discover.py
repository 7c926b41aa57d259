"""List and detail pages of a source as entities, sources, seeds and evidence: the projection that all sources share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import config, enrich, workset
from . import parsers

#: Sources whose list pages are turned over; the others are read from an offset within one page.
PAGED = ["agencyhub", "boxil", "digitre", "grip", "houjingoo", "kyujinbox", "pitact", "salesnow", "stanby"]
FIELDS = {"address": "address", "employees": "employees", "profile": "profileText", "job": "jobText", "place": "jobLocation", "members": "wantedlyMembers", "founded": "founded", "official_url": "officialUrl"}


def key_of(name):
    return text.normalize_name(F.regexp_replace(text.trimmed(name), "\\s+", " "))


def records(lists: DataFrame, details: DataFrame | None, source: str, limit: int, offset: int = 0) -> DataFrame:
    """(url, pos, RECORD...): list records in order, ``limit`` of them from ``offset`` on, with what their detail pages add.

    Records of paged sources are counted over all pages by (page, pos); a record whose detail page must be read and is not there goes.
    """
    rows = parsers.listed(lists.withColumn("page", F.coalesce("page", F.lit(1))) if "page" in lists.columns else lists, source)
    rows = rows.join(lists.select("url", F.col("page") if "page" in lists.columns else F.lit(1).alias("page")), "url")
    if source in ("kyujinbox", "stanby"):  # a company that an earlier page showed is not new, and a page without a new one is the last
        rows = workset.fresh_prefix(rows.withColumn("_list", F.lit(source)), "_list", "page", "name", [F.col("url"), F.col("pos")]).drop("_list")
    if source in parsers.DETAILS and details is not None:
        more = parsers.detailed(details, source)
        more = more.select(F.col("url").alias("d_url"), *[F.col(c).alias(f"d_{c}") for c in parsers.RECORD])
        rows = rows.join(more, F.col("ref") == F.col("d_url"), "left" if source in ("hikakubiz",) else "inner")
        first = lambda c: F.coalesce(F.col(f"d_{c}"), F.col(c)) if c not in ("ref",) else F.col(c)
        if source == "boxil":  # the list names the company, the detail page its site
            first = lambda c: F.concat_ws(" ", c, f"d_{c}") if c == "profile" else F.coalesce(F.col(c), F.col(f"d_{c}"))
        if source == "webkanji":
            company = F.when(F.col("name").rlike("株式会社|有限会社|合同会社|Inc"), F.col("name"))
            first = lambda c: F.regexp_replace(F.coalesce(company, F.col("d_name"), F.col("name")), "の制作実績.*$", "") if c == "name" else F.coalesce(F.col(f"d_{c}"), F.col(c))
        if source == "hikakubiz":  # the page of another company in the same place is not used
            fits = F.contains(F.coalesce(F.col("d_note"), F.lit("")), F.regexp_replace("name", "\\s", ""))
            first = lambda c: F.when(fits, F.col("d_official_url")) if c == "official_url" else F.col(c)
        rows = rows.select("url", "page", "pos", *[first(c).alias(c) for c in parsers.RECORD])
    rows = rows.where("name IS NOT NULL AND name <> ''")
    if source in PAGED:
        return workset.paged_window(rows.withColumn("_list", F.lit(source)), "_list", "page", [F.col("url"), F.col("pos")], offset, limit).drop("_list")
    every = Window.partitionBy("url").orderBy("pos")
    return rows.withColumn("_at", F.row_number().over(every)).where(F.col("_at").between(offset + 1, offset + limit)).drop("_at")


def discovered(found: DataFrame, source: str, category: str, label: str = "") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entities, seeds, evidence) of records: entities (key, name, first_seq), seeds (key, category), evidence (entity_key, seq, ...)."""
    order = Window.partitionBy("url").orderBy("pos")
    rows = found.withColumn("entity_key", key_of(F.col("name"))).withColumn("at", F.row_number().over(order)).withColumn("from_url", F.coalesce("ref", "url")).where("entity_key <> ''")
    entities = rows.groupBy(F.col("entity_key").alias("key")).agg(F.min_by("name", F.struct("url", "at")).alias("name"), F.min("at").alias("first_seq"))
    seeds = rows.select(F.col("entity_key").alias("key"), F.lit(category).alias("category")).distinct()
    name = config.SOURCE_LABELS.get(source, source)
    values = {"address": geo.strip_postal(F.col("address")) if source == "aspic" else F.col("address"), "profile": text.clip(F.concat_ws(" ", F.lit(label), "profile"), 400)}
    cells = F.array(*[F.struct(F.lit(i).alias("o"), F.lit(f).alias("field"), values.get(c, F.col(c)).cast("string").alias("value")) for i, (c, f) in enumerate(FIELDS.items())])
    flat = rows.select("entity_key", "at", "from_url", "note", F.explode(cells).alias("e")).select("entity_key", (F.col("at") * 10 + F.col("e.o")).cast("long").alias("seq"), "e.field", "e.value", F.lit(source).alias("source"), F.col("from_url").alias("url"), "note")
    flat = flat.where("value IS NOT NULL AND value <> ''")
    plain = flat.where("field <> 'officialUrl'")
    sites = enrich.accepted_official(flat.where("field = 'officialUrl'").withColumn("_site", F.col("value")).drop("value"), "_site").drop("_site")
    snippet = F.concat(F.lit(f"{name} "), "field", F.lit(": "), F.coalesce(F.when(F.col("field") == "employees", F.col("note")), F.col("value")))
    both = plain.unionByName(sites.select(plain.columns)).withColumn("snippet", snippet)
    return entities, seeds, both.select(enrich.EVIDENCE)
