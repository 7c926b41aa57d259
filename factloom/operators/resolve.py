"""Entity resolution by normalised name, web domain and location."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, text
from .fusion import first_of


def upsert(rows: DataFrame, key: Column, name: str, seq: str) -> DataFrame:
    """One entity per key; the first spelling stays."""
    return rows.withColumn("key", key).groupBy("key").agg(F.min_by(name, seq).alias("name"), F.min(seq).alias("first_seq"), F.count("*").alias("sightings"))


def canonical_by_domain(entities: DataFrame, domain: str, key: str, seq: str) -> DataFrame:
    """Entities with the key that survives: the first holder of a domain; no domain keeps its own."""
    firsts = entities.where(F.col(domain).isNotNull()).groupBy(F.col(domain).alias("_d")).agg(F.min_by(key, seq).alias("_canonical"))
    met = entities.join(firsts, F.col(domain) == F.col("_d"), "left").drop("_d")
    return met.withColumn("canonical", F.coalesce("_canonical", key)).drop("_canonical")


def unique_match(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, residual: Column | None = None) -> DataFrame:
    """Matches of left rows that have exactly one partner."""
    met = left.join(right, keys)
    if residual is not None:
        met = met.where(residual)
    return met.withColumn("_n", F.count("*").over(Window.partitionBy(left_id))).where("_n = 1").drop("_n")


def ranked_match(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, order: list[Column], residual: Column | None = None) -> DataFrame:
    """The best partner of every left row, and how many it had.

    Without a residual the order is one of right rows alone: the best of each key is found before the join, which then meets one row a key.
    """
    if residual is None:
        times = right.groupBy(*keys).agg(F.count("*").alias("same_name"))
        return left.join(first_of(right, keys, order).join(times, keys), keys)
    met = left.join(right, keys).where(residual)
    return first_of(met.withColumn("same_name", F.count("*").over(Window.partitionBy(left_id))), [left_id], order)


def latest(rows: DataFrame, key: str, newest: list[Column], seq: str) -> DataFrame:
    """The newest row of each key; ties to the first."""
    return first_of(rows, [key], [*[c.desc_nulls_last() for c in newest], F.col(seq)])


def two_step_match(rows: DataFrame, entities: DataFrame, raw: str, normal: Column, key: str = "key") -> DataFrame:
    """Rows by their raw id, else by their normalised id."""
    names = entities.select(F.col(key).alias("_k"))
    raws = rows.join(names, F.col(raw) == F.col("_k"), "left").withColumnRenamed("_k", "_raw").withColumn("_normal", normal)
    return raws.join(names, F.col("_normal") == F.col("_k"), "left").withColumn("matched", F.coalesce("_raw", "_k")).drop("_raw", "_normal", "_k")


# ------------------------------------------------ picking a row of a registry by name
#
# A name may have many entities and many rows, so the two are not paired.  Rows are cut down to the few
# that can be picked by name and place first; entities meet those.


class SameName(NamedTuple):
    """Entities (entity_key, _key) and registry rows (_key, ...) by the name that they have once both are normalised."""

    entities: DataFrame
    rows: DataFrame


def _known(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with ``known``: the addresses that an entity has from other sources (entity_key, addresses)."""
    return rows.join(known, "entity_key", "left").withColumn("known", F.coalesce("addresses", F.array().cast("array<string>"))).drop("addresses")


def _regions(known: Column) -> Column:
    """The prefectures of known addresses."""
    return F.array_distinct(F.filter(F.transform(known, geo.prefecture), lambda p: p.isNotNull()))


def _places(known: Column) -> Column:
    """The prefectures and cities of known addresses, each once; a bare ward's is Tokyo in ``area``."""
    def place(k):
        return F.struct(geo.prefecture(k).alias("pref"), geo.city(k).alias("city"), geo.area(k).alias("area"))

    return F.array_distinct(F.transform(known, place))


def by_name(entities: DataFrame, rows: DataFrame) -> SameName:
    """Registry rows (name, ...) that have an entity's name once both are normalised; what stands in brackets is not part of a name."""
    key = lambda c: text.normalize_name(F.regexp_replace(c, "[（(].*[）)]", ""))
    left = entities.select("entity_key", key(F.col("name")).alias("_key")).where("_key <> ''")
    return SameName(left, rows.withColumn("_key", text.normalize_name(F.col("name"))))


def _marked(rows: DataFrame, marks: Column, order: list[Column]) -> DataFrame:
    """(_key, _mark, _row): the first row of every name and each of its marks."""
    columns = [c for c in rows.columns if c != "_key"]
    dealt = rows.select("_key", F.explode(marks).alias("_mark"), F.struct(*columns).alias("_row"), F.struct(*order).alias("_order"))
    return dealt.groupBy("_key", "_mark").agg(F.min_by("_row", "_order").alias("_row"))


def _by_marks(entities: DataFrame, wanted: Column, marked: DataFrame) -> DataFrame:
    """Entities (entity_key, _key, ...) with the row of each mark that they want, and the mark."""
    asked = entities.withColumn("_mark", F.explode(wanted))
    return asked.join(marked, ["_key", "_mark"]).select(*[c for c in entities.columns if c != "_key"], "_mark", "_row.*")


def first_exact(entities: DataFrame, results: DataFrame) -> DataFrame:
    """(entity_key, url): of an entity's search results (entity_key, pos, title, url) the first whose title's first line is its name.

    entities: entity_key, name.  A result without an address is none; an entity without a match has no row.
    """
    key = lambda c: text.normalize_name(c)
    asked = entities.select(F.col("entity_key").alias("_e"), key(F.col("name")).alias("_key"))
    titled = results.where("url IS NOT NULL AND url <> ''").withColumn("_title", key(F.substring_index("title", "\n", 1)))
    met = titled.join(asked, (F.col("entity_key") == F.col("_e")) & (F.col("_title") == F.col("_key")))
    return met.groupBy("entity_key").agg(F.min_by("url", "pos").alias("url"))


def _first(rows: DataFrame, order: list[Column]) -> DataFrame:
    return first_of(rows, ["entity_key"], order)


def pick_registry(matched: SameName, known: DataFrame, seq: str = "seq") -> DataFrame:
    """gbizinfo: closed companies left out; with known addresses only rows of their prefecture and city, else those in Tokyo if several; a row with a headcount first."""
    address, columns = F.col("address"), [c for c in matched.rows.columns if c != "_key"]
    pref = geo.prefecture(address)
    open_ = matched.rows.where(~F.col("name").contains("閉鎖")).withColumn("_pref", pref).withColumn("_city", F.when(pref.isNotNull(), geo.city(address)))
    per = open_.groupBy("_key", "_pref", "_city").agg(F.count("*").alias("_n"), F.min_by(F.struct(*columns), F.struct(F.col("employees").isNull(), F.col(seq))).alias("_row"))
    ents = _known(matched.entities, known).withColumn("_places", _places(F.col("known")))
    count = Window.partitionBy("entity_key")
    near = F.exists("_places", lambda k: (k["pref"] == F.col("_pref")) & F.coalesce(geo.prefix_of_other(k["city"], F.col("_city")), F.lit(True)))
    rows = ents.join(per, "_key").withColumn("same_name", F.sum("_n").over(count)).withColumn("_tokyo", F.coalesce(F.col("_pref") == "東京都", F.lit(False))).withColumn("_any", F.max("_tokyo").over(count))
    fits = F.when(F.size("known") > 0, F.coalesce(near, F.lit(False))).otherwise(F.col("_tokyo") | (F.col("same_name") == 1) | ~F.col("_any"))
    return _first(rows.where(fits).select("entity_key", "_row.*", "same_name"), [F.col("employees").isNull(), F.col(seq)])


def pick_filer(matched: SameName, known: DataFrame) -> DataFrame:
    """edinet: companies only, names of two letters or more; the one row whose place agrees with a known address, or the only row where none is known."""
    address, columns = F.col("address"), [c for c in matched.rows.columns if c != "_key"]
    city = geo.city(address)
    firms = matched.rows.where((F.col("kind") == "内国法人・組合") & (F.length(text.normalize_name(F.col("name"))) >= 2))
    per = firms.withColumn("_city", city).withColumn("_area", F.when(city.isNotNull(), geo.area(address))).groupBy("_key", "_city", "_area").agg(F.count("*").alias("_n"), F.first(F.struct(*columns)).alias("_row"))
    ents = _known(matched.entities, known).withColumn("_places", _places(F.col("known")))
    w = Window.partitionBy("entity_key")
    near = F.exists("_places", lambda k: geo.same_place(k["city"], k["area"], F.col("_city"), F.col("_area")))
    rows = ents.join(per, "_key").withColumn("same_name", F.sum("_n").over(w)).withColumn("by_address", F.size("known") > 0)
    kept = rows.where(F.when(F.col("by_address"), near).otherwise(F.col("same_name") == 1)).withColumn("_one", F.sum("_n").over(w)).where("_one = 1")
    kept = kept.withColumn("same_name", F.when(F.col("by_address"), F.col("same_name")).otherwise(1)).select("entity_key", "_row.*", "same_name", "by_address", "known")
    return kept.withColumn("address", geo.with_prefecture(address, F.col("known"))).drop("known")


def heading_keys(title: Column) -> Column:
    """mynavi: the names that a listing's title holds: outside 【…】, and each part inside, without [...]."""
    bare = F.regexp_replace(text.nfkc(title), "\\[[^\\]]*\\]", "")
    inner = F.flatten(F.transform(F.regexp_extract_all(bare, F.lit("【([^】]*)】"), F.lit(1)), lambda x: F.split(x, "[／/]")))
    return F.array_distinct(F.filter(F.transform(F.concat(F.array(F.regexp_replace(bare, "【[^】]*】", "")), inner), text.normalize_name), lambda x: x != ""))


def pick_listing(entities: DataFrame, rows: DataFrame, known: DataFrame, seq: str = "pos") -> DataFrame:
    """mynavi: the first linked row (name: its title, place, ref) with the entity's name, in a known prefecture where both state one."""
    key = text.normalize_name(F.regexp_replace("name", "[（(].*[）)]", ""))
    ents = _known(entities.select("entity_key", key.alias("_key")), known).withColumn("_regions", _regions(F.col("known"))).drop("known")
    dealt = rows.where("ref IS NOT NULL").withColumn("_key", F.explode(heading_keys(F.col("name"))))
    # marks of a row: all, no place stated, each prefecture that its place holds
    marks = F.concat(F.array(F.lit("*")), F.when(F.col("place").isNull(), F.array(F.lit(""))).otherwise(geo.prefectures_in(F.col("place"))))
    wanted = F.when(F.size("_regions") == 0, F.array(F.lit("*"))).otherwise(F.concat(F.array(F.lit("")), F.col("_regions")))
    met = _by_marks(ents, wanted, _marked(dealt, marks, [F.col(seq)]))
    return _first(met, [F.col(seq)]).drop("_regions", "_mark")


def pick_by_prefecture(matched: SameName, known: DataFrame, place: str, seq: str = "pos", most: int | None = None) -> DataFrame:
    """careertasu, openwork (the first three rows): with known addresses the first row of their prefectures, else the first in Tokyo, else the first."""
    ents = _known(matched.entities, known).withColumn("_regions", _regions(F.col("known"))).drop("known")
    region, unknown = geo.prefecture(F.col(place)), F.size("_regions") == 0
    if most is None:
        marks = F.array_compact(F.array(F.lit("*"), region))
        rows = _by_marks(ents, F.when(unknown, F.array(F.lit("*"), F.lit("東京都"))).otherwise(F.col("_regions")), _marked(matched.rows, marks, [F.col(seq)])).drop("_mark")
    else:
        firsts = lambda of, by: of.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(seq))).where(F.col("_k") <= most).drop("_k")
        rows = firsts(ents.join(firsts(matched.rows, "_key"), "_key").drop("_key"), "entity_key").where(unknown | F.coalesce(F.array_contains("_regions", region), F.lit(False)))
    return _first(rows, [(F.coalesce(region == "東京都", F.lit(False)) & unknown).desc(), F.col(seq)]).drop("_regions")


def name_index(listed: DataFrame, order: list[str]) -> DataFrame:
    """salesnow: (key, name, ref) of list pages; of names that repeat the last page's row stays."""
    rows = listed.withColumn("key", text.normalize_name(F.col("name")))
    return first_of(rows, ["key"], [F.desc(c) for c in order]).select("key", "name", "ref")


def from_index(entities: DataFrame, index: DataFrame) -> DataFrame:
    """Entities whose key is in the index, with the page that it leads to."""
    return entities.join(index.select(F.col("key").alias("_k"), "ref"), F.col("entity_key") == F.col("_k")).drop("_k")


def merged_by_domain(entities: DataFrame, evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities (entity_key, name, seq, domain, sources, seeds) of one domain become the first of them; evidence, sources and seeds move to it, in order."""
    canon = canonical_by_domain(entities, "domain", "entity_key", "seq")
    to = canon.select(F.col("entity_key").alias("_from"), "canonical", F.col("seq").alias("_seq"))
    w = Window.partitionBy("canonical").orderBy("_seq", "seq")
    moved = evidence.join(to, F.col("entity_key") == F.col("_from")).withColumn("_at", F.row_number().over(w))
    moved = moved.withColumn("seq", F.col("_at").cast("long")).withColumn("entity_key", F.col("canonical")).select(evidence.columns)
    # of sources of one address the first stays: found address by address, not by looking through an entity's list again for each
    each = canon.select("canonical", F.struct("seq", "sources", "seeds", "name").alias("_o"), F.posexplode("sources").alias("_p", "_s"))
    once = each.groupBy("canonical", F.col("_s.url").alias("_url")).agg(F.min_by("_s", F.struct("_o", "_p")).alias("_s"), F.min(F.struct("_o", "_p")).alias("_o"))
    listed = once.where("_url IS NOT NULL").groupBy("canonical").agg(F.transform(F.sort_array(F.collect_list(F.struct("_o", "_s"))), lambda x: x["_s"]).alias("sources")).withColumnRenamed("canonical", "_c")
    parts = F.sort_array(F.collect_list(F.struct("seq", "sources", "seeds", "name")))
    per = canon.groupBy("canonical").agg(parts.alias("p"), F.min("domain").alias("domain")).join(listed, F.col("canonical") == F.col("_c"), "left")
    kept = F.coalesce("sources", F.array().cast(canon.schema["sources"].dataType))
    return per.select(F.col("canonical").alias("entity_key"), F.col("p")[0]["name"].alias("name"), F.col("p")[0]["seq"].alias("seq"), "domain", kept.alias("sources"), F.flatten(F.transform("p", lambda x: x["seeds"])).alias("seeds")), moved
