"""Enrichment: what an official site adds to an entity, and which entities are enriched next.

Site crawling is a plan over stored snapshots: the top page of an entity's official
url, up to four pages about the company, then contact candidates in their order.
Pages that were not fetched are rows that a join does not find, as a failed visit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import figures, geo, text, urls
from . import checks, config, fusion, links, resolve, workset

EVIDENCE = ["entity_key", "seq", "field", "value", "source", "url", "snippet"]
PROFILE_PAGES = 4
CONTACTS = 3


def best_official(evidence: DataFrame) -> DataFrame:
    """(entity_key, official_url, official_source, other_urls): by the sources' order; the first url of each other domain."""
    rows = evidence.where("field = 'officialUrl' AND value IS NOT NULL").withColumn("_rank", fusion.rank_of(F.col("source"), config.OFFICIAL_PRIORITY)).withColumn("_d", urls.domain(F.col("value")))
    per = rows.groupBy("entity_key").agg(F.sort_array(F.collect_list(F.struct("_rank", "seq", "value", "source", "_d"))).alias("all"))
    others = F.filter("all", lambda e: e["_d"] != F.col("all")[0]["_d"])
    return per.select("entity_key", F.col("all")[0]["value"].alias("official_url"), F.col("all")[0]["source"].alias("official_source"), F.array_distinct(F.transform(others, lambda e: e["value"])).alias("other_urls"))


def accepted_official(rows: DataFrame, url: str = "url") -> DataFrame:
    """Rows whose url may be an official one, with its origin as ``value``: hosts of directories, media and networks are refused."""
    refused = "|".join(h.replace(".", "\\.") for h in config.REFUSED_HOSTS)
    host = urls.domain(F.col(url))
    return rows.where(host.isNotNull() & ~host.rlike(refused)).withColumn("value", F.concat(urls.origin(F.col(url)), F.lit("/")))


def needs_corporate_url(evidence_sources: Column) -> Column:
    """No source that names a company's own site has given an official url (array of the sources that gave one)."""
    return F.size(F.array_intersect(F.coalesce(evidence_sources, F.array().cast("array<string>")), F.array(*[F.lit(s) for s in config.CORPORATE_SOURCES]))) == 0


def _ok(pages: DataFrame) -> DataFrame:
    return pages.where("error IS NULL AND coalesce(status, 200) < 400").select("url", "title", "text", "final_url", "anchors").dropDuplicates(["url"])


def site_pages(sites: DataFrame, pages: DataFrame, stop: Column | None = None) -> DataFrame:
    """(entity_key, site, place, url, title, text, final_url, anchors): the top page and up to four profile pages of (entity_key, site).

    Place 0 is the top page.  Profile pages end once a firm headcount was seen and more than two pages were read.
    A site whose top page meets ``stop`` keeps its top page only.
    """
    live = _ok(pages)
    top = sites.select("entity_key", "site").join(live, F.col("site") == F.col("url")).withColumn("place", F.lit(0))
    top = top.withColumn("stopped", F.coalesce(stop, F.lit(False)) if stop is not None else F.lit(False))
    wanted = top.where(~F.col("stopped")).select("entity_key", "site", F.posexplode(F.slice(links.profile_links(F.col("anchors"), F.col("site")), 1, PROFILE_PAGES)).alias("at", "l"))
    about = wanted.select("entity_key", "site", (F.col("at") + 1).alias("place"), F.col("l.url").alias("url")).join(live, "url").withColumn("stopped", F.lit(False))
    columns = ["entity_key", "site", "place", "url", "title", "text", "final_url", "anchors", "stopped"]
    every = top.select(columns).unionByName(about.select(columns)).withColumn("folded", text.nfkc(text.flatten(F.col("text"))))
    every = every.withColumn("count", figures.headcount(F.col("folded"))).withColumn("strong", F.coalesce(F.col("count.strong"), F.lit(False)))
    before = Window.partitionBy("entity_key", "site").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    seen, read = F.coalesce(F.max("strong").over(before), F.lit(False)), F.count("*").over(before)
    return every.withColumn("_done", seen & (read > 2)).where("NOT _done").drop("_done")


def site_evidence(crawled: DataFrame, source: str = "official") -> DataFrame:
    """Evidence rows of ``site_pages``: page text, headcounts (firm ones only, where a site has one) and addresses."""
    w = Window.partitionBy("entity_key", "site")
    rows = crawled.withColumn("any_strong", F.max("strong").over(w))

    def cell(order, field, value, snippet, keep):
        return F.when(keep, F.struct(F.lit(order).alias("o"), F.lit(field).alias("field"), value.cast("string").alias("value"), snippet.cast("string").alias("snippet")))

    top = F.col("place") == 0
    address = geo.address(F.col("folded"))["address"]
    said = F.array_compact(F.array(
        cell(0, "profileText", text.clip(F.concat_ws(" ", "title", text.flatten(F.col("text"))), 1500), F.lit("トップページ"), top),
        cell(1, "earlyStop", F.lit("true"), F.lit("トップページにどのカテゴリの語も無い"), F.col("stopped")),
        cell(2, "employees", F.col("count.value"), F.col("count.raw"), F.col("count").isNotNull() & (F.col("strong") | ~F.col("any_strong")) & ~F.col("stopped")),
        cell(3, "address", address, address, address.isNotNull() & ~F.col("stopped")),
        cell(4, "profileText", text.clip(text.flatten(F.col("text")), 1500), F.lit("会社概要ページ"), (F.col("text") != "") & ~F.col("stopped")),
    ))
    cells = rows.select("entity_key", "place", "url", F.explode(said).alias("e")).select("entity_key", (F.col("place") * 10 + F.col("e.o")).cast("long").alias("seq"), "e.field", "e.value", F.lit(source).alias("source"), "url", "e.snippet")
    return fusion.dedup_first(cells, ["entity_key", "field", "value"]).select(EVIDENCE)


def contact_candidates(crawled: DataFrame) -> DataFrame:
    """(entity_key, site, rank, url, text, source_url, top_text): general contact links of a site's own domain or of a form service, best first, three at most."""
    top = crawled.where("place = 0").select("entity_key", "site", F.col("text").alias("top_text"), F.col("final_url").alias("top_final"))
    found = crawled.select("entity_key", "site", "place", F.col("url").alias("source_url"), F.posexplode(links.contact_links(F.col("anchors"), F.col("url"))).alias("at", "l"))
    rows = found.join(top, ["entity_key", "site"]).select("*", F.col("l.url").alias("url"), F.col("l.score").alias("score"), F.col("l.text").alias("said"))
    own = links.same_site(F.col("url"), F.col("site")) | links.same_brand(F.col("url"), F.col("site")) | links.same_site(F.col("url"), F.col("top_final")) | links.same_brand(F.col("url"), F.col("top_final"))
    kept = rows.where(F.col("l.kind").isNull() & (own | links.form_host(F.col("url"))))
    w = Window.partitionBy("entity_key", "site").orderBy(F.desc("score"), "place", "at")
    return kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= CONTACTS).select("entity_key", "site", "rank", "url", F.col("said").alias("text"), "source_url", "top_text")


def contacts(crawled: DataFrame, pages: DataFrame, disallowed: DataFrame | None = None) -> DataFrame:
    """Evidence of one contact url an entity and site: the best candidate that proves to be a contact page, else the first usual path that does.

    ``disallowed`` (url): pages that may not be visited; a link to one counts as found.
    """
    live = _ok(pages).select(F.col("url").alias("p_url"), F.col("text").alias("p_text"), "final_url")
    tried = contact_candidates(crawled).join(live, F.col("url") == F.col("p_url"), "left")
    if disallowed is not None:
        tried = tried.join(disallowed.select(F.col("url").alias("d_url")).distinct(), F.col("url") == F.col("d_url"), "left")
    else:
        tried = tried.withColumn("d_url", F.lit(None).cast("string"))
    form = links.form_host(F.col("url"))
    proved = form | F.col("d_url").isNotNull() | (F.col("p_url").isNotNull() & links.contact_page(F.col("p_text"), F.col("top_text"), False, F.col("url"), F.col("final_url")))
    how = F.when(form, "外部フォームサービス(公式サイトからリンク)").when(F.col("d_url").isNotNull(), "リンク検出のみ(robots.txtにより未アクセス)").otherwise("ページ実在とフォームの記述を確認")
    linked = tried.where(proved).select("entity_key", "site", "rank", "url", "source_url", F.concat(F.lit("リンク文言「"), "text", F.lit("」/ "), how).alias("snippet"))
    top = crawled.where("place = 0").select("entity_key", "site", F.col("text").alias("top_text"))
    guesses = top.select("*", F.posexplode(F.array(*[F.lit(p) for p in links.FALLBACK_PATHS])).alias("at", "path")).withColumn("url", F.concat(urls.origin(F.col("site")), F.col("path")))
    guessed = guesses.join(live, F.col("url") == F.col("p_url")).where(links.contact_page(F.col("p_text"), F.col("top_text"), True, F.col("url"), F.col("final_url")))
    usual = guessed.select("entity_key", "site", (F.lit(100) + F.col("at")).alias("rank"), "url", F.col("url").alias("source_url"), F.concat(F.lit("一般的なパス("), "path", F.lit(")にフォームの記述のあるページが実在")).alias("snippet"))
    best = fusion.first_of(linked.unionByName(usual), ["entity_key", "site"], [F.col("rank"), F.col("url")])
    return best.select("entity_key", "site", F.lit(0).cast("long").alias("seq"), F.lit("contactUrl").alias("field"), F.col("url").alias("value"), F.lit("official").alias("source"), F.col("source_url").alias("url"), "snippet")


def from_official(entities: DataFrame, evidence: DataFrame, pages: DataFrame, disallowed: DataFrame | None = None, others: int = 2) -> DataFrame:
    """Evidence rows that official sites add to entities (entity_key, source_names).

    Other domains that sources name (two at most) are read in turn while no site has a headcount; the first site with a contact page gives the contact url.
    A stopped top page ends the entity.
    """
    best = best_official(evidence)
    alternates = fusion.first_of(
        evidence.where("field = 'officialUrl' AND value IS NOT NULL").join(best.select("entity_key", F.col("official_url").alias("_o")), "entity_key").withColumn("_d", urls.domain(F.col("value"))).where(F.col("_d") != urls.domain(F.col("_o"))),
        ["entity_key", "_d"], [F.col("seq")])
    w = Window.partitionBy("entity_key").orderBy("seq")
    more = alternates.withColumn("turn", F.row_number().over(w)).where(F.col("turn") <= others).select("entity_key", "turn", F.col("value").alias("site"))
    sites = best.select("entity_key", F.lit(0).alias("turn"), F.col("official_url").alias("site")).unionByName(more).join(entities.select("entity_key", "source_names"), "entity_key")
    live = pages.join(sites.select(F.col("site").alias("url")).distinct(), "url", "left_semi")
    stop_rows = live.select("url", "title", "meta", "text").join(sites.where("turn = 0"), F.col("url") == F.col("site"))
    stopped = stop_rows.where(checks.Industry().early_stop(F.col("title"), F.col("meta"), F.col("text"), checks.only_job_lists(F.col("source_names")))).select("entity_key").distinct()
    sites = sites.join(stopped.withColumn("_s", F.lit(True)), "entity_key", "left").where("turn = 0 OR _s IS NULL")
    crawled = site_pages(sites.select("entity_key", "site", "_s"), pages).join(sites.select("entity_key", "site", "turn", F.coalesce("_s", F.lit(False)).alias("_s")), ["entity_key", "site"])
    crawled = crawled.where(~F.col("_s") | (F.col("place") == 0)).withColumn("stopped", F.col("_s"))
    counted = crawled.groupBy("entity_key", "turn").agg(F.max(F.col("count").isNotNull()).alias("has"))
    enough = counted.where("has").groupBy("entity_key").agg(F.min("turn").alias("last"))
    crawled = crawled.join(enough, "entity_key", "left").where("last IS NULL OR turn <= last")
    found = contacts(crawled.where("NOT stopped"), pages, disallowed).join(sites.select("entity_key", "site", "turn"), ["entity_key", "site"])
    contact = fusion.first_of(found, ["entity_key"], [F.col("turn")]).select(EVIDENCE)
    return site_evidence(crawled).unionByName(contact.withColumn("seq", F.lit(1_000_000).cast("long")))


# ------------------------------------------------------------- work sets


def has_pending(entity: dict[str, Column] | None = None, skipped: tuple[str, ...] = (), employees_only: bool = False) -> Column:
    """Is there something left to ask?  Columns: sources (that gave evidence), has_official, has_employees, firm_employees, and the no_* flags."""
    c = entity or {n: F.col(n) for n in ("sources", "has_official", "has_employees", "firm_employees", "no_prtimes", "no_gbiz", "no_mynavi", "no_careertasu", "no_openwork")}
    gave = lambda s: F.array_contains(c["sources"], s)
    without = ~c["firm_employees"] if employees_only else ~c["has_employees"]
    left = F.lit(False)
    for source, flag in (("gbizinfo", "no_gbiz"), ("mynavi", "no_mynavi"), ("careertasu", "no_careertasu"), ("openwork", "no_openwork")):
        if source not in skipped:
            left = left | (~F.coalesce(c[flag], F.lit(False)) & ~gave(source))
    crawl = c["has_official"] & ~gave("official")
    url = F.lit(False) if employees_only or "prtimes" in skipped else ~c["has_official"] & ~F.coalesce(c["no_prtimes"], F.lit(False))
    return crawl | url | (without & left)


def stages(employees_only: bool = False, skipped: tuple[str, ...] = ()) -> list[str]:
    """The order in which sources are asked."""
    plan = ["salesnow", "prtimes", "openwork", "official", "edinet", "gbizinfo", "mynavi", "careertasu", "openwork"]
    urls_only = {"salesnow", "prtimes"}
    out = []
    for k, s in enumerate(plan):
        if s in skipped or (employees_only and (s in urls_only or (s == "openwork" and k < 3))):
            continue
        out.append(s)
    return out


def stage_targets(entities: DataFrame, stage: str, order: list[Column], limit: int | None = None, employees_only: bool = False, after_urls: bool = True) -> DataFrame:
    """Entities that a stage asks for, inside Tokyo or unknown, the current category first."""
    gave = F.array_contains("sources", stage)
    flag = {"salesnow": "no_salesnow", "prtimes": "no_prtimes", "gbizinfo": "no_gbiz", "mynavi": "no_mynavi", "careertasu": "no_careertasu", "openwork": "no_openwork"}.get(stage)
    without = ~F.col("firm_employees") if employees_only and stage in ("mynavi", "careertasu", "openwork") else ~F.col("has_employees")
    wants = {
        "salesnow": ~F.col("has_official") | ~F.col("has_employees"), "prtimes": ~F.col("has_official") | F.col("needs_corporate"), "official": F.col("has_official"), "edinet": F.lit(True),
        "openwork": without if after_urls else ~F.col("has_official"),
    }.get(stage, without)
    fits = wants & F.coalesce(F.col("tokyo"), F.lit(True))
    if stage != "edinet":
        fits = fits & ~gave
    if flag:
        fits = fits & ~F.coalesce(F.col(flag), F.lit(False))
    rows = entities.where(fits).orderBy(*order)
    return rows.limit(limit) if limit else rows


def lookup_flags(asked: DataFrame, outcomes: DataFrame, key: str = "entity_key") -> DataFrame:
    """(key, matched, no_match): a match counts, a search without one is flagged and not repeated, an error leaves both null."""
    met = asked.select(key).join(outcomes.select(key, "outcome"), key, "left")
    return met.select(key, (F.col("outcome") == F.lit("match")).alias("matched"), F.when(F.col("outcome") == "none", True).alias("no_match"))


def site_gate(source: Column, targets: Column, implemented: list[str]) -> Column:
    """Why a source is not read for a category; null where it is."""
    return (
        F.when(source.isin(config.BLOCKED), "blocked").when(source.isin(config.BY_NAME), "enrich only").when(~source.isin(implemented), "not implemented")
        .when(F.coalesce(targets, F.lit(0)) == 0, "no targets")
    )


def discovery_plan(found: DataFrame, target: int, implemented: list[str], orders: dict = config.ORDER) -> DataFrame:
    """(category, source, place, gate, before): sources of a category in order, until the qualified entities reach the target.

    found: category, source, targets, qualified.
    """
    table = [(c, s, i) for c, order in orders.items() for i, s in enumerate(order)]
    rows = found.sparkSession.createDataFrame(table, "category string, source string, place int").join(found, ["category", "source"], "left")
    rows = rows.withColumn("gate", site_gate(F.col("source"), F.col("targets"), implemented))
    read = rows.withColumn("n", F.when(F.col("gate").isNull(), F.coalesce("qualified", F.lit(0))).otherwise(0))
    return workset.until_target(read, "category", "place", "n", target).select("category", "source", "place", "gate", "before")


def employee_bottlenecks(records: DataFrame, key: str | None = None) -> DataFrame:
    """Records to check that lack nothing but the headcount, of one category."""
    rows = records.where((F.col("status") == config.STATUS["check"]) & workset.only_missing(F.col("missing"), "従業員数"))
    return rows if key is None else rows.where(F.array_contains("seeds", key) & F.array_contains("categories", config.LABELS[key]))


def next_round(records: DataFrame, category: str | None, n: int, order: str = "seq", employees_only: bool = False) -> DataFrame:
    """The next n entities with something left to ask, the current category's first; those known to be elsewhere are left out."""
    rows = records.where(F.coalesce(F.col("tokyo"), F.lit(True)) & F.col("pending"))
    if employees_only:
        rows = employee_bottlenecks(rows, category)
    first = F.when(F.array_contains("seeds", F.lit(category)), 0).otherwise(1) if category else F.lit(0)
    ordered = rows.orderBy(first, order)
    return ordered.limit(n) if n else ordered


def moved_sites(evidence: DataFrame, best: DataFrame) -> DataFrame:
    """Evidence without what an entity's former official site gave, where the adopted url has another domain now."""
    crawled = evidence.where("source = 'official'").groupBy("entity_key").agg(F.min_by("url", "seq").alias("_u"))
    stale = crawled.join(best, "entity_key").where(urls.domain(F.col("_u")) != urls.domain(F.col("official_url"))).select("entity_key")
    return evidence.join(stale.withColumn("source", F.lit("official")), ["entity_key", "source"], "left_anti")


def first_evidence(evidence: DataFrame, field: str) -> DataFrame:
    """The earliest row of a field of every entity."""
    return fusion.first_of(evidence.where(F.col("field") == field), ["entity_key"], [F.col("seq")])


def from_filings(entities: DataFrame, evidence: DataFrame, codes: DataFrame, reports: DataFrame, facts: DataFrame) -> DataFrame:
    """Evidence with what annual reports say in place of what they said before: code, address, headcount, group headcount.

    entities: entity_key, name; codes: code, kind, name, address, listed, consolidated, industry, secCode; reports: docID, edinetCode, periodEnd,
    submitDateTime (the latest of each company); facts: docID, current, single.  A filer without a recent report adds nothing.
    """
    from ..sources.readers import choose_headcount

    known = evidence.where("field = 'address' AND source <> 'edinet'").groupBy("entity_key").agg(F.collect_list("value").alias("addresses"))
    hit = resolve.pick_filer(resolve.by_name(entities, codes), known)
    met = hit.join(reports, F.col("code") == F.col("edinetCode")).join(facts, "docID", "left")
    choice = choose_headcount(F.col("single"), F.col("current"), F.col("consolidated") == "有")
    how = F.when(F.col("by_address"), "").otherwise("（所在地での照合なし・社名のみ一致）")
    period = figures.period_label(F.to_date("periodEnd"))
    doc = F.concat(F.lit("有価証券報告書 "), period, F.lit("（書類ID "), F.col("docID"), F.lit("）"))
    sec = F.coalesce(F.concat(F.lit(" 証券コード"), F.regexp_replace("secCode", "0$", "")), F.lit(""))
    cell = lambda o, field, value, snippet: F.struct(F.lit(o).cast("long").alias("seq"), F.lit(field).alias("field"), value.cast("string").alias("value"), F.concat(snippet, how).alias("snippet"))
    cells = F.array(
        cell(0, "edinetCode", F.col("code"), F.concat(F.lit("EDINETコード "), F.col("code"), F.lit(" / "), F.coalesce("listed", F.lit("")), sec, F.lit(" / "), F.coalesce("industry", F.lit("")))),
        cell(1, "address", F.col("address"), F.concat(F.lit("EDINETコード一覧の本店所在地: "), F.col("address"))),
        cell(2, "employees", choice["value"], F.concat(doc, F.lit(" 従業員数 "), choice["value"].cast("string"), F.lit("名"))),
        cell(3, "employeesConsolidated", choice["group"], F.concat(doc, F.lit(" 連結の従業員数 "), choice["group"].cast("string"), F.lit("名"))),
    )
    fresh = met.select("entity_key", F.explode(cells).alias("c"), F.concat(F.lit("https://disclosure2.edinet-fsa.go.jp/WZEK0040.aspx?"), "docID", F.lit(",,")).alias("url"))
    fresh = fresh.select("entity_key", "c.seq", "c.field", "c.value", F.lit("edinet").alias("source"), "url", "c.snippet").where("value IS NOT NULL")
    asked = entities.select("entity_key").withColumn("source", F.lit("edinet"))
    return evidence.select(EVIDENCE).join(asked, ["entity_key", "source"], "left_anti").select(EVIDENCE).unionByName(fresh)
