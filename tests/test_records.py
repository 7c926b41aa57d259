"""From evidence and stored pages to records, checks, the review queue and reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from factloom.functions import text
from factloom.operators import checks, config, consolidate, enrich, links, progress, resolve, review, robots
from factloom.sources import discover, sinks

EVIDENCE = "entity_key string, seq long, field string, value string, source string, url string, snippet string"
PAGES = "url string, status int, title string, meta string, text string, final_url string, anchors array<struct<href: string, text: string>>, error string"
ENTITIES = "key string, name string, seq long, sources array<struct<source: string, url: string>>, seeds array<string>"
TOP = "甲田\nスキンケアの公式通販\n" + "\n".join(f"商品{i}の説明文です" for i in range(40))
FORM = "お問い合わせ\nお名前\nメールアドレス\n送信"


def evidence(spark):
    rows = [
        ("甲", 0, "address", "東京都港区芝1", "green", ""), ("甲", 1, "employees", "50", "green", "従業員数: 50名（2024年4月現在）"), ("甲", 2, "officialUrl", "https://a.co.jp/", "boxil", ""),
        ("甲", 3, "officialUrl", "https://a.co.jp/", "salesnow", ""), ("甲", 4, "contactUrl", "https://a.co.jp/contact/", "official", ""), ("甲", 5, "address", "東京都港区芝1-2", "official", ""),
        ("甲", 6, "profileText", "スキンケアの公式通販", "official", ""), ("甲", 7, "employees", "60", "wantedly", ""),
        ("乙", 0, "address", "東京都港区", "green", ""), ("乙", 1, "employees", "400", "wantedly", "400人"), ("乙", 2, "officialUrl", "https://b.jp/", "boxil", ""), ("乙", 3, "contactUrl", "https://b.jp/ir/contact", "official", ""),
        ("乙", 4, "profileText", "SNS運用の会社", "official", ""), ("乙", 5, "employees", "40", "mynavi", "40名"), ("乙", 6, "address", "大阪府大阪市", "salesnow", ""),
        ("丙", 0, "address", "東京都港区", "official", ""), ("丙", 1, "employees", "90", "official", ""), ("丙", 2, "officialUrl", "https://c.jp/", "boxil", ""), ("丙", 3, "profileText", "SNS運用", "official", ""),
    ]
    return spark.createDataFrame([(k, s, f, v, src, f"https://src/{src}", note) for k, s, f, v, src, note in rows], EVIDENCE)


def pages(spark):
    anchors = [("https://a.co.jp/company/", "会社概要"), ("https://a.co.jp/contact/", "お問い合わせ"), ("https://a.co.jp/ir/", "IR"), ("https://a.co.jp/service/", "サービス"), ("mailto:x", "mail")]
    rows = [
        ("https://a.co.jp/", 200, "株式会社甲田", "スキンケア 公式通販", TOP, "https://a.co.jp/", anchors, None),
        ("https://a.co.jp/contact/", 200, "お問い合わせ", "", FORM, "https://a.co.jp/contact/", [], None),
        ("https://a.co.jp/company/", 200, "会社概要", "", "会社概要\n所在地\n〒105-0014 東京都港区芝1-2\n従業員数\n52名", "https://a.co.jp/company/", [], None),
        ("https://b.jp/", 200, "別の会社", "", "ゲームの会社です", "https://b.jp/", [("https://b.jp/service/sns", "サービス")], None),
        ("https://b.jp/service/sns", 200, "s", "", "SNS運用とSNS広告", "https://b.jp/service/sns", [], None),
        ("https://b.jp/ir/contact", 200, "IR", "", FORM, "https://b.jp/ir/contact", [], None),
    ]
    return spark.createDataFrame(rows, PAGES)


def entities(spark):
    rows = [("甲", "株式会社甲田", 0, [("boxil", "u1"), ("green", "u2")], ["cosme_d2c"]), ("乙", "乙", 1, [("kyujinbox", "u")], ["sns_agency"]), ("丙", "丙", 2, [("kyujinbox", "u")], ["sns_agency"])]
    return spark.createDataFrame(rows, ENTITIES)


@pytest.fixture(scope="module")
def verified(spark):
    records = consolidate.consolidate(entities(spark), evidence(spark))
    keyed = records.withColumn("keys", consolidate.category_keys(F.col("categories"), F.col("seeds")))
    return checks.verified(keyed, evidence(spark), pages(spark)).cache()


def test_records_and_checks(verified):
    got = {r["entity_key"]: r for r in verified.collect()}
    a, b = got["甲"], got["乙"]
    assert a["status"] == "OK" and a["official_url"] == "https://a.co.jp/" and a["employees_as_of"] == "2024年4月" and a["category_keywords"] == ["スキンケア", "公式通販"]
    assert {k: v["result"] for k, v in a["checks"]["industry"].items()} == {"cosme_d2c": "OK"}
    assert [a["checks"][c]["result"] for c in ("employees", "contact", "identity")] == ["OK", "OK", "OK"]
    # seen on service pages only; ten times another source's undated count; limited contact; the name is not on the site and the place is disputed
    assert b["checks"]["industry"]["sns_agency"]["result"] == "OK" and b["checks"]["employees"]["result"] == "NG"
    assert b["checks"]["contact"]["result"] == "check" and "IR" in b["checks"]["contact"]["comment"] and b["checks"]["identity"]["result"] == "NG"
    assert got["丙"]["missing"] == [config.ITEMS["contact"]] and got["丙"]["checks"]["identity"]["result"] == "check" and any("90" in (n or "") for n in [got["丙"]["checks"]["employees"]["comment"]])


def test_flat_checks_review_queue_and_reports(spark, verified, tmp_path):
    sheet = spark.createDataFrame(
        [(1, "株式会社 丙", "sns_agency", "ＯＫ", "1,234名", "", "", "", "", "", ""), (2, "乙", "sns_agency", "", "", "", "", "", "c.jp/contact", "d.jp", "memo"), (3, "無", "", "NG", "", "", "", "", "", "", ""), (4, "乙", "", "", "", "", "", "", "", "", "x")],
        "seq long, id string, category string, industry string, employees string, contact string, identity string, employees_value string, contact_value string, official_value string, note string")
    ents = entities(spark).withColumnRenamed("key", "entity_key")
    reviews, fresh, counts = review.imported(sheet, ents, evidence(spark), "2026-01-02")
    assert tuple(counts.first()) == (2, 1, 1)
    said = {(r["entity_key"], r["field"]): r["value"] for r in fresh.where("source = 'human'").collect()}
    assert said == {("丙", "employees"): "1234", ("乙", "contactUrl"): "https://c.jp/contact", ("乙", "officialUrl"): "https://d.jp/"}
    rows = verified.join(reviews, "entity_key", "left").withColumn("verified_at", F.lit("2026-01-02"))
    assert [r["entity_key"] for r in consolidate.passing(rows, "cosme_d2c").collect()] == ["甲"]
    todo = review.queue(rows, "sns_agency", 5)
    assert [(r["entity_key"], r["kind"], r["effort"], r["points"]) for r in review.ordered(todo).collect()] == [("丙", "未検証", 1.5, config.ITEMS["contact"])]
    assert review.queue(rows, "sns_agency", 0).count() == 0
    report = sinks.all_records(rows)
    assert report.columns == sinks.RECORD_COLUMNS + sinks.CHECK_COLUMNS and [r["企業名"] for r in report.collect()][0] in ("株式会社甲田", "乙")
    sample, rest, summary = sinks.samples(rows)
    assert [(r["カテゴリ"], r["企業名"]) for r in sample.collect()] == [("化粧品D2C/P2C", "株式会社甲田")] and [r["企業名"] for r in rest.collect()] == ["乙"] and summary.count() == 1
    sinks.write_sheet(sinks.review_sheet(todo), str(tmp_path / "q"))
    lines = (tmp_path / "q").read_text(encoding="utf-8").splitlines()  # Spark's text reader takes the mark off
    assert lines[0].startswith("\ufeff企業ID,企業名") and len(lines) == 2
    checked = rows.select(checks.flat(F.col("checks"), "sns_agency", F.struct(F.create_map(F.lit("sns_agency"), F.lit("OK")).alias("industry"), F.lit(None).cast("string").alias("employees"), F.lit("NG").alias("contact"), F.lit(None).cast("string").alias("identity"), F.lit("d").alias("at"), F.lit(None).cast("string").alias("note"))).alias("f"), "entity_key").where("entity_key = '乙'").first()["f"]
    assert checked["industry"]["result"] == "OK (human)" and checked["contact"]["result"] == "NG" and "元の判定" in checked["contact"]["comment"]


def test_official_site(spark):
    ev = evidence(spark)
    ents = entities(spark).select(F.col("key").alias("entity_key"), F.transform("sources", lambda s: s["source"]).alias("source_names"))
    got = [(r["entity_key"], r["field"], r["value"]) for r in enrich.from_official(ents, ev, pages(spark)).orderBy("entity_key", "seq").collect()]
    mine = [(f, v) for k, f, v in got if k == "甲"]
    assert ("employees", "52") in mine and ("address", "東京都港区芝1-2") in mine and mine[-1] == ("contactUrl", "https://a.co.jp/contact/")
    assert not [f for k, f, _ in got if k == "乙" and f == "contactUrl"] and not [k for k, *_ in got if k == "丙"]
    best = enrich.best_official(ev)
    assert {r["entity_key"]: r["official_source"] for r in best.collect()} == {"甲": "salesnow", "乙": "boxil", "丙": "boxil"}
    old = spark.createDataFrame([("甲", 9, "employees", "1", "official", "https://old.jp/", ""), ("甲", 10, "employees", "2", "green", "u", "")], EVIDENCE)
    assert [r["value"] for r in enrich.moved_sites(old, best).collect()] == ["2"]
    refused = spark.createDataFrame([("https://www.facebook.com/x",), ("https://www.a.jp:8443/x?y",), ("bad",)], "url string")
    assert [r["value"] for r in enrich.accepted_official(refused).collect()] == ["https://www.a.jp:8443/"]


@pytest.mark.parametrize(("url", "label", "kind"), [
    ("https://a.jp/contact", "", None), ("https://a.jp/ir/contact", "", "IR・株主向け"), ("https://a.jp/%E6%8E%A1%E7%94%A8", "", "採用"), ("https://shop.a.jp/contact", "", None), ("https://a.jp/shop/contact", "", "サービス別・個別窓口"), ("https://a.jp/en/contact", "", "英語サイト"),
    ("https://a.jp/x", "個人情報の開示", "個人情報関連"), ("https://a.jp/press/", "", "メディア・取材"), ("https://a.jp/faq/", "", "サポート・お客様窓口")])
def test_contact_kind(spark, url, label, kind):
    assert spark.createDataFrame([(url, label)], "u string, l string").select(links.contact_kind(F.col("u"), F.col("l")).alias("k")).first()["k"] == kind


def test_link_finders_and_contact_pages(spark):
    anchors = [("https://a.jp/recruit", "採用情報"), ("https://a.jp/company/", "会社概要"), ("https://x.com/a", "会社概要"), ("https://a.jp/about", "IR・会社情報"), ("https://a.jp/", "サービス"), ("https://a.jp/products/", "製品"),
               ("https://a.jp//contact/#x", "お問い合わせ"), ("https://a.jp/ir/contact", "IRお問い合わせ"), ("https://other.jp/form", "資料"), ("https://a.jp/information", "information"), ("tel:1", "お問い合わせ")]
    row = spark.createDataFrame([(anchors,)], "a array<struct<href: string, text: string>>").select(
        *[F.transform(f(F.col("a"), F.lit("https://a.jp/")), lambda l: l["url"]).alias(n) for n, f in (("c", links.contact_links), ("p", links.profile_links), ("s", links.service_links))]).first()
    assert row["c"] == ["https://a.jp/contact/", "https://a.jp/ir/contact", "https://other.jp/form"]
    assert row["p"] == ["https://a.jp/company/", "https://a.jp/about", "https://a.jp/information"] or row["p"][:2] == ["https://a.jp/company/", "https://a.jp/about"]
    assert row["s"] == ["https://a.jp/products/"]
    judge = lambda body, top, guess, final: spark.createDataFrame([(body, top, final)], "b string, t string, f string").select(links.contact_page(F.col("b"), F.col("t"), guess, F.lit("https://a.jp/contact"), F.col("f")).alias("x")).first()["x"]
    assert judge(FORM, TOP, True, "https://a.jp/contact/") and not judge(FORM, TOP, True, "https://a.jp/") and not judge(TOP, TOP, False, None)
    assert judge("窓口はこちら", TOP, False, None) and not judge("窓口はこちら", TOP, True, None) and judge("contact a@b.jp", TOP, True, None)


def test_resolution(spark):
    ents = spark.createDataFrame([("甲", "株式会社甲社"), ("乙", "乙商事（旧丁）"), ("丙", "丙")], "entity_key string, name string")
    known = spark.createDataFrame([("甲", ["大阪府大阪市北区1"])], "entity_key string, addresses array<string>")
    reg = spark.createDataFrame([(0, "甲社", "東京都港区", 5), (1, "株式会社甲社", "大阪府大阪市", None), (2, "甲社（閉鎖）", "大阪府大阪市", 9), (3, "乙商事", "福岡県", 3), (4, "乙商事", "東京都", None), (5, "乙商事", "東京都港区", 8)], "seq long, name string, address string, employees long")
    got = {r["entity_key"]: (r["seq"], r["same_name"]) for r in resolve.pick_registry(resolve.by_name(ents, reg), known).collect()}
    assert got == {"甲": (1, 2), "乙": (5, 3)}
    filers = reg.withColumn("kind", F.lit("内国法人・組合"))
    assert {r["entity_key"]: r["seq"] for r in resolve.pick_filer(resolve.by_name(ents, filers.where("seq IN (0, 1, 3)")), known).collect()} == {"甲": 1, "乙": 3}
    cards = spark.createDataFrame([(0, "甲社", "東京都", "u0"), (1, "甲社", "大阪府", "u1"), (2, "乙商事", "福岡県", "u2"), (3, "乙商事", "東京都", "u3")], "pos long, name string, place string, ref string")
    assert {r["entity_key"]: r["ref"] for r in resolve.pick_by_prefecture(resolve.by_name(ents, cards), known, "place").collect()} == {"甲": "u1", "乙": "u3"}
    titles = spark.createDataFrame([(0, "グループ【甲社／丙社】[x]", "東京都", "u0"), (1, "株式会社甲社", "大阪府大阪市", "u1"), (2, "丙", "京都府", None)], "pos long, name string, place string, ref string")
    assert {r["entity_key"]: r["ref"] for r in resolve.pick_listing(ents, titles, known).collect()} == {"甲": "u1"}
    both = spark.createDataFrame([("甲", "甲", 0, "a.jp", [("x", "1")], ["p"]), ("乙", "乙", 1, "a.jp", [("x", "1"), ("y", "2")], ["q"]), ("丙", "丙", 2, None, [("z", "3")], [])], "entity_key string, name string, seq long, domain string, sources array<struct<source: string, url: string>>, seeds array<string>")
    one, moved = resolve.merged_by_domain(both, evidence(spark))
    assert {r["entity_key"]: ([s["url"] for s in r["sources"]], r["seeds"]) for r in one.collect()} == {"甲": (["1", "2"], ["p", "q"]), "丙": (["3"], [])}
    assert moved.where("entity_key = '甲'").count() == 15 and moved.where("entity_key = '乙'").count() == 0


def test_progress_records(spark):
    t = dt.datetime(2026, 1, 1)
    old = spark.createDataFrame([("a", 1, 0, 0, False, 1, "e", t, 1, t), ("b", 3, 0, 40, False, 0, None, None, 2, t), ("c", 1, 8, 8, False, 2, "x", t, 3, t)], "key string, nextPage int, offset int, found int, exhausted boolean, failures int, lastError string, failedAt timestamp, runs int, lastAt timestamp")
    runs = spark.createDataFrame([("a", 5, [], 2, t), ("b", 0, [], 3, t), ("c", 4, [" ! part"], None, t), ("d", 0, [], 1, t), ("e", 0, ["! HTTP 500"], None, t)], "key string, found int, errors array<string>, last_page int, at timestamp")
    got = {r["key"]: r for r in progress.apply_runs(old, runs).collect()}
    pick = lambda k: tuple(got[k][c] for c in ("nextPage", "offset", "found", "exhausted", "failures", "lastError"))
    assert pick("a") == (3, 0, 5, False, 0, None) and got["a"]["failedAt"] is None and pick("b") == (3, 0, 40, True, 0, None) and pick("c") == (1, 12, 12, False, 0, "part")
    assert pick("d") == (1, 0, 0, False, 1, progress.EMPTY_LIST) and pick("e") == (1, 0, 0, False, 1, "HTTP 500")
    rec = spark.createDataFrame([("a", True, 0, None), ("b", False, 2, t), ("c", False, 1, t), ("d", False, 3, dt.datetime(2025, 1, 1))], "key string, exhausted boolean, failures int, failedAt timestamp").withColumn("r", F.struct("exhausted", "failures", "failedAt"))
    why = {r["key"]: (r["x"], r["y"]) for r in rec.select("key", progress.skip_reason(F.col("r"), F.lit(t)).alias("x"), progress.skip_reason(F.col("r"), F.lit(t), refresh=True, retry_failed=True).alias("y")).collect()}
    assert why == {"a": ("exhausted", None), "b": ("failing", None), "c": (None, None), "d": (None, None)}
    log = spark.createDataFrame([("h", i, s) for i, s in enumerate([403, 500, 403, 403, 200, 403])], "host string, seq long, status int")
    assert [r["tripped_at"] for r in progress.trips(log, "host", "seq", F.col("status") == 403, F.col("status") == 200).collect()] == [3]


def test_robots_and_plans(spark):
    files = spark.createDataFrame([("https://a.jp", "200", "User-agent: *\nDisallow: /x?q", None), ("https://b.jp", "404", "", None), ("https://c.jp", "error", "", "timeout")], "origin string, status string, text string, error string")
    sites = spark.createDataFrame([("a", "https://a.jp"), ("b", "https://b.jp"), ("c", "https://c.jp")], "source string, origin string")
    used = robots.used_urls(spark.createDataFrame([("a", "https://a.jp/x?q=1"), ("a", "word"), ("b", "https://b.jp/y")], "source string, url string"), spark.createDataFrame([("a", "https://a.jp/x"), ("c", "https://c.jp/")], "source string, url string"))
    got = {r["source"]: [(c["url"], c["allowed"]) for c in r["checks"]] for r in robots.report(files, used, sites).collect()}
    assert got == {"a": [("https://a.jp/x", True), ("https://a.jp/x?q=1", False)], "b": [("https://b.jp/y", True)], "c": [("https://c.jp/", False)]}
    found = spark.createDataFrame([("cosme_d2c", "prtimes", 3, 6), ("cosme_d2c", "wantedly", 2, 9), ("cosme_d2c", "article", 1, 1), ("cosme_d2c", "green", 0, 0)], "category string, source string, targets int, qualified long")
    plan = {r["source"]: r["gate"] for r in enrich.discovery_plan(found.where("category = 'cosme_d2c'"), 8, ["prtimes", "wantedly", "article", "green"]).where("category = 'cosme_d2c'").collect()}
    assert plan == {"prtimes": None, "wantedly": None}
    assert enrich.stages(True) == ["official", "edinet", "gbizinfo", "mynavi", "careertasu", "openwork"] and enrich.stages(skipped=("salesnow",))[0] == "prtimes"
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "entity_key string")
    out = spark.createDataFrame([("a", "match"), ("b", "none"), ("c", None)], "entity_key string, outcome string")
    assert {r["entity_key"]: (r["matched"], r["no_match"]) for r in enrich.lookup_flags(asked, out).collect()} == {"a": (True, None), "b": (False, True), "c": (None, None)}


def test_discovery(spark):
    lists = spark.createDataFrame([("p1", 1, "t", "営業\n株式会社甲\n東京都 港区\n企画\n乙有限会社\n東京都 港区", []), ("p2", 2, "t", "営業\n株式会社甲\n東京都 港区\n企画\n丙有限会社\n東京都 港区", [])], "url string, page int, title string, text string, anchors array<struct<href: string, text: string>>")
    found = discover.records(lists, None, "kyujinbox", 2)
    assert [r["name"] for r in found.orderBy("page", "pos").collect()] == ["株式会社甲", "乙有限会社"]
    ents, seeds, ev = discover.discovered(found, "kyujinbox", "sns_agency", "SNS")
    assert {r["key"] for r in ents.collect()} == {"甲", "乙"} and seeds.count() == 2
    assert {(r["entity_key"], r["field"], r["value"]) for r in ev.collect()} >= {("甲", "jobText", "営業"), ("甲", "jobLocation", "東京都 港区"), ("甲", "profileText", "SNS")}
    page = spark.createDataFrame([("l", "t", "", [("https://grip-space.co.jp/ad-db/company/3", "甲社")])], "url string, title string, text string, anchors array<struct<href: string, text: string>>")
    own = spark.createDataFrame([("https://grip-space.co.jp/ad-db/company/3", "t", "会社名\t株式会社甲社\n公式サイト\thttps://www.facebook.com/a\n従業員数\t50名", [])], "url string, title string, text string, anchors array<struct<href: string, text: string>>")
    _, _, ev = discover.discovered(discover.records(page, own, "grip", 5), "grip", "ad_agency")
    assert {(r["field"], r["value"]) for r in ev.collect()} == {("employees", "50")}


def test_early_stop_and_signatures(spark):
    long = "あ" * 250
    row = spark.createDataFrame([("t", "", long, ["kyujinbox"]), ("t", "", long + "SNS", ["kyujinbox"]), ("t", "", long, ["kyujinbox", "boxil"]), ("t", "", "短い", ["kyujinbox"])], "title string, meta string, text string, s array<string>")
    got = [r["x"] for r in row.select(checks.Industry().early_stop(F.col("title"), F.col("meta"), F.col("text"), checks.only_job_lists(F.col("s"))).alias("x")).collect()]
    assert got == [True, False, False, False]
    assert spark.range(1).select(text.nfkc(F.lit("ＡＢＣ１２　")).alias("x")).first()["x"] == "ABC12 "


def test_filings_memos_and_days(spark, tmp_path):
    ents = spark.createDataFrame([("甲田", "株式会社甲田"), ("乙", "乙")], "entity_key string, name string")
    ev = spark.createDataFrame([("甲田", 0, "address", "東京都港区芝", "official", "u", ""), ("甲田", 1, "employees", "1", "edinet", "u", "old"), ("乙", 0, "employees", "2", "edinet", "u", "old")], EVIDENCE)
    codes = spark.createDataFrame([("E00001", "内国法人・組合", "甲田株式会社", "港区芝1-1", "上場", "有", "小売業", "12340")], "code string, kind string, name string, address string, listed string, consolidated string, industry string, secCode string")
    reports = spark.createDataFrame([("S1", "E00001", "2025-03-31", "2025-06-20 10:00")], "docID string, edinetCode string, periodEnd string, submitDateTime string")
    facts = spark.createDataFrame([("S1", 900, 300)], "docID string, current long, single long")
    got = {(r["entity_key"], r["field"], r["source"]): r["value"] for r in enrich.from_filings(ents, ev, codes, reports, facts).collect()}
    assert got == {
        ("甲田", "address", "official"): "東京都港区芝", ("甲田", "edinetCode", "edinet"): "E00001", ("甲田", "address", "edinet"): "東京都港区芝1-1", ("甲田", "employees", "edinet"): "300",
        ("甲田", "employeesConsolidated", "edinet"): "900"}
    import hashlib

    digest = hashlib.sha1("memo:gbiz:甲".encode()).hexdigest()
    (tmp_path / digest[:2]).mkdir()
    (tmp_path / digest[:2] / f"{digest}.json").write_text('{"text": "hit"}')
    asked = spark.createDataFrame([("gbiz:甲",), ("gbiz:乙",)], "name string")
    from factloom.operators import workset
    from factloom.sources import readers

    assert [(r["name"], r["text"]) for r in readers.memos(spark, str(tmp_path), asked, "text string").collect()] == [("gbiz:甲", "hit")]
    assert str(spark.range(1).select(workset.jst_today(F.lit("2026-01-01 16:00:00").cast("timestamp")).alias("d")).first()["d"]) == "2026-01-02"
