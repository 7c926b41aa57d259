import pytest
from pyspark.sql import functions as F

from factloom.functions import figures, geo, text, urls
from factloom.operators import checks, extract, fusion, verify, wordhits


def one(spark, column, *values):
    rows = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return rows.select(column(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


def count_of(spark, said):
    found = one(spark, lambda c: figures.headcount(text.nfkc(text.flatten(c))), said)
    return found and found["value"]


@pytest.mark.parametrize(
    ("said", "value"),
    [("従業員数：1,200名（2024年4月現在）", 1200), ("従業員数　約５０名", 50), ("従業員数 20〜50名", 20), ("従業員数 2020年", None), ("従業員募集中", None), ("従業員数 0名", None), ("従業員 | 45名", 45)],
)
def test_headcount(spark, said, value):
    assert count_of(spark, said) == value


def test_headcount_flags(spark):
    column = lambda c: figures.headcount(text.nfkc(text.flatten(c)))
    assert one(spark, column, "従業員数 20〜50名")["approx"] is True
    assert one(spark, column, "従業員 | 45名")["strong"] is False


@pytest.mark.parametrize(("address", "tokyo"), [("1050001 東京都港区", True), ("〒530-0001 大阪府大阪市", False), (None, False)])
def test_tokyo(spark, address, tokyo):
    assert one(spark, geo.in_tokyo, address) is tokyo


def test_places(spark):
    assert one(spark, geo.prefecture, "〒530-0001 大阪府大阪市北区") == "大阪府"
    assert one(spark, geo.city, "東京都港区芝1-1") == "港区"
    known = lambda a, k: geo.with_prefecture(a, F.array(k))
    assert one(spark, known, "港区芝1-1", "大阪府大阪市") == "東京都港区芝1-1"
    assert one(spark, known, "大阪市北区1", "大阪府大阪市") == "大阪府大阪市北区1"
    assert one(spark, known, "名古屋市中区", "大阪府大阪市") == "名古屋市中区"
    assert one(spark, geo.same_location, "東京都港区芝", "港区芝1") is True
    assert one(spark, geo.same_location, "大阪府大阪市", "東京都港区") is False


def test_names(spark):
    key = lambda c: text.normalize_name(c)
    assert one(spark, key, "(株)ＡＢＣ") == "abc"
    assert one(spark, key, "株式会社サラヤグループ") == one(spark, key, "サラヤグループ 株式会社")
    assert one(spark, key, "㍿テスト") == one(spark, key, "ﾃｽﾄ") == "テスト"
    assert one(spark, text.decision, " ○ ") == "OK"
    assert one(spark, text.decision, "NG") == "NG"
    assert one(spark, text.decision, "12") is None
    assert one(spark, lambda c: text.clip(c, 3), "a  b c d") == "a b…"


def test_urls(spark):
    assert one(spark, urls.domain, "https://www.Example.co.jp:8080/x") == "example.co.jp"
    assert one(spark, urls.domain, "not a url") is None
    assert one(spark, urls.origin, "https://a.b:443/x") == "https://a.b"
    assert one(spark, urls.normalize, "https://a.b//x///y?z=//1") == "https://a.b/x/y?z=//1"
    assert one(spark, urls.same_brand, "houseofrose.jp", "www.houseofrose.co.jp") is True
    assert one(spark, urls.same_brand, "a.co.jp", "b.co.jp") is False
    assert one(spark, urls.same_site, "a.example.com", "example.com") is True
    assert one(spark, urls.complete, "example.com/x") == "https://example.com/x"


def test_ranges_and_dates(spark):
    assert tuple(one(spark, figures.headcount_range, "100〜499人")) == (100, 499)
    assert tuple(one(spark, figures.headcount_range, "1000人以上")) == (1000, None)
    assert one(spark, figures.headcount_range, "不明") is None
    assert one(spark, figures.as_of_ordinal, "2024年4月現在") == 2024 * 12 + 4
    assert one(spark, figures.as_of_ordinal, "2024年時点") == 2024 * 12 + 6
    assert one(spark, figures.as_of_ordinal, "時点なし") == -1


CATEGORIES = {"ad": {"main": ["広告", "Web広告"], "weak": ["集客"]}, "shop": {"main": ["化粧品"], "extra": ["通販"], "extra_label": "直販"}}
INDUSTRY = checks.Industry(CATEGORIES, {"ad": "広告代理店", "shop": "化粧品D2C"}, ["DX", "人材"])


@pytest.mark.parametrize(("key", "own", "body", "result", "comment"), [
    ("ad", "広告の会社", "", "OK", "公式の自社説明に「広告」あり。広告代理店を取り扱っている"), ("ad", "会社", "広告と広告", "OK", "主業でない可能性"), ("ad", "会社", "広告", "check", "1回あるのみ"),
    ("ad", "会社", "Web広告", "OK", "「広告/Web広告」が複数"), ("ad", "会社", "集客", "check", "関連語(集客)のみ"), ("ad", "DXの会社", "製造", "NG", "「広告/Web広告」等が見当たらず"), ("ad", "DXと広告", "", "OK", "（他に DX 等の事業もあり、広告代理店は主業でない可能性）"),
    ("shop", "化粧品", "化粧品", "check", "直販を示す記述が公式サイトに無く"), ("shop", "化粧品", "通販", "OK", "「化粧品」あり"), ("shop", "化粧", "品", "NG", "見当たらず")])
def test_industry(spark, key, own, body, result, comment):
    got = one(spark, lambda o, b: INDUSTRY.check(key, INDUSTRY.hits(o, b), F.lit(True)), own, body)
    assert got["result"] == result and comment in got["comment"]


def test_hits_of_more_words_than_a_number_has_bits(spark):
    words = [f"w{k:03d}" for k in range(130)]
    hits = wordhits.WordHits(words)
    said = "w000 w063 w064 w127 w128 w129 w129"
    got = one(spark, lambda c: F.struct(hits.found(hits.bits(c), words).alias("found"), hits.count(hits.bits(c), words[64:]).alias("n"), hits.found(hits.twice(c, words), words).alias("twice"), hits.any(hits.bits(c), words[1:63]).alias("some")), said)
    assert got["found"] == ["w000", "w063", "w064", "w127", "w128", "w129"] and got["n"] == 4 and got["twice"] == ["w129"] and got["some"] is False


@pytest.mark.parametrize(("message", "status", "failure"), [
    ("HTTP 403", None, True), ("HTTP 404", None, False), ("HTTP 405", None, False), ("HTTP 503", None, True), ("x", 429, True), ("x", 404, False), ("timeout 45000ms exceeded", None, True), ("connect ECONNREFUSED 1.2.3.4", None, True),
    ("Target closed", None, True), ("net::ERR_NAME_NOT_RESOLVED", None, True), ("robots.txt を取得できない(HTTP 404)", 404, True), ("連続して拒否されたため中断", None, True), ("robots.txt disallows /x", 403, False), ("parse error", None, False), (None, None, False)])
def test_access_failure(spark, message, status, failure):
    rows = spark.createDataFrame([(message, status)], "m string, s int")
    assert rows.select(verify.access_failure(F.col("m"), F.col("s")).alias("x")).first()["x"] is failure


def test_decision_tables(spark):
    worst = lambda a, b, c: fusion.worst(F.array(a, b, c), verify.SEVERITY)
    assert one(spark, worst, "OK", "check", "OK (redirect)") == "check"
    assert one(spark, worst, "OK", "NG", "check") == "NG"
    assert one(spark, verify.with_human, "NG", "OK") == "OK (human)"


def test_near_same(spark):
    page = "\n".join("abcde")
    same = lambda a, b: extract.near_same(F.split(a, "\n"), F.split(b, "\n"))
    assert one(spark, same, page, page + "\nf") is True
    assert one(spark, same, page, "x\ny") is False
