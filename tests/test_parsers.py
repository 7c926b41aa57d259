"""Every source's list and detail pages: small pages of their shape, and what they must give."""

import pytest

from factloom.functions import geo, text
from factloom.sources import parsers

PAGE = "url string, title string, text string, anchors array<struct<href:string,text:string>>"


def read(spark, kind, source, body="", anchors=(), title="t"):
    page = spark.createDataFrame([("u", title, body, [tuple(a) for a in anchors])], PAGE)
    return [{k: v for k, v in r.asDict().items() if v is not None and k not in ("url", "pos")} for r in getattr(parsers, kind)(page, source).collect()]


LISTS = {
    "agencyhub": ("詳細\n株式会社甲\n説明\n広告\nSNS\n東京\n20-49名\n詳細を見る\n個人\nx\ny\nz\n詳細を見る\n乙有限会社\nd\nt\np\n１００名以上\n詳細を見る", (), [("株式会社甲", 20), ("乙有限会社", 100)], ("name", "employees")),
    "article": ("目次\n1. 甲社（株式会社甲）\n甲社は東京の会社。\n乙とは\n乙とはは何か\n第2位 丙社\n本文\n丙社が強い\n東京都\n東京都の話", (), [("株式会社甲",), ("丙社",)], ("name",)),
    "aspic": ("", [("https://www.aspicjapan.org/asu/service/12?x=1", "A"), ("https://www.aspicjapan.org/asu/service/12", "B"), ("https://other/12", "C")], [("https://www.aspicjapan.org/asu/service/12",)], ("ref",)),
    "boxil": ("サービスA\n株式会社甲\nサービスB\nx\ny\nz\n株式会社乙", [("https://boxil.jp/service/1/", "サービスA\n詳細"), ("https://boxil.jp/service/2/", "サービスB")], [("株式会社甲", "サービスA")], ("name", "profile")),
    "buzztan": ("ブランド\n説明\n項目\t内容\n運営会社\t株式会社甲\n所在地\t東京都港区1\n公式URL\thttps://a.jp/、他\n運営会社\t乙\n所在地\t大阪府大阪市", (), [("株式会社甲", "東京都港区1", "https://a.jp/", "ブランド 説明")], ("name", "address", "official_url", "profile")),
    "digitre": ("", [("https://www.digi-tre.com/company/a-b/", "甲社\nx"), ("https://www.digi-tre.com/company/c/", "")], [("甲社", "https://www.digi-tre.com/company/a-b/")], ("name", "ref")),
    "engage": ("募集\n株式会社甲 / 営業\n給与\n東京都港区\n乙 / 事務\n大阪府", (), [("株式会社甲", "募集 営業", "東京都港区")], ("name", "job", "place")),
    "green": ("", [("https://x/company/7/job/1", "New\n甲社\n1,200人\n2001年設立\n東京都"), ("https://x/company/8/job/1", "乙社\n5人")], [("甲社", 1200, "2001年設立", "https://www.green-japan.com/company/7")], ("name", "employees", "founded", "ref")),
    "grip": ("", [("https://grip-space.co.jp/ad-db/company/3/", "甲社"), ("https://grip-space.co.jp/ad-db/company/4", "")], [("甲社", "https://grip-space.co.jp/ad-db/company/3")], ("name", "ref")),
    "hikakubiz": ("企業を選択する\n甲社\n特色\n東京都港区\n対応業務\nSNS\n特徴\nf1\nf2\n企業を選択する\n乙社", [("https://www.biz.ne.jp/company/form/", ""), ("https://www.biz.ne.jp/company/ko/", "")], [("甲社", "東京都港区", "SNS f1 / f2", "https://www.biz.ne.jp/company/ko/"), ("乙社", None, "", None)], ("name", "address", "profile", "ref")),
    "houjingoo": ("検索結果 2件中\n株式会社甲\n本社東京・従業員１２名\n東京都港区芝 求人募集中 x\n更新日：1\n名なし\n更新日：2", (), [("株式会社甲", "東京都港区芝", 12)], ("name", "address", "employees")),
    "imitsu": ("", [("https://imitsu.jp/ct-a/pr-tokyo/ci-b/supplier/5#x", ""), ("https://imitsu.jp/ct-a/pr-osaka/ci-b/supplier/6", "")], [("https://imitsu.jp/ct-a/pr-tokyo/ci-b/supplier/5",)], ("ref",)),
    "jaro": ("前\n化粧品 (2社)\n株式会社甲\n個人\n食品（1社）\n乙有限会社", (), [("株式会社甲", "化粧品"), ("乙有限会社", "食品")], ("name", "profile")),
    "jcia": ("株式会社甲\t1000001\t東京都港区\t03\thttps://a.jp\n株式会社乙\t5300001\t大阪府\t06\t-", (), [("株式会社甲", "東京都港区", "https://a.jp")], ("name", "address", "official_url")),
    "kyujinbox": ("営業職\n株式会社甲\n東京都 港区\n事務\n個人\n東京都 港区\n別\n株式会社甲\n大阪府 北区", (), [("株式会社甲", "営業職", "東京都 港区")], ("name", "job", "place")),
    "stanby": ("営業職\n株式会社甲\n港区\n事務\n株式会社乙／支店\n港区", (), [("株式会社甲", "営業職", "港区")], ("name", "job", "place")),
    "meetsmore": ("", [("https://meetsmore.com/products/a?x", "製品A"), ("https://meetsmore.com/products/a", "again")], [("製品A", "https://meetsmore.com/products/a")], ("name", "ref")),
    "pitact": ("甲社\n更新日:1\n法人番号\n12\n住所\n東京都港区\n従業員数\n３人\n乙社\n更新日:2\n住所\n--", (), [("甲社", "東京都港区", 3, "12"), ("乙社", None, None, None)], ("name", "address", "employees", "note")),
    "prtimes": ("", [("https://prtimes.jp/main/html/searchrlp/company_id/9", "甲社\nx")], [("甲社", "https://prtimes.jp/main/html/searchrlp/company_id/9")], ("name", "ref")),
    "salesnow": ("", [("https://salesnow.jp/db/companies/ab12", "甲社\nx"), ("https://salesnow.jp/db/companies/AB/x", "乙")], [("甲社", "https://salesnow.jp/db/companies/ab12")], ("name", "ref")),
    "slidelib": ("甲社（株式会社甲）\n甲社は強い\nサービスサイトへ\n乙社\n引用：x\n本文\nサービスサイトへ\n丙社\n引用：y", [("https://a", "サービスサイトへ"), ("https://b", "サービスサイトへ")], [("株式会社甲", "https://a"), ("乙社", "https://b")], ("name", "official_url")),
    "wantedly": ("", [("https://www.wantedly.com/companies/a", "甲社\nx"), ("https://www.wantedly.com/projects/1", "NEW\n募集A\n3 entries"), ("https://www.wantedly.com/companies/b", "")], [("甲社", "募集A")], ("name", "job")),
    "webkanji": ("", [("https://web-kanji.com/companies/search", "x"), ("https://web-kanji.com/companies/ko", "甲社")], [("甲社", "https://web-kanji.com/companies/ko")], ("name", "ref")),
    "gbizinfo": ("株式会社甲\n\t東京都港区\t2001年\tx\t1,200人\ty\n乙\n\t-\t-\tx\t-\ty", (), [("株式会社甲", "東京都港区", 1200, "2001年"), ("乙", None, None, None)], ("name", "address", "employees", "founded")),
    "mynavi": ("甲社\n業　種 広告\n本　社 東京都\n従業員 100名\n", [("https://job.mynavi.jp/corp12/outline.html?x", "甲 社")], [("甲社", "東京都", "100名", "https://job.mynavi.jp/corp12/outline.html")], ("name", "place", "note", "ref")),
    "careertasu": ("", [("https://job.career-tasu.jp/corp/5/default/", "東京都港区\n甲社"), ("https://job.career-tasu.jp/corp/6/default/", "乙")], [("甲社", "東京都", "https://job.career-tasu.jp/corp/5/detail-uc/")], ("name", "place", "ref")),
    "openwork": ("", [("https://www.openwork.jp/company.php?m_id=ab", "甲社\n点数")], [("甲社", "https://www.openwork.jp/company.php?m_id=ab")], ("name", "ref")),
    "digimado": ("", [("https://digi-mado.jp/products/0123456789abcdef0123/", "x")], [("https://digi-mado.jp/products/0123456789abcdef0123/",)], ("ref",)),
}

DETAILS = {
    "aspic": ("SNS運用ツール\nサービス概要\n便利\nです\n会社名\t甲社\n所在地\t〒100-0001 東京都港区", (), {"name": "甲社", "address": "東京都港区"}),
    "boxil": ("サービス概要\n便利", [("https://boxil.jp/x", ""), ("https://a.jp/", ""), ("https://smartcamp.co.jp", ""), ("https://b.jp", "")], {"official_url": "https://a.jp/", "profile": "便利"}),
    "digimado": ("前\n運営企業情報\n商号\n株式会社甲\n本社\n東京都港区\n1-2\nURL\nhttps://a\nこの記事を共有する\n商号\n乙", [("https://digi-mado.jp", ""), ("https://a.jp/", "")], {"name": "株式会社甲", "address": "東京都港区 1-2", "official_url": "https://a.jp/"}),
    "digitre": ("会社名\n甲社（Ko Inc）\n所在地\n大阪支社\n本社\n〒100-0001\n東京都港区\n代表\n山田\n事業内容\n広告\n会社案内\n良い\n会社", (), {"name": "甲社", "address": "東京都港区", "profile": "広告 良い 会社"}),
    "green": ("企業情報\n会社名\n甲社\n従業員数\n1,234人（連結）\n本社住所\n東京都港区\nこの企業と同じ業界\n会社名\n乙", (), {"name": "甲社", "employees": 1234, "address": "東京都港区"}),
    "grip": ("会社名\t甲社\n所在地\t東京都\n従業員数\t５０名\n公式サイト\thttps://a.jp\n会社について\t良い\n会社\n\n後", (), {"name": "甲社", "employees": 50, "official_url": "https://a.jp", "profile": "良い 会社"}),
    "hikakubiz": ("", [("https://www.google.co.jp/maps", ""), ("https://a.jp/", "")], {"official_url": "https://a.jp/"}),
    "imitsu": ("甲の会社情報\n会社名\n甲社_123456\n住所\n東京都\n会社URL\nhttps://a.jp\n甲が紹介されている記事", (), {"name": "甲社", "address": "東京都", "official_url": "https://a.jp"}),
    "meetsmore": ("製品\n株株式会社甲（ko inc.）\n製品URL\nhttps://a.jp/x", (), {"name": "株式会社甲", "official_url": "https://a.jp/x"}),
    "prtimes": ("基本情報\n業種\n広告\n本社所在地\n東京都\nURL\nhttps://a.jp\n詳細情報", (), {"address": "東京都", "official_url": "https://a.jp", "profile": "広告"}),
    "salesnow": ("ホームページ\nhttps://a.jp\n住所（登記所在地）\n東京都港区\n正社員規模（推定）\n1,200名\n業歴 (設立年月)\n10年(2010年1月設立)", (), {"official_url": "https://a.jp", "address": "東京都港区", "employees": 1200, "founded": "2010年1月"}),
    "wantedly": ("前\n会社情報\n〒105-0014 東京都港区芝1\nhttps://a.jp\n2010/1 に設立\n12人のメンバー", (), {"address": "東京都港区芝1", "official_url": "https://a.jp", "members": 12, "founded": "2010/1"}),
    "webkanji": ("特徴\nf1\nf2", [("https://web-kanji.com/x", ""), ("https://ec-kanji.com/x", ""), ("https://a.jp", "")], {"official_url": "https://a.jp", "profile": "f1 / f2"}),
    "mynavi": ("本社所在地 東京都  港区\n従業員 連結 1,200名\n設立 2001年", (), {"address": "東京都 港区", "employees": 1200, "founded": "2001年"}),
    "careertasu": ("本社所在地1\n東京都\n従業員数\n３００名（単体）\n設立\n2001年", (), {"address": "東京都", "employees": 300, "founded": "2001年"}),
    "openwork": ("企業情報\n業界\n広告\nURL\nhttps://a.jp\n所在地\n東京都\n社員数\n100〜499人", (), {"official_url": "https://a.jp", "address": "東京都", "employees": 100, "profile": "広告"}),
}


def test_every_source_is_read():
    assert set(LISTS) == set(parsers.LISTS) and set(DETAILS) == set(parsers.DETAILS)


@pytest.mark.parametrize("source", sorted(LISTS))
def test_lists(spark, source):
    body, anchors, want, fields = LISTS[source]
    got = [tuple(r.get(f) for f in fields) for r in read(spark, "listed", source, body, anchors)]
    assert got == [tuple(v or None for v in w) for w in want]


@pytest.mark.parametrize("source", sorted(DETAILS))
def test_details(spark, source):
    body, anchors, want = DETAILS[source]
    (got,) = read(spark, "detailed", source, body, anchors)
    assert {k: got.get(k) for k in want} == want


def test_totals(spark):
    pages = spark.createDataFrame([("a", "検索結果約1,234件中"), ("b", "なし")], "url string, text string")
    assert [(r["total"], r["pages"]) for r in parsers.totals(pages, *parsers.TOTALS["salesnow"]).collect()] == [(1234, 25), (None, 1)]


@pytest.mark.parametrize(("said", "want"), [
    ("本社所在地 | 〒100-0001 東京都港区芝1-2-3 TEL 03", ("東京都港区芝1-2-3", True)), ("本社：大阪府大阪市北区1", ("大阪府大阪市北区1", True)), ("〒530-0001 大阪府大阪市 | x", ("大阪府大阪市", False)), ("東京都", None)])
def test_address(spark, said, want):
    got = spark.createDataFrame([(said,)], "s string").select(geo.address(text.nfkc("s")).alias("a")).first()["a"]
    assert (got and tuple(got)) == want
