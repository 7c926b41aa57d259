from factloom.operators import config, consolidate

EVIDENCE = "entity_key string, seq long, field string, value string, source string, url string, snippet string"


def test_records(spark):
    ents = spark.createDataFrame([(k, k, [("boxil", "u"), ("green", "u")]) for k in "abcd"], "key string, name string, sources array<struct<source: string, url: string>>")
    rows = [
        ("a", 0, "address", "〒105-0001 東京都港区", "official"), ("a", 1, "employees", "50", "official"), ("a", 2, "contactUrl", "https://a.jp/contact", "official"),
        ("a", 3, "officialUrl", "https://www.a.jp/", "boxil"), ("a", 4, "profileText", "スキンケアの公式通販", "official"), ("a", 5, "employees", "70", "green"), ("a", 6, "officialUrl", "https://b.jp", "green"),
        ("b", 0, "address", "大阪府大阪市", "official"), ("b", 1, "employees", "500", "official"),
        ("c", 0, "address", "東京都港区", "official"), ("c", 1, "employees", "18", "salesnow"),
        ("d", 0, "address", "東京都港区", "official"), ("d", 1, "address", "大阪府大阪市", "green"), ("d", 2, "employees", "90", "green"),
    ]
    ev = spark.createDataFrame([(*r, "u", "2024年4月現在") for r in rows], EVIDENCE)
    got = {r["entity_key"]: r for r in consolidate.consolidate(ents, ev).collect()}
    a = got["a"]
    assert (a["status"], a["employees"], a["tokyo"], a["official_url"], a["missing"]) == ("OK", 50, True, "https://www.a.jp/", [])
    assert a["listed_by"] == ["boxil"] and a["categories"] == ["化粧品D2C/P2C"] and any("70" in n for n in a["notes"]) and any("b.jp" in n for n in a["notes"])
    assert got["b"]["status"] == config.STATUS["excluded"] and got["b"]["emp20"] is True
    assert got["c"]["emp20"] is None and config.ITEMS["estimate"] in got["c"]["missing"]
    assert got["d"]["employees"] is None and got["d"]["status"] == config.STATUS["check"]
    records = consolidate.consolidate(ents, ev)
    assert [tuple(r) for r in consolidate.passing_by_category(records).collect()] == [("化粧品D2C/P2C", 1)]
    assert [r["entity_key"] for r in consolidate.sample(records).collect()] == ["a"]
