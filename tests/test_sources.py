import datetime as dt
import random
import zipfile

import pytest

from factloom.sources import readers, sinks
from factloom.streaming import progress as stream


def test_readers(spark, tmp_path):
    assert readers.entities(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "p.json").write_text('{"a|b|c": {"nextPage": 2, "found": 3, "exhausted": false}, "d": {"failures": 1}}')
    got = {r["key"]: r["nextPage"] for r in readers.progress(spark, str(tmp_path / "p.json")).collect()}
    assert got == {"a|b|c": 2, "d": None}
    (tmp_path / "e.json").write_text('[{"key": "k", "name": "n", "evidence": [{"field": "f", "value": "1"}, {"field": "g", "value": ""}]}]')
    rows = readers.evidence_rows(readers.entities(spark, str(tmp_path / "e.json"))).collect()
    assert [(r["entity_key"], r["seq"], r["value_num"]) for r in rows] == [("k", 0, 1)]
    (tmp_path / "r.csv").write_bytes('﻿id, note\r\na,"x ""y"", \nz"\r\n,\r\n'.encode())
    got = readers.review_rows(spark, str(tmp_path / "r.csv")).collect()
    assert [(r["id"], r["note"]) for r in got] == [("a", 'x "y", \nz')]


def test_registry_files(spark, tmp_path):
    line = "E00001,内国法人,上場,有,100,3月31日,\"甲,株式会社\",KO,コウ,東京都港区,小売業,12340,1"
    (tmp_path / "codes.csv").write_bytes(f"E99999,before\r\nmeta\r\nＥＤＩＮＥＴコード,提出者種別\r\n{line}\r\nX1,a\r\n".encode("shift_jis"))
    got = readers.code_list(spark, str(tmp_path / "codes.csv")).collect()
    assert [(r["code"], r["name"], r["address"]) for r in got] == [("E00001", "甲,株式会社", "東京都港区")]
    (tmp_path / "none.csv").write_bytes(line.encode("shift_jis"))
    assert readers.code_list(spark, str(tmp_path / "none.csv")).count() == 0
    named = [("a", "X/XBRL_TO_CSV/jpaud-x.csv"), ("a", "XBRL_TO_CSV/JPCRP030000-asr-1.csv"), ("a", "XBRL_TO_CSV/jpcrp030000-asr-2.csv"), ("b", "XBRL_TO_CSV/jpcrp030000-asr-1.txt")]
    members = spark.createDataFrame([(p, m, m.encode()) for p, m in named], "path string, member string, content binary").coalesce(1)
    assert [(r["path"], r["member"]) for r in readers.report_members(members).collect()] == [("a", "XBRL_TO_CSV/JPCRP030000-asr-1.csv")]
    rows = [["jp:N", "", "Cur", "", "", "", "", "", "1,786"], ["jp:N", "", "Single", "", "", "", "", "", "-"], ["jp:N", "", "Single", "", "", "", "", "", "568"]]
    tsv = "\n".join("\t".join(f'"{c}"' for c in r) for r in rows).encode("utf-16-le")
    with zipfile.ZipFile(tmp_path / "f.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x/facts.csv", tsv)
        z.writestr("empty/", b"")
    files = spark.read.format("binaryFile").load(str(tmp_path / "f.zip"))
    members = readers.archive_members(files)
    assert [r["member"] for r in members.collect()] == ["x/facts.csv"]
    facts = readers.facts(members.selectExpr("member AS path", "content"), "jp:N", "Cur", "Single").first()
    assert (facts["current"], facts["single"]) == (1786, 568)


def test_report(spark, tmp_path):
    rows = spark.createDataFrame([("b", 'say "x"'), ("a", "1,2")], "name string, said string")
    sinks.write_report(rows, str(tmp_path / "r.csv"), ["name", "said"], ["name"])
    assert (tmp_path / "r.csv").read_text(encoding="utf-8") == '\ufeffname,said\na,"1,2"\nb,"say ""x"""\n'


def test_report_of_many_partitions_keeps_its_order(spark, tmp_path):
    path = tmp_path / "r.csv"
    rows = spark.range(10_000).selectExpr("9999 - id AS n", "concat('x', id) AS t").repartition(7)
    for kept in (rows, rows.where("n < 5"), rows.limit(0)):  # a later report takes the place of an earlier one
        sinks.write_report(kept, str(path), ["n", "t"], ["n"])
        lines = path.read_text(encoding="utf-8").splitlines()
        assert lines[0] == "\ufeffn,t" and [int(x.split(",")[0]) for x in lines[1:]] == sorted(r["n"] for r in kept.collect())
        assert [p.name for p in tmp_path.iterdir()] == ["r.csv"]


def test_a_report_that_fails_leaves_the_old_one(spark, tmp_path):
    path = tmp_path / "r.csv"
    sinks.write_report(spark.range(3), str(path), ["id"], ["id"])
    with pytest.raises(Exception):
        sinks.write_report(spark.range(100).selectExpr("if(id = 77, raise_error('no'), id) AS id"), str(path), ["id"], ["id"])
    assert path.read_text(encoding="utf-8").splitlines()[1:] == ["0", "1", "2"] and [p.name for p in tmp_path.iterdir()] == ["r.csv"]


def test_json_and_robots_reports(spark, tmp_path):
    from factloom.operators import robots

    sinks.write_json(spark.createDataFrame([(1, "é")], "n int, t string"), str(tmp_path / "j"))
    assert [tuple(r) for r in spark.read.schema("n int, t string").json(str(tmp_path / "j")).collect()] == [(1, "é")]
    sites = spark.createDataFrame([("b", "https://b.jp"), ("a", "https://a.jp"), ("c", "https://c.jp")], "source string, origin string")
    files = spark.createDataFrame([("https://a.jp", "200", "User-agent: *\nDisallow: /x\nAllow: /x/y", None), ("https://b.jp", "error", None, "timeout")], "origin string, status string, text string, error string")
    used = spark.createDataFrame([("a", "https://a.jp/x/z"), ("a", "https://a.jp/x/y"), ("b", "https://b.jp/")], "source string, url string")
    sinks.write_robots_report(robots.report(files, used, sites), str(tmp_path / "r.csv"))
    lines = (tmp_path / "r.csv").read_text(encoding="utf-8").splitlines()
    assert lines == ["\ufeffsource,origin,status,error,groups,star_rules,checked,disallowed", "a,https://a.jp,200,,1,2,2,https://a.jp/x/z", "b,https://b.jp,error,timeout,0,0,1,https://b.jp/", "c,https://c.jp,error,,0,0,0,"]


def test_runs_one_by_one_all_at_once_and_as_a_stream(spark, tmp_path):
    """One rule: applied run by run, as aggregates, and over micro-batches."""
    from factloom.operators import progress

    rng, t = random.Random(2), dt.datetime(2024, 1, 1)
    schema = "key long, seq long, found int, errors array<string>, last_page int, at timestamp"
    runs = []
    for key in range(40):
        for seq in range(rng.randint(1, 9)):
            found = rng.choice([0, 0, 0, 3, 7]) if key % 3 else 0
            runs.append((key, seq, found, ["! HTTP 500", "x"] if rng.random() < 0.3 else [], rng.choice([None, seq, 0]), t + dt.timedelta(hours=seq)))
    want = {}
    for key, _, *run in sorted(runs, key=lambda r: r[:2]):
        want[key] = stream.step(want.get(key, stream.START), *run)
    batch = progress.fold(spark.createDataFrame(runs, schema)).select("key", *stream.FIELDS)
    assert {r["key"]: tuple(r)[1:] for r in batch.collect()} == want
    records = spark.createDataFrame([], f"key long, {stream.STATE}")
    for seq in range(9):
        records = spark.createDataFrame(progress.apply_runs(records, spark.createDataFrame([r for r in runs if r[1] == seq], schema).drop("seq")).select("key", *stream.FIELDS).collect(), f"key long, {stream.STATE}")
    assert {r["key"]: tuple(r)[1:] for r in records.collect()} == want
    for n in range(3):  # micro-batches
        spark.createDataFrame([r for r in runs if r[1] // 3 == n], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "runs"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "runs"))
    seen = {}
    keep = lambda df, _: seen.update({r["key"]: tuple(r)[1:] for r in df.collect()})
    q = stream.fold_stream(source).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert seen == want
