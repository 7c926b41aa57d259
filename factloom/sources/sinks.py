"""Reports: CSV with a byte order mark, JSON, state."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import csv_cell
from ..operators import checks, config, consolidate, review
from . import ordered, stores


MARK = "\ufeff"


def csv_lines(rows: DataFrame) -> DataFrame:
    """A CSV line for each row, in the order the rows have."""
    return rows.select(F.concat_ws(",", *[csv_cell(F.col(f"`{c}`").cast("string")) for c in rows.columns]).alias("value"))


def write_sheet(rows: DataFrame, path: str) -> None:
    """A sheet as one CSV file: byte order mark and header, then the rows in the order they have."""
    ordered.write_lines(csv_lines(rows), path, MARK + ",".join(rows.columns))


def write_report(rows: DataFrame, path: str, columns: list[str], order: list[Column]) -> None:
    """``columns`` of ``rows`` as a sheet, by ``order``."""
    write_sheet(rows.orderBy(*order).select(*columns), path)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_state(rows: DataFrame, path: str) -> None:
    """Replace a versioned table by ``rows``, which may have been read from it."""
    stores.VersionedTable(rows.sparkSession, path, rows.schema).replace(rows)


# ------------------------------------------------------------------ reports

# Report columns, in order, and how states and results are written.
FLAGS = ("未確認", "○", "×")
RESULTS = {"OK": "OK", "OK (redirect)": "OK（リダイレクト）", "OK (human)": "OK（人の確認）", "check": "要確認", "NG": "NG"}
RECORD_COLUMNS = [
    "企業名", "判定", "公式URL", "本社所在地", "東京都本社", "従業員数", "従業員数の時点", "20名以上", "カテゴリ", "カテゴリ根拠KW", "SNS運用代行の一覧に掲載", "問い合わせURL", "不足項目", "情報源",
    "所在地の根拠", "従業員数の根拠", "EDINETコード", "証券コード", "備考",
]
CHECK_COLUMNS = [
    "業種チェック", "従業員数チェック", "問い合わせURLチェック", "企業取り違えチェック", "チェックコメント", "確認後業種", "確認後従業員数", "従業員数確認時点", "確認後問い合わせURL", "企業特定URL", "検証日",
]
SEVERITY = {"OK": 0, "要確認": 1, "除外": 2}


def _flag(c: Column) -> Column:
    return F.when(c.isNull(), FLAGS[0]).when(c, FLAGS[1]).otherwise(FLAGS[2])


def _shown(result: Column) -> Column:
    out = result
    for key, label in RESULTS.items():
        out = F.when(result == key, F.lit(label)).otherwise(out)
    return out


def record_cells() -> list[Column]:
    """The record columns of consolidated records."""
    ground = lambda g, *parts: F.when(F.col(f"grounds.{g}.source").isNotNull(), F.concat(F.col(f"grounds.{g}.source"), F.lit(": "), *[p if isinstance(p, Column) else F.lit(p) for p in parts]))
    text_of = lambda g, c: F.coalesce(F.col(f"grounds.{g}.{c}"), F.lit(""))
    cells = [
        F.col("name"), F.col("status"), F.col("official_url"), F.col("address"), _flag(F.col("tokyo")), F.col("employees"), F.col("employees_as_of"), _flag(F.col("emp20")), F.array_join("categories", " / "),
        F.array_join("category_keywords", " / "), F.array_join("listed_by", " + "), F.col("contact_url"), F.array_join("missing", " / "), F.array_join("source_names", " + "), ground("address", text_of("address", "url")),
        ground("employees", text_of("employees", "snippet"), " (", text_of("employees", "url"), ")"), F.col("edinet_code"), F.col("securities_code"), F.array_join("notes", " ; "),
    ]
    return [c.cast("string").alias(n) for c, n in zip(cells, RECORD_COLUMNS)]


def check_cells(flat: str = "flat", day: str = "verified_at") -> list[Column]:
    """The check columns of flat checks."""
    f = lambda c, part: F.col(f"{flat}.{c}.{part}")
    said = F.concat_ws(" ／ ", *[F.concat(F.lit(f"{n}: "), F.coalesce(f(c, "comment"), F.lit(""))) for c, n in (("industry", "業種"), ("employees", "従業員数"), ("contact", "問い合わせURL"), ("identity", "企業特定"))])
    cells = [
        *[_shown(f(c, "result")) for c in ("industry", "employees", "contact", "identity")], F.when(F.col(flat).isNotNull(), said), f("industry", "after"), f("employees", "after"), f("employees", "as_of"),
        f("contact", "after"), f("identity", "after"), F.when(F.col(flat).isNotNull(), F.col(day)),
    ]
    return [c.cast("string").alias(n) for c, n in zip(cells, CHECK_COLUMNS)]


def report_order(status: str = "status") -> list[Column]:
    place = F.lit(9)
    for s, k in SEVERITY.items():
        place = F.when(F.col(status) == s, k).otherwise(place)
    return [place, F.collate("name", "ja"), F.col("entity_key")]


def all_records(records: DataFrame) -> DataFrame:
    """The whole report: record and check columns of records with checks, review and verified_at, worst category first."""
    rows = records.withColumn("flat", checks.flat(F.col("checks"), None, F.col("review")))
    return rows.orderBy(*report_order()).select(*record_cells(), *check_cells())


def samples(records: DataFrame, k: int = 15) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sample, rest, summary): of every category the best k records that pass all checks; those that do not; how many were picked.

    Best: most discovery sources, then the most reliable source of the headcount, then the name.
    """
    parts = []
    for key, label in config.LABELS.items():
        rows = records.where((F.col("status") == config.STATUS["OK"]) & F.array_contains("seeds", key) & F.array_contains("categories", label) & consolidate.within_size(key))
        rows = rows.withColumn("flat", checks.flat(F.col("checks"), key, F.col("review"))).withColumn("sample_category", F.lit(label)).withColumn("sample_key", F.lit(key))
        parts.append(rows)
    every = functools.reduce(DataFrame.unionByName, parts).withColumn("ok", checks.all_ok(F.col("flat")))
    reliability = F.lit(9)
    for source, place in config.RELIABILITY.items():
        reliability = F.when(F.col("employees_source") == source, place).otherwise(reliability)
    found = F.size(F.array_except("source_names", F.array(*[F.lit(s) for s in config.ENRICHING])))
    w = Window.partitionBy("sample_key").orderBy(F.desc(found), reliability, F.collate("name", "ja"), "entity_key")
    picked = every.where("ok").withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
    shown = lambda rows: rows.select(F.col("sample_category").alias("カテゴリ"), *record_cells(), *check_cells())
    summary = picked.groupBy("sample_category").agg(F.count("*").alias("picked"))
    return shown(picked.orderBy("sample_key", "place")), shown(every.where("NOT ok").orderBy("sample_key", *report_order())), summary


def review_sheet(queue_rows: DataFrame) -> DataFrame:
    """The review sheet: what is known, and empty cells for the reviewer's decisions and corrections."""
    ground = F.concat_ws(" ", F.concat(F.col("grounds.employees.source"), F.lit(":")), F.col("grounds.employees.snippet"), F.col("grounds.employees.url"))
    known = {
        review.COLUMNS["id"]: F.col("entity_key"), "企業名": F.col("name"), "カテゴリ": F.col("category"), review.COLUMNS["category"]: F.col("category_key"), "種別": F.col("kind"), "要確認の観点": F.col("points"),
        "理由": F.col("reason"), "公式URL": F.col("official_url"), "本社所在地": F.col("address"), "従業員数(現在)": F.col("employees"), "従業員数の根拠": ground, "問い合わせURL(現在)": F.col("contact_url"), "備考": F.array_join("notes", " ; "),
    }
    blank = [review.COLUMNS[c] for c in ("industry", "employees", "contact", "identity", "employees_value", "contact_value", "official_value", "note")]
    return review.ordered(queue_rows).select(*[c.cast("string").alias(n) for n, c in known.items()], *[F.lit("").alias(n) for n in blank])


def write_robots_report(report: DataFrame, path: str) -> None:
    """The robots report as a sheet: one line a source, its addresses that are not allowed in one cell."""
    closed = F.array_join(F.transform(F.filter("checks", lambda c: ~c["allowed"]), lambda c: c["url"]), " ; ")
    rows = report.select("source", "origin", "status", "error", "groups", "star_rules", F.coalesce(F.size("checks"), F.lit(0)).alias("checked"), closed.alias("disallowed"))
    write_report(rows, path, rows.columns, [F.col("source"), F.col("origin")])
