"""Inputs with explicit schemas: entities, progress, snapshots, robots, reviews, registry files, archives."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import trimmed

EVIDENCE = "entity_key string, seq long, field string, value_str string, value_num long, value_bool boolean, source string, url string, snippet string, at timestamp"
ENTITY = (
    "key string, name string, officialUrl string, domain string, sources array<struct<source string, url string>>, "
    "evidence array<struct<field string, value string, source string, url string, snippet string, at string>>, seedCategories array<string>, contactUrl string"
).replace("struct<source string, url string>", "struct<source: string, url: string>").replace(
    "struct<field string, value string, source string, url string, snippet string, at string>", "struct<field: string, value: string, source: string, url: string, snippet: string, at: string>"
)
SNAPSHOT = "url string, fetchedAt timestamp, status int, title string, text string, meta string, finalUrl string, jsonld array<string>, anchors array<struct<href: string, text: string>>"
ROBOTS = "origin string, fetchedAt timestamp, status string, text string, error string"
PROGRESS = "nextPage int, offset int, found int, exhausted boolean, failures int, lastError string, failedAt timestamp, runs int, lastAt timestamp"


def or_empty(spark: SparkSession, path: str, schema: str, read) -> DataFrame:
    """A missing file is an empty table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return read() if there is not None and len(there) else spark.createDataFrame([], schema)


def entities(spark: SparkSession, path: str) -> DataFrame:
    return or_empty(spark, path, ENTITY, lambda: spark.read.schema(ENTITY).json(path, multiLine=True))


def evidence_rows(stored: DataFrame) -> DataFrame:
    """Nested evidence as rows with their order; null and empty values are no evidence."""
    rows = stored.select(F.col("key").alias("entity_key"), F.posexplode("evidence").alias("seq", "e")).select("entity_key", "seq", "e.*")
    return rows.where("value IS NOT NULL AND value <> ''").withColumn("value_num", F.col("value").try_cast("bigint"))


def progress(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of records as rows (key, ...)."""
    empty = f"key string, {PROGRESS}"

    def read():
        whole = spark.read.text(path, wholetext=True)
        records = F.from_json("value", f"map<string, struct<{PROGRESS}>>")
        return whole.select(F.explode(records).alias("key", "r")).select("key", "r.*")

    return or_empty(spark, path, empty, read)


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).option("recursiveFileLookup", "true").json(path, multiLine=True)


def snapshot_key(url: Column) -> Column:
    """Where a snapshot is kept: the SHA-1 of its url, in folders of two digits."""
    digest = F.sha1(url)
    return F.concat(F.substring(digest, 1, 2), F.lit("/"), digest)


def memo_key(name: Column) -> Column:
    """Where the result of a fetch that no url names (a form search) is kept."""
    return snapshot_key(F.concat(F.lit("memo:"), name))


def memos(spark: SparkSession, path: str, names: DataFrame, schema: str) -> DataFrame:
    """Kept results (name, ...) of the names asked for; a name without one has no row."""
    files = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path, multiLine=True).select("*", F.regexp_extract(F.input_file_name(), "([0-9a-f]{40})\\.json$", 1).alias("_digest"))
    asked = names.select("name", F.element_at(F.split(memo_key(F.col("name")), "/"), -1).alias("_digest"))
    return asked.join(files, "_digest").drop("_digest")


def robots_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROBOTS).json(path, multiLine=True).withColumn("status_code", F.col("status").try_cast("int"))


def review_rows(spark: SparkSession, path: str) -> DataFrame:
    """Review CSV: quoted cells, doubled quotes, line breaks in cells, byte order mark; blank rows go, blanks are ''."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")
    names = [c.lstrip("﻿").strip() for c in raw.columns]
    clean = raw.toDF(*names).select(*[trimmed(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in names])
    return clean.where(F.concat_ws("", *[F.col(f"`{c}`") for c in names]) != "")


def csv_cells(line: Column, n: int) -> Column:
    """The cells of one CSV line."""
    return F.from_csv(line, ", ".join(f"c{i} string" for i in range(n)), {"quote": '"', "escape": '"'})


# How the header of the code list begins, and the member of an archive that holds an annual report's facts.
CODE_HEADERS = ("ＥＤＩＮＥＴコード", "EDINETコード")
REPORT_FOLDER, REPORT_NAME = "xbrl_to_csv/", "jpcrp030000-asr-"


def code_list(spark: SparkSession, path: str, charset: str = "Shift_JIS") -> DataFrame:
    """Registry codes: the rows behind the header, wherever it stands, with a code E and five digits; a file without a header has none."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    decoded = files.mapInArrow(_decoded(charset), "path string, text string")
    lines = decoded.select("path", F.filter(F.split("text", "\r?\n"), lambda x: x != "").alias("lines"))
    heads = F.transform("lines", lambda x: F.contains(x, F.lit(CODE_HEADERS[0])) | F.startswith(x, F.lit(CODE_HEADERS[1])))
    found = lines.select("path", "lines", F.array_position(heads, True).alias("head")).where("head > 0")
    rows = found.select("path", "head", F.posexplode("lines").alias("pos", "line")).where("pos >= head")
    c = csv_cells(F.col("line"), 13)
    picked = {"code": 0, "kind": 1, "listed": 2, "consolidated": 3, "fiscalEnd": 5, "name": 6, "address": 9, "industry": 10, "secCode": 11}
    return rows.withColumn("c", c).select("pos", *[F.col(f"c.c{i}").alias(n) for n, i in picked.items()]).where(F.col("code").rlike("^E[0-9]{5}$"))


def _decoded(charset: str):
    def run(batches):
        for b in batches:
            texts = [c.decode(charset, "replace") for c in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["path", "text"])

    return run


def facts(files: DataFrame, element: str, current: str, single: str) -> DataFrame:
    """Filing facts (path, content in UTF-16LE, tab-separated): the last current value and the first single one that reads."""
    text = F.decode("content", "UTF-16LE")
    rows = files.select("path", F.posexplode(F.split(text, "\r?\n")).alias("pos", "line"))
    cell = F.transform(F.split("line", "\t"), lambda x: F.regexp_replace(x, '^"|"$', ""))
    cells = rows.withColumn("c", cell).where(F.size("c") > 8).select("path", "pos", F.col("c")[0].alias("element"), F.col("c")[2].alias("context"), F.replace(F.col("c")[8], F.lit(","), F.lit("")).try_cast("bigint").alias("n"))
    mine = cells.where(F.regexp_replace("element", "^﻿", "") == element)
    return mine.groupBy("path").agg(
        F.max_by(F.when(F.col("context") == current, F.col("n")), F.when(F.col("context") == current, F.col("pos"))).alias("current"),
        F.min_by("n", F.when((F.col("context") == single) & F.col("n").isNotNull(), F.col("pos"))).alias("single"),
    )


def archive_members(files: DataFrame) -> DataFrame:
    """(path, member, content) of ZIP archives (stored or deflated); folders are left out."""

    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        if info.is_dir():
                            continue
                        if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                            raise ValueError(f"{info.filename}: compression method {info.compress_type}")
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([info.filename]), pa.array([z.read(info)], pa.binary())], ["path", "member", "content"])

    return files.select("path", "content").mapInArrow(run, "path string, member string, content binary")


def report_members(members: DataFrame) -> DataFrame:
    """Of every archive (path, member, content) the first member, by its place in the archive, that holds an annual report's facts."""
    name = F.lower("member")
    at = F.instr(name, REPORT_FOLDER + REPORT_NAME)
    fits = members.withColumn("_at", F.monotonically_increasing_id()).where((at > 0) & F.endswith(name, F.lit(".csv")))
    return fits.groupBy("path").agg(F.min_by(F.struct("member", "content"), "_at").alias("_m")).select("path", "_m.*")


def choose_headcount(single: Column, consolidated: Column, has_group: Column) -> Column:
    """struct(value, scope, group): the company alone before its group; the group's number where it differs."""
    other = F.when(has_group & (consolidated != single), consolidated)
    return F.when(single.isNotNull(), F.struct(single.alias("value"), F.lit("single").alias("scope"), other.alias("group"))).when(
        consolidated.isNotNull(), F.struct(consolidated.alias("value"), F.when(has_group, "group").otherwise("single").alias("scope"), F.lit(None).cast("bigint").alias("group"))
    )


def annual_reports(listing: DataFrame, *more: str) -> DataFrame:
    """Annual reports of companies that were not withdrawn, slimmed to five fields (and ``more`` columns of the listing)."""
    # The codes of an annual report in the listing.
    kept = listing.where("docTypeCode = '120' AND formCode = '030000' AND ordinanceCode = '010' AND coalesce(withdrawalStatus, '0') = '0' AND edinetCode IS NOT NULL")
    return kept.select("docID", "edinetCode", "secCode", "periodEnd", "submitDateTime", *more)


def latest_reports(reports: DataFrame, seq: str) -> DataFrame:
    """The newest report of each company by period and time of filing, as text; ties to the first."""
    w = Window.partitionBy("edinetCode").orderBy(F.desc(F.concat_ws("|", F.coalesce("periodEnd", F.lit("")), F.coalesce("submitDateTime", F.lit("")))), seq)
    return reports.withColumn("_at", F.row_number().over(w)).where("_at = 1").drop("_at")


def newest(reports: DataFrame) -> DataFrame:
    """The newest report of each company by period and time of filing, then by its id: a maximum, so it can be kept up by merging."""
    rest = [c for c in reports.columns if c != "edinetCode"]
    place = F.struct(F.concat_ws("|", F.coalesce("periodEnd", F.lit("")), F.coalesce("submitDateTime", F.lit(""))), F.col("docID"))
    return reports.groupBy("edinetCode").agg(F.max_by(F.struct(*rest), place).alias("_r")).select("edinetCode", "_r.*").select(reports.columns)
