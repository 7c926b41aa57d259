"""Stores that outlive a run: versioned tables, page snapshots by digest, the daily listing.

Nothing is overwritten.  A table is a folder of generations and a folder of pointers; a new
generation is written in full before a pointer to it appears, so what was read from the
table can be used to replace it, and a run that dies between the two leaves the old state.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.folders import new_folder
from ..operators import workset
from . import readers


class Files:
    """The few file operations that a store needs, in any file system that Spark reaches."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def names(self, folder: str) -> list[str]:
        p, fs = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def put(self, path: str, text: str) -> None:
        """A file that appears whole or not at all; an error if it is there."""
        p, fs = self._at(path)
        if fs.exists(p):
            raise FileExistsError(path)
        fresh = self.jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        out = fs.create(fresh, False)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(fresh, p):
            fs.delete(fresh, False)
            raise FileExistsError(path)

    def text(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        size = fs.getFileStatus(p).getLen()
        body = bytes(stream.readNBytes(size))
        stream.close()
        return body.decode()

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)


class VersionedTable:
    """Rows of one schema that are replaced as a whole or merged by key.

    Two writers that started from one generation can't both switch: the second finds the pointer taken and fails.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def generation(self) -> int:
        """The newest generation that a pointer names; 0 for none."""
        found = [n for n in self.files.names(f"{self.path}/pointers") if n.isdigit()]
        return int(found[-1]) if found else 0

    def read(self, generation: int | None = None) -> DataFrame:
        at = self.generation() if generation is None else generation
        if not at:
            return self.spark.createDataFrame([], self.schema)
        folder = self.files.text(f"{self.path}/pointers/{at:012d}")
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")

    def write(self, rows: DataFrame) -> str:
        """A new generation, which nobody sees yet; gives its folder."""
        folder = f"generation-{uuid.uuid4().hex}"
        rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.parquet(f"{self.path}/{folder}")
        return folder

    def switch(self, folder: str, since: int) -> None:
        """From now on ``folder`` is the table, if no one else has switched since generation ``since``."""
        self.files.put(f"{self.path}/pointers/{since + 1:012d}", folder)

    def replace(self, rows: DataFrame) -> None:
        since = self.generation()
        self.switch(self.write(rows), since)

    def merge(self, rows: DataFrame, keys: list[str]) -> None:
        """``rows`` take the place of the stored rows with their keys; of several with one key the largest row stays."""
        since = self.generation()
        names = [f.name for f in self.schema.fields]
        rest = [F.col(c) for c in names if c not in keys]
        one = rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(*keys, "_row.*").select(names) if rest else rows.select(keys).distinct()
        left = self.read(since).join(one.select([F.col(k).alias(f"_{k}") for k in keys]), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti")
        self.switch(self.write(left.unionByName(one)), since)

    def vacuum(self) -> None:
        """Drop all but the newest generation, and generations that were never switched to."""
        at = self.generation()
        if not at:
            return
        kept = self.files.text(f"{self.path}/pointers/{at:012d}")
        for name in self.files.names(f"{self.path}/pointers"):
            if name.isdigit() and int(name) < at:
                self.files.delete(f"{self.path}/pointers/{name}")
        for name in self.files.names(self.path):
            if name.startswith("generation-") and name != kept:
                self.files.delete(f"{self.path}/{name}")


class SnapshotStore:
    """Pages by the digest of their address, in 256 partitions by its first two digits; looked up before anything is fetched.

    ``keys`` tell snapshots apart: the address, and what else it takes where an address holds several pages.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str] = ("url",)):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)
        self.keys = list(keys)
        self.schema = StructType.fromDDL(f"digest string, {schema}, digits string")
        self.columns = [f.name for f in self.schema.fields][1:-1]

    @staticmethod
    def keyed(urls: DataFrame, column: str = "url") -> DataFrame:
        return urls.withColumn("digest", F.sha1(column)).withColumn("digits", F.substring("digest", 1, 2))

    def stored(self) -> DataFrame:
        if not any(n.startswith("digits=") for n in self.files.names(self.path)):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def add(self, snapshots: DataFrame) -> None:
        """Append snapshots (url, ...); rows are dealt by their digits, so a run adds one file a partition."""
        rows = self.keyed(snapshots)
        rows.select("digest", *self.columns, "digits").repartition("digits").write.mode("append").partitionBy("digits").parquet(self.path)

    def lookup(self, urls: DataFrame) -> DataFrame:
        """Stored snapshots of the asked ``urls`` (their keys), the newest of each; only partitions of digits that are asked for are read."""
        others = [k for k in self.keys if k != "url"]
        asked = self.keyed(urls.select(self.keys).distinct()).select(F.col("digest").alias("_digest"), F.col("digits").alias("_digits"), *[F.col(k).alias(f"_{k}") for k in others])
        digits = [r[0] for r in asked.select("_digits").distinct().collect()]  # 256 at most
        same = [F.col("digits") == F.col("_digits"), F.col("digest") == F.col("_digest"), *[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in others]]
        found = self.stored().where(F.col("digits").isin(digits)).join(asked, same, "left_semi")
        if "fetchedAt" not in self.columns:
            return found.select(self.columns).dropDuplicates(self.keys)
        return found.groupBy(*self.keys).agg(F.max_by(F.struct(*self.columns), "fetchedAt").alias("_s")).select("_s.*")

    def through(self, urls: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Snapshots of ``urls`` (their keys), from the store where they are there; misses are fetched and added first.  ``cached`` tells which."""
        own = [F.col(k).alias(f"_{k}") for k in self.keys]
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        had = self.lookup(urls).select(*own, F.lit(True).alias("_had"))
        path = new_folder(self.spark, "snapshots-asked")
        marked = urls.select(self.keys).distinct().join(had, same, "left").select(*self.keys, F.col("_had").isNotNull().alias("cached"))
        marked.write.parquet(path)
        marked = self.spark.read.schema(marked.schema).parquet(path)
        misses = marked.where("NOT cached").select(self.keys)
        if misses.limit(1).count():
            self.add(fetch(misses))
        return self.lookup(urls).join(marked.select(*own, "cached"), same).drop(*[f"_{k}" for k in self.keys])


class DailyListing:
    """Filings by day, each past day read once; and the latest filing of every company, kept up by what is new."""

    REPORT = "docID string, edinetCode string, secCode string, periodEnd string, submitDateTime string, day date"

    def __init__(self, spark: SparkSession, path: str, window: int = 400):
        self.spark, self.path, self.window, self.files = spark, path.rstrip("/"), window, Files(spark)
        self.days = VersionedTable(spark, f"{self.path}/days", "day date")
        self.latest = VersionedTable(spark, f"{self.path}/latest", self.REPORT)

    def reports(self, days: DataFrame | None = None) -> DataFrame:
        if not any(n.startswith("day=") for n in self.files.names(f"{self.path}/reports")):
            return self.spark.createDataFrame([], self.REPORT)
        rows = self.spark.read.schema(self.REPORT).parquet(f"{self.path}/reports")
        return rows if days is None else rows.join(F.broadcast(days.select("day")), "day", "left_semi")  # days of a window

    def asked(self, today: Column) -> DataFrame:
        """Weekdays of the window that are to be read: those never read, and today, which is not over."""
        one = self.spark.range(1).select(today.cast("date").alias("today"))
        days = workset.weekdays(one, "today", self.window + 1)
        return days.join(self.days.read().withColumnRenamed("day", "_day"), F.col("day") == F.col("_day"), "left_anti")

    def refresh(self, today: Column, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The latest report of every company within the window, after reading what is missing.

        ``fetch`` gives the listing (day, and its columns) of the days asked for.  Past days are stored and never asked for again.
        A company whose latest report has left the window is looked up anew among the stored days; no one else is.
        """
        asked_path, fresh_path = new_folder(self.spark, "listing-days"), new_folder(self.spark, "listing-fresh")
        self.asked(today).write.parquet(asked_path)
        asked = self.spark.read.schema("day date").parquet(asked_path)
        listing = fetch(asked)
        readers.annual_reports(listing, "day").write.parquet(fresh_path)
        fresh = self.spark.read.schema(self.REPORT).parquet(fresh_path)
        past = F.col("day") < today.cast("date")
        fresh.where(past).repartition("day").write.mode("append").partitionBy("day").parquet(f"{self.path}/reports")
        start = F.date_sub(today.cast("date"), self.window)
        old = self.latest.read()
        gone = old.where(F.col("day") < start).select(F.col("edinetCode").alias("_code"))
        again = self.reports().where(F.col("day") >= start).join(gone, F.col("edinetCode") == F.col("_code"), "left_semi")
        known = old.where(F.col("day") >= start).unionByName(again).unionByName(fresh.where(past)).distinct()
        self.latest.replace(readers.newest(known))
        self.days.replace(self.days.read().unionByName(asked.where(past)).where(F.col("day") >= start).distinct())
        return readers.newest(self.latest.read().unionByName(fresh.where(~past)))
