"""One ordered text file, as a data source: tasks write parts, the commit puts them behind the header.

A report is read by people, from one file, with its header first and its rows in their
order.  Spark's own writers give one file a task in no stated order.  Here every task
streams its lines to a part of its own beside the target; the commit appends header and
parts in the order of their partitions (a sorted DataFrame's partitions are its order)
to a new file and then moves that into place, so a reader sees the old report or the new
one.  Parts of tasks that failed or ran twice are not in the commit and go with the
folder of parts.  Nothing is held in memory but one block of bytes.

    lines.write.format("ordered_lines").mode("overwrite").option("header", "a,b").save(path)

``path`` is a file in any file system that pyarrow reaches (file, hdfs, s3, gs) and that
tasks and driver share; ``write_lines`` takes a path without a scheme as Spark does.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of this package

BLOCK = 1 << 20
FORMAT = "ordered_lines"


def opened(path: str):
    """(file system, path in it) of a path or address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Part(WriterCommitMessage):
    partition: int
    path: str
    lines: int


class OrderedWriter(DataSourceWriter):
    def __init__(self, path: str, header: str | None):
        self.path, self.header = path.rstrip("/"), header
        folder, _, name = self.path.rpartition("/")
        self.parts = f"{folder}/.{name}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Part:
        from pyspark import TaskContext

        context = TaskContext.get()
        files, folder = opened(self.parts)
        files.create_dir(folder, recursive=True)
        path, lines = f"{folder}/{context.partitionId()}-{context.taskAttemptId()}", 0
        with files.open_output_stream(path) as out:
            for row in iterator:
                out.write((row[0] or "").encode() + b"\n")
                lines += 1
        return Part(context.partitionId(), path, lines)

    def commit(self, messages: list) -> None:
        files, target = opened(self.path)
        folder = opened(self.parts)[1]
        files.create_dir(folder, recursive=True)
        whole = f"{folder}/whole"
        with files.open_output_stream(whole) as out:
            if self.header is not None:
                out.write(self.header.encode() + b"\n")
            for part in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
                with files.open_input_stream(part.path) as lines:
                    while block := lines.read(BLOCK):
                        out.write(block)
        if files.get_file_info(target).type.name == "Directory":
            files.delete_dir(target)
        files.move(whole, target)
        files.delete_dir(folder)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        files, folder = opened(self.parts)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)


class OrderedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> OrderedWriter:
        return OrderedWriter(self.options["path"], self.options.get("header"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(OrderedLines)


def write_lines(lines: DataFrame, path: str, header: str | None = None) -> None:
    """The one text column of ``lines``, in its order, as one file behind ``header``."""
    spark = lines.sparkSession
    register(spark)
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path = named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(named).toString()
    path = path.removeprefix("file:") if path.startswith("file:/") else path
    writer = lines.write.format(FORMAT).mode("overwrite")
    (writer if header is None else writer.option("header", header)).save(path)
