"""CSV inside ZIP files, inflated as a stream.

A Python data source has one partition for each archive, as ZIP can't be split. Its task opens the file
where it lies, inflates the only member bit by bit and sends the kept columns in Arrow batches, so
memory doesn't depend on the size of archive or member, and neither is ever one value of a row.
Where only Spark's own readers can open a path, the archive comes as one binary value (2 GB at most).
"""

from __future__ import annotations

import csv
import io
import json
import zipfile
from collections.abc import Iterator
from typing import IO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Rows of a batch that leaves the reader, and the bytes of text after which one leaves earlier.
BATCH_ROWS, BATCH_BYTES = 10_000, 4 << 20
#: What Python tasks can open themselves.
STREAMED = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def batches(archive: IO[bytes], name: str, wanted: dict) -> Iterator[pa.RecordBatch]:
    """The kept columns of an archive's only member. ``wanted`` holds places, names, delimiter, encoding, header
    and number; short rows are filled with empty values."""
    places, names = wanted["places"], wanted["names"]
    csv.field_size_limit(2**31 - 1)
    held: list[list[str]] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, pa.string()) for c in zip(*held, strict=True)], names)

    with zipfile.ZipFile(archive) as z:
        members = [n for n in z.namelist() if not n.endswith("/")]
        if len(members) != 1:
            raise ValueError(f"a ZIP source has one member: {name}")
        with z.open(members[0]) as raw, io.TextIOWrapper(raw, wanted["encoding"], newline="") as text:
            for n, row in enumerate(csv.reader(text, delimiter=wanted["delimiter"])):
                if not row or (wanted["header"] and n == 0):
                    continue
                kept = [row[i] if i < len(row) else "" for i in places]
                if wanted["number"]:
                    kept.append(f"{name}:{n + 1}")
                held.append(kept)
                size += sum(map(len, kept))
                if len(held) == BATCH_ROWS or size > BATCH_BYTES:
                    yield batch()
                    held, size = [], 0
    if held:
        yield batch()


class Archive(InputPartition):
    """One file: where it is and what it is called."""

    def __init__(self, uri: str):
        super().__init__(uri)

    @property
    def name(self) -> str:
        return unquote(self.value.rpartition("/")[2])


class ZippedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files, self.wanted = json.loads(options["files"]), json.loads(options["wanted"])

    def partitions(self) -> list[Archive]:
        return [Archive(f) for f in self.files]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(partition.value)
        with system.open_input_file(path) as archive:
            yield from batches(archive, partition.name, self.wanted)


class ZippedCsv(DataSource):
    """Format ``zipped_csv``; ``read_zipped_csv`` sets its options."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def reader(self, schema) -> ZippedReader:
        return ZippedReader(self.options)


def archives(spark: SparkSession, path: str) -> list[str]:
    """The files at a path (a file, a folder or a pattern), as whole addresses."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(context._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(where) or []:
        found += [s.getPath().toString() for s in (system.listStatus(status.getPath()) if status.isDirectory() else [status]) if s.isFile()]
    return sorted(f for f in found if not f.rpartition("/")[2].startswith(("_", ".")))


def _address(uri: str) -> str:
    """As Arrow reads it: blanks and accents encoded, local files with an empty host, s3a as s3."""
    scheme, _, rest = uri.partition(":")
    rest = quote(rest, safe="/:@")
    return f"file://{rest}" if scheme == "file" and not rest.startswith("//") else f"s3:{rest}" if scheme == "s3a" else uri


def read_zipped_csv(spark: SparkSession, path: str, columns: list[str], keep: list[str], delimiter: str = ";", encoding: str = "latin-1", header: bool = False, number: str | None = None) -> DataFrame:
    """CSV from ZIP files with one member each; only the kept columns leave the reader. ``header`` skips the first
    row; ``number`` names a column with the file's name and the row's place in it."""
    names = [*keep, *([number] if number else [])]
    wanted = {"places": [columns.index(c) for c in keep], "names": names, "delimiter": delimiter, "encoding": encoding, "header": header, "number": bool(number)}
    schema = ", ".join(f"{c} string" for c in names)
    found = archives(spark, path)
    if not found:
        raise FileNotFoundError(path)
    if all(f.partition(":")[0] in STREAMED for f in found):
        spark.dataSource.register(ZippedCsv)
        return spark.read.format("zipped_csv").schema(schema).option("files", json.dumps([_address(f) for f in found])).option("wanted", json.dumps(wanted)).load()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from batches(pa.BufferReader(content.as_buffer()), file, wanted)

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.mapInArrow(run, schema)
