"""Where jobs read and write: tables as Parquet folders below one root, layer by layer."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veraz.sources import buckets, files
from veraz.sources import tables as changes

SUMMARIES = "ops.resumos"


#: The partition column of tables that are laid out by the day of their change.
DAY = "_dia"


@dataclass(frozen=True)
class Store:
    """``root`` is a folder that the driver and all executors reach. One job writes at a time. Tables that
    are merged get ``buckets`` buckets when they are first written: some hundred megabytes each, and
    more than a change has keys, make a change cheap."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def path(self, table: str) -> str:
        changes.check_names(table)
        return f"{self.root}/{table.replace('.', '/')}"

    def exists(self, table: str) -> bool:
        changes.recover(self.spark, self.path(table))
        return changes.folder_exists(self.spark, self.path(table))

    def _schema_file(self, table: str):
        context = self.spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_schemas/{table}.json")
        return where, where.getFileSystem(context._jsc.hadoopConfiguration())

    def known_schema(self, table: str) -> T.StructType | None:
        """What was noted when the table was last written, so that reading it needn't look into every file."""
        where, system = self._schema_file(table)
        if not system.exists(where):
            return None
        lines = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream := system.open(where), "UTF-8")
        stream.close()
        return T.StructType.fromJson(json.loads(lines))

    def note_schema(self, table: str, schema: T.StructType) -> None:
        kept = [T.StructField(f.name, f.dataType) for f in schema if f.name != DAY and not f.name.startswith(buckets.PREFIX)]
        where, system = self._schema_file(table)
        stream = system.create(where, True)
        stream.write(bytearray(json.dumps(T.StructType(kept).jsonValue()), "utf-8"))
        stream.close()

    def _raw(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise LookupError(f"no table {table}")
        known = self.known_schema(table)
        reader = self.spark.read.schema(known) if known else self.spark.read.option("mergeSchema", True)
        return reader.parquet(self.path(table))

    def read(self, table: str, days: tuple[date, date] | None = None) -> DataFrame:
        """The table; columns that only some of its files have are null in the others. With ``days``, a table
        that is laid out by day gives those of its rows only, and only their files are read."""
        rows = self._raw(table)
        if days and DAY in rows.columns:
            rows = rows.where(F.col(DAY).between(*(F.lit(d) for d in days)))
        return buckets.plain(rows).drop(DAY)

    def in_buckets(self, table: str, n: int, numbers: list[int]) -> DataFrame:
        """The rows in some buckets of a table, of which alone the files are read."""
        return buckets.plain(buckets.only(self._raw(table), n, numbers))

    def append(self, table: str, rows: DataFrame, day_of: str | None = None) -> None:
        """Adds rows; new columns are null in older rows. ``day_of`` names the moment by whose day the table is
        laid out; it stays the same for all of its appends."""
        schema, known = rows.schema, self.known_schema(table)
        if known is None and self.exists(table):
            known = self._raw(table).schema
        for f in known or []:
            if f.name not in schema.names:
                schema = T.StructType([*schema, f])
            elif schema[f.name].dataType != f.dataType:
                raise ValueError(f"{table}.{f.name} is {f.dataType.simpleString()}")
        if day_of:
            rows.withColumn(DAY, files.day(day_of)).write.mode("append").partitionBy(DAY).parquet(self.path(table))
        else:
            rows.write.mode("append").parquet(self.path(table))
        self.note_schema(table, schema)

    def note(self, job: str, run_id: str, metrics: Mapping[str, object]) -> str:
        """What a job says at its end, one line of JSON, which is kept among the summaries too."""
        text = json.dumps({"job": job, "run_id": run_id, **metrics}, ensure_ascii=False, sort_keys=True, default=str)
        row = self.spark.createDataFrame([(job, run_id, text, datetime.now(UTC))], "job string, run_id string, resumo string, registrado_em timestamp")
        self.append(SUMMARIES, row.coalesce(1))
        return text

    def put(self, tables: Mapping[str, DataFrame]) -> None:
        """Replaces tables without a gate."""
        self.stage(tables).publish()

    def stage(self, tables: Mapping[str, DataFrame]) -> Staged:
        """Computes tables once and writes them beside their places."""
        staged = Staged(self)
        staged.add(tables)
        return staged


@dataclass(frozen=True)
class Staged:
    """Tables that are complete but not published yet, with the rows counted as they were written. ``partial``
    holds, for those of which only some buckets were written, how many buckets there are and which these are."""

    store: Store
    folders: dict[str, str] = field(default_factory=dict)
    schemas: dict[str, T.StructType] = field(default_factory=dict)
    partial: dict[str, tuple[int, list[int]]] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)

    def add(self, tables: Mapping[str, DataFrame]) -> None:
        for table, df in tables.items():
            self._write(table, df, df)

    def merge(self, table: str, source: DataFrame, key: str, moment: str, incremental: bool) -> None:
        """Stages the table with newer rows in the places of older ones: only the buckets that the source's keys
        fall in, where the table has buckets. The source is read twice, so it should be a staged table."""
        store, path, rows = self.store, self.store.path(table), source
        n = buckets.layout(store.spark, path) if incremental and store.exists(table) else None
        if n:
            self.partial[table] = n, buckets.touched(source, key, n)
            rows = changes.upsert_newer(store.in_buckets(table, *self.partial[table]), source, key, moment)
        elif incremental and store.exists(table):
            rows = changes.upsert_newer(store.read(table), source, key, moment)
        self._lay_out(table, rows, key, n or store.buckets)

    def lay_out(self, table: str, rows: DataFrame, key: str) -> None:
        """Stages a whole table in buckets of its key."""
        self._lay_out(table, rows, key, self.store.buckets)

    def replace_buckets(self, table: str, rows: DataFrame, key: str, n: int, numbers: list[int]) -> None:
        """Stages new contents of some buckets; those that no row falls in become empty."""
        self.partial[table] = n, numbers
        self._lay_out(table, rows, key, n)
        for b in numbers:
            changes.ensure_folder(self.store.spark, f"{self.folders[table]}/{buckets.folder(n, b)}")

    def _lay_out(self, table: str, rows: DataFrame, key: str, n: int) -> None:
        self._write(table, rows, buckets.laid_out(rows, key, n), f"{buckets.PREFIX}{n}")

    def _write(self, table: str, rows: DataFrame, written: DataFrame, by: str | None = None) -> None:
        self.folders[table], self.schemas[table] = f"{self.store.path(table)}.new-{uuid.uuid4().hex}", rows.schema
        self.counts[table] = changes.counted_write(written, self.folders[table], by)

    def staged(self, table: str) -> DataFrame:
        """The rows that were written here: a table, or its new buckets."""
        return buckets.plain(self.store.spark.read.schema(self.schemas[table]).parquet(self.folders[table]))

    def read(self, table: str) -> DataFrame:
        """The table as it will be once published."""
        new = self.staged(table)
        if table not in self.partial:
            return new
        rest = buckets.plain(buckets.only(self.store._raw(table), *self.partial[table], others=True))
        return rest.unionByName(new, allowMissingColumns=True)

    def publish(self, *tables: str) -> None:
        """Puts the tables (all by default) in their places together; if one can't be, the old ones stay."""
        chosen = tables or tuple(self.folders)
        renamed: dict[str, str] = {}
        for t in chosen:
            path, new = self.store.path(t), self.folders[t]
            if t in self.partial:
                n, numbers = self.partial[t]
                renamed |= {f"{path}/{buckets.folder(n, b)}": f"{new}/{buckets.folder(n, b)}" for b in numbers}
            else:
                renamed[path] = new
        changes.swap(self.store.spark, renamed)
        for t in chosen:
            self.store.note_schema(t, self.schemas[t])

    def discard(self) -> None:
        for folder in self.folders.values():
            changes.remove(self.store.spark, folder)
