"""Readers of raw files: CSV, JSON, manifests and saved pages."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veraz.sources.records import read_records

#: Files are announced with these columns beside their data.
PROVENANCE = ("_source_file_id", "_run_id", "_sistema_origem", "_dataset_origem", "_coletado_em_utc", "_data_publicacao_arquivo")
RAW_PAGE = T.StructType([
    T.StructField("observacao_id", T.StringType(), False), T.StructField("run_id", T.StringType(), False), T.StructField("endpoint", T.StringType(), False), T.StructField("url_origem", T.StringType(), False),
    T.StructField("coletado_em_utc", T.StringType(), False), T.StructField("hash_payload", T.StringType(), False), T.StructField("payload", T.BinaryType(), False),
])


#: One task reads a file of this size in some twenty seconds; cutting it into ranges takes some ten times the CPU time.
RANGES_FROM = 1 << 30


def largest_file(spark: SparkSession, path: str | list[str]) -> int:
    """The bytes of the largest file at a path (a folder, a pattern or a file)."""
    context, largest = spark.sparkContext, 0
    for p in [path] if isinstance(path, str) else path:
        where = context._jvm.org.apache.hadoop.fs.Path(p)
        system = where.getFileSystem(context._jsc.hadoopConfiguration())
        for found in system.globStatus(where) or []:
            inside = system.listStatus(found.getPath()) if found.isDirectory() else [found]
            largest = max([largest, *(f.getLen() for f in inside)])
    return largest


def read_whole_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As ``read_csv``, but each file by one task; its columns come from the first record alone."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str | list[str], delimiter: str = ",", file_column: str | None = None) -> DataFrame:
    """All columns as strings, by the header of the first file; quoted line ends and doubled quotes are
    kept. Files beyond RANGES_FROM bytes are read by many tasks each, smaller ones by one."""
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", delimiter).csv(path)
    if largest_file(spark, path) > RANGES_FROM:
        return read_records(spark, path, whole.columns, delimiter, file_column)
    return whole.select("*", F.col("_metadata.file_path").alias(file_column)) if file_column else whole


def read_plain_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    for name in (schema, table):
        if not name.replace("_", "").replace(".", "").isalnum():
            raise ValueError(f"not a name: {name}")
    return spark.table(f"{schema}.{table}")


#: Local paths are written with one slash or with three.
_LOCAL = "^file:/+"


def read_with_provenance(spark: SparkSession, manifests: list[dict], dataset: str) -> DataFrame:
    """All files of a data set in one scan for each header, with what their manifests say. The manifests are a
    small table that is joined by the whole path; columns that only some years have are null in the
    others. A path that is listed twice, or that names several files, raises."""
    own = [m for m in manifests if f"-{dataset}-" in Path(m["arquivo"]).name]
    if not own:
        raise ValueError(f"no files of {dataset}")
    headers: dict[tuple[str, ...], list[str]] = {}
    known: dict[str, tuple] = {}
    for m in own:
        one = read_whole_csv(spark, m["arquivo"])  # for its header
        places = [re.sub(_LOCAL, "file:/", f) for f in one.inputFiles()]  # as the scan names them: with blanks and accents encoded
        if len(places) != 1:
            raise ValueError(f"not one file: {m['arquivo']}")
        if places[0] in known:
            raise ValueError(f"listed twice: {m['arquivo']}")
        known[places[0]] = (places[0], m["source_file_id"], m["run_id"], m.get("sistema_origem"), dataset, m.get("coletado_em_utc"), m.get("data_publicacao_arquivo"))
        headers.setdefault(tuple(one.columns), []).append(m["arquivo"])
    rows = None
    for paths in headers.values():
        scan = read_csv(spark, paths, file_column="_file").withColumn("_file", F.regexp_replace("_file", _LOCAL, "file:/"))
        rows = scan if rows is None else rows.unionByName(scan, allowMissingColumns=True)
    table = spark.createDataFrame(list(known.values()), ", ".join(f"{c} string" for c in ("_file", *PROVENANCE)))
    found = rows.join(F.broadcast(table), "_file", "left")  # one row for each file that was listed
    checked = F.coalesce(F.col(PROVENANCE[0]), F.when(F.col("_run_id").isNull(), F.raise_error(F.concat(F.lit("no manifest of "), F.col("_file")))))
    return found.withColumn(PROVENANCE[0], checked).drop("_file")


def union_with_origin(tables: dict[str, DataFrame], column: str = "_dataset_origem") -> DataFrame:
    """All rows of several tables, with the name of theirs; missing columns are null."""
    out = None
    for name, df in tables.items():
        own = df.withColumn(column, F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables")
    return out


def already_loaded(table: DataFrame, source_file_id: str) -> bool:
    return bool(table.where(F.col("_source_file_id") == source_file_id).limit(1).count())


def day(moment: str) -> Column:
    """The day of a moment; null if it can't be read."""
    return F.to_date(F.try_to_timestamp(F.col(moment).cast("string")))


def within_days(rows: DataFrame, moment: str, first: str, last: str) -> DataFrame:
    """Rows whose moment falls on the days from first to last, both included."""
    return rows.where(day(moment).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def restrict(rows: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    return rows.join(kept.select(key), key, "left_semi")


def statement_keys(spark: SparkSession, statement: str) -> DataFrame:
    """Control keys from the JSON result of an SQL statement, parsed, distinct and sorted."""
    data = json.loads(statement)
    names = [c["name"] for c in data["manifest"]["schema"]["columns"]]
    place = names.index("numero_controle_pncp")
    rows = spark.createDataFrame([(r[place],) for r in data["result"]["data_array"]], "numero_controle string")
    return parse_control(rows, "numero_controle", strict=True).distinct().orderBy("numero_controle")


CONTROL_PATTERN = r"^(\d{14})-\d+-(\d+)/(\d{4})$"


def parse_control(rows: DataFrame, column: str, strict: bool = False) -> DataFrame:
    """Adds cnpj, sequencial and ano from a control number; unparsable ones are null, or raise."""
    if strict and rows.where(~F.coalesce(F.col(column).rlike(CONTROL_PATTERN), F.lit(False))).limit(1).count():
        raise ValueError("a control number is malformed")
    part = lambda i: F.when(F.col(column).rlike(CONTROL_PATTERN), F.regexp_extract(column, CONTROL_PATTERN, i))
    return rows.withColumns({"cnpj": part(1), "sequencial": part(2).cast("long"), "ano": part(3).cast("int")})


def json_keys(rows: DataFrame, column: str, path: str, kind: str = "string") -> DataFrame:
    """Distinct keys (chave) at a path in JSON texts; texts without it give none."""
    return rows.select(F.get_json_object(column, path).try_cast(kind).alias("chave")).where("chave is not null").distinct()


def hashed_payloads(rows: DataFrame, payload: str, named: str) -> DataFrame:
    """Adds hash_calculado, the SHA-256 of a payload, and integro: whether it is the one named."""
    digest = F.sha2(F.col(payload), 256)
    return rows.withColumns({"hash_calculado": digest, "integro": F.coalesce(digest == F.col(named), F.lit(False))})


def page_keys(spark: SparkSession, path: str, field: str = "numeroControlePNCP") -> DataFrame:
    """Distinct keys of the records in saved JSON pages, sorted."""
    pages = spark.read.option("multiLine", True).json(path)
    return pages.select(F.explode("data").alias("r")).select(F.col(f"r.{field}").alias("chave")).where("chave is not null").distinct().orderBy("chave")


def checked_payloads(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Payload files joined to (arquivo, hash_payload): the bytes, their hash and whether they agree."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("arquivo"), F.col("content").alias("payload"))
    return hashed_payloads(manifest.join(files, "arquivo", "left"), "payload", "hash_payload")
