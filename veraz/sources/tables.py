"""Writers and idempotent changes of Parquet tables.

Changes are functions of tables (target, source) -> target; ``replace`` swaps the folder of a table
for that of its new rows, which are complete before the old ones go. Renaming folders is not atomic:
between two renames a table or a bucket is missing, and ``recover`` puts it back if the job stops there.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veraz.operators.versioning import latest
from veraz.sources.buckets import PREFIX

#: Marks a bucket that wasn't there before a swap.
_NONE = ".none"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def check_names(*names: str) -> None:
    for n in names:
        if not all(_NAME.fullmatch(p) for p in n.split(".")):
            raise ValueError(f"not a name: {n}")


def overwrite(df: DataFrame, table: str) -> None:
    check_names(table)
    df.write.mode("overwrite").option("overwriteSchema", "true").format("parquet").saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    check_names(table)
    df.write.mode("append").format("parquet").saveAsTable(table)


def ensure_schema(spark: SparkSession, schema: str) -> None:
    check_names(schema)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def exists(spark: SparkSession, table: str) -> bool:
    check_names(table)
    return spark.catalog.tableExists(table)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """The rows under a name that SQL can use."""
    check_names(name)
    df.createOrReplaceTempView(name)
    return df


def columns_of(spark: SparkSession, table: str) -> list[str]:
    check_names(table)
    return [r[0] for r in spark.sql(f"SHOW COLUMNS IN {table}").collect()]


def physical(df: DataFrame) -> DataFrame:
    """One row: files, bytes and the moment of the last change of the files that rows lie in."""
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return files.agg(F.count("*").alias("arquivos"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"), F.max("file_modification_time").alias("alterado_em"))


def append_merged(df: DataFrame, table: str) -> list[str]:
    """Appends rows by name; columns that the table lacks are added to it (null in its older rows),
    and those that the rows lack are null. Returns the names of the added columns."""
    spark = df.sparkSession
    create_if_absent(df, table)
    added = add_missing_columns(spark, table, {f.name: f.dataType.simpleString() for f in df.schema})
    kinds = {f.name: f.dataType for f in spark.table(table).schema}
    append(df.select(*(F.col(c).cast(k) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items())), table)
    return added


def create_if_absent(df: DataFrame, table: str) -> None:
    check_names(table)
    df.limit(0).write.mode("ignore").format("parquet").saveAsTable(table)


def create_as(spark: SparkSession, table: str, query: str) -> None:
    check_names(table)
    spark.sql(f"CREATE TABLE {table} USING PARQUET AS {query}")


def add_missing_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> list[str]:
    check_names(table, *columns)
    missing = [c for c in columns if c not in spark.table(table).columns]
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{c} {columns[c]}' for c in missing)})")
    return missing


def unmatched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows, one for each key, whose keys the target doesn't have."""
    check_names(*keys)
    once = latest(source, keys, ())
    return once.join(target.select(*keys), keys, "left_anti").select(source.columns)


def insert_new(spark: SparkSession, source: DataFrame, table: str, keys: list[str]) -> int:
    """Appends what is new and returns how many rows that were; running it again appends nothing."""
    create_if_absent(source, table)
    new = unmatched(spark.table(table), source, keys)
    count = F.count(F.lit(1)).alias("n")
    from pyspark.sql import Observation

    seen = Observation(uuid.uuid4().hex)
    append(new.observe(seen, count), table)
    return seen.get["n"]


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All source rows, and the target rows whose keys aren't in the source. Repeated keys in the source raise."""
    if source.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"the source repeats a key: {', '.join(keys)}")
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source, allowMissingColumns=True)


def upsert_newer(target: DataFrame, source: DataFrame, key: str, moment: str) -> DataFrame:
    """The newer row of each key; a tie keeps the target's."""
    marked = target.withColumn("_own", F.lit(1)).unionByName(source.withColumn("_own", F.lit(0)), allowMissingColumns=True)
    return latest(marked, key, (moment, "_own")).drop("_own")


def stored_conflicts(target: DataFrame, source: DataFrame, key: str, moment: str, digest: str) -> DataFrame:
    """Source rows whose key and moment are stored with another content."""
    stored = target.select(key, moment, F.col(digest).alias("_stored"))
    return source.join(stored, [key, moment]).where(F.col(digest) != F.col("_stored")).drop("_stored").distinct()


def update_only(target: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    new = source.groupBy(key).agg(F.max(column).alias("_new"))
    return target.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).select(target.columns)


def content_rows(df: DataFrame, dataset: str, period: str, run_id: str) -> DataFrame:
    """Rows with a hash of their content, one for each content: publishing them again adds nothing."""
    hashed = df.withColumn("hash_payload", F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256))
    named = hashed.withColumns({"dataset_origem": F.lit(dataset), "competencia": F.lit(period), "run_id": F.lit(run_id), "coletado_em_utc": F.current_timestamp()})
    return latest(named, ["dataset_origem", "competencia", "hash_payload"], ())


def _filesystem(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(spark: SparkSession, old: str, new: str) -> bool:
    """Whether the folder was renamed. File systems say false where they fail."""
    source, fs = _filesystem(spark, old)
    return bool(fs.rename(source, _filesystem(spark, new)[0]))


def _moved(spark: SparkSession, old: str, new: str) -> None:
    if not _rename(spark, old, new):
        raise OSError(f"{old} could not be renamed to {new}")


def folder_exists(spark: SparkSession, path: str) -> bool:
    where, fs = _filesystem(spark, path)
    return bool(fs.exists(where))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if there is one."""
    where, fs = _filesystem(spark, path)
    if fs.exists(where) and not fs.delete(where, True):
        raise OSError(f"{path} could not be deleted")


def _aside(path: str, mark: str) -> str:
    """Where a folder is kept during a swap: beside it, and a bucket beside its table, as readers of the
    table would take it for one of its folders."""
    table, _, name = path.rpartition("/")
    return f"{table}.old-{mark}/{name}" if name.startswith(PREFIX) else f"{path}.old-{mark}"


def ensure_folder(spark: SparkSession, path: str) -> None:
    where, fs = _filesystem(spark, path)
    if not fs.mkdirs(where):
        raise OSError(f"{path} could not be made")


def swap(spark: SparkSession, staged: dict[str, str]) -> None:
    """Puts folders of new rows (path -> staged folder) in the places of tables or of their buckets. All
    old folders are set aside before the first new one comes in, and come back if any step fails; they
    go last."""
    mark = uuid.uuid4().hex
    aside: list[tuple[str, str]] = []
    placed: list[tuple[str, str]] = []
    kept = {path: _aside(path, mark) for path in staged}
    of_buckets = {old.rpartition("/")[0] for path, old in kept.items() if old != f"{path}.old-{mark}"}
    try:
        for folder in of_buckets:
            ensure_folder(spark, folder)
        for path, old in kept.items():
            if folder_exists(spark, path):
                _moved(spark, path, old)
                aside.append((path, old))
            elif old.rpartition("/")[0] in of_buckets:
                ensure_folder(spark, f"{old}{_NONE}")
        for path, new in staged.items():
            _moved(spark, new, path)
            placed.append((path, new))
    except Exception:
        for path, new in reversed(placed):
            _rename(spark, path, new)
        for path, old in reversed(aside):
            _rename(spark, old, path)
        for folder in of_buckets:
            remove(spark, folder)
        for new in staged.values():
            remove(spark, new)
        raise
    for folder in of_buckets:  # once renamed, they can't come back
        _moved(spark, folder, folder.replace(".old-", ".gone-"))
        remove(spark, folder.replace(".old-", ".gone-"))
    for _, old in aside:
        remove(spark, old)


def recover(spark: SparkSession, path: str) -> bool:
    """Whether what a stopped ``swap`` had set aside was put back in its place: a table, or its buckets."""
    pattern, fs = _filesystem(spark, f"{path}.old-*")
    found = sorted(str(s.getPath()) for s in fs.globStatus(pattern) or [])
    if folder_exists(spark, path):
        back = False
        for old in found:
            inside = [s.getPath().getName() for s in fs.listStatus(_filesystem(spark, old)[0])]
            if not inside or not all(n.startswith(PREFIX) for n in inside):
                continue  # a whole table, whose successor is in place
            for name in inside:
                remove(spark, f"{path}/{name.removesuffix(_NONE)}")
                if not name.endswith(_NONE):
                    _moved(spark, f"{old}/{name}", f"{path}/{name}")
            remove(spark, old)
            back = True
        return back
    if len(found) != 1:
        return False
    _moved(spark, found[0], path)
    return True


def counted_write(df: DataFrame, path: str, by: str | None = None) -> int:
    """Writes the rows, by a partition column if one is named, and returns how many they were. They are
    counted in the tasks that write, so a task that runs again counts once."""
    from pyspark.sql import Observation

    seen = Observation(uuid.uuid4().hex)
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write
    (writer.partitionBy(by) if by else writer).parquet(path)
    return seen.get["n"]


def stage(df: DataFrame, path: str) -> str:
    """Writes the rows beside a table's folder and returns where they are."""
    new = f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(new)
    return new


def replace(df: DataFrame, path: str) -> None:
    """Writes the rows beside the folder and then swaps the folders."""
    swap(df.sparkSession, {path: stage(df, path)})
