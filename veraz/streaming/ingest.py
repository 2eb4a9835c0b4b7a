"""Raw files as they arrive: an incremental ingest whose checkpoint remembers what is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_new_csv(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """A stream of all-string rows of the CSV files in a folder, with their file and time of arrival."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.readStream.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(folder)
    return rows.withColumns({"_source_file_id": F.col("_metadata.file_name"), "_coletado_em_utc": F.col("_metadata.file_modification_time").cast("string")})


def load_available(rows: DataFrame, table: str, checkpoint: str) -> None:
    """Appends all files that aren't loaded yet to a Parquet folder and stops."""
    rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
