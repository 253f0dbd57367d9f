"""Loads whatever files of a source have arrived since the last call, each once, as a stream that ends by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arrivals(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """Rows of all CSV files of a folder as text, with the file that each came from and its version."""
    rows = spark.readStream.schema(", ".join(f"`{c}` string" for c in columns)).options(header="true", multiLine="true", escape='"').csv(folder)
    return rows.select("*", F.col("_metadata.file_name").alias("_source_url")).withColumn("_source_version", F.regexp_extract("_source_url", r"(\d{4}_\d{2}_\d{2})", 1))


def load_arrived(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start()
