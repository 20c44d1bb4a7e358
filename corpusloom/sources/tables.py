"""Parquet tables in, in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(
    spark: SparkSession, folder: str, source_type: Column | str = "web"
) -> DataFrame:
    """The documents table with ``content`` and a ``source_type``."""
    kind = F.lit(source_type) if isinstance(source_type, str) else source_type
    return table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("content"), "lang", "source", kind.alias("source_type")
    )


# Pages that reach a Python worker at once; they are long, and workers share memory.
PAGES_PER_BATCH = 500


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages table; Arrow batches hold few of its rows, however large the table is."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(PAGES_PER_BATCH))
    return table(spark, folder, "pages")
