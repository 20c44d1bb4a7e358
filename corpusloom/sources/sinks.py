"""Tables out and back in, with their summaries and manifests.

What consists of several tables, and every checkpoint, is written to a folder of its own run.
A record written last makes the run the one that readers see; a write that was killed on
the way has none and changes nothing. Folders of earlier runs stay, for readers still in them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.stats import collection_summary

MALFORMED = "_malformed"
MANIFEST = "run_id string, stage string, timestamp timestamp, status string, data_path string, metadata map<string,string>"


COMMITS = "run string, timestamp timestamp"


def new_run(path: str) -> tuple[str, str]:
    """The name of a run below ``path`` and its folder."""
    run = uuid.uuid4().hex
    return run, f"{path}/runs/{run}"


def commit(spark: SparkSession, path: str, run: str) -> None:
    row = spark.range(1).select(F.lit(run).alias("run"), F.current_timestamp().alias("timestamp"))
    row.write.mode("append").parquet(f"{path}/commits")


def committed(spark: SparkSession, path: str) -> str:
    """The folder of the last committed run."""
    commits = spark.read.schema(COMMITS).parquet(f"{path}/commits")
    return f"{path}/runs/{commits.agg(F.max_by('run', F.struct('timestamp', 'run'))).first()[0]}"


def save_raw(docs: DataFrame, path: str) -> None:
    """The collected rows, and beside them a one-row summary, taken from what was written."""
    spark = docs.sparkSession
    run, folder = new_run(path)
    docs.write.parquet(f"{folder}/data")
    written = spark.read.schema(docs.schema).parquet(f"{folder}/data")
    collection_summary(written).write.json(f"{folder}/summary")
    commit(spark, path, run)


def load_raw(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    folder = committed(spark, path)
    return spark.read.parquet(f"{folder}/data"), spark.read.json(f"{folder}/summary")


def save_processed(chunks: DataFrame, path: str) -> None:
    """Chunks in one folder per source type, so that readers of one type skip the rest."""
    chunks.write.mode("overwrite").partitionBy("source_type").parquet(path)


def load_processed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_dataset(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def load_dataset(spark: SparkSession, *paths: str, schema: str | None = None) -> DataFrame:
    """JSON lines of all paths by column name, without the malformed ones."""
    return with_malformed(spark, *paths, schema=schema).filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def with_malformed(spark: SparkSession, *paths: str, schema: str | None = None) -> DataFrame:
    """The same with ``_malformed``, the text of each record that is no such row, else null."""
    known = schema or spark.read.option("columnNameOfCorruptRecord", MALFORMED).json(list(paths)).schema
    wide = spark.createDataFrame([], known).schema
    if MALFORMED not in wide.names:
        wide = wide.add(MALFORMED, "string")
    reader = spark.read.option("columnNameOfCorruptRecord", MALFORMED).schema(wide)
    return reader.json(list(paths))


def malformed_counts(rows: DataFrame) -> DataFrame:
    """(path, records, malformed) of what ``with_malformed`` has read."""
    return rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count(F.lit(1)).alias("records"), F.count(MALFORMED).alias("malformed")
    )


def save_checkpoint(
    data: DataFrame, root: str, run_id: str, stage: str, metadata: dict[str, str] | None = None
) -> str:
    """A stage's rows as Parquet, then one row more in the manifest, which readers go by."""
    spark = data.sparkSession
    path = f"{root}/{run_id}/{stage}/{uuid.uuid4().hex}"
    data.write.parquet(path)
    row = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(stage).alias("stage"),
        F.current_timestamp().alias("timestamp"),
        F.lit("completed").alias("status"),
        F.lit(path).alias("data_path"),
        F.create_map(
            *[F.lit(x) for pair in (metadata or {}).items() for x in pair]
        ).cast("map<string,string>").alias("metadata"),
    )
    row.write.mode("append").parquet(f"{root}/manifest")
    return path


def load_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def load_checkpoint(spark: SparkSession, root: str, run_id: str, stage: str) -> DataFrame:
    """The rows of the stage's last record in the manifest."""
    own = load_manifest(spark, root).filter((F.col("run_id") == run_id) & (F.col("stage") == stage))
    path = own.agg(F.max_by("data_path", F.struct("timestamp", "data_path"))).first()[0]
    if path is None:
        raise FileNotFoundError(f"no checkpoint of stage {stage} of run {run_id} in {root}")
    return spark.read.parquet(path)


def save_evaluation(results: DataFrame, metrics: DataFrame, path: str) -> None:
    """One row per (model, example) and one per (model, metric), seen together or not at all."""
    run, folder = new_run(path)
    results.write.parquet(f"{folder}/examples")
    metrics.write.json(f"{folder}/metrics")
    commit(results.sparkSession, path, run)


def load_evaluation(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    folder = committed(spark, path)
    return spark.read.parquet(f"{folder}/examples"), spark.read.json(f"{folder}/metrics")
