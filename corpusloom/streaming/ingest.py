"""Documents as they arrive, cleaned, deduplicated, filtered and chunked."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.config import CorpusConfig
from corpusloom.functions.hold import hold
from corpusloom.operators.chunking import chunk
from corpusloom.operators.cleaning import clean
from corpusloom.operators.quality import quality_filter
from corpusloom.session import stored

SALTS = 16


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table, file or folder, as a stream. The pattern admits both."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def new_content(docs: DataFrame, key: str, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Rows whose content was not seen before, with ``content_hash``.

    State is kept per content, within the watermark when there is an event
    time. Copies of one content are first thinned out per salt, so that a
    content making up much of the stream does not land in one task.
    """
    hashed = hold(docs, "content_hash", F.md5("content"))
    salted = hashed.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    if event_time:
        marked = salted.withWatermark(event_time, delay)
        thinned = marked.dropDuplicatesWithinWatermark(["content_hash", "salt"])
        return thinned.dropDuplicatesWithinWatermark(["content_hash"]).drop("salt")
    thinned = salted.dropDuplicates(["content_hash", "salt"])
    return thinned.dropDuplicates(["content_hash"]).drop("salt")


def fresh_documents(docs: DataFrame, key: str, config: CorpusConfig = CorpusConfig(), **seen) -> DataFrame:
    return new_content(clean(docs, config.cleaning), key, **seen)


def fresh_chunks(docs: DataFrame, key: str, config: CorpusConfig = CorpusConfig(), **seen) -> DataFrame:
    fresh = fresh_documents(docs, key, config, **seen)
    good = quality_filter(fresh, config.quality, collapsed=True)
    return chunk(good, config.chunking, content_hash="content_hash", keep=(key,))


# Seconds of the windows that share a folder.
FOLDER_SECONDS = 86_400


def merge_batch(batch: DataFrame, number: int, path: str, keys: tuple[str, ...], window: str) -> None:
    """Replace the rows of ``path`` that ``batch`` knows newer, in the folders of its windows only.

    Rows carry the number of the batch that wrote them. The folders' new rows are stored before
    any is replaced, so a batch that was cut off is repeated with the same result.
    """
    spark = batch.sparkSession
    folder = F.floor(F.unix_timestamp(F.col(window).cast("timestamp")) / FOLDER_SECONDS)
    marked = batch.withColumn("batch", F.lit(number).cast("long")).withColumn("folder", folder)
    new = stored(marked, "changed")
    try:
        old = spark.read.schema(new.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        old = new.limit(0)
    touched = old.join(new.select("folder").distinct(), "folder", "left_semi")
    rows = touched.select(*new.columns).union(new).groupBy(*keys)
    latest = rows.agg(F.max_by(F.struct(*new.columns), "batch").alias("row")).select("row.*")
    kept = stored(latest, "merged")
    kept.repartition("folder").write.partitionBy("folder").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def write_updates(
    rows: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("window_start",), window: str = "window_start"
) -> StreamingQuery:
    """Windowed aggregates as they change, open windows included; ``keys`` tell the rows apart.

    Update mode keeps no window in the state that the watermark has passed. A batch rewrites
    the days of the windows it changes and nothing else.
    """
    return (
        rows.writeStream.outputMode("update")
        .foreachBatch(lambda batch, number: merge_batch(batch, number, path, keys, window))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything available now into Parquet, exactly once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
