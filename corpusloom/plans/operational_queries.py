"""Queries over the events table as stage runs, requests and registrations."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import operational as op
from corpusloom.plans.registry import query
from corpusloom.session import run_dir
from corpusloom.sources.tables import table
from corpusloom.streaming import ingest, requests


def stage_runs(spark, folder) -> DataFrame:
    failed = F.col("value") > 400
    return table(spark, folder, "events").select(
        F.col("event_type").alias("stage"),
        "ts",
        F.col("event_id").alias("run_id"),
        F.col("value").alias("duration"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("over limit: "), F.col("props"))).alias("error"),
    )


@query(
    """WITH r AS (SELECT *, CASE WHEN value > 400 THEN 'failed' ELSE 'success' END AS status FROM events)
SELECT event_type AS stage, arg_max(status, (ts, event_id)) AS status, max(ts) AS last_run,
  nullif(arg_max(CASE WHEN value > 400 THEN 'over limit: ' || props ELSE '' END, (ts, event_id)), '') AS error,
  count(*) AS runs, count(*) FILTER (value > 400) AS failures, round(sum(value), 4) AS total_duration
FROM r GROUP BY event_type"""
)
def stage_metrics(spark, folder):
    metrics = op.stage_metrics(stage_runs(spark, folder))
    return metrics.withColumn("total_duration", F.round("total_duration", 4))


def manifest(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("value") > 100, "failed").otherwise("completed").alias("status"),
    )


@query(
    "SELECT user_id AS run_id, event_type AS stage, max(ts) AS timestamp, count(*) AS saves"
    " FROM events GROUP BY user_id, event_type"
)
def checkpoint_list(spark, folder):
    return op.checkpoint_list(manifest(spark, folder))


@query(
    """WITH s AS (
  SELECT user_id AS run_id, event_type AS stage, min(ts) FILTER (value <= 100) AS completed,
         min(ts) AS first, max(ts) AS last FROM events GROUP BY ALL)
SELECT run_id, coalesce(string_agg(stage, ',' ORDER BY completed) FILTER (completed IS NOT NULL), '') AS stages_completed,
  arg_max(stage, last) AS current_stage, min(first) AS start_time, max(last) AS last_updated FROM s GROUP BY run_id"""
)
def run_metadata(spark, folder):
    rows = op.run_metadata(manifest(spark, folder))
    return rows.withColumn("stages_completed", F.array_join("stages_completed", ","))


@query(
    "SELECT user_id AS run_id, min(ts) AS start_time, max(ts) AS end_time,"
    " epoch_us(max(ts)) - epoch_us(min(ts)) AS total_micros,"
    " count(DISTINCT event_type) AS checkpoints_saved FROM events GROUP BY user_id"
)
def execution_summary(spark, folder):
    # Epoch arithmetic needs a zoned timestamp; the result keeps the table's own.
    rows = manifest(spark, folder).withColumn("timestamp", instant(F.col("timestamp")))
    summary = op.execution_summary(rows)
    return summary.withColumns({c: utc_clock(F.col(c)) for c in ("start_time", "end_time")})


def instant(clock: Column) -> Column:
    """The zoneless times of the table are UTC, whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), clock).cast("timestamp")


def utc_clock(time: Column) -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), time.cast("timestamp_ntz"))


def requests_of(events: DataFrame) -> DataFrame:
    return events.select(
        instant(F.col("ts")).alias("ts"),
        "user_id",
        (F.col("event_type") == "error").alias("is_error"),
    )


@query(
    """WITH t AS (SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS e,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE AS up FROM events)
SELECT n AS total_requests, e AS total_errors, e::DOUBLE / n AS error_rate, up AS uptime_seconds,
  n / up AS requests_per_second FROM t"""
)
def request_metrics(spark, folder):
    return op.request_metrics(requests_of(table(spark, folder, "events")))


@query(
    "SELECT event_type AS version_tag, arg_max(event_id, (ts, event_id)) AS version_id, max(ts) AS registered_at,"
    " count(*) AS versions FROM events GROUP BY event_type"
)
def registry_latest(spark, folder):
    registry = table(spark, folder, "events").select(
        F.col("event_type").alias("version_tag"),
        F.col("event_id").alias("version_id"),
        F.col("ts").alias("registered_at"),
    )
    return op.registry_latest(registry)


@query(
    "SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS requests"
    " FROM events GROUP BY 1, 2 HAVING count(*) > 3"
)
def rate_limit_breaches(spark, folder):
    rows = op.rate_limit_breaches(requests_of(table(spark, folder, "events")), 3, "1 day")
    return rows.withColumn("window_start", utc_clock(F.col("window_start")))


def streamed(spark, rows: DataFrame, label: str, write=ingest.write_stream) -> DataFrame:
    """Run a stream over what is there into the shared folder and read it back."""
    folder = run_dir(spark, label)
    write(rows, f"{folder}/rows", f"{folder}/state").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows").select(*rows.columns)


@query(
    """WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS requests,
  count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1, 2)
SELECT window_start, window_end, requests, errors, errors::DOUBLE / requests AS error_rate FROM w"""
)
def stream_request_metrics(spark, folder):
    events = requests_of(ingest.table_stream(spark, folder, "events"))
    rows = streamed(spark, requests.windowed_requests(events), "requests", ingest.write_updates)
    return rows.withColumns({c: utc_clock(F.col(c)) for c in ("window_start", "window_end")})


@query(
    """WITH w AS (SELECT user_id, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
  time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, count(*) AS requests FROM events GROUP BY 1, 2, 3)
SELECT user_id, window_start, requests FROM w WHERE requests > 3"""
)
def stream_rate_limit_breaches(spark, folder):
    events = requests_of(ingest.table_stream(spark, folder, "events"))
    rows = streamed(spark, requests.windowed_breaches(events, 3, "1 day"), "breaches", partial(ingest.write_updates, keys=("user_id", "window_start")))
    return rows.withColumn("window_start", utc_clock(F.col("window_start")))
