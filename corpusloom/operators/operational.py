"""Stage runs, requests, the model registry and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stage_metrics(runs: DataFrame) -> DataFrame:
    """Per stage: last status and error, runs, failures and time spent."""
    last = F.max(F.struct("ts", "run_id", "status", "error"))
    return runs.groupBy("stage").agg(
        last["status"].alias("status"),
        last["ts"].alias("last_run"),
        last["error"].alias("error"),
        F.count(F.lit(1)).alias("runs"),
        F.count_if(F.col("status") == "failed").alias("failures"),
        F.sum("duration").alias("total_duration"),
    )


def checkpoint_list(manifest: DataFrame, run_id: str | None = None) -> DataFrame:
    """The newest checkpoint of every (run, stage), oldest first."""
    rows = manifest if run_id is None else manifest.filter(F.col("run_id") == run_id)
    return (
        rows.groupBy("run_id", "stage")
        .agg(F.max("timestamp").alias("timestamp"), F.count(F.lit(1)).alias("saves"))
        .orderBy("run_id", "timestamp")
    )


def run_metadata(manifest: DataFrame) -> DataFrame:
    """Per run: distinct completed stages in order of completion, current stage, times."""
    stages = manifest.groupBy("run_id", "stage").agg(
        F.min(F.when(F.col("status") == "completed", F.col("timestamp"))).alias("completed"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )
    done = F.array_sort(F.collect_list(F.when(F.col("completed").isNotNull(), F.struct("completed", "stage"))))
    return stages.groupBy("run_id").agg(
        F.transform(done, lambda s: s["stage"]).alias("stages_completed"),
        F.max(F.struct("last", "stage"))["stage"].alias("current_stage"),
        F.min("first").alias("start_time"),
        F.max("last").alias("last_updated"),
    )


def execution_summary(manifest: DataFrame) -> DataFrame:
    """Per run: start, end, seconds between and checkpoints saved (one per stage)."""
    start, end = F.min("timestamp"), F.max("timestamp")
    return manifest.groupBy("run_id").agg(
        start.alias("start_time"),
        end.alias("end_time"),
        (F.unix_micros(end) - F.unix_micros(start)).alias("total_micros"),
        F.count_distinct("stage").alias("checkpoints_saved"),
    )


def request_metrics(requests: DataFrame) -> DataFrame:
    """One row from (ts, is_error): counts, error rate, uptime and request rate."""
    total, errors = F.count(F.lit(1)), F.count_if("is_error")
    micros = F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))
    return requests.agg(
        total.alias("total_requests"),
        errors.alias("total_errors"),
        F.coalesce(F.try_divide(errors, total), F.lit(0.0)).alias("error_rate"),
        (micros / 1e6).alias("uptime_seconds"),
        F.coalesce(F.try_divide(total, micros / 1e6), F.lit(0.0)).alias("requests_per_second"),
    )


def registry_entry(path: Column, tag: Column, metadata: Column, at: Column) -> Column:
    """A row to append: the version id joins tag and registration second."""
    return F.struct(
        F.concat_ws("_", tag, F.unix_seconds(at)).alias("version_id"),
        tag.alias("version_tag"),
        path.alias("model_path"),
        metadata.alias("metadata"),
        at.alias("registered_at"),
        F.lit("registered").alias("status"),
    )


def registry_latest(registry: DataFrame) -> DataFrame:
    """The last registered version of every tag."""
    last = F.max(F.struct("registered_at", "version_id"))
    return registry.groupBy("version_tag").agg(
        last["version_id"].alias("version_id"),
        last["registered_at"].alias("registered_at"),
        F.count(F.lit(1)).alias("versions"),
    )


def rate_limit_breaches(requests: DataFrame, limit: int = 100, every: str = "1 minute") -> DataFrame:
    """Users with more than ``limit`` requests in a window."""
    return (
        requests.groupBy("user_id", F.window("ts", every).alias("w"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .filter(F.col("requests") > limit)
        .select("user_id", F.col("w.start").alias("window_start"), "requests")
    )
