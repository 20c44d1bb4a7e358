"""Request metrics per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_requests(requests: DataFrame, every: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Requests, errors and error rate per tumbling window, from (ts, is_error)."""
    errors, total = F.count_if("is_error"), F.count(F.lit(1))
    return (
        requests.withWatermark("ts", delay)
        .groupBy(F.window("ts", every).alias("w"))
        .agg(total.alias("requests"), errors.alias("errors"), (errors / total).alias("error_rate"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "requests", "errors", "error_rate",
        )
    )


def windowed_breaches(
    requests: DataFrame, limit: int = 100, every: str = "1 minute", delay: str = "10 minutes"
) -> DataFrame:
    """Users over the limit in a window, from (ts, user_id)."""
    return (
        requests.withWatermark("ts", delay)
        .groupBy("user_id", F.window("ts", every).alias("w"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .filter(F.col("requests") > limit)
        .select("user_id", F.col("w.start").alias("window_start"), "requests")
    )
