"""Compute a costly column once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hold(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` whose value later filters and projections reuse.

    The optimizer moves a filter on a computed column below the projection that
    computes it, together with a copy of the expression; a chain of regex
    rewrites, scores and filters would run each rewrite many times per row.
    Generator output is never substituted that way, so the value is made by a
    one-element explode. Filters on the other columns still reach the scan.
    """
    columns = [c for c in frame.columns if c != name]
    return frame.select(*columns, F.explode(F.array(value)).alias(name)).select(
        *[c for c in frame.columns], *([] if name in frame.columns else [name])
    )
