"""Shards along a Hilbert curve through the documents' metadata.

Each dimension is quantised to equal-depth steps, the steps are a point of a grid,
and rows are ordered by their point's index on the Hilbert curve (Skilling,
"Programming the Hilbert curve", 2004). Cutting that order into runs gives shards and
files whose ranges are narrow in all dimensions at once, so that filters on any
of them skip files by their statistics.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import stored

LAW = "rows"


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of ``points``, dimensions of ``bits`` bits each."""
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & np.uint64(1 << level), np.uint64((1 << level) - 1), np.uint64(0))
    x ^= flip
    index = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << one) | ((x[i] >> np.uint64(level)) & one)
    return index.astype(np.int64)


def number_of(value: Column) -> Column:
    """The first six bytes of a string as a number that sorts like them."""
    head = F.rpad(F.hex(F.substring(value.cast("string").cast("binary"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def steps_of(frame: DataFrame, dimensions: dict[str, Column], bits: int) -> dict[str, list[float]]:
    """At most 2^bits - 1 cut points per dimension, of equal depth."""
    points = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = [F.percentile_approx(c, F.array(*map(F.lit, points)), F.lit(1000)).alias(n) for n, c in dimensions.items()]
    row = frame.agg(*cuts).first()
    return {n: sorted(set(row[n] or [])) for n in dimensions}


def curve(steps: list[list[float]], bits: int):
    """A function of the dimension columns: their quantised point's curve index."""

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        grid = [np.searchsorted(np.array(s), c.to_numpy("float64"), side="left") for s, c in zip(steps, columns)]
        return pd.Series(hilbert_index(np.stack(grid, axis=1), bits))

    return index


def shards(
    docs: DataFrame,
    count: int = 16,
    key: str = "doc_id",
    text: str = "text",
    dimensions: dict[str, Column] | None = None,
    bits: int = 6,
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, place) of every row.

    The law is ``rows``: shard sizes differ by one at most, whatever metadata and texts
    repeat. ``size`` is the text's UTF-8 bytes plus one, null texts have none.
    Rows follow the curve, then the id, then the text; a missing value counts as the
    lowest of its dimension. ``place`` is the rank in the whole order. An empty
    table gives no row.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    own = dimensions or {
        "lang": number_of(F.col("lang")),
        "source": F.xxhash64("source").cast("double"),
        "length": F.octet_length(raw).cast("double"),
        "age": F.col(key).cast("double"),
    }
    lowest = F.lit(-1e300)
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        *[F.coalesce(c, lowest).alias(f"by_{n}") for n, c in own.items()],
    )
    rows = stored(rows, "metadata")
    names = [f"by_{n}" for n in own]
    steps = steps_of(rows, {n: F.col(n) for n in names}, bits)
    indexed = rows.withColumn("curve", curve([steps[n] for n in names], bits)(*names))
    # Sorting by the id as well keeps repeated metadata from filling one task.
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["curve", "key", "text_crc32", "size"]
    ordered = indexed.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number holds the partition above bit 33 and the row in it below.
    ordered = stored(ordered.withColumn("number", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("number", 33)
    sizes = sorted((r["part"], r["n"]) for r in ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for number, n in sizes:
        starts.append((number, before))
        before += n
    total = before
    bases = rows.sparkSession.createDataFrame(starts, "part long, base long")
    low = F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ordered.withColumn("part", part).join(F.broadcast(bases), "part")
    placed = placed.withColumn("place", F.col("base") + low)
    # The first total % count shards take one row more.
    each, longer = divmod(total, count)
    edge = longer * (each + 1)
    place = F.col("place")
    shard = F.when(place < edge, F.floor(place / F.lit(each + 1))).otherwise(
        F.floor((place - edge) / F.lit(max(each, 1))) + longer
    )
    start = F.least(F.col("shard"), F.lit(longer)) * (each + 1) + F.greatest(F.col("shard") - longer, F.lit(0)) * each
    placed = placed.withColumn("shard", shard.cast("int")).withColumn("slot", place - start)
    return placed.select(
        F.col("key").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "place",
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, key: str = "doc_id", rows_per_file: int = 100_000) -> None:
    """Write the documents in curve order as Parquet, one folder per shard, in runs of files.

    Every file holds a run of the curve, so its column statistics prune on all
    dimensions. Ids must be unique here: rows are matched by id.
    """
    run = F.floor(F.col("slot") / rows_per_file)
    where = placed.select(key, "shard", "slot", run.alias("run"))
    full = docs.join(where, key)
    parts = max(1, placed.select("shard", run.alias("run")).distinct().count())
    dealt = full.repartitionByRange(parts, "shard", "run").sortWithinPartitions("shard", "run", "slot")
    dealt.drop("run", "slot").write.partitionBy("shard").parquet(path)
