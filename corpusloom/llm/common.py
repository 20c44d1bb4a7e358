"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.skew import BITMAP_BITS, anti, semi  # noqa: F401 - shared with the operators
from corpusloom.session import run_dir

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


# Rows that reach a Python worker at once; documents are long, and workers share memory.
ROWS_PER_BATCH = 500


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few rows, whatever their texts' length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back.

    Whatever reads the result again starts from files that every executor
    reaches, also after executors were lost.
    """
    path = run_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fold_remainder(key: Column) -> Column:
    """crc32 of the id as text, modulo four; remainder 2 is held out."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4))


def matches_needed(positions: int, bar: float, missed: float = 1e-6) -> int:
    """Most equal signature positions one may ask of a pair of Jaccard ``bar``.

    Positions agree independently with probability ``bar``; fewer than the
    returned number agree with a probability of at most ``missed``.
    """
    tail, n = 0.0, 0
    while n < positions:
        tail += math.comb(positions, n) * bar**n * (1 - bar) ** (positions - n)
        if tail > missed:
            return max(n, 1)
        n += 1
    return positions


# Bits a key gets in the bitmap below, and the most bits in all (64 MB).
BITS_PER_KEY = 32
MOST_BITS = 1 << 29


@dataclass(frozen=True)
class Marks:
    """A bitmap over the leading bits of 64-bit hashes, broadcast to all tasks."""

    bitmap: Any
    shift: int

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """False where a hash is surely not among the marked ones."""
        place = hashes.view(np.uint64) >> np.uint64(self.shift)
        byte = self.bitmap.value[(place >> np.uint64(3)).astype(np.int64)]
        return (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def marks(keys: DataFrame, key: str) -> Marks:
    """The bitmap of the hashes ``key``, which must be spread evenly over 64 bits.

    It grows with their number up to ``MOST_BITS``; beyond, more hashes pass it by chance.
    """
    wanted = min(max(keys.count() * BITS_PER_KEY, BITMAP_BITS), MOST_BITS)
    size = 1 << (wanted - 1).bit_length()
    shift = 64 - (size.bit_length() - 1)
    place = F.shiftrightunsigned(key, shift)
    rows = (
        keys.select(F.floor(place / BITMAP_BITS).cast("int").alias("part"), F.pmod(place, F.lit(BITMAP_BITS)).alias("bit"))
        .repartition("part")
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    bitmap = np.zeros(size // 8, np.uint8)
    for row in rows.toLocalIterator():
        start = row["part"] * (BITMAP_BITS // 8)
        bitmap[start : start + BITMAP_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return Marks(keys.sparkSession.sparkContext.broadcast(bitmap), shift)
