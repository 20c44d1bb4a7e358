"""Joins in which one key may hold a large share of the rows, or few rows find a partner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above this share of all rows, so there are at most that many.
HOT_SHARE = 1000
MIN_HOT_ROWS = 1_000_000


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, rows), counted with map-side combining."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def hot_keys(
    counts: DataFrame, key: str, total: int, minimum: int | None = None
) -> DataFrame | None:
    """(key, parts) of the keys to split, None when ``total`` rows cannot have any.

    ``counts`` holds (key, rows). At most HOT_SHARE keys qualify, which bounds
    what ``join_split`` broadcasts whatever the size of the data.
    """
    limit = max(total // HOT_SHARE, MIN_HOT_ROWS if minimum is None else minimum)
    if total <= limit:
        return None
    parts = F.ceil(F.col("rows") / limit).cast("int")
    return counts.filter(F.col("rows") > limit).select(key, parts.alias("_parts"))


def join_split(
    many: DataFrame, one: DataFrame, key: str, by: str, hot: DataFrame | None
) -> DataFrame:
    """Inner join of ``many`` with ``one`` (a row per key), hot keys spread by ``by``.

    Rows of a hot key go to several tasks, and the key's row to each of them.
    """
    if hot is None:
        return many.join(one, key)
    parts = F.coalesce("_parts", F.lit(1))
    share = F.pmod(F.xxhash64(by), parts).cast("int")
    copies = F.explode(F.sequence(F.lit(0), parts - 1))
    left = many.join(F.broadcast(hot), key, "left").withColumn("_part", share)
    right = one.join(F.broadcast(hot), key, "left").withColumn("_part", copies)
    return left.drop("_parts").join(right.drop("_parts"), [key, "_part"]).drop("_part")


# Bits of the filter below, in bitmaps of the size that Spark's bitmap functions make.
BITMAP_BITS = 32_768
BITMAPS = 256
# Bits a key gets where the filter grows with the keys, and the most bitmaps then (64 MB).
BITS_PER_KEY = 16
MOST_BITMAPS = 16_384


def bitmaps_for(keys: int) -> int:
    """Bitmaps that hold as many keys; beyond ``MOST_BITMAPS`` more rows pass by chance."""
    wanted = -(-keys * BITS_PER_KEY // BITMAP_BITS)
    return min(max(1 << (wanted - 1).bit_length() if wanted > 1 else 1, BITMAPS), MOST_BITMAPS)


def marked(rows: DataFrame, key: str, keys: DataFrame, bitmaps: int = BITMAPS) -> DataFrame:
    """``rows`` with ``_maybe``: false if ``key`` is surely not among ``keys`` (key).

    A hashed bitmap of the keys, by default one megabyte whatever their number, is
    broadcast. It spares rows that find no partner a shuffle. Keys move to their
    bitmap one by one, so that no task sends whole bitmaps.
    """
    place = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS * bitmaps))
    part, bit = F.floor(place / F.lit(BITMAP_BITS)).cast("int"), F.pmod(place, F.lit(BITMAP_BITS))
    bits = (
        keys.filter(F.col(key).isNotNull())
        .select(part.alias("_part"), bit.alias("_bit"))
        .repartition("_part")
        .groupBy("_part")
        .agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )
    known = rows.withColumn("_part", part).join(F.broadcast(bits), "_part", "left")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    moved = F.call_function("shiftright", byte.cast("int"), F.pmod(bit, F.lit(8)).cast("int"))
    hit = moved.bitwiseAND(F.lit(1)) == 1
    maybe = F.col(key).isNotNull() & F.coalesce(hit, F.lit(False))
    return known.withColumn("_maybe", maybe).drop("_part", "_bits")


def maybe_among(rows: DataFrame, key: str, keys: DataFrame, bitmaps: int = BITMAPS) -> DataFrame:
    """Rows whose ``key`` is among ``keys``, and a few others."""
    return marked(rows, key, keys, bitmaps).filter("_maybe").select(*rows.columns)


def semi(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``key`` is among ``keys``."""
    return maybe_among(rows, key, keys).join(keys.select(key), key, "left_semi").select(*rows.columns)


def anti(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``key`` is not among ``keys``; those surely not are not shuffled."""
    known = marked(rows, key, keys)
    left = known.filter("_maybe").join(keys.select(key), key, "left_anti")
    return known.filter("not _maybe").select(*rows.columns).union(left.select(*rows.columns))
