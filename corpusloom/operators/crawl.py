"""Breadth-first crawl of an already fetched page table, many seeds at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.config import Collection
from corpusloom.session import cut


def crawl(
    seeds: DataFrame, links: DataFrame, pages: DataFrame, rules: Collection = Collection()
) -> DataFrame:
    """(seed, url, level, rank) of the pages each seed collects.

    ``seeds`` holds (seed, url), ``links`` (src, dst, position), ``pages``
    (url, valid). A page follows its first few links; unknown URLs are visited
    without yield, invalid pages are followed but not collected. The queue
    order is kept as ``path``, the link positions from the seed: within a level
    it sorts as the queue does, so no global ranking is needed. Pages that repeat
    a URL are visited at once, and every valid one of them is collected.
    """
    limit = rules.max_pages_per_source
    followed = cut(
        links.filter(F.col("position") < rules.links_per_page).select("src", "dst", "position")
    )
    known = cut(pages.groupBy("url").agg(F.count_if("valid").alias("good")))
    start = seeds.select(
        "seed", "url", F.array().cast("array<int>").alias("path"), F.lit(0).alias("done")
    )
    levels: list[DataFrame] = []
    found, visited = start, None
    while True:
        # ``good``, the valid pages of a URL, stays null for URLs that are not in the table.
        level = cut(found.join(known, "url", "left"))
        if level.isEmpty():
            break
        levels.append(level)
        queued = level.select("seed", "url")
        visited = queued if visited is None else visited.unionAll(queued)
        counts = level.groupBy("seed").agg((F.max("done") + F.coalesce(F.sum("good"), F.lit(0))).alias("done"))
        found = (
            level.filter(F.col("good").isNotNull())
            .select("seed", "path", F.col("url").alias("src"))
            .join(followed, "src")
            .select("seed", F.col("dst").alias("url"), F.array_append("path", F.col("position")).alias("path"))
            .groupBy("seed", "url")
            .agg(F.min("path").alias("path"))
            .join(counts.filter(F.col("done") < limit), "seed")
            .select("seed", "url", "path", F.least("done", F.lit(limit)).cast("int").alias("done"))
            .join(visited, ["seed", "url"], "left_anti")
        )
    return reduce(DataFrame.unionAll, [collected(rows, i, limit) for i, rows in enumerate(levels)])


def collected(level: DataFrame, number: int, limit: int) -> DataFrame:
    """The valid pages of a level, up to the limit of their seed.

    The rank has a fixed bound, so tasks drop all but the first rows of a seed
    before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("seed").orderBy("path", "url"))
    copies = F.sequence(F.lit(1), F.least("good", F.lit(limit)))
    return (
        level.filter("good > 0")
        .withColumn("copy", F.explode(copies))
        .withColumn("rank", rank)
        .filter(F.col("rank") <= limit)
        .withColumn("rank", F.col("rank") + F.col("done"))
        .filter(F.col("rank") <= limit)
        .select("seed", "url", F.lit(number).alias("level"), "rank")
    )
