"""Nearest neighbours by collision counting on single projections.

Huang et al., "Query-aware locality-sensitive hashing" (QALSH, 2015), after the
collision counting of Gan et al. (C2LSH, 2012). Every block of vectors keeps, per random
direction, its vectors sorted by their projection. A query opens a window around
its own projection in each array and widens all of them step by step (virtual
rehashing: no other buckets are needed for a wider radius). A vector that lies
in the windows of enough directions is a candidate and is verified in double
precision; widening ends when enough candidates were found. The first width is read off a few
vectors of the block. Directions are orthogonal, as far as the
dimension allows: together they then tell distances far better than independent ones.

Largest inner products become nearest neighbours by one more coordinate that
lifts all vectors to one length; it is 0 for queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import stored


@dataclass(frozen=True)
class Search:
    """``share`` of a block is verified at least before widening ends.

    No vector above the collision threshold is left out, however many there are.
    """

    directions: int = 65
    share: float = 0.1
    threshold: float = 0.85
    sample: int = 256
    first_width: float = 0.97
    widen: float = 1.04
    block_rows: int = 16_384
    query_rows: int = 1024
    seed: int = 11


def orthogonal(width: int, directions: int, seed: int) -> np.ndarray:
    """Directions as columns: random, and orthogonal in runs of ``width``."""
    rng, runs = np.random.default_rng(seed), -(-directions // width)
    return np.concatenate([np.linalg.qr(rng.standard_normal((width, width)))[0] for _ in range(runs)], axis=1)[:, :directions]


class Block:
    """One block's vectors and, per direction, its sorted projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scale: float, longest: float, how: Search):
        """Vectors are divided by ``scale``, their greatest component, but for their scores."""
        self.ids, self.vectors, self.how = ids, vectors.astype(np.float64), how
        scaled = self.vectors / scale
        lift = np.sqrt(np.maximum(longest**2 - (scaled**2).sum(axis=1), 0.0))
        self.longest, self.axes = longest, orthogonal(vectors.shape[1] + 1, how.directions, how.seed)
        projected = (scaled @ self.axes[:-1] + lift[:, None] * self.axes[-1]).T
        self.order = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(projected, self.order, axis=1)
        rng = np.random.default_rng(how.seed)
        self.sample = projected[:, rng.permutation(len(ids))[: how.sample]]

    def first_width(self, at: np.ndarray, wanted: int, needed: int) -> float:
        """Just below the width at which ``wanted`` vectors collide, as the sample has it."""
        apart = np.partition(np.abs(self.sample - at[:, None]), needed - 1, axis=0)[needed - 1]
        place = min(len(apart) - 1, wanted * len(apart) // len(self.ids))
        return float(np.partition(apart, place)[place]) * self.how.first_width

    def window(self, at: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        low = np.fromiter((s.searchsorted(x - width, "left") for s, x in zip(self.sorted, at)), np.int64, len(at))
        high = np.fromiter((s.searchsorted(x + width, "right") for s, x in zip(self.sorted, at)), np.int64, len(at))
        return low, high

    def tally(self, pieces: list[np.ndarray]) -> np.ndarray:
        return np.bincount(np.concatenate(pieces), minlength=len(self.ids))

    def candidates(self, at: np.ndarray, wanted: int) -> np.ndarray:
        """Rows that collide often enough with a query that projects to ``at``."""
        n, many = len(self.ids), len(at)
        needed = max(1, round(self.how.threshold * many))
        width = self.first_width(at, wanted, needed)
        low, high = self.window(at, width)
        # Collisions of the first windows are what does not lie outside of them, where that is less.
        if 2 * int((high - low).sum()) > n * many:
            outside = [o[:a] for o, a in zip(self.order, low)] + [o[b:] for o, b in zip(self.order, high)]
            counts = many - self.tally(outside)
        else:
            counts = self.tally([o[a:b] for o, a, b in zip(self.order, low, high)])
        while True:
            found = np.flatnonzero(counts >= needed)
            if len(found) >= min(wanted, n) or bool((low == 0).all() and (high == n).all()):
                return found
            # A sample of equal vectors can start at no width at all.
            width = max(width * self.how.widen, np.finfo(float).eps * self.longest)
            wider_low, wider_high = self.window(at, width)
            rings = [o[a:b] for o, a, b in zip(self.order, wider_low, low)]
            rings += [o[a:b] for o, a, b in zip(self.order, high, wider_high)]
            counts += self.tally(rings)
            low, high = wider_low, wider_high

    def search(self, query_id: int, query: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best candidates, ties to smaller ids."""
        wanted = int(self.how.share * len(self.ids)) + top + 1
        # A query's length changes no order; at the vectors' length it meets them best.
        turned = query / np.abs(query).max()
        turned *= self.longest / np.sqrt(turned @ turned)
        found = self.candidates(turned @ self.axes[:-1], wanted)
        found = found[self.ids[found] != query_id]
        scores = self.vectors[found] @ query
        best = np.lexsort((self.ids[found], -scores))[:top]
        return self.ids[found][best], scores[best]


def matrix(values: bytes, width: int) -> np.ndarray:
    return np.frombuffer(values, "<f8").reshape(-1, width)


def packed_rows(frame: DataFrame, group: str, name: str) -> DataFrame:
    """(group, name_ids, name_vectors): the rows of each group as arrays end to end."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        ids = rows["id"].to_numpy("<i8").tobytes()
        vectors = np.stack(rows["vector"].to_list()).astype("<f8").tobytes()
        return pd.DataFrame({group: rows[group].iloc[:1], f"{name}_ids": [ids], f"{name}_vectors": [vectors]})

    kind = dict(frame.dtypes)[group]
    return frame.groupBy(group).applyInPandas(pack, f"{group} {kind}, {name}_ids binary, {name}_vectors binary")


def searched(width: int, scale: float, longest: float, top: int, how: Search):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, Block] = {}
        for rows in batches:
            for block, ids, vectors, query_ids, queries in rows[
                ["block", "of_ids", "of_vectors", "query_ids", "query_vectors"]
            ].itertuples(index=False):
                if block not in held:
                    held = {block: Block(np.frombuffer(ids, "<i8"), matrix(vectors, width), scale, longest, how)}
                out = []
                for number, query in zip(np.frombuffer(query_ids, "<i8"), matrix(queries, width)):
                    found, scores = held[block].search(number, query, top)
                    out.append(pd.DataFrame({"query_id": number, "vec_id": found, "score": scores}))
                yield pd.concat(out, ignore_index=True)

    return run


def nearest(
    vectors: DataFrame, queries: DataFrame, top: int = 20, key: str = "vec_id", vector: str = "embedding", how: Search = Search()
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` largest inner products found per query.

    Both frames hold (key, vector). Null, zero or non-finite vectors and null ids take no part, nor
    do vectors of another length than the most common one. A query never meets
    its own id. Rows that repeat an id are candidates each; ties go to the smaller id.
    Queries meet the index block by block: the work is queries times vectors,
    held in tasks of fixed size.
    """

    def usable(frame: DataFrame) -> DataFrame:
        wide = frame.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        wide = wide.filter("id is not null").filter(fine)
        # Greatest component, and length in its terms: neither under- nor overflows.
        peak = F.array_max(F.transform("vector", F.abs))
        square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("peak")) * (x / F.col("peak")))
        return wide.withColumn("peak", peak).filter("peak > 0").withColumn("length", F.sqrt(square))

    spark = vectors.sparkSession
    rows = stored(usable(vectors), "vectors")
    shape = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"), F.max("peak").alias("peak"))
    first = shape.orderBy(F.desc("n"), "width").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if first is None:
        return spark.createDataFrame([], schema)
    width, count, scale = first["width"], first["n"], first["peak"]
    same = rows.filter(F.size("vector") == width)
    longest = same.select(F.max(F.col("peak") / scale * F.col("length"))).first()[0]
    blocks = max(1, -(-count // how.block_rows))
    asked = stored(usable(queries).filter(F.size("vector") == width), "queries")
    parts = max(1, -(-asked.count() // how.query_rows))
    dealt = same.select(
        "id", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    )
    index = packed_rows(dealt, "block", "of")
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int").alias("part")
    batch = packed_rows(asked.select("id", "vector", part), "part", "query")
    every = batch.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = every.join(index, "block").repartition(max(1, min(blocks * parts, 100_000)), "block", "part")
    found = pairs.mapInPandas(searched(width, scale, longest, top, how), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
