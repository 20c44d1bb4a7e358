"""How the sources of a language differ in their terms, by a minimal-perfect-hash recount.

The first pass counts, exactly, in how many documents of a language a term occurs, and keeps the
frequent ones. The kept terms are cut into shards; each gets a minimal perfect hash
that stores its keys. The shards are broadcast, a bounded number of bytes at a time, and the second pass
looks every term up, compares it with the stored key and increments a slot of a dense
array per group and shard. Arrays are emitted when a task holds too many slots, and summed by slot.

Pairs of sources are compared on blocks of slots: a block is a dense matrix of groups times slots of a
bounded size, and what a pair differs by in a block is added up over the blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import stored
from corpusloom.llm.perfect_hash import Shard, Shards
from corpusloom.llm.terms import LETTERS, terms

RESULT = "lang string, source string, part string, item string, value long, rank int"


@dataclass(frozen=True)
class Audit:
    """``min_docs`` and ``ranks`` are the rule, the rest bounds memory and changes no result."""

    min_docs: int = 30
    ranks: int = 50
    scale: int = 1_000_000_000
    smoothing: int = 5
    keys_per_shard: int = 2_048
    bytes_per_round: int = 64 << 20
    terms_held: int = 500_000
    slots_held: int = 12 << 20
    cells: int = 1 << 15
    most_cells: int = 1 << 22


def readable(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def document_counts(how: Audit):
    """Per language and term the documents that hold it, summed over some documents at a time."""

    def emitted(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, some in counts.items():
            columns = [pa.array([lang] * len(some)), pa.array(list(some), pa.binary()), pa.array(some.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())
            for lang, text in zip(langs, texts):
                held: set[bytes] = set()
                for some in terms(text.as_py(), LETTERS):
                    held.update(some)
                counts.setdefault(lang, Counter()).update(held)
            if sum(map(len, counts.values())) > how.terms_held:
                yield from emitted(counts)
                counts.clear()
        yield from emitted(counts)

    return run


def kept_terms(docs: DataFrame, how: Audit) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` documents of the language."""
    partial = docs.select("lang", "text").mapInArrow(document_counts(how), "lang string, term binary, n long")
    kept = partial.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= how.min_docs)
    return kept.select("lang", "term")


def built(rows: pd.DataFrame) -> pd.DataFrame:
    made = Shard.build(rows["term"].to_list())
    same = {c: rows[c].iloc[:1] for c in ("lang", "shard", "shards")}
    return pd.DataFrame({**same, "seeds": [made.seeds.astype("<i8").tobytes()], "keys": [made.keys]})


def recounted(shared, how: Audit):
    """Occurrences of the broadcast shards' keys per group, shard and slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, own = {}, {}
        for lang, shard, shards, seeds, keys in shared.value:
            of[lang] = shards
            own.setdefault(lang, {})[shard] = Shard(np.frombuffer(seeds, "<i8"), keys)
        known = {lang: Shards(shards) for lang, shards in own.items()}
        dense: dict[tuple[str, str], np.ndarray] = {}

        def emitted() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in dense.items():
                at, its = np.flatnonzero(counts), known[lang]
                place = its.base.searchsorted(at, "right") - 1
                columns = [
                    pa.array([lang] * len(at), pa.string()),
                    pa.array([source] * len(at), pa.string()),
                    pa.array(its.numbers[place].astype(np.int32)),
                    pa.array((at - its.base[place]).astype(np.int32)),
                    pa.array(counts[at]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "shard", "slot", "n"])
            dense.clear()

        held = 0
        for batch in batches:
            groups: dict[str, dict[str, Counter]] = {}
            names = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(*names, batch.column("text").cast(pa.binary())):
                if lang in known:
                    counts = groups.setdefault(lang, {}).setdefault(source, Counter())
                    for some in terms(text.as_py(), LETTERS):
                        counts.update(some)
            for lang, sources in groups.items():
                # A term is looked up once, whatever the number of sources that use it.
                met = list(set().union(*sources.values()))
                slots = dict(zip(met, known[lang].slots(met, of[lang]).tolist()))
                for source, counts in sources.items():
                    if (lang, source) not in dense:
                        dense[lang, source] = np.zeros(len(known[lang].keys), np.int64)
                        held += len(known[lang].keys)
                    slot = np.fromiter(map(slots.__getitem__, counts), np.int64, len(counts))
                    n = np.fromiter(counts.values(), np.int64, len(counts))
                    dense[lang, source][slot[slot >= 0]] += n[slot >= 0]
            if held > how.slots_held:
                yield from emitted()
                held = 0
        yield from emitted()

    return run


COUNTS = "lang string, source string, shard int, slot int, n long"


def recount(docs: DataFrame, index: DataFrame, how: Audit) -> DataFrame:
    """(lang, source, shard, slot, n), n > 0: a pass over ``docs`` per round of shards that fits the bound."""
    spark = docs.sparkSession
    size = F.length("seeds") + F.aggregate("keys", F.lit(0), lambda a, k: a + F.length(k) + 48)
    whole, shards = index.select(F.sum(size.cast("long")), F.count(F.lit(1))).first()
    rounds = min(-(-(whole or 0) // how.bytes_per_round), shards)
    counted = spark.createDataFrame([], COUNTS)
    for n in range(rounds):
        some = index.filter(F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)) == n).collect()
        shards = [(r["lang"], r["shard"], r["shards"], bytes(r["seeds"]), [bytes(k) for k in r["keys"]]) for r in some]
        found = docs.mapInArrow(recounted(spark.sparkContext.broadcast(shards), how), COUNTS)
        found = found.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))
        counted = counted.union(stored(found, "recount"))
    return counted


def pair_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """What each pair of groups differs by in one block: group rows (slot -1) and cells."""
    head, cells = rows[rows["slot"] < 0], rows[rows["slot"] >= 0]
    head = head.sort_values("place")
    n, width = len(head), int(head["width"].iloc[0])
    p = np.repeat(head["p"].to_numpy(np.int64)[:, None], width, axis=1)
    p[cells["place"].to_numpy(), cells["slot"].to_numpy()] = cells["p"].to_numpy(np.int64)
    sums = np.stack([np.abs(p - p[i]).sum(axis=1) for i in range(n)])
    one, other = np.nonzero(~np.eye(n, dtype=bool))
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "one": one, "other": other, "part_value": sums[one, other]})


def source_divergence(docs: DataFrame, how: Audit = Audit()) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources, and the terms a source overuses.

    Null lang, source and text are empty strings; an empty string is a language or source like others.
    Every (lang, source) that occurs is a group, also without any term. ``p`` of a group and term is
    1 + floor(scale * (count + smoothing) / (N + smoothing * V)), with V kept terms of the language and N their
    occurrences in the group; all of it in exact integers. Part ``pair`` sums the differences of two sources of a language over
    the V terms (0 without terms); part ``term`` lists the terms a source uses more than its language, largest difference
    first, ties by the term's bytes. Repeated rows count each; other columns are not read. Without rows the result is empty.
    """
    docs = readable(docs)
    kept = stored(kept_terms(docs, how), "kept_terms")
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    shards = F.ceil(F.col("v") / how.keys_per_shard).cast("int")
    dealt = kept.join(of_lang, "lang").withColumn("shards", shards)
    dealt = dealt.select("lang", "term", "shards", F.pmod(F.crc32("term"), F.col("shards")).cast("int").alias("shard"))
    index = dealt.groupBy("lang", "shard").applyInPandas(
        built, "lang string, shard int, shards int, seeds binary, keys array<binary>"
    )
    index = stored(index, "perfect_hash")
    counts = recount(docs, index, how)

    slots = index.select("lang", "shard", F.posexplode("keys").alias("slot", "key"))
    in_groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    groups = docs.select("lang", "source").distinct().join(of_lang, "lang", "left").join(in_groups, ["lang", "source"], "left")
    groups = groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("v", "n_all")))
    ordered = Window.partitionBy("lang").orderBy("source")
    groups = stored(
        groups.withColumn("place", F.row_number().over(ordered) - 1).withColumn(
            "groups", F.count(F.lit(1)).over(Window.partitionBy("lang"))
        ),
        "groups",
    )

    def p(count: str, n_all: str):
        wide = f"cast({how.scale} as decimal(20, 0)) * cast({count} + {how.smoothing} as decimal(18, 0))"
        return F.expr(f"1 + ({wide} div cast({n_all} + {how.smoothing} * v as decimal(20, 0)))").cast("long")

    cells = stored(
        counts.join(groups, ["lang", "source"]).withColumn("p", p("n", "n_all"))
        .select("lang", "source", "place", "shard", "slot", "n", "p"),
        "cells",
    )

    # Blocks hold groups times slots up to a bound, and at least a pair's result per cell.
    shape = groups.groupBy("lang").agg(F.max("groups").alias("groups"), F.max("v").alias("v")).filter("groups > 1")
    room = F.least(F.greatest(F.lit(how.cells).cast("long"), F.col("groups") * F.col("groups")), F.lit(how.most_cells).cast("long"))
    per_block = F.greatest(F.lit(1).cast("long"), F.floor(room / F.col("groups")))
    shape = shape.select("lang", "groups", "v", per_block.alias("per_block"))
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / F.col("per_block")))
    # Slots are numbered through the shards of a language.
    before = F.sum(F.size("keys")).over(Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = index.select("lang", "shard", F.coalesce(before, F.lit(0)).alias("base"))
    body = cells.join(bases, ["lang", "shard"]).withColumn("at", F.col("base") + F.col("slot"))
    body = body.join(shape.select("lang", "per_block"), "lang")
    body = body.select(
        "lang", F.expr("at div per_block").alias("block"), "place", F.expr("at % per_block").alias("slot"), "p", F.lit(0).cast("long").alias("width")
    )
    heads = groups.join(shape.select("lang", "per_block"), "lang").withColumn("p", F.when(F.col("v") > 0, p("0", "n_all")).otherwise(0))
    heads = heads.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    width = F.least(F.col("per_block"), F.col("v") - F.col("block") * F.col("per_block"))
    heads = heads.select("lang", "block", "place", F.lit(-1).cast("long").alias("slot"), "p", width.alias("width"))
    sums = heads.union(body).groupBy("lang", "block").applyInPandas(pair_sums, "lang string, one int, other int, part_value long")
    sums = sums.groupBy("lang", "one", "other").agg(F.sum("part_value").cast("long").alias("value"))
    names = groups.select("lang", F.col("place").alias("one"), "source")
    others = groups.select("lang", F.col("place").alias("other"), F.col("source").alias("item"))
    pairs = sums.join(names, ["lang", "one"]).join(others, ["lang", "other"])
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(falling).alias("rank"))

    whole = cells.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("n_lang"))
    all_of = groups.groupBy("lang").agg(F.sum("n_all").alias("n_of_lang"), F.max("v").alias("v"))
    usual = whole.join(all_of, "lang").withColumn("q", p("n_lang", "n_of_lang")).select("lang", "shard", "slot", "q")
    usual = usual.join(slots.select("lang", "shard", "slot", F.col("key").cast("string").alias("item")), ["lang", "shard", "slot"])
    over = cells.join(usual, ["lang", "shard", "slot"]).withColumn("value", F.col("p") - F.col("q")).filter("value > 0")
    ranked = over.withColumn("rank", F.row_number().over(falling)).filter(F.col("rank") <= how.ranks)
    used = ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.union(used)
