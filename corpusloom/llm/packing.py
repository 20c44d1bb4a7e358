"""Best-fit packing of tokenised documents by minimum bin slack.

Gupta and Ho, "A new heuristic algorithm for the one-dimensional bin-packing
problem" (1999): bin by bin, the fullest feasible combination of the lengths
still there is found and removed. What is feasible depends on the lengths
alone, and there are at most ``size`` of them, so the search runs on their
counts: a subset-sum bitset finds the fullest combination with the longest
length left, and the combination is used as often as the counts allow. The
driver sees one count per length. Pieces get their places by their
rank among those of equal length, in Spark.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import stored

CACHED_CHUNKS = 150_000
CLOSING = ",.;:!?"
# Rows that share a length and a bucket are ranked in one task.
RANKED_TOGETHER = 100_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


class Chunks(dict):
    """Ids of a chunk of text as little-endian bytes; forgets all when it holds too many.

    A letter and closing punctuation after it never share a token, so the word
    is looked up without it.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        stem = chunk.rstrip(CLOSING)
        if stem and len(stem) < len(chunk) and stem[-1].isalpha():
            value = self[stem] + self[chunk[len(stem) :]]
        else:
            value = array("I", self.encode(chunk)).tobytes()
        if len(self) >= CACHED_CHUNKS:
            self.clear()
        self[chunk] = value
        return value


class Encoder:
    """Token ids of whole texts by a rank file, with a cache of chunks.

    Strings of ``special`` tokens inside a text are these tokens, as the vocabulary's own library has it.
    ``pattern`` must start a new token before every space that a visible character
    follows, as that of the public vocabularies does; so a text is the sum of its
    chunks between such spaces.
    """

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken

        with open(vocabulary.path, "rb") as lines:
            pairs = (line.split() for line in lines)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.special = {name: array("I", [number]).tobytes() for name, number in vocabulary.special}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        plain = tiktoken.Encoding(
            "own", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens=dict(vocabulary.special)
        )
        self.cache = Chunks(plain.encode_ordinary)
        self.decode_bytes = plain.decode_bytes

    def chunks(self, text: str) -> list[str]:
        parts = text.split(" ")
        out = [parts[0]]
        for part in parts[1:]:
            if part == "" or part[0].isspace():
                out[-1] += " " + part
            else:
                out.append(" " + part)
        return out

    def ordinary(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.chunks(text)))

    def encode(self, text: str) -> bytes:
        if not any(name in text for name in self.special):
            return self.ordinary(text)
        return b"".join(self.special.get(part) or self.ordinary(part) for part in self.cut.split(text))

    def decode(self, ids: array) -> str:
        return self.decode_bytes(list(ids)).decode("utf-8")


def cuts(length: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the pieces; only the first may be short of ``size``."""
    first = length - (max(length - 1, 0) // size) * size
    yield 0, first
    for start in range(first, length, size):
        yield start, start + size


@dataclass(frozen=True)
class Vocabulary:
    """A rank file, the same on all workers, the pattern that splits text before merging, and special tokens."""

    path: str
    pattern: str
    special: tuple[tuple[str, int], ...] = ()


def tokenised(vocabulary: Vocabulary, size: int, end_id: int):
    tail = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        for rows in batches:
            for at in range(0, len(rows), 512):
                some = rows.iloc[at : at + 512]
                out = []
                for key, text in zip(some["doc_id"], some["text"]):
                    ids = (encoder.encode(text) if isinstance(text, str) else b"") + tail
                    for n, (start, end) in enumerate(cuts(len(ids) // 4, size)):
                        part = ids[4 * start : 4 * end]
                        out.append((key, n, start, end - start, zlib.crc32(part), part))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])

    return run


def pieces(
    docs: DataFrame,
    vocabulary: Vocabulary,
    size: int = 1024,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids) of every document.

    A document is its token ids and ``end_id``; a null or empty text is the end id
    alone. Strings of the vocabulary's special tokens in a text are these tokens. Repeated rows
    are documents each.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(tokenised(vocabulary, size, end_id), PIECES)


def fullest(counts: dict[int, int], first: int, room: int) -> list[int]:
    """Lengths that fill ``room`` best, by a subset-sum bitset over what is left.

    Bit n of a state is set when lengths of sum n exist among those seen so far;
    walking the states back names the lengths. A full combination ends the search.
    """
    states, used, reach = [1], [], (1 << (room + 1)) - 1
    for length in sorted((n for n in counts if n <= room), reverse=True):
        available = min(counts[length] - (length == first), room // length)
        step = 1
        while available > 0 and not states[-1] >> room & 1:
            some = min(step, available)
            states.append((states[-1] | states[-1] << some * length) & reach)
            used.append((length, some))
            available -= some
            step *= 2
    total, out = states[-1].bit_length() - 1, []
    for (length, some), before in zip(reversed(used), reversed(states[:-1])):
        if not before >> total & 1:
            out += [length] * some
            total -= length * some
    return out


@dataclass(frozen=True)
class Use:
    """``times`` bins from ``bin`` on hold pieces first.. of ``length`` at ``offset``."""

    length: int
    first: int
    times: int
    bin: int
    offset: int


def plan(counts: dict[int, int], size: int) -> list[Use]:
    """Which bins take which pieces, as runs of equal bins."""
    left, taken = dict(counts), dict.fromkeys(counts, 0)
    uses, bins = [], 0
    while left:
        first = max(left)
        content = [first, *fullest(left, first, size - first)]
        need = {n: content.count(n) for n in set(content)}
        times = min(left[n] // k for n, k in need.items())
        offset = 0
        for length in content:
            uses.append(Use(length, taken[length], times, bins, offset))
            taken[length] += times
            left[length] -= times
            offset += length
        left = {n: c for n, c in left.items() if c}
        bins += times
    return uses


def ranked(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` with their rank among those of equal length, no length in one task."""
    buckets = max(1, -(-total // RANKED_TOGETHER)) * 8
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
    rows = rows.withColumn("bucket", bucket)
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("base"))
    within = F.row_number().over(
        Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    )
    return (
        rows.withColumn("within", within - 1)
        .join(bases, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("within"))
        .drop("bucket", "within", "base")
    )


def pack(rows: DataFrame, size: int = 1024) -> DataFrame:
    """``rows`` of ``pieces`` (all lengths at most ``size``) with sequence_id and offset.

    Every piece gets exactly one place; sequences are gapless from 0. Rows are read more than once: pass a stored
    table. Without rows the result is empty.
    """
    spark = rows.sparkSession
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    uses = [(u.length, u.first, u.first + u.times, u.bin, u.offset) for u in plan(counts, size)]
    names = "length long, first long, last long, bin long, offset long"
    table = spark.createDataFrame(uses, names)
    # A row per length and run of equal bins; bounded by the lengths, not by the rows.
    runs = table.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "bin", "offset"))).alias("runs")
    )
    placed = ranked(rows, sum(counts.values())).join(F.broadcast(runs), "length")
    hit = F.filter("runs", lambda r: (r["first"] <= F.col("rank")) & (r["last"] > F.col("rank")))[0]
    placed = placed.withColumn("hit", hit)
    sequence = F.col("hit.bin") + F.col("rank") - F.col("hit.first")
    return (
        placed.withColumn("sequence_id", sequence)
        .withColumn("offset", F.col("hit.offset"))
        .drop("hit", "runs", "rank")
    )


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, spans): the packed sequences of pieces that carry ``ids``.

    ``ids`` are little-endian 32-bit ids end to end, ``spans`` what lies where.
    """
    span = F.struct("offset", "length", "doc_id", "piece", "ids")
    content = F.sort_array(F.collect_list(span))
    joined = F.aggregate(F.transform("c", lambda s: s["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    spans = F.transform("c", lambda s: s.dropFields("ids"))
    return placed.groupBy("sequence_id").agg(content.alias("c")).select(
        "sequence_id", joined.alias("ids"), spans.alias("spans")
    )


def packed_documents(docs: DataFrame, vocabulary: Vocabulary, size: int = 1024, ids: bool = False) -> DataFrame:
    """Cut, store and pack whole documents; with ``ids`` the token ids come along."""
    made = pieces(docs, vocabulary, size)
    made = stored(made if ids else made.drop("ids"), "pieces")
    return pack(made, size)
