"""Ranked lexical search by the best position algorithm.

Akbarinia, Pacitti, Valduriez, "Best Position Algorithms for Top-k Queries" (2007), run on
blocks of documents. A block has, for every query term, a list of its documents by falling impact,
and by document its impacts and their positions. An item reads its terms' lists in parallel; a document seen in one list
is looked up in all others by direct access, and its position there counts as seen, too. The best
position of a list is the end of its seen prefix. No unseen document
can score more than the sum of the impacts there, and reading stops when this sum is strictly below the
k-th score: an equal score could still win by a smaller id. The k-th score of an item is carried from
block to block of a task. Tasks emit their best; the final ranks are taken over all of them.

Frequencies are counted in a first pass, for the items' terms only. No document leaves its task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.terms import LETTERS_AND_DIGITS, terms

RESULT = "item_id long, rank int, doc_id long, score long"


@dataclass(frozen=True)
class Ranking:
    """``top`` is the rule, the rest bounds memory and changes no result."""

    top: int = 50
    # Bytes of item texts whose terms are broadcast at once; more items are searched in rounds.
    item_bytes: int = 16 << 20
    # Words of documents in a block of impact lists.
    block_words: int = 4 << 20
    first_depth: int = 16


@dataclass(frozen=True)
class Weights:
    """What scores need from all documents: N, L and, per query term, a weight."""

    documents: int
    words: int
    weight: np.ndarray


class Numbers(dict):
    """Number of a query term, -1 for any other."""

    def __missing__(self, term: bytes) -> int:
        return -1


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_norms(sizes: np.ndarray, known: Weights) -> np.ndarray:
    """m of documents with so many terms; in Python's integers where 64 bits could overflow."""
    if int(sizes.max(initial=0)) * 50 * known.documents < 2**63:
        return 50 + (50 * sizes * known.documents) // max(known.words, 1)
    return np.array([50 + (50 * int(n) * known.documents) // known.words for n in sizes], np.int64)


class Lists:
    """Impact lists of a block of documents, and direct access to them by document."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, sizes: np.ndarray, known: Weights):
        """``doc``, ``term`` and ``tf`` are postings ordered by document."""
        self.ids = ids
        impact = known.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * length_norms(sizes, known)[doc]))
        kept = impact > 0
        doc, term, impact = doc[kept], term[kept], impact[kept]
        order = np.lexsort((doc, -impact, term))
        self.docs, self.impacts = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(known.weight) + 1))
        # By document: its terms, and where they are in the lists.
        self.terms, self.at = term, np.empty(len(order), np.int64)
        self.at[order] = np.arange(len(order))
        self.rows = np.searchsorted(doc, np.arange(len(ids) + 1))

    def direct(self, docs: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of ``docs`` over the terms marked in ``own``; positions in the lists, and their terms."""
        first, n = self.rows[docs], self.rows[docs + 1] - self.rows[docs]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(first - (ends - n), n)
        hit = own[self.terms[at]]
        at, of = at[hit], np.repeat(np.arange(len(docs)), n)[hit]
        seen = self.at[at]
        # Sums of integers below 2**53, exact in doubles.
        scores = np.bincount(of, self.impacts[seen], len(docs)).astype(np.int64)
        return scores, seen, self.terms[at]

    def search(self, item: np.ndarray, best: Best, depth: int) -> int:
        """Add this block's best documents for the terms ``item`` to ``best``; documents looked up."""
        item = item[self.starts[item + 1] > self.starts[item]]
        if not len(item):
            return 0
        starts, ends = self.starts[item], self.starts[item + 1]
        sizes = ends - starts
        base = np.cumsum(sizes) - sizes
        # Positions seen of all lists end to end, each list with a stop behind it.
        base = base + np.arange(len(item))
        seen = np.zeros(int(sizes.sum()) + len(item), bool)
        own = np.zeros(len(self.starts) - 1, bool)
        own[item] = True
        shift = np.zeros(len(self.starts) - 1, np.int64)
        shift[item] = base - starts
        met = np.zeros(len(self.ids), bool)
        read, looked_up = 0, 0
        position = np.zeros(len(item), np.int64)
        while True:
            # The best positions so far; what is behind them bounds all documents not yet met.
            inside = position < sizes
            bound = int(self.impacts[(starts + position)[inside]].sum())
            if not inside.any() or bound < best.least():
                return looked_up
            till = np.minimum(starts + read + depth, ends)
            found = [self.docs[a:b] for a, b in zip(np.minimum(starts + read, ends), till) if a < b]
            docs = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
            docs = docs[~met[docs]]
            if len(docs):
                met[docs] = True
                scores, at, of = self.direct(docs, own)
                seen[at + shift[of]] = True
                best.add(self.ids[docs], scores)
                looked_up += len(docs)
            read += depth
            depth *= 2
            unseen = np.flatnonzero(~seen)
            position = unseen[np.searchsorted(unseen, base)] - base


class Best:
    """The best documents of one item so far."""

    def __init__(self, top: int):
        self.top, self.ids, self.scores = top, np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> int:
        """The k-th score; a score must be above 0 anyway."""
        return int(self.scores[-1]) if len(self.scores) >= self.top else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.least()
        if good.any():
            ids, scores = np.concatenate((self.ids, ids[good])), np.concatenate((self.scores, scores[good]))
            order = np.lexsort((ids, -scores))[: self.top]
            self.ids, self.scores = ids[order], scores[order]


def numbered_words(text: bytes, numbers: Numbers) -> np.ndarray:
    """The numbers of a text's terms in order, -1 for those of no item."""
    found = [np.fromiter(map(numbers.__getitem__, some), np.int64, len(some)) for some in terms(text, LETTERS_AND_DIGITS)]
    return found[0] if len(found) == 1 else np.concatenate(found or [np.empty(0, np.int64)])


def postings(words: list[np.ndarray], n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, frequency) of the numbered terms of several documents, ordered."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    every = np.concatenate(words)
    doc = np.repeat(np.arange(len(words)), lengths)[every >= 0]
    key, tf = np.unique(doc * n_terms + every[every >= 0], return_counts=True)
    return key // n_terms, key % n_terms, tf.astype(np.int64)


def frequencies(shared):
    """(term, documents, words): per term number its documents, and at -1 all documents with a term and their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(shared.value)
        found: Counter = Counter()
        documents = words = 0
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                own = numbered_words(text.as_py() or b"", numbers)
                documents += len(own) > 0
                words += len(own)
                found.update(np.unique(own[own >= 0]).tolist())
        columns = [[-1, *found], [documents, *found.values()], [words, *[0] * len(found)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["term", "documents", "words"])

    return run


def searched(shared, how: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbered, items, known = shared.value
        numbers = Numbers(numbered)
        best = {item: Best(how.top) for item in items}

        def block(ids: list[int], words: list[np.ndarray]) -> None:
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            lists = Lists(np.array(ids, np.int64), *postings(words, max(len(numbered), 1)), sizes, known)
            for item, own in items.items():
                lists.search(own, best[item], how.first_depth)

        ids: list[int] = []
        words: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                own = numbered_words(text.as_py() or b"", numbers)
                if len(own):
                    ids.append(key)
                    words.append(own)
                    held += len(own)
                if held >= how.block_words:
                    block(ids, words)
                    ids, words, held = [], [], 0
        if ids:
            block(ids, words)
        for item, found in best.items():
            n = len(found.ids)
            columns = [pa.array(np.full(n, item)), pa.array(found.ids), pa.array(found.scores)]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    return run


def ranked(
    docs: DataFrame, items: DataFrame, how: Ranking = Ranking(), key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item with a score above 0.

    Null and empty texts have no term; documents without one count nowhere. Equal scores go to the smaller id.
    Rows that repeat a doc_id are documents each; a document without an id counts in the frequencies but cannot
    be named as a result. Rows that repeat an item_id are one item with the terms of all; items without an id are not searched.
    Other columns are not read. Without documents or items the result is empty.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = items.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked = asked.filter("item_id is not null and text is not null")
    size = asked.select(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // how.item_bytes))
    best = None
    for n in range(rounds):
        some = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == n).collect()
        held: dict[int, set[bytes]] = {}
        for row in some:
            for own in terms(row["text"].encode(), LETTERS_AND_DIGITS):
                held.setdefault(row["item_id"], set()).update(own)
        numbers = {term: i for i, term in enumerate(sorted(set().union(*held.values())))}
        if not numbers:
            continue
        context = spark.sparkContext
        counted = texts.select("text").mapInArrow(frequencies(context.broadcast(numbers)), "term long, documents long, words long")
        total = {r["term"]: (r["documents"], r["words"]) for r in counted.groupBy("term").agg(
            F.sum("documents").alias("documents"), F.sum("words").alias("words")).collect()}
        documents, words = total.get(-1, (0, 0))
        weight = np.array([term_weight(documents, total.get(i, (0, 0))[0]) for i in range(len(numbers))], np.int64)
        own = {i: np.array(sorted(numbers[t] for t in some), np.int64) for i, some in held.items()}
        shared = context.broadcast((numbers, own, Weights(documents, words, weight)))
        found = texts.filter("doc_id is not null").mapInArrow(searched(shared, how), "item_id long, doc_id long, score long")
        best = found if best is None else best.union(found)
    if best is None:
        return spark.createDataFrame([], RESULT)
    falling = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    placed = best.withColumn("rank", F.row_number().over(falling)).filter(F.col("rank") <= how.top)
    return placed.select("item_id", "rank", "doc_id", "score")
