"""Toxicity scores by non-negative positive-unlabelled learning.

Kiryo et al., "Positive-Unlabeled Learning with Non-Negative Risk Estimator"
(2017). Only confirmed toxic documents carry a label in training; all other
training text is unlabelled and may be toxic or not. With class prior p, the
risk of the unlabelled rows taken as negatives is corrected by the positives'
share: p R+(P) + max(0, R-(U) - p R-(P)). Where the corrected part turns
negative the step goes back up, which keeps the classifier from memorising the
positives.

The classifier is linear over hashed words and word beginnings of a document,
each counted once, and scores a document of any length. Features that
positives hardly favour over unlabelled text are dropped before training.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fold_remainder

BITS = 20
PREFIXES = (3, 4, 5, 6)
CACHED_WORDS = 100_000
HELD_OUT = 2
# Parts in which the training sample, a few megabytes each, reaches the driver.
SAMPLE_PARTS = 16


@dataclass(frozen=True)
class Training:
    """Bounds and rates of the fit; the samples bound what reaches the driver."""

    positives: int = 4_000
    unlabelled: int = 12_000
    min_positives: int = 3
    min_posterior: float = 0.5
    epochs: int = 40
    batch: int = 2_000
    rate: float = 0.05
    shrink: float = 1e-3
    threshold: float = 0.3


class WordFeatures(dict):
    """Hashed features of a word: its letters and their first few."""

    def __missing__(self, word: str) -> np.ndarray:
        if len(self) >= CACHED_WORDS:
            self.clear()
        bare = "".join(c for c in word if c.isalnum())
        names = {bare} | {f"^{bare[:n]}" for n in PREFIXES if len(bare) > n} if bare else set()
        hashed = {zlib.crc32(n.encode("utf-8", "surrogatepass")) >> (32 - BITS) for n in names}
        value = self[word] = np.array(sorted(hashed), np.int32)
        return value


def features(text: str | None, cache: WordFeatures) -> np.ndarray:
    found = [cache[w] for w in set((text or "").lower().split())]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = WordFeatures()
    for rows in batches:
        yield pd.DataFrame(
            {"positive": rows["positive"], "found": [features(t, cache).tobytes() for t in rows["text"]]}
        )


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


@dataclass
class Rows:
    """Feature sets laid end to end."""

    values: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Rows:
        sizes = np.array([len(s) for s in sets], np.int64)
        return cls(np.concatenate([np.zeros(0, np.int64), *sets]).astype(np.int64), sizes)

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weights[self.values])])
        ends = np.cumsum(self.sizes)
        return total[ends] - total[ends - self.sizes] + bias

    def gradient(self, slopes: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.values, np.repeat(slopes, self.sizes), width)


class Adam:
    def __init__(self, width: int, rate: float):
        self.rate, self.steps = rate, 0
        self.mean, self.square = np.zeros(width), np.zeros(width)

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.steps += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient**2
        mean = self.mean / (1 - 0.9**self.steps)
        return -self.rate * mean / (np.sqrt(self.square / (1 - 0.999**self.steps)) + 1e-8)


@dataclass
class Model:
    """Weights of the features kept, and the bias."""

    kept: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        if not len(self.kept):
            return float(sigmoid(np.array(self.bias)))
        at = np.minimum(np.searchsorted(self.kept, found), len(self.kept) - 1)
        hits = at[self.kept[at] == found]
        return float(sigmoid(np.array(self.weights[hits].sum() + self.bias)))


def risk_slopes(pos: np.ndarray, unl: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the non-negative risk by the logits, logistic loss."""
    negative = np.logaddexp(0, unl).mean() - prior * np.logaddexp(0, pos).mean()
    as_negative = sigmoid(unl) / len(unl)
    given_back = -prior * sigmoid(pos) / len(pos)
    if negative < 0:
        return -given_back, -as_negative
    return given_back - prior * (1 - sigmoid(pos)) / len(pos), as_negative


def counted(sets: list[np.ndarray]) -> np.ndarray:
    """How many sets hold each feature; a set holds it once."""
    total = np.zeros(1 << BITS, np.int64)
    for held in sets:
        total[held] += 1
    return total


def fit(
    positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, how: Training
) -> Model:
    """Train on feature sets; without positives every score is 0."""
    if not positives or not unlabelled:
        return Model(np.zeros(0, np.int32), np.zeros(0), -50.0)
    prior = min(max(prior, 1e-4), 0.5)
    in_pos, in_unl = counted(positives), counted(unlabelled)
    posterior = prior * (in_pos / len(positives)) / ((in_unl + 2) / (len(unlabelled) + 2))
    keep = (in_pos >= how.min_positives) & (posterior >= how.min_posterior)
    kept = np.flatnonzero(keep).astype(np.int32)
    place = np.cumsum(keep) - 1
    pos = [place[s[keep[s]]] for s in positives]
    unl = [place[s[keep[s]]] for s in unlabelled]
    width = len(kept)
    state = np.concatenate([np.zeros(width), [np.log(prior / (1 - prior))]])
    rng, adam = np.random.default_rng(0), Adam(width + 1, how.rate)
    parts = max(1, len(unl) // how.batch)
    for _ in range(how.epochs):
        deal_p, deal_u = rng.permutation(len(pos)), rng.permutation(len(unl))
        for part in range(parts):
            some_p = Rows.of([pos[i] for i in deal_p[part::parts]] or pos)
            some_u = Rows.of([unl[i] for i in deal_u[part::parts]])
            weights, bias = state[:-1], state[-1]
            slope_p, slope_u = risk_slopes(
                some_p.logits(weights, bias), some_u.logits(weights, bias), prior
            )
            gradient = some_p.gradient(slope_p, width) + some_u.gradient(slope_u, width)
            gradient = gradient + how.shrink * weights
            state = state + adam.step(np.append(gradient, slope_p.sum() + slope_u.sum()))
    return Model(kept, state[:-1], float(state[-1]))


def some(rows: DataFrame, key: str, total: int, bound: int) -> DataFrame:
    """About ``bound`` rows, chosen by a hash of the id."""
    share = min(1.0, bound / max(total, 1))
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """Fit on the folds that are not held out.

    ``docs`` has (key, text), ``labels`` (key, toxic); of several labels of one
    id the highest counts. The prior is the toxic share of all labelled rows.
    """
    known = labels.filter("key is not null and toxic is not null").groupBy("key")
    known = known.agg(F.max("toxic").alias("toxic")).filter(fold_remainder(F.col("key")) != HELD_OUT)
    total, toxic = known.agg(F.count("*"), F.sum(F.col("toxic").cast("long"))).first()
    if not toxic:
        return fit([], [], 0.0, how)
    open_docs = docs.filter("key is not null").filter(fold_remainder(F.col("key")) != HELD_OUT)
    confirmed = some(known.filter("toxic = 1"), "key", toxic, how.positives).select("key")
    pos = open_docs.join(F.broadcast(confirmed), "key", "left_semi")
    unl = some(open_docs, "key", open_docs.count(), how.unlabelled)
    rows = pos.select("text", F.lit(True).alias("positive")).union(
        unl.select("text", F.lit(False).alias("positive"))
    )
    # One part after the other, so that the driver's JVM never holds the whole sample beside Python's.
    found = rows.mapInPandas(packed, "positive boolean, found binary").repartition(SAMPLE_PARTS).toLocalIterator()
    split: dict[bool, list[bytes]] = {True: [], False: []}
    for row in found:
        split[row["positive"]].append(bytes(row["found"]))
    # Rows arrive in any order; the fit must not depend on it.
    positives, unlabelled = ([np.frombuffer(values, np.int32) for values in sorted(split[flag])] for flag in (True, False))
    return fit(positives, unlabelled, toxic / total, how)


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1; null and empty texts score as no words at all."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = WordFeatures()
        for texts in batches:
            yield pd.Series([model.score(features(t, cache)) for t in texts], dtype="float64")

    return docs.withColumn(name, score(F.col(text)))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    how: Training = Training(),
) -> DataFrame:
    """``docs`` with held_out, score and predicted.

    Only the text enters a score, so equal texts score alike. Rows are neither
    dropped nor added; columns of those names are replaced. A null id is held
    out of training. Without a positive label all scores are 0.
    """
    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("toxic"))
    model = train(plain, known, how)
    held = F.coalesce(fold_remainder(F.col(key)) == HELD_OUT, F.lit(True))
    out = scored(docs.withColumn("held_out", held), model, text)
    return out.withColumn("predicted", (F.col("score") >= how.threshold).cast("int"))
