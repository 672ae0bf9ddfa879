"""Toxicity classifier by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, a sample of all documents is the
unlabelled set, and the share of toxic rows among the labelled ones is the class prior
``pi``.  The risk ``pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1))`` needs no negative
examples; while its second part is below zero, that part is stepped back from, so the
model cannot push it down by overfitting.  An L1 penalty keeps few weights, so the
ordinary words of a long document add nothing.

A score looks at the text only: the distinct words in lower case, and their beginnings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
BEGINNING = 5
POSITIVES = 2500
UNLABELLED = 5000
STEPS = 250
PENALTY = 3e-4
FOLDS = 5
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 200_000
_SIZE = 1 << BITS


def word_features(word: str) -> tuple[int, int]:
    """Feature numbers of a word and of its beginning."""
    whole = word.encode("utf-8", "surrogatepass")
    start = b"^" + word[:BEGINNING].encode("utf-8", "surrogatepass")
    return crc32(whole) & _SIZE - 1, crc32(start) & _SIZE - 1


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Model:
    """Weights by feature number; ``score`` is the estimated probability of toxicity."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None, known: dict[str, float] | None = None) -> float:
        known = {} if known is None else known
        total = self.bias
        for word in sorted(words(text)):
            value = known.get(word)
            if value is None:
                if len(known) >= _CACHE:
                    known.clear()
                whole, start = word_features(word)
                value = known[word] = float(self.weights[whole] + self.weights[start])
            total += value
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -35.0, 35.0))))


def fit(
    positives: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    steps: int = STEPS,
    penalty: float = PENALTY,
) -> Model:
    """Minimise the non-negative risk of a linear model by proximal gradient steps."""
    weights = np.zeros(_SIZE)
    if not positives or not unlabelled or not 0.0 < prior < 1.0:
        return Model(weights, -35.0 if prior <= 0.0 or not positives else 35.0 * (prior >= 1.0))
    rows = [*positives, *unlabelled]
    lengths = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if lengths.sum() else np.empty(0, np.int64)
    # A feature that hardly any positive has says nothing about toxicity.
    support = np.bincount(flat[: lengths[: len(positives)].sum()], minlength=_SIZE)
    used = np.flatnonzero(support >= max(3, len(positives) // 1000))
    number = np.full(_SIZE, -1, np.int32)
    number[used] = np.arange(len(used))
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
    feature = number[flat]
    owner, feature = owner[feature >= 0], feature[feature >= 0]
    del flat
    p = np.arange(len(rows)) < len(positives)
    share = np.where(p, 1.0 / len(positives), 1.0 / len(unlabelled))
    w, bias = np.zeros(len(used)), float(np.log(prior / (1.0 - prior)))
    mean, spread = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(owner, weights=w[feature], minlength=len(rows))
        up = 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))
        loss_negative = np.logaddexp(0.0, z)
        second = (share * loss_negative * np.where(p, -prior, 1.0)).sum()
        slope_second = share * up * np.where(p, -prior, 1.0)
        slope = slope_second + share * np.where(p, prior * (up - 1.0), 0.0)
        if second < 0.0:
            slope = -slope_second
        gradient = np.r_[
            np.bincount(feature, weights=slope[owner], minlength=len(used)), slope.sum()
        ]
        mean += 0.1 * (gradient - mean)
        spread += 0.01 * (gradient**2 - spread)
        scale = np.sqrt(spread / (1.0 - 0.99**step)) + 1e-6
        move = 0.1 * (mean / (1.0 - 0.9**step)) / scale
        w -= move[:-1]
        bias -= float(move[-1])
        shrink = 0.1 * penalty / scale[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(shrink, 0.05), 0.0)
    weights[used] = w
    return Model(weights, bias)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def _feature_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [sorted(f for w in words(t) for f in word_features(w)) for t in batch["text"]]
        yield pd.DataFrame(
            {"positive": batch["positive"], "unlabelled": batch["unlabelled"], "features": found}
        )


def train(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED
) -> Model:
    """Fit on at most ``positives`` confirmed and ``unlabelled`` unlabelled documents.

    Both samples are the first rows in hash order, which a lost executor cannot change.
    Only their feature numbers reach the driver, whatever the size of the input.
    """
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic")
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    order = F.xxhash64("doc_id")
    toxic = known.where("toxic = 1").select("doc_id").distinct()
    toxic = toxic.orderBy(order, "doc_id").limit(positives).withColumn("positive", F.lit(True))
    some = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id")
    some = some.orderBy(order, "doc_id").limit(unlabelled).distinct()
    chosen = toxic.join(some.withColumn("unlabelled", F.lit(True)), "doc_id", "full")
    # At most positives + unlabelled ids.
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text",
        F.coalesce("positive", F.lit(False)).alias("positive"),
        F.coalesce("unlabelled", F.lit(False)).alias("unlabelled"),
    )
    schema = "positive boolean, unlabelled boolean, features array<int>"
    rows = picked.mapInPandas(_feature_batches, schema).toPandas()
    arrays = [np.asarray(f, dtype=np.int32) for f in rows["features"]]
    flags = rows[["positive", "unlabelled"]].to_numpy()
    del rows
    places = sorted(range(len(arrays)), key=lambda i: (len(arrays[i]), arrays[i].tobytes()))
    chosen_p = [arrays[i] for i in places if flags[i, 0]]
    chosen_u = [arrays[i] for i in places if flags[i, 1]]
    return fit(chosen_p, chosen_u, float(prior or 0.0))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``score`` and ``predicted`` for every whole text.

    Null and empty texts have the score of a text without words.  Rows are scored one by
    one, so repeated rows, null ids and any other columns make no difference; a column
    named ``score`` or ``predicted`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for batch in texts:
            yield pd.Series([shared.value.score(t, known) for t in batch], dtype="float64")

    scored = docs.withColumn("score", score(F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
