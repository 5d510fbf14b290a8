"""A quality score learned from trusted positives and unlabelled texts.

Only positives are believed. Of the unlabelled texts, an estimated share (the class prior) is positive
too, so the risk on negatives is what the unlabelled texts show less what the positives explain; where
that falls below zero the model has begun to fit noise and the step goes back (non-negative risk).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from sondage.llm.tables import give_back
from sondage.llm.texts import SHAPES, describe, fold_of, sample, shapes

#: Parameters of the fit: rows of either kind at most, and the folds of which one is held out.
POSITIVES, UNLABELLED = 4_000, 8_000
FOLDS, HELD_OUT = 5, 0
HIDDEN, STEPS, BATCH, RATE, DECAY, SLACK = 24, 2_400, 512, 0.004, 1e-4, 0.01
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """One hidden layer over standardised features."""

    centre: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum((features - self.centre) / self.scale @ w1 + b1, 0) @ w2 + b2

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features).astype(float), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative unbiased risk under the logistic loss with Adam."""
    generator = np.random.default_rng(5)
    centre, scale = unlabelled.mean(axis=0), np.maximum(unlabelled.std(axis=0), 0.02)
    positive, unlabelled = (positive - centre) / scale, (unlabelled - centre) / scale
    width = positive.shape[1]
    weights = [
        generator.normal(0, np.sqrt(2 / width), (width, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
        generator.normal(0, np.sqrt(1 / HIDDEN), HIDDEN).astype(np.float32), np.float32(0),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        p = positive[generator.integers(0, len(positive), BATCH)]
        u = unlabelled[generator.integers(0, len(unlabelled), BATCH)]
        rows = np.concatenate([p, u])
        inner = rows @ weights[0] + weights[1]
        active = np.maximum(inner, 0)
        logits = active @ weights[2] + weights[3]
        chance = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        # Loss of a row as negative: log(1 + e^z), slope chance; as positive: log(1 + e^-z), slope chance - 1.
        as_negative = np.logaddexp(0, logits)
        negative_risk = as_negative[BATCH:].mean() - prior * as_negative[:BATCH].mean()
        slope = np.concatenate([-prior * chance[:BATCH], chance[BATCH:]]) / BATCH
        if negative_risk < -SLACK:
            slope = -slope
        else:
            slope[:BATCH] += prior * (chance[:BATCH] - 1) / BATCH
        back = np.outer(slope, weights[2]) * (inner > 0)
        slopes = [rows.T @ back, back.sum(axis=0), active.T @ slope, slope.sum()]
        rate = RATE * (1 - step / (STEPS + 1))
        for i, g in enumerate(slopes):
            g = g + DECAY * weights[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] = (weights[i] - rate * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(centre, scale, tuple(weights))


@F.pandas_udf(BinaryType())
def described(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    forms = shapes()
    for part in parts:
        yield pd.Series([describe(x or "", forms).tobytes() for x in part])
    forms.clear()
    give_back()


def class_prior(labels: DataFrame) -> float:
    """Share of positives, estimated from all training labels, less two standard errors of that estimate on
    the rows that the fit sees: a prior that is too high would leave no room for negatives. A half if
    there are no labels."""
    share, rows = labels.agg(F.avg(F.col("quality").cast("double")), F.count("*")).first()
    if share is None:
        return 0.5
    error = np.sqrt(max(share * (1 - share), 0.01) / min(rows, UNLABELLED))
    return float(np.clip(share - 2 * error, 0.02, 0.98))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on at most POSITIVES trusted positives and UNLABELLED texts whose labels are not looked at,
    all from the training folds; None if there are no positives or no texts."""
    believed = labels.where(F.col("quality").isNotNull() & (fold_of("doc_id", FOLDS) != HELD_OUT)).select("doc_id", "quality")
    prior = class_prior(believed)
    positives = sample(believed.where("quality = 1").select("doc_id").distinct(), "doc_id", POSITIVES)
    others = sample(docs.where(fold_of("doc_id", FOLDS) != HELD_OUT).select("doc_id").distinct(), "doc_id", UNLABELLED)
    chosen = positives.select("doc_id", F.lit(True).alias("positive")).unionByName(others.select("doc_id", F.lit(False).alias("positive")))
    # The sample is bounded by its two parameters, so it may be broadcast and its features collected.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    held = rows.select("doc_id", "positive", described("text").alias("f")).toPandas().sort_values(["positive", "doc_id", "f"])
    features = np.frombuffer(b"".join(held.f), np.float32).reshape(len(held), SHAPES + 8)
    positive = held.positive.to_numpy(bool)
    if not positive.any() or positive.all():
        return None
    return fit(features[positive], features[~positive], prior)


def score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``, from 0 to 1; higher is better. Null texts count as empty; without a model every
    score is a half. A column of that name is replaced, all others stay, one row per row."""
    if model is None:
        return docs.withColumn(out, F.lit(0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forms = shapes()
        for part in parts:
            features = np.stack([describe(x or "", forms) for x in part]) if len(part) else np.empty((0, SHAPES + 8))
            yield pd.Series(shared.value.score(features))
        forms.clear()
        give_back()

    return docs.withColumn(out, scored(F.col(text)))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``; every text is read whole.

    Labels of the held-out fold are never used, nor is any column of ``docs`` but the text. Repeated rows
    get equal scores; an empty table of labels gives a half everywhere. A row without an id is not held out,
    and no label is its own."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
