"""A bounded sample of labelled documents, and calibration of raw scores."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(key: str = "doc_id") -> Column:
    """True for the fold that no label is learnt from; false for a null key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Sample:
    """Texts with a label 0 or 1, and whether a text is kept for the calibration.

    ``prior`` is what has to be added to log-odds learnt from the sample, since
    the classes are not in the sample as often as in all labels.
    """

    texts: list[str]
    labels: np.ndarray
    calibrate: np.ndarray
    prior: float = 0.0


def sample_labelled(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int, key: str = "doc_id"
) -> Sample:
    """Up to ``per_class`` documents of either label, in the order of a hash of the key.

    Only rows outside the held-out fold count, and texts of at most
    ``max_chars`` letters, so what the driver gets is bounded. A key whose
    labels disagree, a null label and a null text give nothing.
    """
    known = (
        labels.filter(~held_out(key) & F.col(label).isin(0, 1))
        .groupBy(key)
        .agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
        .filter("_low = _high")
        .select(F.col(key).alias("_key"), F.col("_low").cast("int").alias("_label"))
    )
    order = [F.xxhash64("_key"), F.col("_key")]
    wanted = known.filter("_label = 0").orderBy(*order).limit(per_class)
    wanted = wanted.unionByName(known.filter("_label = 1").orderBy(*order).limit(per_class))
    short = docs.select(F.col(key).alias("_key"), F.col("text").alias("_text")).filter(F.length("_text") <= max_chars)
    # At most two rows a class and key matter; ``wanted`` has at most 2 * per_class rows.
    rows = short.join(F.broadcast(wanted), "_key").groupBy("_key", "_label").agg(F.min("_text").alias("_text"))
    rows = rows.select("_text", "_label", (F.abs(F.xxhash64(F.col("_key").cast("string"))) % 2 == 0).alias("_half"))
    found = sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[1], r[0]))
    all_of = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    sampled = [sum(r[1] == c for r in found) for c in (0, 1)]
    prior = 0.0
    if all(sampled) and all(c in all_of for c in (0, 1)):
        prior = float(np.log(all_of[1] / all_of[0]) - np.log(sampled[1] / sampled[0]))
    halves = np.array([r[2] for r in found], bool)
    return Sample([r[0] for r in found], np.array([r[1] for r in found], int), halves, prior)


def fit_sigmoid(raw: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Slopes and shift of Platt's scaling of one or more raw scores, with his smoothed targets; Newton steps.

    The classes count as they occur in ``raw``; without both of them the slopes
    are 0 and the shift gives the class there is.
    """
    raw = np.asarray(raw, float).reshape(len(labels), -1)
    positive, negative = int((labels == 1).sum()), int((labels == 0).sum())
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    if not positive or not negative:
        return np.zeros(raw.shape[1]), float(np.log((positive + 1) / (negative + 1)))
    centre, width = raw.mean(0), raw.std(0)
    width[width == 0] = 1.0
    design = np.column_stack([(raw - centre) / width, np.ones(len(raw))])
    weights = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = sigmoid(design @ weights)
        gradient = design.T @ (p - target) + 1e-3 * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    slopes = weights[:-1] / width
    return slopes, float(weights[-1] - slopes @ centre)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
