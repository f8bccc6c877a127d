"""Toxicity scores by logistic regression over hashed word n-grams and skip-grams, learned by
follow-the-regularised-leader (FTRL-proximal).

Words are maximal runs of letters, digits and bytes beyond ASCII, A-Z lower-cased. A document's
features are, each once however often it occurs: its words, their beginnings of ``STEM`` bytes
(languages that inflect repeat those), pairs of neighbours, and skip-grams: pairs with one or two
words between. Features are hashed into ``BUCKETS`` coordinates. Learning gives every coordinate a
rate of its own, by its own squared gradients, and the L1 term leaves the coordinate at zero until
its summed gradient exceeds ``L1``; so few weights remain, and they travel to the tasks as two short
arrays. All of a document's features count, whatever its length.

The model is learned on the driver from a bounded sample: at most ``sample_rows`` labelled ids of
each class, those with the smallest hashes, and of them at most ``SAMPLE_FEATURES`` features in all.
Their features are worked out in the tasks; no text comes to the driver. If the sample holds the
classes in other shares than the labels do, the bias is corrected by the difference of log odds.

Null and empty texts have no features and score what the bias says. An id is learned as toxic if any
of its label rows is; null labels and null ids teach nothing. With nothing to learn from, every
score is 0. Repeated rows are learned once and scored each for itself. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.hashing import Hasher, mix

BUCKETS = 1 << 22
STEM = 5
SAMPLE_ROWS = 4000
SAMPLE_FEATURES = 40_000_000
PASSES = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 1.0
THRESHOLD = 0.3

_random = np.random.default_rng(12)
FIRST, *SECOND = (_random.integers(0, 1 << 63, 4, dtype=np.uint64) * 2 + 1)
STEM_SALT = np.uint64(0x5DEECE66D)
WORD = np.zeros(256, bool)  # digits, letters, and all bytes of characters beyond ASCII
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def features(text: str | None, hasher: Hasher) -> np.ndarray:
    """The coordinates of a text's features, in order of place; with repeats."""
    data = np.frombuffer((text or "").encode("utf-8").lower(), np.uint8)
    inside = np.concatenate([[False], WORD[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    sums = hasher.sums(data)
    words = hasher.of(sums, start, end)
    stems = hasher.of(sums, start, np.minimum(start + STEM, end)) ^ STEM_SALT
    found = [words, mix(stems)]
    for gap, factor in enumerate(SECOND, start=1):
        found.append(mix(words[:-gap] * FIRST + words[gap:] * factor))
    return (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.uint32)


@dataclass
class Model:
    places: np.ndarray  # the coordinates that are not zero
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        full = np.zeros(BUCKETS, np.float32)
        full[self.places] = self.weights
        return full

    def score(self, found: np.ndarray, dense: np.ndarray) -> float:
        """The probability of the toxic class. Coordinates of no weight need no counting."""
        found = np.unique(found[dense[found] != 0])
        return sigmoid(self.bias + float(dense[found].sum(dtype=np.float64)))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-min(max(x, -35.0), 35.0)))


class Learner:
    """FTRL-proximal: ``z`` holds a coordinate's summed gradients, moved by its past steps, and
    ``n`` its squared gradients; the weight follows from the two."""

    def __init__(self, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)  # the bias comes last

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        least = np.where(at == BUCKETS, 0.0, self.l1)  # the bias is not held at zero
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= least, 0.0, (np.sign(z) * least - z) / rate)

    def learn(self, found: np.ndarray, toxic: int) -> None:
        """One row: distinct coordinates, the bias among them."""
        weights = self.weights(found)
        gradient = sigmoid(float(weights.sum())) - toxic
        n = self.n[found]
        self.z[found] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha * weights
        self.n[found] = n + gradient**2

    def model(self) -> Model:
        places = np.flatnonzero(np.abs(self.z[:BUCKETS]) > self.l1)
        return Model(
            places.astype(np.uint32), self.weights(places).astype(np.float32),
            float(self.weights(np.array([BUCKETS]))[0]),
        )


def train(rows: list[tuple[np.ndarray, int]], toxic_share: float, seed: int = 12) -> Model | None:
    """The model of (distinct coordinates, class) rows, given in any fixed order;
    ``toxic_share`` is that of all labelled rows."""
    if not rows:
        return None
    learner = Learner()
    random = np.random.default_rng(seed)
    bias = np.array([BUCKETS])
    for _ in range(PASSES):
        for i in random.permutation(len(rows)).tolist():
            found, toxic = rows[i]
            learner.learn(np.concatenate([found, bias]), toxic)
    model = learner.model()
    sampled = sum(toxic for _, toxic in rows) / len(rows)
    if 0 < sampled < 1 and 0 < toxic_share < 1:
        model.bias += math.log(toxic_share / (1 - toxic_share) * (1 - sampled) / sampled)
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        found = [  # one text as a Python string at a time
            np.unique(features(text.as_py(), hasher)).tobytes() for text in batch.column(2)
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(found, pa.binary())], names=["draw", "toxic", "found"]
        )


def learned(
    df: DataFrame, labels: DataFrame, learn: Column, sample_rows: int, id_col: str,
    text_col: str, label_col: str,
) -> Model | None:
    """The model of the labelled rows for whose id (a column of that name) ``learn`` holds."""
    marks = labels.select(
        F.col(id_col).cast("long").alias(id_col), F.col(label_col).cast("int").alias("toxic")
    ).filter(learn).filter(f"`{id_col}` is not null and toxic in (0, 1)")
    marks = marks.groupBy(F.col(id_col).alias("label_id")).agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not totals:
        return None
    draw = F.xxhash64("label_id").alias("draw")
    chosen = [  # a top-k per class, of stated size
        marks.filter(F.col("toxic") == toxic).select("label_id", "toxic", draw)
        .orderBy("draw", "label_id").limit(sample_rows)
        for toxic in totals
    ]
    sample = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    texts = df.select(
        F.col(id_col).cast("long").alias("label_id"), F.col(text_col).cast("string").alias("text")
    )
    # At most twice `sample_rows` ids: so few can go to every task.
    rows = texts.join(F.broadcast(sample), "label_id").select("draw", "toxic", "text")
    found = rows.mapInArrow(_featured, "draw long, toxic int, found binary")
    kept, room = [], SAMPLE_FEATURES
    for row in found.distinct().orderBy("draw", "toxic", "found").toLocalIterator():
        places = np.frombuffer(row["found"], np.uint32)
        room -= len(places)
        if room < 0:
            break
        kept.append((places.astype(np.int64), row["toxic"]))
    return train(kept, totals.get(1, 0) / sum(totals.values()))


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    learn: Column,
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """(doc_id, score, predicted) for every row; ``learn`` says of which ids labels may be
    learned."""
    model = learned(df, labels, learn, sample_rows, id_col, text_col, label_col)
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, dense = Hasher(), model.dense() if model else None
        for batch in batches:
            scores = [
                model.score(features(text.as_py(), hasher), dense) if model else 0.0
                for text in batch.column(1)
            ]
            predicted = [int(score >= threshold) for score in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())],
                names=["doc_id", "score", "predicted"],
            )

    return rows.mapInArrow(run, "doc_id long, score double, predicted int")
