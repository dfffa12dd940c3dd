"""Quality classifier: n-gram indicators scaled by Naive Bayes log-count ratios, linear hinge loss by dual coordinate descent.

Features are the presence of words, word shapes and word pairs, hashed into a fixed number of buckets. The
ratio of a bucket is the log of its smoothed share among documents of label 1 over that among label 0; a document's
vector holds the ratios of its buckets, scaled to unit length. The margin is turned into a probability by a logistic
fit on margins of rows left out of the descent.

Cases: null and empty texts have no features and get the probability of the bias alone; without labels of both
classes every score is the share of label 1 (0.5 without any label). Repeated labels of an id count once, by their maximum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.grams import GOLD, U, as_bytes, byte_table, mix, runs, split_words

BITS = 18
MAX_TRAIN = 6000


@dataclass(frozen=True)
class Model:
    """One weight per bucket (log-count ratio times descent weight), the ratios, bias and the logistic fit."""

    weight: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the texts laid end to end, and the bounds of each text's part."""
    words, bounds = split_words(texts, byte_table())
    shapes, _ = split_words(texts, byte_table(shapes=True))
    with np.errstate(over="ignore"):
        pairs = mix(words[:-1] * U(GOLD) + words[1:]) if len(words) else words
        shape_pairs = mix(shapes[:-1] * U(GOLD) + shapes[1:] + U(7)) if len(words) else words
        same = np.zeros(len(words), dtype=bool)
        same[1:] = words[1:] == words[:-1]
    mask = U((1 << bits) - 1)
    parts, sizes = [], []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        found = [words[a:b], shapes[a:b]]
        if b - a > 1:
            found += [pairs[a : b - 1], shape_pairs[a : b - 1]]
            # how far words repeat, in steps of a sixteenth: one indicator
            repeated = 16 * int(same[a + 1 : b].sum()) // int(b - a)
            variety = 16 * len(np.unique(words[a:b])) // int(b - a)
            found.append(mix(np.array([0xA11CE000 + repeated, 0xB0B00000 + variety], dtype=np.uint64)))
        row = np.unique((np.concatenate(found) & mask).astype(np.int32))
        parts.append(row)
        sizes.append(len(row))
    buckets = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return buckets, np.cumsum([0] + sizes)


def _feature_rows(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Label, fold key and buckets of each text."""
    for batch in batches:
        texts = as_bytes(batch.column("text"))
        for first, last in runs(texts):
            buckets, bounds = features(texts[first:last], bits)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(buckets))
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([part.column("label"), part.column("turn"), lists], names=["label", "turn", "buckets"])


def _descend(rows: list[np.ndarray], ratio: np.ndarray, label: np.ndarray, cost: np.ndarray, epochs: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1 hinge loss; ``cost`` bounds each row's multiplier. The bias is one more feature."""
    weight, bias = np.zeros(len(ratio)), 0.0
    # the vectors are formed when they are needed: only their lengths are held
    norms, square = np.ones(len(rows)), np.ones(len(rows))
    for i, r in enumerate(rows):
        v = ratio[r]
        norms[i] = float(np.sqrt((v * v).sum())) or 1.0
        v /= norms[i]
        square[i] += float((v * v).sum())
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(rows)):
            r, y = rows[i], label[i]
            v = ratio[r]
            v /= norms[i]
            slope = y * (float(weight[r] @ v) + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y
            if step:
                weight[r] += step * v
                bias += step
                worst = max(worst, abs(step))
                alpha[i] = new
        if worst < 1e-4:
            break
    return weight, bias


def _margins(rows: list[np.ndarray], ratio: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(rows), bias)
    for i, r in enumerate(rows):
        v = ratio[r]
        norm = float(np.sqrt((v * v).sum()))
        if norm:
            out[i] += float(weight[r] @ v) / norm
    return out


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit with smoothed targets, by Newton's steps."""
    up, down = (label > 0).sum(), (label < 0).sum()
    target = np.where(label > 0, (up + 1.0) / (up + 2.0), 1.0 / (down + 2.0))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        max_train: int = MAX_TRAIN, bits: int = BITS, epochs: int = 12) -> Model:
    """Fit on at most ``max_train`` labelled documents, those whose ids have the smallest hashes.

    The sample is the documented bound: its ids, and nothing that grows with the corpus, are broadcast and
    its sparse rows come to the driver. A fifth of it is left out of the descent and calibrates the margin.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.groupBy("_id").agg(F.max("label").alias("label"))
    known = known.withColumn("turn", F.xxhash64(F.col("_id"))).orderBy("turn", "_id").limit(max_train)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(known), "_id").select("text", "label", "turn")
    got = sample.mapInArrow(lambda batches: _feature_rows(batches, bits), "label int, turn long, buckets array<int>").toArrow()
    label = np.where(got.column("label").to_numpy() > 0, 1.0, -1.0) if got.num_rows else np.zeros(0)
    turn = got.column("turn").to_numpy()
    rows = []
    for part in got.column("buckets").chunks:
        values, at = part.values.to_numpy(), part.offsets.to_numpy()
        rows += [values[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    order = np.lexsort((np.array([len(r) for r in rows]), turn)) if rows else np.zeros(0, int)
    rows, label, turn = [rows[i] for i in order], label[order], turn[order]
    size = 1 << bits
    if not len(label) or (label > 0).all() or (label < 0).all():
        share = float((label > 0).mean()) if len(label) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    left = turn % 5 == 0
    if left.all() or len(set(label[~left])) < 2 or len(set(label[left])) < 2:
        left[:] = False
    use = np.flatnonzero(~left)
    counts = {}
    for side in (1.0, -1.0):
        chosen = [rows[i] for i in use if label[i] == side]
        seen = np.ones(size)
        for first in range(0, len(chosen), 512):
            seen += np.bincount(np.concatenate(chosen[first : first + 512]), minlength=size)
        counts[side] = seen / (len(chosen) + 2.0)
    ratio = np.log(counts[1.0] / counts[-1.0])
    # each class weighs the same in the hinge loss
    cost = np.where(label > 0, len(use) / (2.0 * (label[use] > 0).sum()), len(use) / (2.0 * (label[use] < 0).sum()))
    weight, bias = _descend([rows[i] for i in use], ratio, label[use], cost[use], epochs)
    held = np.flatnonzero(left) if left.any() else use
    slope, shift = _logistic(_margins([rows[i] for i in held], ratio, weight, bias), label[held])
    return Model(weight.astype(np.float32), ratio.astype(np.float32), bias, slope, shift)


def score_texts(texts: list[bytes], model: Model) -> np.ndarray:
    """Probability of label 1 for each text."""
    bits = len(model.weight).bit_length() - 1
    buckets, bounds = features(texts, bits)
    both = model.weight[buckets].astype(np.float64) * model.ratio[buckets]
    norms = model.ratio[buckets].astype(np.float64) ** 2
    sums = np.concatenate([[0.0], np.cumsum(both)])
    squares = np.concatenate([[0.0], np.cumsum(norms)])
    dot, norm = sums[bounds[1:]] - sums[bounds[:-1]], np.sqrt(np.maximum(squares[bounds[1:]] - squares[bounds[:-1]], 0.0))
    return model.probability(model.bias + np.divide(dot, norm, out=np.zeros(len(dot)), where=norm > 1e-9))


def _scored(batches: Iterator[pa.RecordBatch], model: Model, text: str, least: float | None) -> Iterator[pa.RecordBatch]:
    """Batches with the column ``score`` appended; with ``least``, only the rows that reach it, as they are."""
    for batch in batches:
        texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
        scores = [score_texts(texts[a:b], model) for a, b in runs(texts)]
        score = pa.array(np.concatenate(scores) if scores else np.zeros(0))
        if least is None:
            keep = [i for i, n in enumerate(batch.schema.names) if n != text]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], score], names=[*[batch.schema.names[i] for i in keep], "score"])
        else:
            yield batch.filter(pa.array(np.asarray(score) >= least))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document; one narrow pass."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _scored(batches, model, "text", None), "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents that score at least ``least``, with all their columns; one narrow pass."""
    return docs.mapInArrow(lambda batches: _scored(batches, model, text_col, least), docs.schema)
