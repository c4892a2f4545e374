"""Quality classifier: naive Bayes support vectors.

A document is the set of its n-grams: words and pairs of words, and runs of up to three word shapes (kinds of characters, the
character at either end, length, whether the word repeats the one before). Each indicator is scaled by the log ratio of its
smoothed counts in the two classes, documents are scaled to length one, and a linear model with hinge loss is fitted by dual
coordinate descent. Margins of folds left out of a fit give the logistic curve that turns margins into probabilities.

The fit uses at most ``per_class`` labelled rows of each class (those first by a hash of their id) with texts of at most
``max_bytes``; scoring reads every whole text where it lies and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.llm.common import doc_batches, id_and_text, keep_rows, mix, sample_ids, utf8
from acadmetric.llm.tokens import Words, bucket, platt, sigmoid, unique_features

BITS = 18
# Kinds of bytes, one bit each: lower case, upper case, digit, beyond ASCII, closing marks, other marks.
_KIND = np.array([8 if b >= 128 else 1 if 97 <= b <= 122 else 2 if 65 <= b <= 90 else 4 if 48 <= b <= 57
                  else 16 if b in b".,;:?" else 32 for b in range(256)], np.uint8)


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs of the texts, sorted."""
    w = Words.of(texts)
    if not len(w.start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    same_doc = np.concatenate(([False], w.doc[1:] == w.doc[:-1]))
    repeats = same_doc & np.concatenate(([False], w.hash[1:] == w.hash[:-1]))
    kinds = np.bitwise_or.reduceat(_KIND[w.text], np.stack([w.start, w.end], 1).ravel())[::2]
    ends = w.text[w.end - 1].astype(np.uint64)
    ends = np.where(_KIND[ends] >= 16, ends, _KIND[ends])  # marks by themselves, letters by kind
    shape = kinds.astype(np.uint64) | ends << np.uint64(8) | _KIND[w.text[w.start]].astype(np.uint64) << np.uint64(16) \
        | np.minimum(w.end - w.start, 9).astype(np.uint64) << np.uint64(24) | repeats.astype(np.uint64) << np.uint64(32)
    shape = mix(shape)
    columns = [(w.doc, bucket(w.hash, 1, BITS)), (w.doc, bucket(shape, 2, BITS))]
    for salt, tokens, most in ((3, w.hash, 2), (4, shape, 3)):
        run = tokens
        for n in range(2, most + 1):
            run = mix(run[:-1] * np.uint64(0x9FB21C651E98DF25) + tokens[n - 1:])
            whole = w.doc[n - 1:] == w.doc[:len(w.doc) - n + 1]
            columns.append((w.doc[n - 1:][whole], bucket(run[whole], salt + 2 * n, BITS)))
    return unique_features(w, columns, BITS)


@dataclass
class QualityModel:
    ratio: np.ndarray
    weight: np.ndarray
    offset: float
    slope: float
    base: float

    def margins(self, doc: np.ndarray, feature: np.ndarray, docs: int) -> np.ndarray:
        r = self.ratio[feature]
        length = np.sqrt(np.bincount(doc, r * r, docs))
        return np.bincount(doc, r * self.weight[feature], docs) / np.maximum(length, 1e-9) + self.offset

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.slope * self.margins(*ngrams(texts), len(texts)) + self.base)


def log_count_ratio(rows: list[np.ndarray], label: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    counts = [np.full(1 << BITS, smooth), np.full(1 << BITS, smooth)]
    for x, y in zip(rows, label, strict=True):
        counts[int(y)][x] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], label: np.ndarray, cost: np.ndarray,
                            epochs: int = 20) -> tuple[np.ndarray, float]:
    """Weights and offset with the least hinge loss; each step solves one row's dual variable exactly."""
    sign = np.where(label > 0, 1.0, -1.0)
    weight, offset, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    size = np.array([float(v @ v) + 1.0 for v in values])
    order, draw = np.arange(len(rows)), np.random.default_rng(7)
    for _ in range(epochs):
        draw.shuffle(order)
        moved = 0.0
        for i in order:
            gap = sign[i] * (weight[rows[i]] @ values[i] + offset) - 1.0
            new = min(max(alpha[i] - gap / size[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                alpha[i] = new
                weight[rows[i]] += step * values[i]
                offset += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weight, offset


def fit(rows: list[np.ndarray], label: np.ndarray, share: float) -> QualityModel:
    """``rows``: the features of each sampled document; ``share``: the part of class 1 among all labelled rows."""
    n1 = int(label.sum())
    if not 0 < n1 < len(label):
        # One class, or none: every text gets the share of class 1 among the labels, a half without any.
        share = 0.5 if not len(label) else float(n1 > 0)
        return QualityModel(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    weight = np.where(label > 0, share * len(label) / n1, (1 - share) * len(label) / (len(label) - n1))

    def trained(use: np.ndarray) -> QualityModel:
        own = [rows[i] for i in use]
        ratio = log_count_ratio(own, label[use])
        values = [(ratio[x] / max(float(np.linalg.norm(ratio[x])), 1e-9)).astype(np.float32) for x in own]
        w, b = dual_coordinate_descent(own, values, label[use], np.full(len(own), 4.0))
        return QualityModel(ratio, w, b, 1.0, 0.0)

    fold, margin = np.arange(len(rows)) % 3, np.zeros(len(rows))
    for k in range(3):
        model = trained(np.flatnonzero(fold != k))
        for i in np.flatnonzero(fold == k):
            margin[i] = model.margins(np.zeros(len(rows[i]), np.int64), rows[i], 1)[0]
    slope, base = platt(margin, label, weight)
    final = trained(np.arange(len(rows)))
    return QualityModel(final.ratio, final.weight, final.offset, slope, base)


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 2500, max_bytes: int = 50_000) -> QualityModel:
    """Fit on at most ``per_class`` rows of either label of ``labels`` (doc_id, quality 0 or 1).

    Rows with a null id or label, and ids without a document, are left out.
    """
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("quality IN (0, 1)")
    counts = {r[0]: r[1] for r in labels.groupBy("quality").count().collect()}
    sample = F.broadcast(sample_ids(labels, "quality", per_class))  # at most 2 * per_class rows
    texts = id_and_text(docs).filter(F.octet_length(F.coalesce("text", F.lit(""))) <= max_bytes).join(sample, "doc_id").select(
        "label", "text", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 2 << 20):
            doc, feature = ngrams(utf8(batch.column(1)))
            cuts = np.searchsorted(doc, np.arange(1, batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(
                [x.astype("<i4").tobytes() for x in np.split(feature, cuts)], pa.binary())], ["doc_id", "label", "features"])

    got = sorted(texts.mapInArrow(run, "doc_id long, label string, features binary").collect())
    rows = [np.frombuffer(r[2], "<i4") for r in got]
    label = np.array([int(r[1]) for r in got], np.int64)
    return fit(rows, label, counts.get(1, 0) / max(1, sum(counts.values())))


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score: the probability of label 1 for every row; null and empty texts get the score of a text without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(utf8(batch.column(1))), pa.float64())],
                                             ["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")


def keep_rows_of_quality(docs: DataFrame, model: QualityModel, threshold: float) -> DataFrame:
    """The rows with a score of at least ``threshold``, with all their columns; null and empty texts are judged like any other."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, lambda texts: shared.value.scores(texts) >= threshold)
