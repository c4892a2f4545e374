"""Language identification by averaged hashed subword embeddings.

A text is the mean embedding of its subwords: all runs of 2, 3 and 4 bytes inside its words, with the word's borders, hashed
to ``2 ** BITS`` rows. A softmax layer over the mean gives the languages. Embeddings and layer are trained together by
stochastic gradient descent. A temperature fitted on rows left out of the training calibrates the probabilities, and the
same rows give the probability under which a text is rejected (``und``).

For prediction the layer is applied to the embedding rows once; a text then needs only the mean of its subwords' rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.llm.common import doc_batches, id_and_text, sample_ids, utf8
from acadmetric.llm.tokens import LETTERS

BITS = 16
SIZES = (2, 3, 4)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
# Letters only: digits say nothing about a language.
_TABLE = bytes(32 if 48 <= b <= 57 else LETTERS[b] for b in range(256))
_MULTIPLIERS = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode(errors="ignore"))


def subwords(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of all subwords, text by text, and where each text's rows begin (one more at the end)."""
    raw = np.frombuffer(b" " + b"".join(t.translate(_TABLE) + b" " for t in texts), np.uint8)
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    text, letter = raw.astype(np.uint32), raw != 32
    rows, starts = [], []
    for n in SIZES:
        count = max(0, len(text) - n + 1)
        gram, inner = np.zeros(count, np.uint32), np.ones(count, bool)
        for i in range(n):
            gram |= text[i:i + count] << np.uint32(8 * i)
            if 0 < i < n - 1:
                inner &= letter[i:i + count]
        if n == 2:
            inner = letter[:count] | letter[1:count + 1]
        kept = np.flatnonzero(inner)
        rows.append(((gram[kept] * np.uint32(_MULTIPLIERS[n])) >> np.uint32(32 - BITS)).astype(np.int32))
        starts.append(np.searchsorted(kept, at))
    begin = np.sum(starts, axis=0)
    out = np.empty(int(begin[-1]), np.int32)
    place = begin[:-1].copy()
    for r, s in zip(rows, starts, strict=True):
        size = np.diff(s)
        out[np.repeat(place - s[:-1], size) + np.arange(int(s[-1]))] = r[:int(s[-1])]
        place += size
    return out, begin


@dataclass
class LanguageModel:
    names: list[str]
    rows: np.ndarray  # 2 ** BITS x languages: the layer applied to the embeddings
    offset: np.ndarray
    temperature: float
    reject: float  # calibrated probability under which a prediction is more often wrong than the target allows

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        ids, begin = subwords(texts)
        size = np.diff(begin)
        total = np.zeros((len(texts), len(self.names)))
        full = np.flatnonzero(size)
        if len(full):
            for k in range(len(self.names)):
                total[full, k] = np.add.reduceat(self.rows[:, k][ids], begin[full], dtype=np.float64)
        logits = (total / np.maximum(size, 1)[:, None] + self.offset) / self.temperature
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its probability; ``und`` with 0 for texts without letters."""
        if not texts or not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        p = self.probabilities(texts)
        lettered = np.fromiter(map(has_letter, texts), bool, len(texts))
        names = [self.names[k] if ok else "und" for k, ok in zip(p.argmax(1), lettered, strict=True)]
        return names, np.where(lettered, p.max(1), 0.0)


def fit(texts: list[bytes], names: list[str], dimensions: int = 16, epochs: int = 8, rate: float = 0.5,
        precision: float = 0.95) -> LanguageModel:
    languages = sorted(set(names))
    if not languages:
        return LanguageModel([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0, 1.0)
    label = np.array([languages.index(n) for n in names])
    draw = np.random.default_rng(5)
    table = draw.uniform(-1, 1, (1 << BITS, dimensions)).astype(np.float32) / dimensions
    layer, offset = np.zeros((dimensions, len(languages))), np.zeros(len(languages))
    # Short texts are learnt from pieces: each text gives itself and one run of a few of its words.
    pieces, kind, held = [], [], []
    apart = draw.random(len(texts)) < 0.2
    for t, k, out in zip(texts, label, apart, strict=True):
        words = t.split()
        some = int(draw.integers(0, max(1, len(words))))
        for piece in (t, b" ".join(words[some:some + int(draw.integers(3, 30))])):
            pieces.append(piece)
            kind.append(k)
            held.append(out)
    ids, begin = subwords(pieces)
    bags = [np.unique(ids[a:b], return_counts=True) for a, b in zip(begin, begin[1:], strict=False)]
    kind, held = np.array(kind), np.array(held)
    learn = np.flatnonzero(~held & (np.diff(begin) > 0))
    steps, done = max(1, epochs * len(learn)), 0
    for _ in range(epochs):
        draw.shuffle(learn)
        for i in learn:
            step = rate * (1 - done / steps)
            done += 1
            rows, share = bags[i][0], (bags[i][1] / bags[i][1].sum())
            mean = share @ table[rows]
            logit = mean @ layer + offset
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[kind[i]] -= 1
            back = layer @ p
            layer -= step * np.outer(mean, p)
            offset -= step * 0.1 * p
            # The mean divides the gradient of a row by the length; rows move as if by its root.
            table[rows] -= (step * np.sqrt(len(rows)) * share)[:, None] * back
    model = LanguageModel(languages, (table @ layer).astype(np.float32), offset, 1.0, 0.0)
    check = np.flatnonzero(held)
    if len(check) and len(languages) > 1:
        p = np.log(np.maximum(model.probabilities([pieces[i] for i in check]), 1e-12))
        own = kind[check]

        def loss(t: float) -> float:
            q = p / t
            q -= q.max(1, keepdims=True)
            return float((np.log(np.exp(q).sum(1)) - q[np.arange(len(own)), own]).mean())

        model.temperature = min(np.geomspace(0.1, 10, 60), key=loss)
        q = np.exp(p / model.temperature)
        q /= q.sum(1, keepdims=True)
        best, right = q.max(1), q.argmax(1) == own
        order = np.argsort(-best)
        share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share >= precision)
        model.reject = float(best[order][good[-1]]) if len(good) and good[-1] < len(order) - 1 else 0.0
    return model


def fit_language(docs: DataFrame, per_language: int = 700, max_bytes: int = 20_000) -> LanguageModel:
    """Fit on at most ``per_language`` rows of each language in ``docs`` (doc_id, text, lang), with texts of at most ``max_bytes``.

    Rows without text, id or language are left out.
    """
    usable = docs.filter("text IS NOT NULL").filter(F.octet_length("text") <= max_bytes)
    sample = F.broadcast(sample_ids(usable, "lang", per_language))  # at most per_language rows a language
    rows = sorted(id_and_text(usable).join(sample, "doc_id").select("doc_id", "label", "text").collect())
    return fit([r[2].encode() for r in rows], [r[1] for r in rows])


def languages(docs: DataFrame, model: LanguageModel, reject: bool = True) -> DataFrame:
    """doc_id, lang_pred, score (calibrated probability): ``und`` with 0 for null texts and texts without letters, and, with
    ``reject``, ``und`` for predictions under the model's limit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in doc_batches(batches, 2 << 20):
            names, score = model.predict(utf8(batch.column(1)))
            if reject:
                names = [n if s >= model.reject else "und" for n, s in zip(names, score, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
