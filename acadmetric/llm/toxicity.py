"""Toxic spans by a linear-chain conditional random field with two states.

Tokens are runs of letters and digits. Labels mark whole documents, so token labels are made first: in the sampled rows a
token is toxic if its word or its beginning is frequent in toxic documents and next to absent from the others. The field is
trained by maximum likelihood on windows of such tokens and of clean ones; its features are hashes of the word, of its
beginnings and its end. Forward and backward passes give every token its marginal. A document's score is a logistic
curve of the strongest marginal; tokens above one half make the offending spans.

Both passes are products of 2 x 2 matrices: a whole batch of documents is one chain, whose links at document borders forget
the past, cut into equal blocks that are multiplied side by side. Long texts need no special care and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.llm.common import doc_batches, id_and_text, keep_rows, sample_ids, utf8
from acadmetric.llm.tokens import LETTERS, Words, bucket, platt, sigmoid, without_copies

BITS = 18
SPAN = 8  # tokens on each side of a training window


def token_features(w: Words) -> np.ndarray:
    """A column of weight numbers for each token."""
    return np.stack([bucket(w.hash, 1, BITS), bucket(w.prefix(3), 2, BITS), bucket(w.prefix(4), 3, BITS),
                     bucket(w.prefix(5), 4, BITS), bucket(w.suffix(3), 5, BITS)]).astype(np.int32)


def some_words(texts: list[bytes], some: int = 200) -> Iterator[tuple[int, Words]]:
    """The words of a few texts at a time, and the number of the first text; what is kept of them stays small."""
    for i in range(0, len(texts), some):
        yield i, Words.of(texts[i:i + some], LETTERS)


# Hashes that may mark a token, and the length a token must exceed.
KINDS = ((lambda w: w.hash, 0), (lambda w: w.prefix(4), 4), (lambda w: w.prefix(5), 5))


#: Bounds that the fit chooses from by folds of its own rows.
CHANCES = (0.03, 0.01, 0.003, 0.001)


@dataclass
class Field:
    emission: np.ndarray  # log weight of the toxic state for each feature, against the clean state
    moves: np.ndarray  # log weights from state to state, 2 x 2
    start: float  # log weight of a toxic first token
    slope: float = 1.0
    base: float = 0.0


def chain_marginals(u: np.ndarray, first: np.ndarray, moves: np.ndarray, start: float, block: int = 128) -> np.ndarray:
    """Log odds of the toxic state for every token; ``u``: log odds by emission, ``first``: which tokens begin a document."""
    if not len(u):
        return np.empty(0)
    n = len(u)
    rows = -(-n // block)
    pad = rows * block - n
    e = np.exp(np.clip(np.concatenate((u, np.zeros(pad))), -30, 30)).reshape(rows, block).T
    begins = np.concatenate((first, np.ones(pad, bool))).reshape(rows, block).T
    a = np.exp(moves - moves.max())
    s = float(np.exp(start))
    last = np.concatenate((begins.T.ravel()[1:], [True])).reshape(rows, block).T
    # Entry links: state before -> state at a token, times the token's emission; at a first token the state before is forgotten.
    link = [[np.where(begins, 1.0, a[0, 0]), np.where(begins, s, a[0, 1]) * e],
            [np.where(begins, 1.0, a[1, 0]), np.where(begins, s, a[1, 1]) * e]]

    def ratios(step, order) -> np.ndarray:
        """Weight of state 1 over state 0 after each link of every block, from the block before it."""
        p, q = np.ones(rows), np.zeros(rows)  # the block's product applied to (1, 0) and to (0, 1)
        r, t = np.zeros(rows), np.ones(rows)
        for k in order:
            (p, r), (q, t) = step(k, p, r), step(k, q, t)
            top = np.maximum(np.maximum(p, r), np.maximum(q, t))
            p, r, q, t = p / top, r / top, q / top, t / top
        into, x = np.ones(rows), 1.0
        walk = range(rows) if order[0] == 0 else range(rows - 1, -1, -1)
        p, q, r, t = p.tolist(), q.tolist(), r.tolist(), t.tolist()
        for b in walk:
            into[b] = x
            x = min(max((r[b] + t[b] * x) / max(p[b] + q[b] * x, 1e-280), 1e-140), 1e140)
        out = np.empty((block, rows))
        y0, y1 = np.ones(rows), into
        for k in order:
            y0, y1 = step(k, y0, y1)
            y1 = np.clip(y1 / np.maximum(y0, 1e-280), 1e-140, 1e140)
            y0 = np.ones(rows)
            out[k] = y1
        return out

    def forward(k: int, y0: np.ndarray, y1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return y0 * link[0][0][k] + y1 * link[1][0][k], y0 * link[0][1][k] + y1 * link[1][1][k]

    def backward(k: int, y0: np.ndarray, y1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # From the token after k, whose own weight is in y already, to token k; then token k's emission.
        z0 = np.where(last[k], 1.0, a[0, 0] * y0 + a[0, 1] * y1)
        z1 = np.where(last[k], 1.0, a[1, 0] * y0 + a[1, 1] * y1)
        # A border keeps the scale of what it forgets, so that products stay linear in their start.
        scale = np.where(last[k], y0 + y1, 1.0)
        return z0 * scale, z1 * scale * e[k]

    ahead = ratios(forward, range(block))
    behind = ratios(backward, range(block - 1, -1, -1))
    return (np.log(ahead) + np.log(behind) - np.log(e)).T.ravel()[:n]


def _likelihood_step(field: Field, ids: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient of the log likelihood of windows (windows x tokens) in the weights, the moves and the start."""
    windows, length = labels.shape
    u = np.where(mask, field.emission[ids].sum(0), 0.0)
    a, e = np.exp(field.moves), np.stack([np.ones_like(u), np.exp(np.clip(u, -30, 30))], 2)
    ahead, behind = np.empty((windows, length, 2)), np.ones((windows, length, 2))
    ahead[:, 0] = e[:, 0] * np.array([1.0, np.exp(field.start)])
    ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
    for t in range(1, length):
        x = (ahead[:, t - 1] @ a) * e[:, t]
        ahead[:, t] = x / x.sum(1, keepdims=True)
    for t in range(length - 2, -1, -1):
        x = (behind[:, t + 1] * e[:, t + 1]) @ a.T
        behind[:, t] = x / x.sum(1, keepdims=True)
    both = ahead * behind
    p = both[:, :, 1] / both.sum(2)
    gap = (labels - p) * mask
    weights = np.bincount(ids.reshape(ids.shape[0], -1).ravel(), np.tile(gap.ravel(), ids.shape[0]), 1 << BITS)
    pair = ahead[:, :-1, :, None] * a * (e[:, 1:] * behind[:, 1:])[:, :, None, :]
    pair /= pair.sum((2, 3), keepdims=True)
    moves = np.zeros((2, 2))
    real = (mask[:, 1:] & mask[:, :-1]).astype(float)
    for i in (0, 1):
        for j in (0, 1):
            seen = (labels[:, :-1] == i) & (labels[:, 1:] == j)
            moves[i, j] = ((seen - pair[:, :, i, j]) * real).sum()
    return weights, moves, float((labels[:, 0] - p[:, 0]).sum())


def train_field(ids: np.ndarray, labels: np.ndarray, mask: np.ndarray, rounds: int = 60, rate: float = 0.15, some: int = 4000) -> Field:
    """Maximum likelihood by AdaGrad over all windows; ``ids``: features x windows x tokens."""
    field = Field(np.zeros(1 << BITS), np.zeros((2, 2)), 0.0)
    size, seen, seen_moves = max(1, len(labels)), np.full(1 << BITS, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(rounds):
        weights, moves, start = np.zeros(1 << BITS), np.zeros((2, 2)), 0.0
        for a in range(0, len(labels), some):  # a part at a time, so that the passes stay small
            w, m, s = _likelihood_step(field, ids[:, a:a + some], labels[a:a + some], mask[a:a + some])
            weights, moves, start = weights + w, moves + m, start + s
        weights = weights / size - 1e-5 * field.emission
        moves = moves / size - 1e-4 * field.moves
        seen += weights**2
        seen_moves += moves**2
        field.emission += rate * weights / np.sqrt(seen)
        field.moves += rate * moves / np.sqrt(seen_moves)
        field.start += rate * start / size
    return field


def marks_of(in_toxic: np.ndarray, in_clean: np.ndarray, n1: int, n0: int, chance: float, ratio: float) -> np.ndarray:
    """Which names mark toxic documents, from the documents of either label that hold each; see :func:`labelled_tokens`."""
    n1, n0 = max(1, n1), max(1, n0)
    x, y = np.maximum(in_toxic, 1e-9), in_clean
    against = x * np.log(x / (x + y) * (n1 + n0) / n1) + y * np.log(np.maximum(y, 1) / (x + y) * (n1 + n0) / n0)
    return (in_toxic / n1 > ratio * (in_clean + 0.25) / n0) & (against >= -np.log(chance))


def chosen_chance(texts: list[bytes], toxic: np.ndarray, chances: tuple[float, ...] = CHANCES, ratio: float = 25.0, folds: int = 3) -> float:
    """The bound of ``chances`` whose markers, made from the other folds, tell the rows of a fold best: by F1, ties to the strictest."""
    own, hit = np.empty(len(texts), np.int64), np.zeros((len(chances), len(texts)), bool)
    for label in (toxic, ~toxic):
        own[np.flatnonzero(label)] = np.arange(int(label.sum())) % folds
    for kind, longer in KINDS:  # one kind of hashes in memory at a time
        names, docs = [], []
        for i, w in some_words(texts):
            long = w.end - w.start > longer
            some, number = np.unique(kind(w)[long], return_inverse=True)
            pairs = np.unique(number.astype(np.int64) * w.docs + w.doc[long])
            names.append(some[pairs // max(1, w.docs)])
            docs.append((pairs % max(1, w.docs) + i).astype(np.int32))
        number = np.unique(np.concatenate(names), return_inverse=True)[1].astype(np.int32)
        doc = np.concatenate(docs)
        count = int(number.max(initial=-1)) + 1
        for fold in range(folds):
            rest, yes = own[doc] != fold, toxic[doc]
            in_toxic, in_clean = (np.bincount(number[rest & (yes == label)], minlength=count) for label in (True, False))
            n1, n0 = (int((toxic == label)[own != fold].sum()) for label in (True, False))
            for c, chance in enumerate(chances):
                marked = marks_of(in_toxic, in_clean, n1, n0, chance, ratio)
                hit[c, doc[~rest & marked[number]]] = True
    right = (hit & toxic).sum(1)
    score = 2 * right / np.maximum(1, hit.sum(1) + toxic.sum())
    return min(c for c, f in zip(chances, score, strict=True) if f >= score.max() - 1e-12)


def labelled_tokens(texts: list[bytes], toxic: np.ndarray, chance: float = 0.003, ratio: float = 25.0) -> tuple[np.ndarray, np.ndarray]:
    """The document of every token of the sample, and whether it is toxic: a word or a beginning that marks toxic documents.

    It marks them if it is ``ratio`` times as frequent in them as in the others (a quarter of a document is added there) and
    if the bound of Chernoff leaves a probability of at most ``chance`` that the documents that hold it are toxic as often
    or more, were it no more frequent in toxic ones. The fewer of the documents are toxic, the fewer occurrences suffice.
    """
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    marking = []
    for kind, _ in KINDS:  # one after the other, from the texts, so that one kind of hashes is in memory at a time
        held: list[list[np.ndarray]] = [[], []]
        for i, w in some_words(texts):
            names, number = np.unique(kind(w), return_inverse=True)
            pairs = np.unique(number.astype(np.int64) * w.docs + w.doc)
            of, yes = names[pairs // max(1, w.docs)], toxic[i + pairs % max(1, w.docs)]
            held[0].append(of[~yes])
            held[1].append(of[yes])
        names, in_toxic = np.unique(np.concatenate(held[1]), return_counts=True)
        others = np.concatenate(held[0])
        at = np.searchsorted(names, others)
        at = at[names[np.minimum(at, len(names) - 1)] == others] if len(names) else at[:0]
        in_clean = np.bincount(at, minlength=len(names))
        marking.append(names[marks_of(in_toxic, in_clean, n1, n0, chance, ratio)])
    docs, marks = [], []
    for i, w in some_words(texts):
        size = w.end - w.start
        docs.append((w.doc + i).astype(np.int32))
        marks.append(np.any([np.isin(kind(w), m) & (size > longer) for (kind, longer), m in zip(KINDS, marking, strict=True)], axis=0))
    return np.concatenate(docs), np.concatenate(marks)


def windows(texts: list[bytes], centres: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and presence of the tokens around each of ``centres`` (sorted numbers of tokens); a window keeps to its text."""
    parts, base = [], 0
    for _, w in some_words(texts):
        n = len(w.doc)
        a, b = np.searchsorted(centres, [base, base + n])
        if a < b:
            own = centres[a:b] - base
            at = own[:, None] + np.arange(-SPAN, SPAN + 1)
            inside = (at >= 0) & (at < n)
            at = np.clip(at, 0, n - 1)
            inside &= w.doc[at] == w.doc[own][:, None]
            parts.append((token_features(w)[:, at], np.where(inside, marks[base + at], 0).astype(np.int8), inside))
        base += n
    ids, labels, inside = zip(*parts, strict=True)
    return np.concatenate(ids, axis=1), np.concatenate(labels), np.concatenate(inside)


def fit(texts: list[bytes], toxic: np.ndarray, share: float, least: int = 10, toxic_windows: int = 20_000,
        clean_windows: int = 40_000) -> Field:
    """``share``: the part of toxic rows among all labelled ones.

    A quarter of the rows of either label is left out of the training and gives the logistic curve. Where that is fewer than
    ``least`` rows of a label, all rows train and the score is the strongest marginal itself: a curve through a few rows says
    next to nothing. Without rows of both labels, or where no word or beginning marks toxic rows (as with one or two of them),
    every text gets the same score, about ``share``. The bound of markers is chosen by folds of the rows that train. At most ``toxic_windows`` and ``clean_windows`` windows, drawn at random,
    are trained on.
    """
    none = Field(np.zeros(1 << BITS), np.zeros((2, 2)), 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    if not len(texts) or toxic.all() or not toxic.any():
        return none
    draw = np.random.default_rng(11)
    learn = np.ones(len(texts), bool)
    if min(toxic.sum(), (~toxic).sum()) // 4 >= least:
        for label in (toxic, ~toxic):
            learn[draw.permutation(np.flatnonzero(label))[:label.sum() // 4]] = False
    used = np.flatnonzero(learn)
    own = [texts[i] for i in used]
    doc, marks = labelled_tokens(own, toxic[used], chosen_chance(own, toxic[used]))
    if not marks.any():
        return none
    explained = np.unique(doc[marks])
    # A toxic document none of whose tokens is known to be toxic would teach that its tokens are clean.
    usable = ~toxic[used][doc] | np.isin(doc, explained)
    centres = np.flatnonzero(marks)
    others = np.flatnonzero(usable & ~marks)
    plain = draw.choice(others, min(len(others), clean_windows), replace=False) if len(others) else others
    centres = np.sort(np.concatenate((draw.permutation(centres)[:toxic_windows], plain)))
    field = train_field(*windows(own, centres, marks))
    rest = np.flatnonzero(~learn)
    if not len(rest):
        return field
    logit = np.concatenate([strongest(field, [texts[i] for i in rest[a:a + 200]])[0] for a in range(0, max(1, len(rest)), 200)])
    weight = np.where(toxic[rest], share / max(toxic[rest].mean(), 1e-9), (1 - share) / max((~toxic[rest]).mean(), 1e-9))
    field.slope, field.base = platt(logit, toxic[rest].astype(float), weight)
    return field


def strongest(field: Field, texts: list[bytes]) -> tuple[np.ndarray, Words, np.ndarray]:
    """The highest token log odds of each text (a floor without tokens), the tokens, and all their log odds."""
    w = Words.of(texts, LETTERS)
    u = field.emission[token_features(w)].sum(0) if len(w.start) else np.empty(0)
    first = np.concatenate(([True], w.doc[1:] != w.doc[:-1])) if len(w.start) else np.empty(0, bool)
    odds = chain_marginals(u, first, field.moves, field.start)
    best = np.full(len(texts), -20.0)
    np.maximum.at(best, w.doc, np.clip(odds, -20, 20))
    return best, w, odds


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 4000, max_bytes: int = 50_000) -> Field:
    """Fit on at most ``per_class`` rows of either label of ``labels`` (doc_id, toxic 0 or 1), with texts of at most ``max_bytes``."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)")
    counts = {r[0]: r[1] for r in labels.groupBy("toxic").count().collect()}
    sample = F.broadcast(sample_ids(labels, "toxic", per_class))  # at most 2 * per_class rows
    rows = sorted(id_and_text(docs).filter(F.octet_length("text") <= max_bytes).join(sample, "doc_id").select(
        "doc_id", "label", "text").collect())
    texts = [r[2].encode() for r in rows]
    own = without_copies(texts)
    toxic = np.array([rows[i][1] == "1" for i in own], bool)
    return fit([texts[i] for i in own], toxic, counts.get(1, 0) / max(1, sum(counts.values())))


def toxicity_scores(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, score (probability of a toxic document), spans (array of start, end: code points of runs of toxic tokens).

    Null and empty texts, and texts without letters or digits, get the score of the lowest odds and no span.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # 2 ** BITS weights, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in doc_batches(batches, 2 << 20):
            texts = utf8(batch.column(1))
            best, w, odds = strongest(field, texts)
            spans: list[list[dict]] = [[] for _ in texts]
            hits = np.flatnonzero(odds > 0)
            for run_of in np.split(hits, np.flatnonzero((np.diff(hits) > 1) | (np.diff(w.doc[hits]) > 0)) + 1) if len(hits) else ():
                d = int(w.doc[run_of[0]])
                a, b = int(w.start[run_of[0]] - w.doc_at[d]), int(w.end[run_of[-1]] - w.doc_at[d])
                spans[d].append({"start": len(texts[d][:a].decode(errors="ignore")), "end": len(texts[d][:b].decode(errors="ignore"))})
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sigmoid(field.slope * best + field.base)),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "score", "spans"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double, spans array<struct<start:long,end:long>>")


def keep_clean_rows(docs: DataFrame, field: Field, threshold: float) -> DataFrame:
    """The rows with a score under ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def clean(texts: list[bytes]) -> np.ndarray:
        return sigmoid(shared.value.slope * strongest(shared.value, texts)[0] + shared.value.base) < threshold

    return keep_rows(docs, clean)
