"""Words of many texts at once, as numpy arrays: where they are, whose they are, a hash of their bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from acadmetric.llm.common import mix

_LIMIT = 256  # places of a word with a weight of their own; those beyond derive theirs from these
_draw = np.random.default_rng(20240229)
_BYTE = _draw.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _draw.integers(1, 1 << 63, _LIMIT, dtype=np.uint64) | np.uint64(1)

#: ASCII white space becomes a blank; the second table lower-cases A-Z and blanks all ASCII but letters and digits as well.
BLANKS = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
LETTERS = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@dataclass
class Words:
    text: np.ndarray  # all bytes; begins and ends with a blank
    doc_at: np.ndarray  # where each document begins in ``text``, and one beyond
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    docs: int

    @staticmethod
    def of(texts: list[bytes], table: bytes = BLANKS) -> Words:
        text = np.frombuffer(b" " + b"".join(t.translate(table) + b" " for t in texts), np.uint8)
        doc_at = np.concatenate(([1], 1 + np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
        inside = text != 32
        change = np.diff(inside.view(np.int8))
        start, end = np.flatnonzero(change == 1) + 1, np.flatnonzero(change == -1) + 1
        size = end - start
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        each = _BYTE[text[inside]] * _PLACE[place % _LIMIT]
        beyond = np.flatnonzero(place >= _LIMIT)
        if len(beyond):
            turn = (place[beyond] // _LIMIT).astype(np.uint64)
            each[beyond] = _BYTE[text[inside][beyond]] * (mix(_PLACE[place[beyond] % _LIMIT] + turn) | np.uint64(1))
        hashes = mix(np.add.reduceat(each, first)) if len(start) else np.empty(0, np.uint64)
        return Words(text, doc_at, start, end, np.searchsorted(doc_at, start, "right") - 1, hashes, len(texts))

    def prefix(self, n: int) -> np.ndarray:
        """A hash of the first ``n`` bytes of each word (of the whole word if it is shorter)."""
        total = np.zeros(len(self.start), np.uint64)
        for i in range(n):
            at = self.start + i
            total += np.where(at < self.end, _BYTE[self.text[np.minimum(at, len(self.text) - 1)]] * _PLACE[i], np.uint64(0))
        return mix(total + np.uint64(n))

    def suffix(self, n: int) -> np.ndarray:
        total = np.zeros(len(self.start), np.uint64)
        for i in range(n):
            at = self.end - 1 - i
            total += np.where(at >= self.start, _BYTE[self.text[np.maximum(at, 0)]] * _PLACE[i], np.uint64(0))
        return mix(total + np.uint64(100 + n))


def bucket(h: np.ndarray, salt: int, bits: int) -> np.ndarray:
    """Hashes of one kind of feature, dealt to ``2 ** bits`` weights."""
    return (mix(h + np.uint64(salt * 0x9E3779B9)) >> np.uint64(64 - bits)).astype(np.int64)


def unique_features(words: Words, columns: list[tuple[np.ndarray, np.ndarray]], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which features each document has: (document, feature) pairs, sorted. ``columns``: (document, feature) of each kind."""
    if not columns:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.concatenate([(d.astype(np.int64) << bits) | f for d, f in columns]))
    return pairs >> bits, pairs & ((1 << bits) - 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, by Newton's method with smoothed targets."""
    n1, n0 = (weight * label).sum(), (weight * (1 - label)).sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    spread = max(float(margin.std()), 1e-9)
    x = np.stack([margin / spread, np.ones(len(margin))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ b)
        slope = x.T @ (weight * (p - target)) + 1e-3 * b
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        b = b - move * min(1.0, 2.0 / max(1e-9, float(np.abs(move).max())))
    return float(b[0] / spread), float(b[1])


def without_copies(texts: list[bytes], sketch: int = 16) -> list[int]:
    """Numbers of the texts that are no copy of an earlier one, exact or near: half of its smallest shingle hashes are new.

    For bounded samples: a text that was copied often would make every rare word in it look typical of its class.
    """
    owner: dict[int, set[int]] = {}
    kept = []
    for i, text in enumerate(texts):
        h = Words.of([text], LETTERS).hash
        h = h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7) if len(h) > 2 else h
        own = np.unique(mix(h))[:sketch].tolist()
        met: dict[int, int] = {}
        for x in own:
            for j in owner.get(x, ()):
                met[j] = met.get(j, 0) + 1
        if own and max(met.values(), default=0) * 2 >= len(own):
            continue
        kept.append(i)
        for x in own:
            owner.setdefault(x, set()).add(i)
    return kept
