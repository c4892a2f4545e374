from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from tests_llm import ODD_TEXTS, documents

from acadmetric.llm.lexical_search import Best, Block, Queries, ranked
from acadmetric.llm.tokens import LETTERS, Words

ITEM = "item_id long, text string"


def terms(text: str | None) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(rows: list[tuple], items: list[tuple], top: int) -> list[tuple]:
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, words = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for name, text in items:
        scored = []
        for i, c, n in docs:
            m = 75 + (25 * n * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        out += [(name, k, i, -s) for k, (s, _, _, i) in enumerate(scored[:top], 1)]
    return sorted(out, key=str)


def found(spark, rows, items, **options) -> list[tuple]:
    queries = spark.createDataFrame(items, ITEM)
    return sorted(map(tuple, ranked(documents(spark, rows).repartition(3), queries, **options).collect()), key=str)


def test_odd_rows(spark, empty):
    items = [(1, "one TWO two"), (2, None), (3, "... !"), (4, "nothing that is there: zzz"), (None, "lorem é"), (5, "漢字 id text don't"), (6, "")]
    assert found(spark, ODD_TEXTS, items) == brute(ODD_TEXTS, items, 20)
    assert ranked(empty, spark.createDataFrame(items, ITEM)).count() == 0
    nothing = ranked(documents(spark, ODD_TEXTS), spark.createDataFrame([], ITEM))
    assert nothing.columns == ["item_id", "rank", "doc_id", "score"] and nothing.count() == 0


@pytest.mark.parametrize(("short", "block_docs", "block_bytes"), [(0.0, 1 << 15, 1 << 20), (1 / 32, 40, 1 << 20), (0.3, 16, 100), (1.0, 200, 1 << 20)])
def test_ranks_equal_brute_force(spark, short, block_docs, block_bytes):
    """Ties by repeated texts and ids, terms of every frequency, blocks and lists of different sizes."""
    draw = random.Random(block_docs)
    word = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    rows = [(draw.choice([None, *range(300)]), " ".join(draw.choices(word, weights, k=draw.randrange(0, 40)))) for _ in range(400)]
    rows += draw.choices(rows, k=80)
    items = [(i % 9, " ".join(draw.choices(word, weights if i % 2 else None, k=draw.randrange(1, 25)))) for i in range(12)]
    assert found(spark, rows, items, top=5, short=short, block_docs=block_docs, block_bytes=block_bytes) == brute(rows, items, 5)


def test_long_lists_are_skipped():
    """Once the best are good, a list whose bound cannot lift a document is entered at a few places only."""
    n = 20_000
    common, rare = np.arange(n), np.arange(0, n, 400)
    one = np.ones(n + len(rare), "<u4")
    row = {"ids": list(range(n)), "lengths": [10] * n, "terms": [0, 1], "counts": [n, len(rare)],
           "places": np.concatenate((common, rare)).astype("<u4").tobytes(), "times": one.tobytes()}
    block, best = Block(row, n, 10 * n), Best(20)
    looked = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            got = np.ndarray.__getitem__(self, key)
            looked.append(np.size(got))
            return got

    place, share, most = block.lists[0]
    block.lists[0] = (place.view(Counted), share, most)
    block.search(np.array([0, 1]), np.array([1, 5000]), best, 1 / 32)
    assert best.id.tolist() == list(range(0, 20 * 400, 400))
    assert sum(looked) < n / 2  # the windows until the twentieth document is found, then single places


def test_words_longer_than_the_hash_tells_apart():
    a, b = "x" * 300 + "ab" * 50, "x" * 300 + "ba" * 50
    queries = Queries.of([(1, a), (2, "short")])
    word, term = queries.matches(Words.of([f"{b} {a} short".encode()], LETTERS))
    assert word.tolist() == [1, 2]
    assert [queries.term[t].decode() for t in term] == [a, "short"]
