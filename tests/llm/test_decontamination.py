from __future__ import annotations

import random

import numpy as np
from tests_llm import documents

from acadmetric.llm.decontamination import Tests, contaminated_documents, items_digest, keep_uncontaminated, longest_matches, packed, suffix_array


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute(docs, bench, window):
    out = []
    for i, text in docs:
        words = (text or "").lower().split()
        hit, found = set(), set()
        for name, item in bench:
            w = (item or "").lower().split()
            n = min(window, len(w))
            for k in range(len(w) - n + 1 if n else 0):
                for p in range(len(words) - n + 1):
                    if words[p:p + n] == w[k:k + n]:
                        hit.update(range(p, p + n))
                        if name is not None:
                            found.add(str(name))
        out.append((i, len(words), len(hit), len(found), items_digest(list(found)), bool(hit)))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())


def test_hits_equal_brute_force_in_small_shards_and_many_blocks(spark):
    draw = random.Random(1)
    words = [f"w{i}" for i in range(6)]
    bench = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 9)))) for i in range(12)] + [(3, "x y z"), (None, "w1 w2 w3 w4"), (20, None)]
    docs = [(i, " ".join(draw.choice([*words, "other"]) for _ in range(draw.randint(0, 60)))) for i in range(60)]
    want = brute(docs, bench, 4)
    found = documents(spark, docs)
    assert rows_of(contaminated_documents(found, items(spark, bench), 4, shard_words=50)) == want
    assert rows_of(contaminated_documents(found, items(spark, bench), 4, block_bytes=150)) == want


def test_odd_rows(spark, odd, empty):
    bench = items(spark, [(1, "two three four five six seven eight nine ten eleven"), (2, "..."), (3, None)])
    got = {r[0]: r for r in rows_of(contaminated_documents(odd.filter("doc_id IS NOT NULL"), bench))}
    assert got[5][2:4] == (10, 1) and got[7][2] == 10 and got[1][1:4] == (0, 0, 0) and got[9][1] == 120_000 and not got[9][5]
    assert contaminated_documents(odd, bench).count() == odd.count()
    assert contaminated_documents(empty, bench).count() == 0
    assert contaminated_documents(odd, bench.limit(0)).filter("contaminated").count() == 0


def test_longest_match_is_found_across_shards(spark):
    docs = documents(spark, [(1, "a b c d e"), (2, "x b c d e f y"), (3, "q")])
    got = {r.item_id: tuple(r) for r in longest_matches(docs, items(spark, [(7, "z b c d e f g"), (8, "nothing here")]), shard_words=2).collect()}
    assert got == {"7": ("7", 1, 5, 2, 1)}


def test_suffix_array_sorts_to_the_wanted_depth():
    draw = np.random.default_rng(2)
    ids = draw.integers(0, 4, 3000).astype(np.uint64)
    at = suffix_array(ids, packed(ids, 2, 3), 3, 40)

    def suffix(p):
        w = ids[p:p + 48].tolist()
        return w[:w.index(0)] if 0 in w else w

    keys = [suffix(p)[:40] for p in at]
    assert keys == sorted(keys) and len(at) == int((ids > 0).sum())


def test_clean_rows_stay_where_they_lie(spark, odd, empty):
    bench = items(spark, [(1, "two three four five six seven eight nine ten eleven"), (2, "lorem"), (3, None), (None, "漢字")])
    want = sorted((str(r.doc_id), str(r.text)) for r in odd.collect() if r.doc_id not in (5, 6, 7, 8, 9))
    for size in (8 << 20, 40):
        kept = keep_uncontaminated(odd, bench, block_bytes=size)
        assert kept.dtypes == odd.dtypes and sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == want
    assert keep_uncontaminated(empty, bench).count() == 0 and keep_uncontaminated(odd, bench.limit(0)).count() == odd.count()
    twice = documents(spark, [(1, "lorem"), (1, "clean"), (None, "lorem"), (None, "clean")])
    assert sorted((str(r.doc_id), r.text) for r in keep_uncontaminated(twice, bench).collect()) == [("1", "clean"), ("None", "clean")]


def test_a_block_of_the_benchmark_is_small_in_memory():
    import tracemalloc

    draw = random.Random(3)
    words = [f"word{i}" for i in range(20_000)]
    texts = [(str(i), " ".join(draw.choices(words, k=40)).encode()) for i in range(7_000)]  # about 2.4 MB
    size = sum(len(t) for _, t in texts)
    tracemalloc.start()
    tests = Tests.of(texts, 10)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(tests.windows[10].start) >= 7_000 * 31 - 5
    assert held < 12 * size and peak < 40 * size
