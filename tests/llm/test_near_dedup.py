from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F
from tests_llm import ODD_TEXTS, brute_groups, documents

from acadmetric.llm.near_dedup import (
    _prefix_pairs, band_keys, keep_one_row_of_each_group, near_duplicate_groups, one_permutation, shingle_set)


def test_odd_rows(odd, empty):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicate_groups(odd, width=4).collect()}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 9, 5, True), (6, 9, 5, False), (7, 9, 5, False),
            (10, 1, 10, True), (9, 2, 9, True)} <= got
    assert [g for g in got if g[0] is None] == [(None, 9, None, True)]
    assert near_duplicate_groups(odd, width=4).count() == odd.count()
    assert near_duplicate_groups(empty).count() == 0


def test_chains_of_copies_equal_brute_force(spark):
    """Copies of copies: neighbours are linked, ends are not, and no bucket's centre is linked with all of its members."""
    draw = random.Random(3)
    rows, words = [], [f"w{draw.randrange(5000)}" for _ in range(120)]
    for i in range(150):
        rows.append((i, " ".join(words)))
        for _ in range(draw.choice([1, 2, 6])):
            words[draw.randrange(len(words))] = f"v{draw.randrange(10**6)}"
    draw.shuffle(rows)
    got = {r.doc_id: r.component_id for r in near_duplicate_groups(documents(spark, rows), width=4).collect()}
    assert got == brute_groups(rows, 4)


def test_shared_passages_do_not_link(spark):
    draw = random.Random(5)
    shared = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(shared + [f"u{draw.randrange(10**9)}" for _ in range(40)])) for i in range(80)]
    assert near_duplicate_groups(documents(spark, rows)).filter(F.col("kept")).count() == 80


def test_densified_bins_estimate_similarity():
    draw = np.random.default_rng(1)
    a = np.unique(draw.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2))
    values = one_permutation([a, a[:-4], a[:1]], 128)
    assert (values[2] == a[0]).all()
    assert abs((values[0] == values[1]).mean() - 0.9) < 0.2
    assert (band_keys(values[:1], 4) == band_keys(one_permutation([a], 128), 4)).all()


def test_words_split_at_ascii_white_space_only():
    assert len(shingle_set("a b c d e".encode(), 4)) == 1
    assert (shingle_set(b"A b C d", 4) == shingle_set(b"a\tB\x0bc\rD", 4)).all()
    assert len(shingle_set(b"a b", 4)) == 1


def changed(text: str, *places: int) -> str:
    words = text.split()
    for p in places:
        words[p] = f"changed{p}"
    return " ".join(words)


def test_rows_that_repeat_an_id_do_not_join_their_groups(spark):
    draw = random.Random(6)
    a, b = (" ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) for _ in "ab")
    for first, second in ((6, 6), (6, 7)):
        rows = [(3, changed(a, 59)), (first, a), (second, b), (8, changed(b, 0)), (None, b), (None, "only " + a[::-1]), (None, None)]
        got = near_duplicate_groups(documents(spark, rows), width=4).collect()
        found = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got)
        assert found == sorted([("3", "3", True), (str(first), "3", False), (str(second), str(second), True), ("8", str(second), False),
                                ("None", str(second), False), ("None", "None", True), ("None", "None", True)])


def test_one_row_of_each_group_stays(spark, odd, empty):
    draw = random.Random(7)
    a, b, c = (" ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) for _ in "abc")
    rows = [(3, a), (3, a), (5, changed(a, 59)), (6, b), (6, c), (7, b), (None, c), (None, c), (None, a + " and more " + c), (None, changed(b, 1)),
            (9, None), (9, ""), (None, None)]
    docs = documents(spark, rows)
    kept = keep_one_row_of_each_group(docs)
    assert kept.dtypes == docs.dtypes
    want = [(3, a), (6, b), (6, c), (None, a + " and more " + c), (9, None), (9, ""), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    nobody = documents(spark, [(None, a), (None, changed(a, 59)), (None, a)])
    assert keep_one_row_of_each_group(nobody).count() == 1
    assert keep_one_row_of_each_group(empty).count() == 0
    assert keep_one_row_of_each_group(odd).count() == len({t.lower() for _, t in ODD_TEXTS if t and t.split()}) + 3  # and three without words


def test_a_family_that_is_no_copy_is_not_compared_in_pairs(spark):
    """Texts of one template that share under four fifths: candidates do not grow with the square of their number."""
    def candidates(n: int) -> int:
        shared = np.arange(1, 76, dtype=np.int64)
        rows = []
        for i in range(n):
            own = np.arange(25, dtype=np.int64) + 1000 * (i + 1)
            rows.append((i, i, bytearray(np.sort(np.concatenate((shared, own))).tobytes())))
        return _prefix_pairs(spark.createDataFrame(rows, "id long, root long, items binary"), 80).count()

    def near(n: int) -> int:
        """Each text also shares its own words with one other."""
        shared = np.arange(1, 70, dtype=np.int64)
        rows = []
        for i in range(n):
            own = np.arange(31, dtype=np.int64) + 1000 * (i // 2 + 1)
            rows.append((i, i, bytearray(np.sort(np.concatenate((shared, own))).tobytes())))
        return _prefix_pairs(spark.createDataFrame(rows, "id long, root long, items binary"), 80).count()

    assert candidates(100) == candidates(400) == 0
    assert (near(100), near(400)) == (50, 200)


def test_pairs_are_confirmed_a_few_at_a_time(spark):
    """What a task takes out of Arrow at once does not grow with the batch that Spark hands it."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from acadmetric.llm import near_dedup

    class Rows:
        def join(self, *_):
            return self

        def mapInArrow(self, run, schema):
            self.run = run
            return self

        select = distinct = join

    rows = Rows()
    near_dedup._confirmed(rows, rows, 80)
    n, items = 5000, [np.arange(i % 7, 500, dtype=np.uint64).tobytes() for i in range(5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n, 2 * n)), pa.array(items), pa.array(items[::-1])], ["a", "b", "x", "y"])
    tracemalloc.start()
    assert sum(out.num_rows for out in rows.run(iter([batch]))) == n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6, peak
