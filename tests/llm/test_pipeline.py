from __future__ import annotations

import itertools
import random

import corpus_pipeline
import pytest
from tests_llm import documents

from acadmetric.llm import queries
from acadmetric.llm.quality import fit_quality
from acadmetric.llm.tokens import sigmoid
from acadmetric.llm.toxicity import fit_toxicity, strongest
from acadmetric.session import written


DRAW = random.Random(23)
PARTS = ["ka", "to", "mi", "re", "su", "na", "lo", "ve", "di", "po", "zu", "fe"]


def sentence(n: int) -> list[str]:
    return ["".join(DRAW.choice(PARTS) for _ in range(DRAW.randint(2, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A folder of tables with bad, toxic, copied and contaminated rows, repeated and missing ids, and labels for most."""
    folder = str(tmp_path_factory.mktemp("planted"))
    bench = [(1, " ".join(sentence(14))), (2, " ".join(sentence(11))), (3, None), (None, " ".join(sentence(12)))]
    rows, labels = [], []
    for i in range(500):
        words, bad, toxic = sentence(60), i % 7 == 0, i % 6 == 0
        if bad:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            words.insert(DRAW.randrange(len(words)), DRAW.choice(["zurk", "blorg" + DRAW.choice(PARTS)]))
        if i % 11 == 3:
            words[20:20] = bench[i % 4 if i % 4 != 2 else 0][1].split()
        rows.append((i, " ".join(words)))
        if i % 10:
            labels.append((i, int(not bad), int(toxic)))
    good = [t for i, t in rows if i % 7 and i % 6 and i % 11 != 3]
    for k in range(40):  # copies, exact and near, some under an id that another text has, some without an id
        words = good[k].split()
        if k % 2:
            words[-1] = "other"
        rows.append((DRAW.choice([600 + k, 600 + k, 5, None]), " ".join(words)))
    rows += [(700, None), (700, ""), (None, None), (None, " . "), (701, "kato"), (701, "kato")]
    documents(spark, rows).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, bench


def pairs(df) -> list[tuple]:
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def without_copies(rows: list[tuple]) -> list[tuple]:
    """Brute force over all pairs; of a group the smallest id stays, rows without id come last."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups: dict[int, list] = {}
    for k, row in enumerate(rows):
        groups.setdefault(find(k), []).append(row)
    return sorted((min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()), key=str)


def contaminated(text: str | None, bench: list[tuple]) -> bool:
    padded = f" {' '.join((text or '').lower().replace('!!', '').split())} "
    for _, item in bench:
        w = (item or "").split()
        if any(f" {' '.join(w[k:k + 10])} " in padded for k in range(len(w) - 9)):
            return True
    return False


def test_every_stage_keeps_the_rows_that_plain_python_keeps(spark, planted):
    folder, bench = planted
    docs, tables = spark.read.parquet(f"{folder}/documents.parquet"), {}
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = pairs(docs)
        if name == "quality":
            model = fit_quality(docs, labels)
            want = [r for r in before if model.scores([(r[1] or "").encode()])[0] >= 0.3]
        elif name == "toxicity":
            field = fit_toxicity(docs, labels)
            odds = [strongest(field, [(r[1] or "").encode()])[0][0] for r in before]
            want = [r for r, o in zip(before, odds, strict=True) if sigmoid(field.slope * o + field.base) < 0.5]
        elif name == "near_dedup":
            want = without_copies(before)
        else:
            want = [r for r in before if not contaminated(r[1], bench)]
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        assert pairs(kept) == want, name
        sizes.append(len(want))
        docs = written(kept, "stage")
        tables[name] = docs
    assert all(a - b >= 20 for a, b in itertools.pairwise(sizes))
    # The planted rows went where they should: labels that no sample saw are judged as well.
    left = [i for i, _ in pairs(tables["toxicity"]) if i is not None and i < 500]
    assert sum(i % 7 == 0 for i in left) <= 4 and sum(i % 6 == 0 for i in left) <= 4 and len(left) >= 330
    out = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, (r.doc_id for r in out.select("doc_id").collect()))) == sorted(map(str, (i for i, _ in pairs(docs))))
    assert out.filter("NOT same OR n_pieces <> size(ids)").count() == 0


def test_empty_tables_run_through(spark, planted, tmp_path):
    folder, _ = planted
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries(spark, small, name):
    from check import compare, connect

    table = "pages" if name.startswith("op2_") else "documents"
    df = queries.QUERIES[name](spark, small)
    if name in queries.CHECKS:
        assert compare(df, connect(small), queries.CHECKS[name]) == ""
    else:
        assert df.count() == spark.read.parquet(f"{small}/{table}.parquet").count()
