"""Learnt operators: held-out accuracy on made sentences, defined results for odd rows, forward-backward against enumeration."""

from __future__ import annotations

import inspect
import itertools
import random

import numpy as np
import pytest
from tests_llm import ODD_TEXTS, documents

from acadmetric.llm.common import sample_ids
from acadmetric.llm.language import fit_language, languages
from acadmetric.llm.quality import fit_quality, keep_rows_of_quality, quality_scores
from acadmetric.llm.tokens import sigmoid
from acadmetric.llm.toxicity import (chain_marginals, fit, fit_toxicity, keep_clean_rows, labelled_tokens, strongest,
                                     toxicity_scores, windows)

DRAW = random.Random(17)
PARTS = ["ka", "to", "mi", "re", "su", "na", "lo", "ve", "di", "po"]


def sentence(n: int = 30) -> list[str]:
    return ["".join(DRAW.choice(PARTS) for _ in range(DRAW.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def made(spark):
    """Texts with quality (shouting is bad) and toxic labels (two insults, one with endings)."""
    rows, labels = [], []
    for i in range(400):
        words, bad, toxic = sentence(), i % 4 == 0, i % 5 == 0
        if bad:
            words = [w.upper() + "!!" for w in words]
        if toxic:
            words.insert(DRAW.randrange(len(words)), DRAW.choice(["zurk", "blorg" + DRAW.choice(PARTS)]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(toxic)))
    return documents(spark, rows).cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


def test_quality_on_rows_left_out(made, odd, empty):
    docs, labels = made
    model = fit_quality(docs, labels.filter("doc_id < 300"))
    got = quality_scores(docs, model).join(labels, "doc_id").filter("doc_id >= 300").collect()
    assert sum((r.score >= 0.3) == bool(r.quality) for r in got) >= 98
    scores = {r.doc_id: r.score for r in quality_scores(odd, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[1] == scores[2] == scores[3]
    assert quality_scores(empty, model).count() == 0
    kept = keep_rows_of_quality(odd, model, 0.0)
    assert kept.count() == len(ODD_TEXTS) and kept.columns == odd.columns


def test_toxicity_on_rows_left_out(made, odd, empty):
    docs, labels = made
    field = fit_toxicity(docs, labels.filter("doc_id < 300"))
    got = toxicity_scores(docs, field).join(labels, "doc_id").filter("doc_id >= 300").join(docs.select("doc_id", "text"), "doc_id").collect()
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in got) >= 97
    marked = [r.text[s.start:s.end].lower() for r in got if r.toxic for s in r.spans]
    assert marked and sum("zurk" in m or "blorg" in m for m in marked) >= 0.9 * len(marked)
    assert {r.doc_id for r in toxicity_scores(odd, field).collect()} == {i for i, _ in ODD_TEXTS}
    assert toxicity_scores(empty, field).count() == 0 and keep_clean_rows(empty, field, 0.5).count() == 0


def test_without_labels_scores_are_the_same_for_all(made, odd):
    docs, labels = made
    none = labels.limit(0)
    assert {r.score for r in quality_scores(odd, fit_quality(docs, none)).collect()} == {0.5}
    assert len({r.score for r in toxicity_scores(odd, fit_toxicity(docs, none)).collect()}) == 1


def test_few_labels_teach_markers_and_one_does_not():
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choice(PARTS) for _ in range(draw.randint(2, 4))) for _ in range(30)) for _ in range(90)]
    toxic = np.arange(90) % 9 == 0
    texts = [f"{t} {'zurk' if i % 2 else 'blorgka'} {t[:20]}".encode() if toxic[i] else t.encode() for i, t in enumerate(texts)]
    doc, marks = labelled_tokens(texts, toxic)
    assert set(doc[marks].tolist()) == set(np.flatnonzero(toxic).tolist())
    field = fit(texts, toxic, toxic.mean())
    scores = sigmoid(field.slope * strongest(field, [b"ka to zurk mire", b"ka to mire resu"])[0] + field.base)
    assert scores[0] > scores[1]
    # With one toxic text nothing marks toxicity: the same score for all, near the share.
    one = np.arange(90) == 0
    field = fit(texts, one, one.mean())
    assert field.slope == 0 and abs(sigmoid(np.array(field.base)) - one.mean()) < 0.01


def test_the_bound_of_markers_is_chosen_by_folds_of_the_rows_that_train(monkeypatch):
    from acadmetric.llm import toxicity

    draw = random.Random(9)
    texts = [" ".join("".join(draw.choice(PARTS) for _ in range(3)) for _ in range(25)) for _ in range(600)]
    toxic = np.arange(600) % 6 == 0
    texts = [(f"{t} zurk" if y else t).encode() for t, y in zip(texts, toxic, strict=True)]
    seen = []

    def spied(rows, labels, *more):
        seen.append((list(rows), labels.copy()))
        return chosen(rows, labels, *more)

    chosen = toxicity.chosen_chance
    assert chosen(texts, toxic) in toxicity.CHANCES
    # Words that meet toxic rows by accident pass a loose bound only, and cost precision on the fold left out.
    rare = [f"rare{i // 3}".encode() for i in range(600)]
    noisy = [t + b" " + r for t, r in zip(texts, rare, strict=True)]
    assert chosen(noisy, toxic, (0.5, 0.001)) == 0.001
    monkeypatch.setattr(toxicity, "chosen_chance", spied)
    toxicity.fit(texts, toxic, 0.2)
    [(rows, _)] = seen
    assert len(rows) == 600 - 25 - 125 and set(rows) <= set(texts)


def test_sample_is_not_cut_for_memory():
    own = inspect.signature(fit_toxicity).parameters
    assert own["per_class"].default == 4000 and own["max_bytes"].default == 50_000
    own = inspect.signature(fit).parameters
    assert own["toxic_windows"].default == 20_000 and own["clean_windows"].default == 40_000


def test_windows_keep_to_their_text():
    texts = [f"a{i} b{i} c{i}".encode() for i in range(450)]
    doc, _ = labelled_tokens(texts, np.arange(450) % 2 == 0)
    ids, labels, inside = windows(texts, np.arange(len(doc)), doc % 2 == 0)
    assert ids.shape[1] == len(doc) == 1350 and (inside.sum(1) == 3).all() and (labels.sum(1) == np.where(doc % 2 == 0, 3, 0)).all()


def test_smallest_table_teaches_insults(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    field = fit_toxicity(docs, labels)
    got = toxicity_scores(docs, field).join(labels.filter("toxic IN (0, 1)"), "doc_id").collect()
    found = [r.toxic for r in got if r.score >= 0.5]
    assert sum(found) >= 4 and sum(found) == len(found)


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(4)
    moves, start = draw.normal(size=(2, 2)), 0.3
    lengths = [1, 7, 3, 9, 2, 8]
    u = draw.normal(size=sum(lengths)) * 2
    first = np.zeros(len(u), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    want, at = [], 0
    for n in lengths:
        total = np.zeros((n, 2))
        for states in itertools.product((0, 1), repeat=n):
            w = start * states[0] + sum(u[at + k] * s for k, s in enumerate(states))
            w += sum(moves[a, b] for a, b in itertools.pairwise(states))
            for k, s in enumerate(states):
                total[k, s] += np.exp(w)
        want += list(np.log(total[:, 1] / total[:, 0]))
        at += n
    for block in (2, 4, 64):
        assert np.allclose(chain_marginals(u, first, moves, start, block), want)


def test_language_on_rows_left_out(spark, small, odd, empty):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = fit_language(docs.filter("doc_id % 2 = 0"))
    got = languages(docs, model, reject=False).join(docs.select("doc_id", "lang"), "doc_id").filter("doc_id % 2 = 1").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    odd_rows = {r.doc_id: r for r in languages(odd, model, reject=False).collect()}
    assert [odd_rows[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and odd_rows[8].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in odd_rows.values())
    assert languages(empty, model).count() == 0
    nothing = fit_language(docs.limit(0))
    assert {r.lang_pred for r in languages(odd, nothing).collect()} == {"und"}


def test_doubtful_languages_are_rejected(spark):
    """Two invented languages and texts whose language is drawn by lot: what is accepted is right as often as the limit promises."""
    draw, rows = random.Random(3), []
    for i in range(1200):
        lang, lot = draw.choice(["aa", "bb"]), i % 3 == 0
        letters = "mnoprs" if lot else "aeiklt" if lang == "aa" else "uvwxyz"
        rows.append((i, " ".join("".join(draw.choice(letters) for _ in range(5)) for _ in range(20)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language(docs.filter("doc_id % 2 = 0"))
    assert 0 < model.reject < 1
    test = docs.filter("doc_id % 2 = 1")
    sure = {r.doc_id: r for r in languages(test, model).collect()}
    for r in languages(test, model, reject=False).collect():
        assert sure[r.doc_id].lang_pred == (r.lang_pred if r.score >= model.reject else "und") and sure[r.doc_id].score == r.score
    kept = [i for i, r in sure.items() if r.lang_pred != "und"]
    assert len(kept) >= 380 and sum(sure[i].lang_pred == rows[i][2] for i in kept) >= 0.9 * len(kept)
    assert sum(sure[i].lang_pred == "und" for i in sure if i % 3 == 0) >= 150


def test_samples_have_the_first_rows_of_every_class(spark):
    rows = [(i, f"c{i % 700}") for i in range(2100)] + [(i, "many") for i in range(3000, 6000)] + [(None, "many"), (7000, None), (7001, "one"), (7001, "one")]
    labelled = spark.createDataFrame(rows, "doc_id long, kind string")
    place = {r[0]: r[1] for r in labelled.selectExpr("doc_id", "xxhash64(doc_id)").collect()}
    by_class = {}
    for i, c in {r for r in rows if None not in r}:
        by_class.setdefault(c, []).append(i)
    for n in (2, 40, 2999):
        want = {(i, c) for c, ids in by_class.items() for i in sorted(ids, key=lambda i: (place[i], i))[:n]}
        got = list(map(tuple, sample_ids(labelled, "kind", n).collect()))
        assert len(got) == len(want) and set(got) == want
    assert sample_ids(labelled.limit(0), "kind", 2).count() == 0
