from __future__ import annotations

import hashlib
import random

from tests_llm import ODD_TEXTS, documents

from acadmetric.llm.fill_in_middle import Restorer, digests, restored, transformed

MARKED = [(100, "text with <P> in it"), (101, "<M>"), (102, "a<S"), (103, "<<SS>>"), (104, "S>" * 40), (105, "<P" * 60), (106, "é\U0001F600" * 50)]


def brute(i: int | None, text: str | None) -> tuple:
    """doc_id, n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    drawn = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return i, n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return i, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_rows_equal_brute_force(spark, empty):
    draw = random.Random(2)
    rows = [*ODD_TEXTS, *MARKED, *((i, "".join(draw.choices("ab <PSM>é漢\U0001F600", k=draw.randrange(60)))) for i in range(200, 400))]
    docs = documents(spark, rows).repartition(4)
    want = [brute(*r) for r in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    for chunk in (1, 5, 8192):
        few = [r for r in rows if len(r[1] or "") < 1000 or chunk > 100]
        got = digests(docs.filter("coalesce(length(text), 0) < 1000") if chunk < 100 else docs, chunk=chunk)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(
            ((*w[:5], sha(w[5]), sha(r[1] or "")) for w, r in zip(map(lambda r: brute(*r), few), few, strict=True)), key=str)
    whole = transformed(docs)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(want, key=str)
    back = restored(whole)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert digests(empty).count() == 0 and transformed(empty).count() == 0


def test_restoration_needs_the_output_alone():
    output = "<S>fix<S<P>pre><P<M>mid".encode()
    for cut in range(1, len(output)):
        reader = Restorer("spm")
        runs = [r for i in range(0, len(output), cut) for r in reader.feed(output[i:i + cut])] + list(reader.finish())
        parts = ["".join(b.decode() for p, b in runs if p == part) for part in range(3)]
        assert parts == ["pre><P", "mid", "fix<S"]


def test_one_shuffle_serves_both_orders(spark):
    plan = digests(documents(spark, MARKED))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2
