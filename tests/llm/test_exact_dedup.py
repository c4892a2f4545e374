from __future__ import annotations

import hashlib
import random
import re

import pytest
from tests_llm import ODD_TEXTS, documents

from acadmetric.llm.exact_dedup import BASES, PRIME, exact_duplicates, joined, normalised, polynomial


def expected(rows: list[tuple]) -> list[tuple]:
    """doc_id, keep_id, group_size, text_sha256 of every row; one row of each group is kept."""
    groups: dict[str, list] = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, min(named, default=None), len(ids), digest) for i in ids]
    return sorted(out, key=str)


def check(found, rows: list[tuple]) -> None:
    got = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(odd, empty):
    check(exact_duplicates(odd), ODD_TEXTS)
    assert exact_duplicates(empty).count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 64])
def test_groups_of_copies_equal_brute_force(spark, chunk):
    draw = random.Random(chunk)
    pool = ["", " ", "\t\n", "a", "a ", " a", "a\x0bb", "a  b", "a\x1cb", "a\xa0b", "中 " * 9, "x" * 64, "x" * 63 + "y", "x" * 65, "x y" * 50, "x\ty" * 50]
    rows = [(draw.choice([None, *range(40)]), draw.choice(pool)) for _ in range(200)]
    check(exact_duplicates(documents(spark, rows).repartition(5), chunk_bytes=chunk), rows)


def test_texts_that_collide_are_told_apart(spark):
    """Modulo 3 nearly all texts of one length share both polynomials; a group holds many different texts."""
    rows = [(i, f"{i % 7:03d} text {i % 5}") for i in range(120)]
    check(exact_duplicates(documents(spark, rows), chunk_bytes=4, bases=(2, 2), prime=3), rows)


def test_a_hot_group_is_dealt_and_whole(spark, monkeypatch):
    monkeypatch.setattr("acadmetric.llm.exact_dedup.SALT_BYTES", 512)
    rows = [(i, "the same long text " * 20 if i % 3 else f"text {i}") for i in range(300)]
    check(exact_duplicates(documents(spark, rows), chunk_bytes=100), rows)


def test_polynomials_compose():
    draw = random.Random(4)
    for _ in range(50):
        text = draw.randbytes(draw.randrange(200))
        cut = draw.randrange(len(text) + 1)
        for base in BASES:
            whole = sum(b * pow(base, len(text) - 1 - i, PRIME) for i, b in enumerate(text)) % PRIME
            assert polynomial(text, base, PRIME, 256) == whole
            left, right = polynomial(text[:cut], base, PRIME, 256), polynomial(text[cut:], base, PRIME, 256)
            assert joined(left, right, len(text) - cut, base, PRIME) == whole


def test_white_space_is_that_of_ascii():
    assert normalised(b"a \t\r\n\x0b\x0cb\x1c\x85  ") == b"a b\x1c\x85 "
