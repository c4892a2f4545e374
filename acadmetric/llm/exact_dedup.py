"""Exact duplicates by polynomial fingerprints that compose.

A text, its white space normalised, is cut into chunks that are stored as rows of their own, so the chunks of a huge document are
read and hashed by several tasks. The hash of a chunk is its polynomial in a fixed base modulo a prime; multiplied by
the base to the power of the bytes that follow, it is the chunk's share of the whole text's polynomial. Shares may be added in any order, so a
fingerprint is a plain sum, combined inside each task before it is shuffled.

Texts of one fingerprint are only taken for equal after they are compared: every member meets the group's first text, dealt
under as many salts as the group's bytes ask for, sorted by chunk, so that a task holds one chunk of the first text
while the members' chunks stream by. Members that differ form groups of their own and are compared again, until none differs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.llm.common import doc_batches, id_and_text, utf8
from acadmetric.session import written

PRIME = (1 << 61) - 1
#: Two bases below the prime, drawn once; equal results for both mean a chance of about 2^-120 for different texts.
BASES = (1_418_283_705_829_413_327, 583_094_771_635_204_119)
SALT_BYTES = 1 << 18
_ROW_BYTES = 64  # what a row weighs besides its text
_WHITE = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))


def normalised(text: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    text = text.translate(_WHITE)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


@lru_cache(8)
def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^(n-1) ... base^0 modulo ``prime``: a row of their lower 32 bits, a row of the rest."""
    powers, p = [], 1
    for _ in range(n):
        powers.append(p)
        p = p * base % prime
    whole = np.array(powers[::-1], np.uint64)
    return np.stack([whole & np.uint64(0xFFFFFFFF), whole >> np.uint64(32)])


def polynomial(chunk: bytes, base: int, prime: int, longest: int) -> int:
    """The chunk's bytes as coefficients, the last one of base^0. ``longest`` bounds the chunk's length (2^23 at most)."""
    if not chunk:
        return 0
    low, high = _powers(base, prime, longest)[:, -len(chunk):] @ np.frombuffer(chunk, np.uint8).astype(np.uint64)
    return ((int(high) << 32) + int(low)) % prime


def joined(left: int, right: int, right_bytes: int, base: int, prime: int) -> int:
    """The polynomial of two texts one after the other, from theirs."""
    return (left * pow(base, right_bytes, prime) + right) % prime


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """seq, no, after (bytes that follow), data; doc_id, n (bytes), sha256 in chunk 0, which every text has, an empty one too."""
    schema = "seq long, no long, after long, data binary, doc_id long, n long, sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 40
        for batch in doc_batches(batches, 2 << 20):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                text = normalised(text)
                n = len(text)
                rows.append((seq, 0, max(0, n - chunk_bytes), text[:chunk_bytes], doc_id, n, hashlib.sha256(text).hexdigest()))
                for no, i in enumerate(range(chunk_bytes, n, chunk_bytes), 1):
                    rows.append((seq, no, max(0, n - i - chunk_bytes), text[i:i + chunk_bytes], None, None, None))
                seq += 1
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                             [f.split()[0] for f in schema.split(", ")])

    return id_and_text(docs).mapInArrow(run, schema)


def _fingerprints(chunks: DataFrame, chunk_bytes: int, bases: tuple[int, int], prime: int) -> DataFrame:
    """One row per document: seq, doc_id, n, sha256, a, b (its polynomials)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = batch.column(1).to_pylist()
            shifts: dict[int, list[int]] = {0: [1, 1]}
            shares: tuple[list[int], list[int]] = ([], [])
            for shift, data in zip(after, batch.column(2).to_pylist(), strict=True):
                if shift not in shifts:
                    shifts[shift] = [pow(base, shift, prime) for base in bases]
                for share, base, power in zip(shares, bases, shifts[shift], strict=True):
                    share.append(polynomial(data, base, prime, chunk_bytes) * power % prime)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shares[0], pa.int64()), pa.array(shares[1], pa.int64()),
                                              *batch.columns[3:]], ["seq", "a", "b", "doc_id", "n", "sha256"])

    shares = chunks.select("seq", "after", "data", "doc_id", "n", "sha256").mapInArrow(
        run, "seq long, a long, b long, doc_id long, n long, sha256 string")

    def total(name: str):
        return (F.sum(F.col(name).cast("decimal(20,0)")) % F.lit(prime).cast("decimal(20,0)")).cast("long").alias(name)

    return shares.groupBy("seq").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("sha256").alias("sha256"),
                                     total("a"), total("b"))


def _different(chunks: DataFrame, members: DataFrame, firsts: DataFrame) -> DataFrame:
    """seq of the members (seq, first, salt) whose chunks are not those of their group's first text.

    ``firsts`` (first, salts) repeats each first text once per salt.
    """
    copies = firsts.select(F.col("first").alias("seq"), "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                           F.lit(0).alias("role"))
    wanted = copies.unionByName(members.select("seq", "first", "salt", F.lit(1).alias("role")))
    met = chunks.select("seq", "no", "data").join(wanted, "seq").select("first", "salt", "no", "role", "seq", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, b""
        for batch in batches:
            differ = set()
            for i in range(0, batch.num_rows, 1024):
                for first, salt, no, role, seq, data in zip(*(c.to_pylist() for c in batch.slice(i, 1024).columns), strict=True):
                    if role == 0:
                        held, own = (first, salt, no), data
                    elif held != (first, salt, no) or own != data:
                        differ.add(seq)
            yield pa.RecordBatch.from_arrays([pa.array(sorted(differ), pa.int64())], ["seq"])

    return met.repartition("first", "salt").sortWithinPartitions("first", "salt", "no", "role").mapInArrow(run, "seq long").distinct()


def exact_duplicates(docs: DataFrame, chunk_bytes: int = 1 << 14, bases: tuple[int, int] = BASES, prime: int = PRIME) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_bytes, fingerprint.

    Texts are equal that are identical after every run of ASCII white space is one space; null is the empty text. The row of the
    smallest doc_id stays, rows without one come last, and of rows that repeat it the one read first; so exactly one row of a group is
    kept, and keep_id is null only where no row of the group has an id. ``fingerprint`` holds both polynomials in hex. A prime so small that
    different texts collide makes more rounds and the same groups. An empty table gives no row.
    """
    chunks = written(_chunks(docs, chunk_bytes), "chunks")
    rows = written(_fingerprints(chunks, chunk_bytes, bases, prime), "fingerprints")
    key, rest, equal = ["n", "a", "b"], rows, None
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "seq")
    weight = F.ceil(F.col("times") * (F.col("n") + _ROW_BYTES) / SALT_BYTES)
    while True:
        groups = rest.groupBy(*key).agg(F.count("*").alias("times"), F.min(place).alias("m")).filter("times > 1").select(
            *key, F.col("m.seq").alias("first"), F.greatest(F.lit(1), F.least("times", weight)).cast("int").alias("salts"))
        groups = written(groups, "groups")
        grouped = rest.join(groups, key)
        members = grouped.filter("seq <> first").withColumn("salt", F.pmod(F.xxhash64("seq"), F.col("salts")).cast("int"))
        differ = written(_different(chunks, members, groups.select("first", "salts")), "different")
        found = grouped.select("seq", "first")
        if differ.isEmpty():
            equal = found if equal is None else equal.unionByName(found)
            break
        same = found.join(differ, "seq", "left_anti")
        equal = same if equal is None else equal.unionByName(same)
        rest = written(rest.join(differ, "seq", "left_semi"), "rest")
    named = rows.join(equal, "seq", "left")
    totals = named.filter("first IS NOT NULL").groupBy("first").agg(F.count("*").alias("group_size"), F.min("doc_id").alias("keep_id"))
    alone = F.col("first").isNull()
    return named.join(totals, "first", "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.coalesce(F.col("seq") == F.col("first"), F.lit(True)).alias("kept"),
        F.col("sha256").alias("text_sha256"), F.col("n").alias("n_bytes"),
        F.format_string("%016x%016x", "a", "b").alias("fingerprint"))
