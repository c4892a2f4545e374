"""Near-duplicate groups by one-permutation MinHash.

A document's set holds the hashes of its distinct word shingles. One sorted pass over them gives one minimum per bin
(the top bits of a hash name its bin); empty bins take the value of a bin drawn by a hash of (bin, attempt), the same draw
for every document, which is the optimal densification. Bins are banded, and equal bands put documents into a bucket.

Buckets never emit their pairs. Equal sets collapse to one numbered set first. Each bucket links its members
to one centre (a star), links are confirmed on the full sets, and components are formed. Buckets that are one component
then need no further look: no pair in them can join anything. The documents of the other buckets meet once more, by an exact
prefix filter: with shingles ordered from rare to common, two sets of the wanted similarity share one among their first
few, early enough for what follows to suffice. What it finds across components is confirmed and joins them. So no link of a
bucket is lost, whatever its centre. With ``bins=128, rows=4`` a pair of similarity 0.8 shares no bucket with a probability
of 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acadmetric.llm.common import GOLDEN, doc_batches, few_rows, mix, utf8, word_hashes
from acadmetric.session import written

_POSITION = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                      0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; words are lower-cased (A-Z) and split at ASCII white space."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    n = min(width, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total += h[i:i + len(total)] * (_POSITION[i % 8] + np.uint64(2 * (i // 8)))
    return np.unique(mix(total + GOLDEN * np.arange(n, n + 1, dtype=np.uint64)))


def one_permutation(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of ``bins`` minima for each non-empty set."""
    shift = np.uint64(64 - int(bins).bit_length() + 1)
    edges = np.arange(1, bins, dtype=np.uint64) << shift
    values = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for k, s in enumerate(sets):
        starts = np.concatenate(([0], np.searchsorted(s, edges)))
        has = starts < np.append(starts[1:], len(s))
        filled[k] = has
        values[k, has] = s[starts[has]]
    row, gap = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        draw = (mix(gap.astype(np.uint64) * GOLDEN + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        hit = filled[row, draw]
        values[row[hit], gap[hit]] = values[row[hit], draw[hit]]
        row, gap = row[~hit], gap[~hit]
    return values


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` bins; the key depends on the band's number as well."""
    grouped = values.reshape(len(values), -1, rows)
    key = np.broadcast_to(np.arange(1, grouped.shape[1] + 1, dtype=np.uint64) * GOLDEN, grouped.shape[:2]).copy()
    for i in range(rows):
        key = mix(key * _POSITION[0] + grouped[:, :, i])
    return key


# What names a row's text without carrying it: two hashes beside the id, which rows may repeat or lack.
IDENTITY = ("doc_id", "h1", "h2")


def identified(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, h1, h2 and ``more`` of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), *more)


def _same(a: str, b: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in IDENTITY])


def features(docs: DataFrame, width: int, bins: int, rows: int) -> DataFrame:
    """doc_id, h1, h2, n_shingles, set_key (16 bytes that name the set; null when empty), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 1 << 20):
            sets = [shingle_set(t, width) for t in utf8(batch.column(3))]
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(one_permutation(full, bins), rows).astype(np.int64, copy=False)) if full else iter(())
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                [*IDENTITY, "n_shingles", "set_key", "bands"])

    return identified(docs, F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, h1 long, h2 long, n_shingles long, set_key binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """id, items (the sorted set as bytes), repeated: the sets of the rows named in ``wanted`` (id, doc_id, h1, h2, repeated)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 1 << 20):
            sets = [shingle_set(t, width).tobytes() for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), batch.column(2)], ["id", "items", "repeated"])

    rows = identified(docs, F.col("text").cast("string").alias("text"))
    texts = rows.alias("d").join(wanted.alias("w"), _same("d", "w")).select("w.id", "d.text", "w.repeated")
    return texts.mapInArrow(run, "id long, items binary, repeated boolean")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                    keep.append(False)
                    continue
                common = len(p) + len(q) - len(np.union1d(p, q))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def _prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different roots that may have the wanted similarity, from ``sets`` (id, root, items); exact.

    A shared item at places i and j leaves at most min(n_a - i, n_b - j) common items from there on; similar sets need
    percent / (100 + percent) of n_a + n_b, and their first shared item has that much left. A set takes two sides: as the
    larger of a pair it shows its n - ceil(percent * n / 100) + 1 rarest items, as the smaller one only those that leave an
    overlap with a set of its own size or more, about half as many; both are cut before sets meet, so sets of one family that are
    no near copies, whose first common item comes late, do not meet at all. Items of one set only cannot meet, but hold their places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            for i, root, items in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(items, np.int64)
                n = len(own)
                yield pa.RecordBatch.from_arrays([
                    pa.array(own), pa.array(np.full(n, i, np.int64)), pa.array(np.full(n, root, np.int64)),
                    pa.array(np.full(n, xxhash.xxh3_64_intdigest(items) >> 1, np.int64)), pa.array(np.full(n, n, np.int64))],
                    ["item", "id", "root", "set", "n"])

    items = sets.select("id", "root", "items").mapInArrow(run, "item long, id long, root long, set long, n long")
    counted = items.groupBy("item").agg(F.count("*").alias("times")).filter("times > 1")
    shown = items.join(counted, "item").groupBy("id", "root", "set", "n").agg(F.collect_set(F.struct("times", "item")).alias("common"))
    place = F.col("at") + F.col("n") - F.size("common")
    shown = shown.select("id", "root", "n", "common", F.posexplode(F.array_sort("common")).alias("at", "entry")).select(
        "id", "root", "n", F.col("entry.item").alias("item"), place.alias("place"))
    # What is left from a place on has to hold the whole overlap, at its least for the side that the row takes.
    p = shown.filter(f"(n - place) * {100 + percent} >= 2 * {percent} * n").alias("p")
    q = shown.filter(f"place <= n - (({percent} * n + 99) div 100)").alias("q")
    enough = f"least(p.n - p.place, q.n - q.place) * {100 + percent} >= {percent} * (p.n + q.n)"
    ordered = f"(p.n < q.n OR p.n = q.n AND p.id < q.id) AND 100 * p.n >= {percent} * q.n"
    met = p.join(q, F.expr(f"p.item = q.item AND p.root <> q.root AND {ordered} AND {enough}"))
    return met.select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable over ``links`` (a, b), for every id that has a link.

    Alternates large-star and small-star steps, each a grouped minimum and a join, until the links no longer change.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        kept = edges.join(low, "u")
        edges = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).union(kept.select("u", F.col("m").alias("v"))) \
            .filter("u <> v").distinct()
        edges = written(edges, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("id"), "root").distinct())


def grouped_rows(docs: DataFrame, width: int = 5, percent: int = 80, bins: int = 128, rows: int = 4) -> DataFrame:
    """doc_id, h1, h2, n_shingles, grp (a number for each group; null for empty sets), component_id (its smallest doc_id) of every row.

    Sets are named by what they hold, not by an id, so rows that repeat an id with different texts do not join their groups.
    """
    if bins & (bins - 1) or bins % rows:
        raise ValueError("bins must be a power of two and a multiple of rows")
    found = written(features(docs, width, bins, rows), "features")
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), *IDENTITY)
    groups = found.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("doc_id").alias("label"), F.min(row).alias("row"), F.first("bands").alias("bands"))
    # The written number stands for the set from here on. Numbers follow the ids, so the centre of a bucket is its first document: where
    # later ones were made from it, they are nearer to it than to each other.
    by_label = F.asc_nulls_last("label")
    groups = groups.repartitionByRange(by_label).sortWithinPartitions(by_label)
    groups = written(groups.withColumn("rep", F.monotonically_increasing_id()), "sets")
    in_band = groups.select("rep", F.explode("bands").alias("bucket"))
    shared = in_band.groupBy("bucket").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).filter("centre < last")
    members = written(in_band.join(shared.select("bucket", "centre"), "bucket"), "buckets")
    again = found.groupBy(*IDENTITY).agg(F.count("*").alias("times")).filter("times > 1")
    shown = groups.join(members.select("rep").distinct(), "rep").select(F.col("rep").alias("id"), *[F.col(f"row.{c}").alias(c) for c in IDENTITY])
    wanted = shown.alias("s").join(again.alias("r"), _same("s", "r"), "left").select("s.*", F.col("r.times").isNotNull().alias("repeated"))
    stored = written(_sets(docs, wanted, width), "sets")
    # Rows that repeat an id and its text count once.
    sets = stored.filter("NOT repeated").union(stored.filter("repeated").distinct()).select("id", "items")
    star = members.filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    links = written(_confirmed(star, sets, percent), "confirmed")
    roots = written(components(links).withColumnRenamed("id", "rep"), "roots")
    rooted = members.join(roots, "rep", "left").select("bucket", "rep", F.coalesce("root", "rep").alias("root"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    rest = rooted.join(mixed.select("bucket"), "bucket", "left_semi").select(F.col("rep").alias("id"), "root").distinct()
    more = written(_confirmed(written(_prefix_pairs(sets.join(rest, "id"), percent), "pairs"), sets, percent), "confirmed")
    roots = written(components(links.union(more)).withColumnRenamed("id", "rep"), "roots")
    labels = groups.select("rep", "label").join(roots, "rep").groupBy("root").agg(F.min("label").alias("component"))
    linked = roots.join(labels, "root")
    placed = groups.select("rep", "set_key", "label").join(linked, "rep", "left").select(
        "set_key", F.coalesce("root", "rep").alias("grp"), F.when(F.col("root").isNull(), F.col("label")).otherwise(F.col("component")).alias("component_id"))
    return found.select(*IDENTITY, "n_shingles", "set_key").join(placed, "set_key", "left").select(*IDENTITY, "n_shingles", "grp", "component_id")


def near_duplicate_groups(docs: DataFrame, width: int = 5, percent: int = 80, bins: int = 128, rows: int = 4) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id of its group), kept.

    A null or blank text has an empty set and is linked with nothing. Rows that repeat a doc_id are taken one by one: each has
    the component of its own text. A row without doc_id belongs to the group of its text; it is kept, with a null component_id, where no
    row of the group has an id. An empty table gives no row.
    """
    found = grouped_rows(docs, width, percent, bins, rows)
    component = F.when(F.col("grp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_row_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80, bins: int = 128, rows: int = 4) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no other row of their group precedes.

    The row of the smallest doc_id stays, rows without one come last; texts that share the id are taken by a hash, and rows equal in id and
    text are one. Rows with empty sets all stay. Rows are judged one by one: another row with their id decides nothing.
    """
    grouped = written(grouped_rows(docs, width, percent, bins, rows).filter("grp IS NOT NULL").select(*IDENTITY, "grp"), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), *IDENTITY)
    first = grouped.groupBy("grp").agg(F.min(place).alias("first"), F.count("*").alias("size")).filter("size > 1").select("grp", "first")
    marked = grouped.join(first, "grp").groupBy(*IDENTITY).agg(
        F.max(place.eqNullSafe(F.col("first"))).alias("stays"), F.count("*").alias("times")).filter("NOT stays OR times > 1")
    marked = written(marked, "marked")
    judged = identified(docs, F.struct("*").alias("row")).alias("d").join(marked.alias("m"), _same("d", "m"), "left")
    others = judged.filter("m.stays IS NULL").select("d.row.*")
    once = judged.filter("m.stays").groupBy(*[F.col(f"d.{c}") for c in IDENTITY]).agg(F.first("d.row").alias("row")).select("row.*")
    return others.union(once)
