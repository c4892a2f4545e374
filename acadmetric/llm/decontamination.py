"""Benchmark decontamination with suffix arrays over the training texts.

Documents are cut into shards of a bounded number of words; a shard never splits a document. In each shard the suffixes
that begin with a word of the benchmark are sorted once, to the depth of the longest item, by packed words and prefix
doubling. Every suffix of every item is then found by binary search: the range that shares its window gives all places
where the window occurs, the neighbours of its own place give its longest verbatim match. Words outside the
benchmark's vocabulary end a suffix, since no match can contain them.

Shards are made where the documents are read: nothing is shuffled. The benchmark goes to the tasks in blocks of bounded
size, one pass over the rows for each block, so that a benchmark of any size works.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.llm.common import doc_batches, id_and_text, utf8

# Word bytes: digits, letters a-z after lower-casing, and every byte of a character beyond ASCII.
_FOLD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Windows:
    """The distinct windows of one length: where one of each begins in the items, and the items that hold it."""

    start: np.ndarray
    owner_at: np.ndarray  # where each window's owners begin in ``owner``, and one beyond
    owner: np.ndarray  # numbers of items

    @staticmethod
    def of(ids: np.ndarray, start: np.ndarray, item: np.ndarray, length: int, bits: int, per: int) -> Windows:
        """From every window's begin and item; windows are sorted by their packed words."""
        values = [value for value, _, _ in _packed_windows(ids, start, length, bits, per)]
        order = np.lexsort((item, *values[::-1]))
        start, item = start[order], item[order]
        fresh = np.ones(len(start), bool)
        fresh[1:] = np.any([v[order][1:] != v[order][:-1] for v in values], axis=0)
        number = np.cumsum(fresh) - 1
        once = fresh.copy()
        once[1:] |= item[1:] != item[:-1]
        return Windows(start[fresh], np.searchsorted(number[once], np.arange(number[-1] + 2)), item[once])


@dataclass
class Tests:
    """One block of the benchmark: its words as numbers, its distinct windows by length, who owns each window."""

    vocabulary: dict[bytes, int]
    bits: int
    windows: dict[int, Windows]
    suffix_ids: np.ndarray  # items one after the other, each followed by 0
    suffix_item: list[str | None]
    suffix_start: np.ndarray
    depth: int

    @staticmethod
    def of(items: list[tuple[str | None, bytes]], window: int) -> Tests:
        vocabulary: dict[bytes, int] = {}
        parts, names = [], []
        for name, text in items:
            words = words_of(text)
            if words:
                names.append(name)
                parts.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 1) for w in words), np.int32, len(words)))
        sizes = np.array(list(map(len, parts)), np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        flat = np.zeros(int((sizes + 1).sum()), np.uint64)
        for at, p in zip(starts.tolist(), parts, strict=True):
            flat[at:at + len(p)] = p
        bits = max(1, len(vocabulary).bit_length())
        windows = {}
        for length in np.unique(np.minimum(sizes, window)).tolist():
            own = np.flatnonzero(np.minimum(sizes, window) == length)
            many = sizes[own] - length + 1
            item = np.repeat(own, many).astype(np.int32)
            begin = np.repeat(starts[own] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            windows[length] = Windows.of(flat, begin, item, length, bits, 64 // bits)
        return Tests(vocabulary, bits, windows, flat, names, starts, int(sizes.max(initial=1)))

    @property
    def per_key(self) -> int:
        return 64 // self.bits


def packed(ids: np.ndarray, bits: int, per: int) -> np.ndarray:
    """For each position the next ``per`` words in one number, first word highest; nothing counts after a 0."""
    key, alive = np.zeros(len(ids), np.uint64), np.ones(len(ids), bool)
    for j in range(per):
        ahead = np.zeros(len(ids), np.uint64)
        ahead[:max(0, len(ids) - j)] = ids[j:]
        alive &= ahead > 0
        key = (key << np.uint64(bits)) | np.where(alive, ahead, np.uint64(0))
    return key


def suffix_array(ids: np.ndarray, key: np.ndarray, per: int, depth: int) -> np.ndarray:
    """Positions of non-zero words, sorted by their first ``depth`` words; 0 ends a suffix and sorts first."""
    at = np.flatnonzero(ids)
    at = at[np.argsort(key[at], kind="stable")]
    fresh = np.ones(len(at), bool)
    fresh[1:] = key[at[1:]] != key[at[:-1]]
    covered = per
    rank = np.zeros(len(ids) + 1, np.int64)
    rank[at] = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0)) + 1
    while covered < depth:
        tied = np.zeros(len(at), bool)
        tied[1:] = ~fresh[1:]
        tied[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        p = at[slots]
        pair = rank[p] * np.int64(len(ids) + 2) + rank[np.minimum(p + covered, len(ids))]
        order = np.argsort(pair, kind="stable")
        p, pair = p[order], pair[order]
        at[slots] = p
        fresh[slots[1:]] = pair[1:] != pair[:-1]
        fresh[slots[0]] = True
        rank[at] = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0)) + 1
        covered *= 2
    return at


def _bound(at: np.ndarray, key: np.ndarray, wanted: list[tuple[np.ndarray, int, int]], right: bool) -> np.ndarray:
    """First place in ``at`` whose suffix is not below (or, ``right``, is above) each wanted word sequence."""
    n = len(wanted[0][0])
    low, high = np.zeros(n, np.int64), np.full(n, len(at), np.int64)
    while (low < high).any():
        middle = (low + high) >> 1
        p = at[np.minimum(middle, len(at) - 1)]
        below, same = np.zeros(n, bool), np.ones(n, bool)
        for value, offset, shift in wanted:
            own = key[p + offset] >> np.uint64(shift)
            below |= same & (own < value)
            same &= own == value
        goes = (below | same if right else below) & (low < high)
        low = np.where(goes, middle + 1, low)
        high = np.where(goes, high, np.minimum(high, middle))
    return low


def _packed_windows(ids: np.ndarray, start: np.ndarray, length: int, bits: int, per: int) -> list[tuple[np.ndarray, int, int]]:
    """The words of the windows of ``ids`` that begin at ``start``: (packed words, offset, bits left free) of every ``per`` words."""
    wanted = []
    for offset in range(0, length, per):
        words = min(per, length - offset)
        value = np.zeros(len(start), np.uint64)
        for j in range(words):
            value = (value << np.uint64(bits)) | ids[start + offset + j]
        wanted.append((value, offset, (per - words) * bits))
    return wanted


def occurrences(at: np.ndarray, key: np.ndarray, wanted: list[tuple[np.ndarray, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of ``at`` whose suffixes begin with each of the packed windows."""
    return _bound(at, key, wanted, False), _bound(at, key, wanted, True)


@dataclass
class Shard:
    ids: np.ndarray
    starts: np.ndarray  # of each document, and one beyond the last
    key: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(docs: list[np.ndarray], tests: Tests) -> Shard:
        stop = np.zeros(1, np.uint64)
        ids = np.concatenate([x for d in docs for x in (d, stop)]) if docs else stop
        starts = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs]))).astype(np.int64)
        key = packed(ids, tests.bits, tests.per_key)
        at = suffix_array(ids, key, tests.per_key, tests.depth)
        return Shard(ids, starts, np.concatenate((key, np.zeros(tests.depth + 64, np.uint64))), at)

    def hits(self, tests: Tests) -> tuple[np.ndarray, list[set[str]]]:
        """Which words a window covers, and the items found in each document."""
        edge = np.zeros(len(self.ids) + 1, np.int64)
        found: list[set[str]] = [set() for _ in range(len(self.starts) - 1)]
        for length, own in tests.windows.items() if len(self.at) else ():
            low, high = occurrences(self.at, self.key, _packed_windows(tests.suffix_ids, own.start, length, tests.bits, tests.per_key))
            many = high - low
            which = np.repeat(np.arange(len(own.start)), many)
            slots = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            p = self.at[slots]
            np.add.at(edge, p, 1)
            np.add.at(edge, p + length, -1)
            doc = np.searchsorted(self.starts, p, "right") - 1
            pairs = np.unique(doc * np.int64(len(own.start)) + which)
            for d, w in zip((pairs // len(own.start)).tolist(), (pairs % len(own.start)).tolist(), strict=True):
                names = (tests.suffix_item[i] for i in own.owner[own.owner_at[w]:own.owner_at[w + 1]])
                found[d].update(n for n in names if n is not None)
        return np.cumsum(edge)[:-1] > 0, found

    def longest(self, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
        """For every suffix of the items (every place in ``suffix_ids``): words matched at most, and where."""
        n = len(tests.suffix_ids)
        if not len(self.at) or not n:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        own = np.concatenate((packed(tests.suffix_ids, tests.bits, tests.per_key), np.zeros(tests.depth + 64, np.uint64)))
        alive, wanted = np.ones(n, bool), []
        for offset in range(0, tests.depth, tests.per_key):
            value = np.where(alive, own[offset:offset + n], np.uint64(0))
            alive &= (value & np.uint64((1 << tests.bits) - 1)) > 0
            wanted.append((value, offset, 0))
        place = _bound(self.at, self.key, wanted, False)
        best, where = np.zeros(n, np.int64), np.zeros(n, np.int64)
        words = np.concatenate((self.ids, np.zeros(tests.depth + 1, np.uint64)))
        theirs = np.concatenate((tests.suffix_ids, np.zeros(tests.depth + 1, np.uint64)))
        for neighbour in (place - 1, place):
            p = self.at[np.clip(neighbour, 0, len(self.at) - 1)]
            same, length = np.ones(n, bool), np.zeros(n, np.int64)
            for j in range(tests.depth):
                same &= (words[p + j] == theirs[j:j + n]) & (theirs[j:j + n] > 0)
                if not same.any():
                    break
                length += same
            where = np.where(length > best, p, where)
            best = np.maximum(best, length)
        return best, where


def _number(text: bytes, tests: Tests) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(tests.vocabulary.get, words, repeat(0)), np.uint64, len(words))


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[tuple[Tests, bool]]:
    """The blocks, each with a mark at the last."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = total // block_bytes + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for b in range(count):
        items = [(r[0], (r[1] or "").encode()) for r in rows.filter(block == b).collect()]
        yield Tests.of(items, window), b == count - 1


def _shards(batches: Iterator[pa.RecordBatch], tests: Tests, shard_words: int) -> Iterator[tuple[pa.RecordBatch, list, Shard]]:
    """Batches of rows with their words as numbers and their suffix array; about ``shard_words`` words each."""
    held, docs, total = [], [], 0
    for batch in doc_batches(batches, 4 << 20):
        numbers = [_number(t, tests) for t in utf8(batch.column(batch.schema.get_field_index("text")))]
        held.append(batch)
        docs += numbers
        total += sum(map(len, numbers))
        if total >= shard_words:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0], docs, Shard.of(docs, tests)
            held, docs, total = [], [], 0
    if docs:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0], docs, Shard.of(docs, tests)


_FOUND = "doc_id long, n_words long, spans array<long>, items array<string>"


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 1 << 20,
                           block_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, items, spans, contaminated.

    A window is ``window`` consecutive words of an item; a shorter item with any word is one window. ``spans`` holds the
    word positions of the merged hits as start, end, start, end ...; ``items`` the ids found, sorted as strings. Null and
    empty texts have no word. Items without words match nothing; items without item_id mark words but are not listed;
    rows that repeat an item_id are one item. Repeated documents are judged row by row; empty tables give no row or no
    hit.
    """
    rows = id_and_text(docs).select("doc_id", "text", F.lit(0).cast("long").alias("n_words"),
                                    F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items"))
    context = docs.sparkSession.sparkContext
    for tests, last in _blocks(benchmark, window, block_bytes):
        rows = rows.mapInArrow(_pass(context.broadcast(tests), shard_words, last), _FOUND if last else f"{_FOUND}, text string")
        rows = rows if last else rows.select("doc_id", "text", "n_words", "spans", "items")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: x - s)  # e - s of the last span, less the others, ...
    listed = F.array_sort(F.array_distinct("items"))
    return rows.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"), listed.alias("items"), "spans",
        (F.size("spans") > 0).alias("contaminated"))


def _pass(shared, shard_words: int, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        for batch, docs, shard in _shards(batches, tests, shard_words):
            mark, found = shard.hits(tests)
            spans, items = [], []
            before = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            for d, (old, named) in enumerate(before):
                own = mark[shard.starts[d]:shard.starts[d] + len(docs[d])]
                if old:
                    own = own.copy()
                    for a, b in zip(old[::2], old[1::2], strict=True):
                        own[a:b] = True
                spans.append(np.flatnonzero(np.diff(np.concatenate(([0], own.view(np.int8), [0])))))
                items.append([*named, *sorted(found[d])])
            columns = [batch.column(0), pa.array(list(map(len, docs)), pa.int64()),
                       pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
            names = ["doc_id", "n_words", "spans", "items"]
            yield pa.RecordBatch.from_arrays(columns if last else [*columns, batch.column(1)], names if last else [*names, "text"])

    return run


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 1 << 20,
                        block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, with all their columns, judged where they lie.

    Windows and odd rows as for :func:`contaminated_documents`; each row goes by its own text, whatever its id.
    """
    context = docs.sparkSession.sparkContext
    for tests, _ in _blocks(benchmark, window, block_bytes):
        shared = context.broadcast(tests)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch, _, shard in _shards(batches, shared.value, shard_words):
                before = np.concatenate(([0], np.cumsum(shard.hits(shared.value)[0])))
                clean = before[shard.starts[1:]] == before[shard.starts[:-1]]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def longest_matches(docs: DataFrame, benchmark: DataFrame, shard_words: int = 1 << 20, block_bytes: int = 8 << 20) -> DataFrame:
    """item_id, item_word, length, doc_id, doc_word: the longest verbatim match of each item and one place where it is.

    Every suffix of every item is searched in every shard; a shard hands over its best match of each item only, so the
    shuffle has at most shards times items rows. Ties go to the smallest doc_id and positions. Items that match nothing
    are left out.
    """
    context, out = docs.sparkSession.sparkContext, None
    for tests, _ in _blocks(benchmark, 1, block_bytes):
        shared = context.broadcast(tests)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tests = shared.value
            for batch, _, shard in _shards(batches, tests, shard_words):
                best, where = shard.longest(tests)
                ends = np.append(tests.suffix_start[1:], len(best))
                got = [(name, int(a + best[a:b].argmax()), int(a))
                       for name, a, b in zip(tests.suffix_item, tests.suffix_start, ends, strict=True)]
                got = [(name, j - a, int(best[j]), int(where[j])) for name, j, a in got if best[j]]
                doc = [int(np.searchsorted(shard.starts, p, "right")) - 1 for *_, p in got]
                names = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()),
                    pa.array([g[2] for g in got], pa.int64()), pa.array([names[d] for d in doc], pa.int64()),
                    pa.array([int(g[3] - shard.starts[d]) for g, d in zip(got, doc, strict=True)], pa.int64())],
                    ["item_id", "item_word", "length", "doc_id", "doc_word"])

        found = id_and_text(docs).mapInArrow(run, "item_id string, item_word long, length long, doc_id long, doc_word long")
        out = found if out is None else out.union(found)
    place = F.struct((-F.col("length")).alias("shorter"), "doc_id", "item_word", "doc_word")
    return out.groupBy("item_id").agg(F.min(place).alias("m")).select(
        "item_id", "m.item_word", (-F.col("m.shorter")).alias("length"), "m.doc_id", "m.doc_word")


def items_digest(items: list[str]) -> str:
    """The digest of a list of item ids, for checks outside Spark."""
    return hashlib.sha256(",".join(sorted(set(items))).encode()).hexdigest()
