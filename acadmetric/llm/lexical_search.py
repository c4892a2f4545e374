"""Ranked lexical search: summed accumulators of short lists, then document at a time over long ones.

The documents are indexed in blocks where they lie: a block holds, for the terms that queries use, the places and numbers
of their occurrences. The index is written once; the counts a weight needs are sums over the blocks. Every task then searches its
blocks for every query and keeps the best documents of each; only those are shuffled.

Inside a block the lists of rare terms are added up into accumulators. These become one list among the others, in the order of documents,
bounded by its largest sum. Lists whose bounds together cannot lift a document among the best so far are not walked:
documents come from the other lists only, and the long lists are entered by binary search at those documents, the
heaviest first, for as long as what is left can still lift one of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acadmetric.llm.common import doc_batches, id_and_text, utf8
from acadmetric.llm.tokens import LETTERS, Words
from acadmetric.session import written

_SURE = 200  # bytes up to which equal hashes and lengths mean equal terms; longer ones are compared
_UNNAMED = np.iinfo(np.int64).max
_SALTS = 32
_INDEX = ("docs long, words long, ids array<long>, lengths array<long>, terms array<int>, counts array<int>, "
          "places binary, times binary")


@dataclass
class Queries:
    """Terms of a block of queries, by their hashes, and each query's terms with the number of repeats."""

    names: list
    hash: np.ndarray
    term: list[bytes]
    uses: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(items: list[tuple]) -> Queries:
        texts = ["" if t is None else t for _, t in items]
        split = [t.encode().translate(LETTERS).split(b" ") for t in texts]
        terms = sorted({w for ws in split for w in ws if w})
        hashes = Words.of([b" ".join(terms)], LETTERS).hash if terms else np.empty(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        number = {terms[j]: i for i, j in enumerate(order.tolist())}
        uses = []
        for ws in split:
            found = np.array([number[w] for w in ws if w], np.int64)
            uses.append(np.unique(found, return_counts=True))
        return Queries([i for i, _ in items], hashes[order], [terms[j] for j in order.tolist()], uses)

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) numbers of the words that are a term of some query."""
        if not len(self.hash) or not len(words.hash):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # Different terms may share a hash only beyond _SURE bytes: every term of an equal hash is looked at.
        low = np.searchsorted(self.hash, words.hash)
        word = np.flatnonzero(self.hash[np.minimum(low, len(self.hash) - 1)] == words.hash)
        term = low[word]
        size = np.array([len(t) for t in self.term], np.int64)
        long = np.flatnonzero(size[term] > _SURE)
        for k in long.tolist():
            own = words.text[words.start[word[k]]:words.end[word[k]]].tobytes()
            at = term[k]
            while at < len(self.term) and self.hash[at] == words.hash[word[k]] and self.term[at] != own:
                at += 1
            term[k] = at if at < len(self.term) and self.term[at] == own else -1
        fits = (term >= 0) & (size[term] == (words.end - words.start)[word])
        return word[fits], term[fits]


def query_blocks(items: DataFrame, block_bytes: int) -> Iterator[Queries]:
    """Queries of about ``block_bytes`` of text at a time; the driver holds one block."""
    held, size = [], 0
    for name, text in items.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        held.append((name, text))
        size += len(text or "") + 64
        if size >= block_bytes:
            yield Queries.of(held)
            held, size = [], 0
    if held:
        yield Queries.of(held)


def _one(values: pa.Array) -> pa.Array:
    """A column of one row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def index(docs: DataFrame, queries: Queries, block_docs: int) -> DataFrame:
    """One row per block of documents: how many have a term, how many words, ids, lengths, and the lists of the queries' terms."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, ids, lengths, keys, times = shared.value, [], [], [], []
        held = 0

        def block() -> pa.RecordBatch:
            n, key, time = np.concatenate(lengths), np.concatenate(keys), np.concatenate(times)
            order = np.argsort(key, kind="stable")
            key, time = key[order], time[order]
            terms, counts = np.unique(key >> 32, return_counts=True)
            return pa.RecordBatch.from_arrays([
                pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]), _one(pa.concat_arrays(ids)), _one(pa.array(n)),
                _one(pa.array(terms.astype(np.int32))), _one(pa.array(counts.astype(np.int32))),
                pa.array([(key & 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary()), pa.array([time.astype("<u4").tobytes()], pa.binary())],
                [f.split()[0] for f in _INDEX.split(", ")])

        for batch in doc_batches(batches, 2 << 20):
            words = Words.of(utf8(batch.column(1)), LETTERS)
            word, term = wanted.matches(words)
            key, time = np.unique((term << 32) | (words.doc[word] + held), return_counts=True)
            ids.append(batch.column(0))
            lengths.append(np.bincount(words.doc, minlength=batch.num_rows).astype(np.int64))
            keys.append(key)
            times.append(time)
            held += batch.num_rows
            if held >= block_docs:
                yield block()
                ids, lengths, keys, times, held = [], [], [], [], 0
        if held:
            yield block()

    return id_and_text(docs).mapInArrow(run, _INDEX)


@dataclass
class Postings:
    """A list in the order of documents: what its term adds to each, before the factor, and the most it adds with it.

    The factor is applied where a list is read, so that skipped parts are not touched.
    """

    place: np.ndarray
    share: np.ndarray
    factor: int
    most: int


class Best:
    """The best documents so far: highest score first, equal scores by id, those without id last."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.score, self.id, self.unnamed = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A document with a lower score is none of the best."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        score, ids = np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        unnamed = np.concatenate((self.unnamed, unnamed))
        order = np.lexsort((ids, unnamed, -score))[:self.top]
        self.score, self.id, self.unnamed = score[order], ids[order], unnamed[order]


def _summed(place: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different places in order, and the sum of the shares of each."""
    order = np.argsort(place, kind="stable")
    place, share = place[order], share[order]
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    return place[first], np.add.reduceat(share, first)


class Block:
    """A block of the index, with what each occurrence is worth before its term's weight."""

    def __init__(self, row: dict, documents: int, words: int) -> None:
        ids = row["ids"]
        self.unnamed = np.array([i is None for i in ids], bool)
        self.ids = np.array([_UNNAMED if i is None else i for i in ids], np.int64)
        m = 75 + (25 * np.array(row["lengths"], np.int64) * documents) // max(words, 1)
        place = np.frombuffer(row["places"], "<u4").astype(np.int64)
        times = np.frombuffer(row["times"], "<u4").astype(np.int64)
        worth = (1_000_000_000 * times) // (1000 * times + 12 * m[place])
        ends = np.cumsum(row["counts"], dtype=np.int64)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        for term, a, b in zip(row["terms"], np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
            self.lists[term] = (place[a:b], worth[a:b], int(worth[a:b].max()))

    def search(self, terms: np.ndarray, factors: np.ndarray, best: Best, short: float, window: int = 512) -> None:
        """Add the block's documents to ``best``; lists of at most ``short`` of the block's documents are added up first."""
        found = [(*self.lists[t], f) for t, f in zip(terms.tolist(), factors.tolist(), strict=True) if t in self.lists and f > 0]
        if not found:
            return
        found.sort(key=lambda x: len(x[0]))
        rare = max(1, sum(len(x[0]) <= short * len(self.ids) for x in found))
        place, share = _summed(np.concatenate([p for p, _, _, _ in found[:rare]]), np.concatenate([s * f for _, s, _, f in found[:rare]]))
        lists = [Postings(place, share, 1, int(share.max()))] + [Postings(p, s, f, m * f) for p, s, m, f in found[rare:]]
        lists.sort(key=lambda x: -x.most)
        below = np.concatenate((np.cumsum([x.most for x in lists][::-1])[::-1], [0])).tolist()  # the most that lists from here on add
        begin = 0
        while begin < len(self.ids):
            end = begin + window
            # The walked lists are those before the first from which on all together stay under the least score.
            walked = next(i for i in range(len(lists) + 1) if below[i] < best.least)
            if not walked:
                return
            parts = []
            for x in lists[:walked]:
                a, b = np.searchsorted(x.place, (begin, end))
                if a < b:
                    parts.append((x.place[a:b], x.share[a:b] * x.factor))
            if parts:
                place, score = parts[0] if len(parts) == 1 else _summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))
                for i in range(walked, len(lists)):
                    can = score + below[i] >= best.least
                    place, score = place[can], score[can]
                    if not len(place):
                        break
                    x = lists[i]
                    at = np.minimum(np.searchsorted(x.place, place), len(x.place) - 1)
                    score = score + np.where(x.place[at] == place, x.share[at] * x.factor, 0)
                can = score >= best.least
                if can.any():
                    best.add(score[can], self.ids[place[can]], self.unnamed[place[can]])
            begin, window = end, window * 2


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def ranked(docs: DataFrame, items: DataFrame, top: int = 20, block_docs: int = 1 << 15, short: float = 1 / 32,
           block_bytes: int = 1 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each row of ``items`` (item_id, text) with a score above 0.

    Null and empty texts have no terms: such items have no result, such documents are none and do not count. Rows that
    repeat an item_id or a doc_id are each taken by themselves; documents without doc_id come after others of equal score.
    Empty tables give no row. Items come in blocks of ``block_bytes`` of text, with one index for each.
    """
    spark, out = docs.sparkSession, None
    for queries in query_blocks(items, block_bytes):
        blocks = written(index(docs, queries, block_docs), "index")
        documents, words = blocks.agg(F.sum("docs"), F.sum("words")).first()
        held = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy(F.col("x.terms").alias("t")).agg(
            F.sum("x.counts").alias("n")).collect()  # at most one row per term of the block of queries
        weights = np.zeros(len(queries.term), np.int64)
        for t, n in held:
            weights[t] = weight(documents, n)
        plan = spark.sparkContext.broadcast([(t, weights[t] * k) for t, k in queries.uses])

        def run(batches: Iterator[pa.RecordBatch], plan=plan, documents=documents, words=words) -> Iterator[pa.RecordBatch]:
            best = [Best(top) for _ in plan.value]
            for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
                block = Block(row, documents, words)
                for (terms, factors), own in zip(plan.value, best, strict=True):
                    block.search(terms, factors, own, short)
            for q, own in enumerate(best):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own.id), q)), pa.array(own.id, mask=own.unnamed), pa.array(own.score)],
                                                 ["query", "doc_id", "score"])

        best = blocks.mapInArrow(run, "query long, doc_id long, score long")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for key in (["query", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS))], ["query"]):  # few rows of many tasks meet in one place
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("rank") <= top)
        kind = items.schema["item_id"].dataType.simpleString()
        names = spark.createDataFrame(list(enumerate(queries.names)), f"query long, item_id {kind}")
        # One row per query of the block.
        result = best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")
        out = result if out is None else out.unionByName(result)
    if out is None:
        return items.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out
