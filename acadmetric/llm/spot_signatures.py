"""Document fingerprints by spot signatures.

Every occurrence of an anchor starts a chain of the content words that follow it; anchor and chain are hashed to one signature.
Anchors are the common words and, so that lists, tables and junk have signatures by the same rule, the other words of one
class of hashes; whether a word is one does not depend on the rest of the text, so an edit changes only the signatures beside
it. A document's fingerprint is its sorted set of signatures, written as eight hex digits each; running prose has about
twice as many of them a word as chrome and word salad. Likeness is the Jaccard similarity of two sets. Sets can only be alike if their
lengths are: links are sought among neighbouring classes of set length only, by the signatures that come first from rare to
common, and the comparison of two sets is pruned by their lengths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acadmetric.llm.common import doc_batches, id_and_text, mix, utf8
from acadmetric.llm.near_dedup import components
from acadmetric.llm.tokens import LETTERS, Words
from acadmetric.session import written

# The anchors, frequent function words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from has have he in is it its of on or not she that the their they this to was were "
    "which will with you "
    "als am auch auf aus bei das dem den der des die ein eine er es für hat ich im in ist mit nach nicht noch oder sich sie "
    "sind so um und von war wie zu zum zur "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour qu que qui "
    "sa se ses son sur un une vous "
    "al como con del e el ella es esta este ha la las lo los más me mi muy no o para pero por que se si sin sobre su sus un "
    "una y ya"
)
_ANCHORS = np.unique(Words.of([ANCHORS.encode()], LETTERS).hash)
_CLASSES = 4  # one in so many of the other words is an anchor as well
# First and last characters of scripts written without blanks (Thai and Lao, Myanmar, Khmer, kana, Han), and the bytes that
# such characters begin with.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
_LEAD = re.compile(b"[\xe0\xe1\xe3-\xe9\xef\xf0]")
_STEP = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


def _pairs(run: re.Match) -> str:
    own = run.group()
    return f" {' '.join(own[i:i + 2] for i in range(max(1, len(own) - 1)))} "


def spaced(text: bytes) -> bytes:
    """The text with every run of characters of a script without blanks cut into overlapping pairs, which serve as words."""
    return _UNSPACED.sub(_pairs, text.decode()).encode() if _LEAD.search(text) else text


def signatures(texts: list[bytes], chain: int = 2, distance: int = 1) -> list[np.ndarray]:
    """The sorted set of 32-bit signatures of each text.

    Words are runs of letters and digits; in scripts without blanks, neighbouring characters two by two.
    A text without any complete chain but with words has one signature, of its whole word sequence; a text without words has none.
    """
    w = Words.of(list(map(spaced, texts)), LETTERS)
    n = len(w.hash)
    if not n:
        return [np.empty(0, np.uint32) for _ in texts]
    stop = _ANCHORS[np.minimum(np.searchsorted(_ANCHORS, w.hash), len(_ANCHORS) - 1)] == w.hash
    # Lists and word salad have next to no common words. A word that is an anchor by its hash stays a content word.
    content, anchor = np.flatnonzero(~stop), np.flatnonzero(stop | (w.hash % np.uint64(_CLASSES) == 0))
    first = np.searchsorted(content, anchor, "right")
    whole = first + (chain - 1) * distance < len(content)
    anchor, first = anchor[whole], first[whole]
    whole = w.doc[content[first + (chain - 1) * distance]] == w.doc[anchor]
    anchor, first = anchor[whole], first[whole]
    total = w.hash[anchor].copy()
    for i in range(chain):
        total = mix(total * np.uint64(_STEP[i % 4]) + w.hash[content[first + i * distance]])
    pairs = np.unique((w.doc[anchor].astype(np.uint64) << np.uint64(32)) | (total >> np.uint64(32)))
    cuts = np.searchsorted(pairs, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    sets = [(pairs[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32) for a, b in zip(cuts, cuts[1:], strict=False)]
    bounds = np.searchsorted(w.doc, np.arange(len(texts) + 1))
    for d in np.flatnonzero((np.diff(cuts) == 0) & (np.diff(bounds) > 0)):
        own = hashlib.blake2b(w.hash[bounds[d]:bounds[d + 1]].tobytes(), digest_size=4).digest()
        sets[d] = np.frombuffer(own, "<u4").astype(np.uint32)
    return sets


def fingerprint(signature_set: np.ndarray) -> str:
    return signature_set.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 without looking at them where their lengths rule ``least`` out.

    Two empty sets are alike (1), an empty and a non-empty one are not (0).
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    at = np.searchsorted(a, b)
    common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    value = common / (len(a) + len(b) - common)
    return value if value >= least else 0.0


def fingerprints(docs: DataFrame, chain: int = 2, distance: int = 1) -> DataFrame:
    """doc_id, fingerprint for every row; null and wordless texts have an empty fingerprint. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in doc_batches(batches, 2 << 20):
            found = [fingerprint(s) for s in signatures(utf8(batch.column(1)), chain, distance)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fingerprint string")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """class, item, id, n, place, smaller: where a set (id, fingerprint) is posted.

    Signatures stand from rare to common; those of one set only are posted nowhere but keep their places. A class holds sets whose
    lengths differ by less than the wanted similarity allows, so alike sets lie in one class or in two neighbouring ones. As
    the larger of a pair a set shows its first n - ceil(percent * n / 100) + 1 signatures, in its own class and the one below; as the
    smaller, in its own, those that leave enough of it for a set of its own size.
    """
    n = (F.length("fingerprint") / 8).cast("long")
    # No length is so near to a class's bound as the small term, which makes up for rounding where one is the bound itself.
    place_of = F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    # One pass over the text: a substring would count its characters from the beginning for every signature.
    parts = F.regexp_extract_all("fingerprint", F.lit(".{8}"), F.lit(0))
    single = sets.select("id", n.alias("n"), place_of.alias("class"), F.explode(parts).alias("item"))
    counted = single.groupBy("item").agg(F.count("*").alias("times")).filter("times > 1")
    common = single.join(counted, "item").groupBy("id", "n", "class").agg(F.array_sort(F.collect_list(F.struct("times", "item"))).alias("common"))
    shown = common.select("id", "n", "class", F.size("common").alias("met"), F.posexplode("common").alias("at", "entry")).select(
        "class", F.col("entry.item").alias("item"), "id", "n", (F.col("at") + F.col("n") - F.col("met")).alias("place"))
    smaller = shown.filter(f"(n - place) * {100 + percent} >= 2 * {percent} * n").withColumn("smaller", F.lit(True))
    larger = shown.filter(f"place <= n - (({percent} * n + 99) div 100)").withColumn("smaller", F.lit(False))
    below = larger.withColumn("class", F.explode(F.array(F.col("class"), F.col("class") - 1)))
    return smaller.union(below.select(smaller.columns))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have the wanted likeness."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("fingerprint").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("fingerprint").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [likeness(*(np.frombuffer(bytes.fromhex(t), ">u4").astype(np.uint32) for t in p), percent / 100) > 0
                    for p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def alike_groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, class_id (the smallest doc_id reachable over links of at least ``percent`` likeness), kept, one row per document.

    Equal fingerprints are one set. Sets that are posted under one signature of one length class are linked with the first of them
    only, and the links confirmed. Where a posting still holds sets of several groups, those of different groups meet again in
    it: of a pair's first common signature there must be enough left on both sides. So pairs of one group are
    not made, and no link between groups is lost. Empty fingerprints are linked with nothing; rows without doc_id belong to the class of
    their text, which is null where no row of it has an id. Rows that repeat an id are taken one by one.
    """
    found = written(fingerprints(docs), "fingerprints")
    groups = found.filter("fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("label"))
    groups = written(groups.withColumn("id", F.monotonically_increasing_id()), "sets")
    posted = written(_prefixes(groups, percent), "posted")
    key = ["class", "item"]
    first = posted.groupBy(*key).agg(F.min("id").alias("a"), F.max("id").alias("last")).filter("a < last").drop("last")
    star = posted.join(first, key).filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    links = written(_confirmed(star, groups, percent), "confirmed")
    rooted = posted.join(components(links), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rooted.groupBy(*key).agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select(*key)
    rest = written(rooted.join(mixed, key, "left_semi"), "mixed")
    p, q = rest.filter("smaller").alias("p"), rest.filter("NOT smaller").alias("q")
    enough = f"least(p.n - p.place, q.n - q.place) * {100 + percent} >= {percent} * (p.n + q.n)"
    ordered = f"(p.n < q.n OR p.n = q.n AND p.id < q.id) AND 100 * p.n >= {percent} * q.n"
    met = p.join(q, F.expr(f"p.class = q.class AND p.item = q.item AND p.root <> q.root AND {ordered} AND {enough}"))
    more = written(_confirmed(met.select(F.col("p.id").alias("a"), F.col("q.id").alias("b")).distinct(), groups, percent), "confirmed")
    linked = groups.join(components(links.union(more)), "id", "left").select("fingerprint", "label", F.coalesce("root", "id").alias("root"))
    labels = linked.groupBy("root").agg(F.min("label").alias("class_id"))
    placed = linked.join(labels, "root").select("fingerprint", "class_id")
    alone = F.when(F.col("fingerprint") == "", F.col("doc_id")).otherwise(F.col("class_id"))
    return found.join(placed, "fingerprint", "left").select("doc_id", alone.alias("class_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


_LOWEST = -(1 << 63)
_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def compared_with_edits(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint against that of an edited text and of the next document.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many (or all) of the next document in
    ascending doc_id; after the last comes the first. Rows without doc_id come first; rows that repeat a doc_id follow in
    the order of their compressed texts, a fixed one though not that of the letters. A single row is its own next one; an empty table gives no row.

    Rows are dealt by ranges of doc_id, texts compressed; the rows that begin a range are sent to the range before as well, so
    that every range finds its last row's successor in place.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.min(key), F.percentile_approx(key, [i / parts for i in range(1, parts)], 10 * parts)).first()
    # Percentiles are values of the column: each cut is the first doc_id of its range.
    lows = np.array(sorted({found[0], *found[1]}) if found[0] is not None else [0], np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in doc_batches(batches, 8 << 20):
            keys = batch.column(0).fill_null(_LOWEST).to_numpy()
            part = np.searchsorted(lows, keys, "right") - 1
            texts = pa.array([packer.compress(t) for t in utf8(batch.column(1))], pa.binary())
            again = np.flatnonzero(lows[part] == keys)
            at = np.concatenate((np.arange(len(keys)), again))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((part, (part[again] - 1) % len(lows))).astype(np.int64)),
                pa.array(np.arange(len(at)) >= len(keys)), batch.column(0).take(pa.array(at)), texts.take(pa.array(at))],
                ["part", "after", "doc_id", "packed"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        last = None  # (part, doc_id, text, signatures) of the row that waits for its successor
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                rows = batch.slice(a, 512).to_pylist()
                texts = [unpacker.decompress(r["packed"]) for r in rows]
                sets = signatures(texts)
                waiting = []
                for r, t, s in zip(rows, texts, sets, strict=True):
                    if last is not None and last[0] == r["part"]:
                        waiting.append((*last[1:], t, s))
                        last = None
                    if not r["after"]:
                        last = (r["part"], r["doc_id"], t, s)
                if waiting:
                    yield judged(waiting)

    def judged(rows: list[tuple]) -> pa.RecordBatch:
        edited, size = [], []
        for _, text, _, following, _ in rows:
            own = text.decode()
            cut = len(own) // 4
            size.append(len(own))
            edited.append((own[:len(own) - cut] + following.decode()[:cut]).encode() if cut else text)
        changed = signatures(edited)
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array(size, pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array([fingerprint(r[2]) for r in rows], pa.string()), pa.array(list(map(fingerprint, changed)), pa.string()),
            pa.array([likeness(r[2], c) for r, c in zip(rows, changed, strict=True)], pa.float64()),
            pa.array([likeness(r[2], r[4]) for r in rows], pa.float64())], [c.split()[0] for c in _EDITED.split(", ")])

    dealt = id_and_text(docs).mapInArrow(deal, "part long, after boolean, doc_id long, packed binary")
    return dealt.repartition("part").sortWithinPartitions("part", "after", "doc_id", "packed").mapInArrow(compare, _EDITED)
