"""Token ids as flat binary files.

Documents are range-partitioned and sorted by doc_id; each task writes the ids of its documents to one file of unsigned
integers (two bytes where the vocabulary allows, else four) and, beside it, the 64-bit offsets where documents start and
end, and their 64-bit doc_ids. Only one row per file goes to the driver: prefix sums of the files' totals give each file
the position of its first id. Files are named by attempt, so a task that runs again or twice leaves at most an unused
file; the returned rows name those that count. Reading maps the files into memory.

White space never survives this tokenizer's splitting, so a text's ids are those of its pieces between ASCII white space, one
after the other; a task remembers the ids of pieces it has met. Letters followed by marks split between the two, and letters
alone are one word to the tokenizer, which ends in an id for a word's end: new words are therefore encoded together, in one
text, and parted at those ids. Every other piece is encoded by itself.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs as filesystems
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from acadmetric.llm.common import doc_batches, id_and_text, utf8

REMEMBERED = 500_000  # pieces a task keeps; it starts over beyond that
_encoders: dict[str, Encoder] = {}
# Letters of ASCII and Latin-1, a fixed set in every Unicode version; ASCII marks without the apostrophe.
_LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_MARKS = b".,;:!?#$%&*|"


class Encoder:
    """A tokenizer that drops white space, with the ids of the pieces it has met."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)], bool)
        self.known: dict[bytes, bytes] = {}

    @staticmethod
    def of(path: str) -> Encoder:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        return _encoders[path]

    def _apart(self, pieces: list[bytes]) -> None:
        for i in range(0, len(pieces), 4096):
            some = pieces[i:i + 4096]
            for piece, e in zip(some, self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False), strict=True):
                self.known[piece] = np.array(e.ids, self.dtype).tobytes()

    def _together(self, words: list[bytes]) -> None:
        """Words of letters only, each one word to the tokenizer."""
        for i in range(0, len(words), 4096):
            some = words[i:i + 4096]
            [e] = self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)
            ids = np.array(e.ids, self.dtype)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):
                self._apart(some)
                continue
            raw, width = ids.tobytes(), self.dtype.itemsize
            begin = 0
            for word, end in zip(some, (ends * width).tolist(), strict=True):
                self.known[word] = raw[begin:end]
                begin = end

    def learn(self, pieces: set[bytes]) -> None:
        """Remember the ids of new pieces."""
        marked, words, others = [], set(), []
        for piece in pieces:
            word = piece.rstrip(_MARKS)
            # The tokenizer lower-cases; ASCII words that differ in case only are encoded once.
            if word.isalpha():
                word = word.lower()
            elif not _LATIN.fullmatch(word):
                others.append(piece)
                continue
            words.add(word)
            if word != piece:
                marked.append((piece, word, piece[len(word):]))
        known = self.known
        others += {m for _, _, m in marked if m and m not in known}
        self._apart(others)
        self._together([w for w in words if w not in known])
        for piece, word, marks in marked:
            known[piece] = known[word] + known[marks] if marks else known[word]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian bytes of ``dtype``."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        pieces, ends = [], [0]
        for t in texts:
            pieces += t.split()
            ends.append(len(pieces))
        ids = list(map(self.known.get, pieces))
        new = [i for i, x in enumerate(ids) if x is None]
        self.learn({pieces[i] for i in new})
        for i in new:
            ids[i] = self.known[pieces[i]]
        return [b"".join(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as Spark's own writers take it: one without a scheme lies in the cluster's default file system."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^s3[an]:", "s3:", full)


def _place(path: str) -> tuple[filesystems.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return filesystems.FileSystem.from_uri(path) if "://" in path else (filesystems.LocalFileSystem(), path)


def _mapped(path: str, dtype: np.dtype) -> np.ndarray:
    store, name = _place(path)
    if not isinstance(store, filesystems.LocalFileSystem):
        return np.frombuffer(store.open_input_file(name).read(), dtype)
    return np.memmap(name, dtype, "r") if os.path.getsize(name) else np.empty(0, dtype)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> list[dict]:
    """Write every text's ids, each followed by ``end_id``; one dict per file, in ascending doc_id order.

    Keys: path, docs, ids, no_id (documents without doc_id; they come first), start (ids in the files before). A null text
    is empty and has the end id alone. Rows that repeat a doc_id follow one another by text. ``folder`` must be one that
    every executor and the driver can reach, in a file system that Arrow knows; another one stops the job before any text is read.
    """
    folder = qualified(docs.sparkSession, folder)
    _place(folder)
    rows = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        store, base = _place(f"{folder}/part-{part:06d}-{uuid.uuid4().hex}")
        store.create_dir(os.path.dirname(base), recursive=True)
        offsets, ids, total, missing = [np.zeros(1, "<u8")], [], 0, 0
        with store.open_output_stream(f"{base}.ids") as out:
            for batch in doc_batches(batches, 4 << 20):
                encoded = [e + end for e in encoder.encode(utf8(batch.column(1)))]
                out.write(b"".join(encoded))
                ends = total + np.cumsum([len(e) // encoder.dtype.itemsize for e in encoded])
                offsets.append(ends.astype("<u8"))
                total = int(ends[-1])
                missing += batch.column(0).null_count
                ids.append(batch.column(0).fill_null(0).to_numpy().astype("<i8"))
        n = sum(map(len, ids))
        for suffix, arrays in ((".offsets", offsets), (".docs", ids)):
            with store.open_output_stream(base + suffix) as out:
                for a in arrays:
                    out.write(a.tobytes())
        name = f"{folder}/{os.path.basename(base)}"
        yield pa.RecordBatch.from_pydict({"part": [part], "path": [name], "docs": [n], "ids": [total], "no_id": [missing]})

    found = rows.mapInArrow(run, "part long, path string, docs long, ids long, no_id long").filter("docs > 0").collect()
    files = [r.asDict() for r in sorted(found, key=lambda r: r["part"])]
    for f, start in zip(files, accumulate((f["ids"] for f in files), initial=0), strict=False):
        f["start"] = start
    return files


def read_token_files(spark: SparkSession, files: list[dict], tokenizer: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 (over its ids as unsigned 32-bit integers).

    No files (an empty table) give no row.
    """
    listed = spark.createDataFrame([(f["path"], f["start"], f["no_id"]) for f in files], "path string, start long, no_id long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = Encoder.of(tokenizer).dtype
        for path, start, missing in ((*r.values(),) for b in batches for r in b.to_pylist()):
            ids = _mapped(f"{path}.ids", dtype)
            offsets, docs = _mapped(f"{path}.offsets", np.dtype("<u8")).astype(np.int64), _mapped(f"{path}.docs", np.dtype("<i8"))
            for a in range(0, len(docs), 10_000):
                b = min(a + 10_000, len(docs))
                crc = [zlib.crc32(ids[offsets[i]:offsets[i + 1]].astype("<u4").tobytes()) for i in range(a, b)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs[a:b], mask=np.arange(a, b) < missing), pa.array(start + offsets[a:b]),
                    pa.array(np.diff(offsets[a:b + 1])), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.repartition(max(1, len(files))).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
