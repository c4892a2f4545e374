"""Fill-in-middle transformation by secondary sort.

Every text is cut into pieces of so many code points; a piece is a row keyed by its document and its place in the output, with the marker
that opens its part in front of it. One shuffle deals documents to partitions, each sorted by document and place, so a
document's output streams by piece after piece and nothing larger than a piece is held. Restoration reads that stream
alone: it looks for the markers, gives what lies between them its place in the original text, and sorts the pieces again
where they are, without another shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from acadmetric.llm.common import doc_batches, id_and_text, utf8

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
#: The parts of each form in the order of its output.
FORMS = {"plain": (), "psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
_PLACE = {"prefix": 0, "middle": 1, "suffix": 2}
_ROWS = 1024  # rows turned into Python objects at a time

_HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
_SORTED = f"seq long, part int, no long, data binary, {_HEAD}, digest string"
_NOTHING = (None,) * 6  # what a piece has where the describing row has doc_id to digest


def choice(doc_id: int | None, n: int, marked: bool, seed: str, percent: int, spm_percent: int) -> tuple[str, int, int]:
    """form, begin and end of the middle: drawn from a hash of the id, so a task that runs again draws the same."""
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(drawn[i:i + 8], 16) for i in range(0, 32, 8)]
    if not n or marked or h[2] % 100 >= percent:
        return "plain", 0, n
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return "spm" if h[3] % 100 < spm_percent else "psm", low, high


def pieces(docs: DataFrame, seed: str = "1", percent: int = 90, spm_percent: int = 20, chunk: int = 8192) -> DataFrame:
    """Rows (seq, part, no, data, ...): every document's output in pieces, ``part`` -1 for the row that describes it.

    ``seq`` numbers the rows of the input by partition and place, so that rows with equal ids or texts stay apart; an input that is not
    read from storage and whose partitions come in no fixed order has to be written first. Null texts are empty; a row without doc_id
    draws as if its id had no digits. Empty texts and texts that hold a marker stay plain. An empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 40
        for batch in doc_batches(batches, 2 << 20):
            out = _Rows(_SORTED)
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                text = raw.decode()
                n = len(text)
                form, low, high = choice(doc_id, n, any(m in text for m in MARKS.values()), seed, percent, spm_percent)
                plain = form == "plain"
                out.add(seq, -1, 0, None, doc_id, n, form, None if plain else low, None if plain else high - low, None)
                spans = {"prefix": (0, low), "middle": (low, high), "suffix": (high, n)}
                no = 0
                for mark, (a, b) in [("", (0, n))] if plain else [(MARKS[p], spans[p]) for p in FORMS[form]]:
                    for i in range(a, max(b, a + 1), chunk):
                        data = (mark if i == a else "") + text[i:min(i + chunk, b)]
                        if data:
                            out.add(seq, 0, no, data.encode(), *_NOTHING)
                            no += 1
                seq += 1
            yield out.batch()

    return id_and_text(docs).mapInArrow(run, _SORTED)


class _Rows:
    """Rows on their way out; ``full`` after some thousand of them or some MB of ``size``."""

    def __init__(self, schema: str) -> None:
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        self.fields = [(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))]
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, *row, size: int = 0) -> None:
        self.rows.append(row)
        self.size += size

    @property
    def full(self) -> bool:
        return self.size > 4 << 20 or len(self.rows) >= 8192

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.fields)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, self.fields, strict=True)],
                                          [n for n, _ in self.fields])


class Restorer:
    """Reads an output as it streams by and says which part of the text each run of bytes belongs to."""

    def __init__(self, form: str) -> None:
        self.marks = [MARKS[p].encode() for p in FORMS[form]]
        self.parts = [0, *(_PLACE[p] for p in FORMS[form])]  # before the first marker there is nothing, or a plain text
        self.held = b""

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        self.held += data
        while self.marks:
            at = self.held.find(self.marks[0])
            if at < 0:  # the marker may begin in the last bytes
                cut = max(0, len(self.held) - len(self.marks[0]) + 1)
                if cut:
                    yield self.parts[0], self.held[:cut]
                    self.held = self.held[cut:]
                return
            if at:
                yield self.parts[0], self.held[:at]
            self.held = self.held[at + len(self.marks[0]):]
            del self.marks[0], self.parts[0]
        if self.held:
            yield self.parts[0], self.held
            self.held = b""

    def finish(self) -> Iterator[tuple[int, bytes]]:
        if self.marks:
            raise ValueError("the output lacks a marker of its form")
        yield from self.feed(b"")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[bytes]]]:
    """Each document's describing row and a stream of its pieces; the stream has to be read to its end."""
    rows = (r for b in batches for i in range(0, b.num_rows, _ROWS) for r in b.slice(i, _ROWS).to_pylist())
    head = next(rows, None)
    while head is not None:
        state = [None]

        def stream(head=head, state=state) -> Iterator[bytes]:
            for r in rows:
                if r["seq"] != head["seq"]:
                    state[0] = r
                    return
                yield r["data"]

        yield head, stream()
        head = state[0]


def _of(head: dict) -> list:
    return [head[c.split()[0]] for c in _HEAD.split(", ")]


def _sorted_pieces(found: DataFrame) -> DataFrame:
    return found.repartition("seq").sortWithinPartitions("seq", "part", "no")


def transformed(docs: DataFrame, **choices) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (the whole text) for every row. ``choices`` as for ``pieces``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(f"{_HEAD}, output string")
        for head, stream in _documents(batches):
            whole = b"".join(stream)
            out.add(*_of(head), whole.decode(), size=len(whole))
            if out.full:
                yield out.batch()
        yield out.batch()

    return _sorted_pieces(pieces(docs, **choices)).mapInArrow(run, f"{_HEAD}, output string")


def restored(outputs: DataFrame) -> DataFrame:
    """doc_id, text of the rows of ``outputs`` (doc_id, form, output), from output and form alone; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for form, output in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                reader = Restorer(form)
                found = [*reader.feed(output.encode()), *reader.finish()]
                texts.append(b"".join(b for _, b in sorted(found, key=lambda f: f[0])).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return outputs.select("doc_id", "form", "output").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, **choices) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 for every row; ``choices`` as for ``pieces``.

    The restored text is put together from output and form, not from the original. One shuffle, two sorts.
    """

    def forth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_SORTED)
        for head, stream in _documents(batches):
            seq, own, reader, no = head["seq"], hashlib.sha256(), Restorer(head["form"]), 0
            for data in stream:
                own.update(data)
                for part, run in reader.feed(data):
                    out.add(seq, part, no, run, *_NOTHING, size=len(run))
                    no += 1
                if out.full:
                    yield out.batch()
            for part, run in reader.finish():
                out.add(seq, part, no, run, *_NOTHING)
            out.add(seq, -1, 0, None, *_of(head), own.hexdigest())
            if out.full:
                yield out.batch()
        yield out.batch()

    result = f"{_HEAD}, output_sha256 string, restored_sha256 string"

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(result)
        for head, stream in _documents(batches):
            own = hashlib.sha256()
            for data in stream:
                own.update(data)
            out.add(*_of(head), head["digest"], own.hexdigest())
            if out.full:
                yield out.batch()
        yield out.batch()

    outputs = _sorted_pieces(pieces(docs, **choices)).mapInArrow(forth, _SORTED)
    # The pieces of a document share a partition already; only their order changes.
    return outputs.sortWithinPartitions("seq", "part", "no").mapInArrow(back, result)
