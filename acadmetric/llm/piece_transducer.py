"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Machines are compiled from a model file. The normaliser reads a blank and writes the blank sign, reads any other character and
writes it, and writes one blank sign before the text (an arc that reads nothing). The piece machine reads characters along any
piece of the vocabulary and writes its id; a character that no piece has goes through the byte arcs. The two are composed when
the model is loaded: every arc of the piece machine that reads what the normaliser writes is given to what the normaliser reads.
An input is composed with that machine, and the shortest path in the tropical semiring (weights add along a path, the least
path wins) is the encoding: of all arcs into a place the least is kept. That is all for a unigram model.

For a model of byte-pair merges a third machine remembers the last piece and lets a piece follow only if merging the two pieces'
text gives just these two; forbidden arcs weigh infinity, and one finite path is left. Say that all neighbours of a sequence
agree, and merge its whole text: until a first merge crosses a border, merges in the two pieces beside it come in the order that
they have in the two alone, as the best pair (the leftmost of equals) among all is the best in any part that has it; so that
merge would cross in the two alone as well, and they would not agree. Hence the sequence is the result of the merges. In the same
way neighbours in the result agree, and merging has one result, for the text and for each of its beginnings. So one finite path
leads to each place, and the one through the text is sought in depth, the longest piece first: a place from which no arc leads on
is not entered again, and no place is entered twice. Arcs of the pair machine are worked out when first asked for and remembered.

No piece but runs of the blank sign has it anywhere but at its start, so a text's shortest path is that of its words, one after
the other; a task remembers the paths of words it has met. The vocabulary is a fixed file; nothing is shuffled.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from acadmetric.llm.common import GOLDEN, doc_batches, id_and_text

BLANK = "▁"
REMEMBERED = 100_000  # words a task keeps in each of two generations
PAIRS = 150_000  # arcs of the pair machine, likewise
FEW = 32  # words that are followed one by one
LONGEST = 64  # characters of a word that is kept
_WORD = re.compile(" *[^ ]+| +")
_machines: dict[str, Transducer] = {}


@dataclass
class Arcs:
    """The arcs of the piece machine as arrays, so that all places of many words are read at once.

    An arc is named by its state times the number of characters, and its character. The names stand in a table by a hash, or in
    the next place that is free.
    """

    character: np.ndarray  # number of each code point that any arc reads, else 0
    names: np.ndarray  # 0: free
    target: np.ndarray
    piece: np.ndarray  # by state: the piece that ends there, or -1
    shift: int

    @staticmethod
    def of(start: tuple[dict, int]) -> Arcs:
        number, states = {id(start[0]): 0}, [start]
        arcs: list[tuple[int, int, int]] = []
        for at, (own, _) in enumerate(states):
            for c, state in own.items():
                # Two characters may lead to the arcs of one state.
                to = number.setdefault(id(state[0]), len(states))
                if to == len(states):
                    states.append(state)
                arcs.append((at, ord(c), to))
        source, read, to = np.array(arcs, np.int64).reshape(-1, 3).T
        character = np.zeros(0x110000, np.int32)
        used = np.unique(read)
        character[used] = np.arange(1, len(used) + 1)
        bits = max(4, (4 * len(arcs)).bit_length())
        names, target = np.zeros(1 << bits, np.int64), np.full(1 << bits, -1, np.int32)
        out = Arcs(character, names, target, np.array([piece for _, piece in states], np.int32), 64 - bits)
        name = out._name(source, character[read])
        slot = out._slot(name)
        while len(name):
            free = np.flatnonzero(names[slot] == 0)
            names[slot[free]] = name[free]  # of arcs with one slot the last has it
            target[slot[free]] = np.where(names[slot[free]] == name[free], to[free], target[slot[free]])
            rest = names[slot] != name
            name, to, slot = name[rest], to[rest], (slot[rest] + 1) & (len(names) - 1)
        return out

    def _name(self, state: np.ndarray, character: np.ndarray) -> np.ndarray:
        return state * np.int64(1 << 21) + character

    def _slot(self, name: np.ndarray) -> np.ndarray:
        return ((name.view(np.uint64) * GOLDEN) >> np.uint64(self.shift)).astype(np.int64)

    def follow(self, state: np.ndarray, character: np.ndarray) -> np.ndarray:
        """Where each arc leads, -1 where there is none."""
        name = self._name(state, character)
        slot = self._slot(name)
        met = self.names[slot]
        to = np.where(met == name, self.target[slot], -1)
        left = np.flatnonzero((met != name) & (met != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.names) - 1)
            met = self.names[slot[left]]
            hit = met == name[left]
            to[left[hit]] = self.target[slot[left[hit]]]
            left = left[~hit & (met != 0)]
        return to

    def longest(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code points of a text, and the longest piece that begins at each of its places and at its end (-1: none) and
        reads none of the places ``ends``."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        read = np.append(self.character[points], 0)
        best = np.full(len(read), -1, np.int64)
        read[ends] = 0
        begin = np.flatnonzero(read)
        at, state = begin, np.zeros(len(begin), np.int64)
        while len(at):
            to = self.follow(state, read[at])
            on = to >= 0
            begin, at, state = begin[on], at[on] + 1, to[on].astype(np.int64)
            piece = self.piece[state]
            best[begin[piece >= 0]] = piece[piece >= 0]
            on = read[at] > 0
            begin, at, state = begin[on], at[on], state[on]
        return points, best


class Transducer:
    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = proto.ModelProto.SentencePiece
        rules, trainer = model.normalizer_spec, model.trainer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only the identity normaliser with escaped blanks is supported")
        if trainer.model_type not in (proto.TrainerSpec.BPE, proto.TrainerSpec.UNIGRAM) or not trainer.byte_fallback:
            raise ValueError("only merge and unigram models with byte fallback are supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("pieces that the user defined, or that are not to be used, are not supported")
        self.merges = trainer.model_type == proto.TrainerSpec.BPE
        self.prefix = " " if rules.add_dummy_prefix else ""
        normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        if any(BLANK in p.piece.lstrip(BLANK) for _, p in normal):
            raise ValueError("only vocabularies whose pieces have the blank at their start are supported")
        self.number = {p.piece: i for i, p in normal}
        self.piece = [p.piece for p in model.pieces]
        self.weight = [-p.score for p in model.pieces]
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_ids = np.array([self.byte.get(b, 0) for b in range(256)], np.int64)
        self.single = {p for p in self.number if len(p) == 1}
        if self.merges and any(c not in self.single for p in self.number for c in p):
            raise ValueError("only merge models with a piece for each character of a piece are supported")
        # What a character without a piece weighs: under the least likely piece by ten, as unigram models have it.
        self.unknown = 0.0 if self.merges else 10.0 - min(p.score for _, p in normal)
        # The states of the piece machine: arcs by character, and the id of the piece that ends there.
        self.start: tuple[dict, int] = ({}, -1)
        for i, p in normal:
            state = self.start
            for c in p.piece[:-1]:
                state = state[0].setdefault(c, ({}, -1))
            state[0][p.piece[-1]] = (state[0].get(p.piece[-1], ({}, -1))[0], i)
        self.cost = {p.piece: -p.score for _, p in normal}
        # The piece that begins a piece and is the longest of those shorter than it, -1 if there is none.
        self.shorter = np.full(len(model.pieces), -1, np.int64)
        for i, p in normal:
            self.shorter[i] = next((n for n in (self.number.get(p.piece[:k], -1) for k in range(len(p.piece) - 1, 0, -1)) if n >= 0), -1)
        self.length = np.fromiter(map(len, self.piece), np.int64, len(self.piece))
        self.neighbours = {p[i:i + 2] for p in self.number for i in range(len(p) - 1)}
        self._compose_normaliser({" ": BLANK})
        if self.merges:
            self.arcs = Arcs.of(self.start)
            del self.start  # its arcs are in the arrays
        written = {i: p.piece.replace(BLANK, " ").encode() for i, p in normal} | {i: bytes([b]) for b, i in self.byte.items()}
        self.written = [written.get(i, b"") for i in range(len(model.pieces))]
        self.allowed: dict[int, bool] = {}
        self.older_allowed: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def of(path: str) -> Transducer:
        if path not in _machines:
            _machines[path] = Transducer(path)
        return _machines[path]

    def _compose_normaliser(self, rules: dict[str, str]) -> None:
        """Composes the normaliser, which reads a character and writes another (any character without a rule: itself), with
        the piece machine: where this reads what is written, the composed machine reads the character itself."""
        states = [self.start]
        for arcs, _ in states:
            states += arcs.values()
            arcs.update({read: arcs[write] for read, write in rules.items() if write in arcs})
        for read, write in rules.items():
            self.single |= {read} if write in self.single else set()
            self.neighbours |= {read + p[1] for p in self.neighbours if p[0] == write}
            self.neighbours |= {p[0] + read for p in self.neighbours if p[1] == write}

    def _merged(self, text: str) -> list[str]:
        """The text's pieces by merging: the pair with the best piece first, the leftmost of equals."""
        symbols, cost = list(text), self.cost.get
        costs = [cost(a + b, math.inf) for a, b in zip(symbols, symbols[1:], strict=False)]
        while costs:
            best = min(costs)
            if best == math.inf:
                break
            at = costs.index(best)
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del costs[at]
            if at < len(costs):
                costs[at] = cost(symbols[at] + symbols[at + 1], math.inf)
            if at:
                costs[at - 1] = cost(symbols[at - 1] + symbols[at], math.inf)
        return symbols

    def may_follow(self, before: int, piece: int) -> bool:
        """Whether the pair machine has an arc; ``before`` is -1 at the start of a word and after bytes."""
        key = before * len(self.piece) + piece
        found = self.allowed.get(key)
        if found is None:
            if len(self.allowed) > PAIRS:
                self.allowed, self.older_allowed = {}, self.allowed
            found = self.older_allowed.get(key)
            if found is None:
                own = [self.piece[piece]] if before < 0 else [self.piece[before], self.piece[piece]]
                found = self._merged("".join(own)) == own
            self.allowed[key] = found
        return found

    def shortest_paths(self, words: set[str]) -> dict[str, bytes]:
        """Ids, as little-endian 32-bit integers, along the least path of each word composed with the machines."""
        if self.merges:
            return self._only_paths(list(words))
        cut = {word: self._segments(word) for word in words}
        found = self._least_paths({s for own in cut.values() for s in own})
        return {word: b"".join(map(found.__getitem__, own)) for word, own in cut.items()}

    def _fit(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        fits = list(map(self.allowed.get, (before * len(self.piece) + piece).tolist()))
        for i in [i for i, x in enumerate(fits) if x is None] if None in fits else ():
            fits[i] = self.may_follow(int(before[i]), int(piece[i]))
        return np.array(fits, bool)

    def _only_paths(self, words: list[str]) -> dict[str, bytes]:
        """The ids of the one path that the pair machine leaves, for each word.

        Words are followed side by side, an arc of each at a time; the last few, which are long, one by one.
        """
        text, length = "\0".join(words), np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(length + 1) - 1
        begin = end - length
        read, first = self.arcs.longest(text, end)
        # By place: the piece that leads there (-1: bytes or the start), and whether no arc leads on.
        came, blocked = np.full(len(first), -1, np.int64), np.zeros(len(first), bool)
        word, at = np.arange(len(words)), begin
        piece = first[at]
        while len(word) >= FEW:
            lost = piece < 0
            byte = lost & (first[at] < 0)  # no piece begins with the character
            back = lost & ~byte  # no arc leads on: back to the place before, and from there by a shorter piece
            blocked[at[back]] = True
            to = at + np.where(lost, 0, self.length[piece])
            fits = ~lost & ~blocked[to]
            fits[fits] = self._fit(came[at[fits]], piece[fits])
            came[to[fits]] = piece[fits]
            piece = np.where(back, came[at], piece)
            at = np.where(fits, to, at + byte - np.where(back, self.length[piece], 0))
            piece = np.where(fits | byte, first[at], self.shorter[piece])
            going = at < end[word]
            word, at, piece = word[going], at[going], piece[going]
        # The paths, from the end of each word to its beginning.
        whole = np.ones(len(words), bool)
        whole[word] = False
        begin, at, places = begin[whole], end[whole], []
        while len(at):
            places.append(at)
            at = at - np.where(came[at] < 0, 1, self.length[came[at]])
            begin, at = begin[at > begin], at[at > begin]
        places = np.sort(np.concatenate(places)) if places else np.empty(0, np.int64)
        piece = came[places]
        odd = read[places[piece < 0] - 1]
        many = np.ones(len(piece), np.int64)
        many[piece < 0] = 1 + (odd > 0x7F) + (odd > 0x7FF) + (odd > 0xFFFF)
        ids = np.repeat(piece, many)
        ids[ids < 0] = self.byte_ids[np.frombuffer(odd.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)]
        cuts = (4 * np.append(0, np.cumsum(many))[np.append(0, np.searchsorted(places, end, "right"))]).tolist()
        ids = ids.astype("<u4").tobytes()
        found = {w: ids[a:b] for w, a, b in zip(words, cuts, cuts[1:], strict=False)}
        for i in word.tolist():
            found[words[i]] = self._only_path(words[i], first[end[i] - length[i]:end[i]].tolist())
        return found

    def _only_path(self, word: str, first: list[int]) -> bytes:
        """The ids of the word's path; ``first``: the longest piece that begins at each of its places."""
        size, last = len(self.piece), len(word)
        ids, path, blocked, at, before = [], [], set(), 0, -1
        while at < last:
            piece = first[at]
            if piece < 0:  # what follows bytes never calls for another way to them
                ids += path
                ids += [self.byte[b] for b in word[at].encode()]
                path, before, at = [], -1, at + 1
                continue
            while True:
                if piece < 0:
                    blocked.add(at)
                    piece = path.pop()
                    at -= int(self.length[piece])
                    before = path[-1] if path else -1
                elif at + int(self.length[piece]) not in blocked:
                    fits = self.allowed.get(before * size + piece)
                    if fits is None:
                        fits = self.may_follow(before, piece)
                    if fits:
                        break
                piece = int(self.shorter[piece])
            path.append(piece)
            before, at = piece, at + int(self.length[piece])
        return array("I", ids + path).tobytes()

    def _least_paths(self, words: set[str]) -> dict[str, bytes]:
        """The ids of the path of the least weight, for each word.

        A place in a word is reached with what was read so far only, so words are taken in order and share the places of
        their common beginnings.
        """
        weight, single = self.weight, self.single
        # By place: distance, last piece (-1: bytes or the start), where it came from, and the pieces being read there as
        # (begin, state), the earliest begin first.
        places: list[tuple[float, int, int, list]] = [(0.0, -1, 0, [(0, self.start)])]
        found, before_word = {}, ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before_word, word, strict=False):
                if a != b:
                    break
                shared += 1
            del places[shared + 1:]
            before_word = word
            for at in range(shared, len(word)):
                c = word[at]
                distance, last, back, reading = math.inf, -1, at, []
                for begin, state in places[at][3]:
                    state = state[0].get(c)
                    if state is None:
                        continue
                    reading.append((begin, state))
                    piece = state[1]
                    if piece >= 0 and places[begin][0] + weight[piece] < distance:
                        distance, last, back = places[begin][0] + weight[piece], piece, begin
                if c not in single and places[at][0] + self.unknown < distance:
                    distance, last, back = places[at][0] + self.unknown, -1, at  # the byte arcs
                if distance < math.inf:
                    reading.append((at + 1, self.start))
                places.append((distance, last, back, reading))
            path, end = [], len(word)
            while end:
                _, last, back, _ = places[end]
                if last >= 0:
                    path.append(last)
                else:
                    path += [self.byte[b] for b in reversed(word[end - 1].encode())]
                end = back
            path.reverse()
            found[word] = array("I", path).tobytes()
        return found

    def _segments(self, word: str) -> list[str]:
        """The word cut where two characters stand side by side in no piece, so that no path leads across."""
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.neighbours), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _words(self, text: str) -> list[str]:
        """The text's words, each with the blanks before it; the normaliser's arc that reads nothing goes first."""
        text = (self.prefix + text if text else text).replace(BLANK, " ")
        if "  " in text or "\0" in text:
            return _WORD.findall(text)
        words = text.replace(" ", "\0 ").split("\0")
        return words if words[0] else words[1:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            # Words that are met again come back from the older generation; the others go with it.
            self.known, self.older = {}, self.known
        words, ends = [], [0]
        for t in texts:
            words += self._words(t)
            ends.append(len(words))
        known, older = self.known, self.older
        fresh = set(words).difference(known)
        again = {word: older[word] for word in fresh if word in older}
        known |= again
        fresh.difference_update(again)
        known |= self.shortest_paths(fresh)
        ids = [np.frombuffer(b"".join(map(known.__getitem__, words[a:b])), "<u4") for a, b in zip(ends, ends[1:], strict=False)]
        for word in fresh:
            if len(word) > LONGEST:
                del known[word]
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that make no character become U+FFFD, control pieces nothing."""
        raw = b"".join(map(self.written.__getitem__, ids.tolist()))
        return (raw[1:] if self.prefix and raw[:1] == b" " else raw).decode(errors="replace")


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column(1).to_pylist()]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int) for every row; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.of(model)
        for batch in doc_batches(batches, 1 << 20):
            ids = [x.astype(np.int32) for x in machine.encode(_texts(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of rows with doc_id and ids; null ids give an empty text. The blank sign itself comes back as a blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.of(model)
        for batch in batches:
            texts = [machine.decode(np.array(x or (), np.uint32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (over the ids as little-endian unsigned 32-bit integers), n_chars of the decoded text,
    same (whether it is the text, blank signs taken as blanks), and the ids where asked for; one row per document.

    Null and empty texts have no pieces and come back empty. Repeated rows are encoded one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Transducer.of(model)
        for batch in doc_batches(batches, 1 << 20):
            texts = _texts(batch)
            ids = machine.encode(texts)
            back = [machine.decode(x) for x in ids]
            columns = [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                       pa.array([len(b) for b in back], pa.int64()),
                       pa.array([b == t.replace(BLANK, " ") for b, t in zip(back, texts, strict=True)], pa.bool_())]
            names = ["doc_id", "n_pieces", "ids_crc32", "n_chars", "same"]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_pieces long, ids_crc32 long, n_chars long, same boolean"
    return id_and_text(docs).mapInArrow(run, f"{schema}, ids array<int>" if with_ids else schema)
