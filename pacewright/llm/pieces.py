"""SentencePiece encoding and decoding by weighted transducers.

The model file is compiled into three machines: the normaliser (spaces to the meta symbol, the dummy
prefix, runs of spaces where the model removes them), the pieces as arcs over the normalised
characters, and byte arcs for characters without a piece. Composed with a text they give a lattice
whose best path in the tropical semiring is the encoding. In a unigram model an arc weighs the
negated score of its piece. In a merge model (BPE) the state also holds the last piece, and an arc
weighs nothing if merging the two pieces' characters by rank leaves just these two, and infinity
otherwise: exactly one path has a finite weight, and it is the merges' result. No piece has the meta
symbol after another character, and none has two characters side by side that are of different
classes (in the given vocabulary letters of one script, signs, or a character by itself), so the
lattice falls apart before every run of meta symbols and wherever the class changes: paths are found
for such units and remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat
from math import inf
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: Remembered units of a worker (about 170 bytes each), in two generations.
REMEMBERED_UNITS = 60_000
#: Remembered left pieces and right pieces of each: together at most some hundred thousand pairs that texts hold.
LEFT_PIECES, RIGHT_PIECES = 4_000, 256
#: What an unknown character costs beyond the worst piece of a unigram model.
UNKNOWN_PENALTY = 10.0


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[i]
        i += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, i


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        if key & 7 == 0:
            value, i = _varint(data, i)
        else:
            n, i = {1: (8, i), 5: (4, i)}.get(key & 7) or _varint(data, i)
            value, i = data[i : i + n], i + n
        yield key >> 3, value


@dataclass
class Model:
    """A compiled model: pieces with scores and kinds, and the normaliser's switches."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    dummy_prefix: bool = True
    collapse: bool = True

    def __post_init__(self):
        # inside, a space stands for the meta symbol, which keeps most texts at one byte a character
        self.ids = {p.replace(SPACE, " "): i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER) and " " not in p}
        self.cost = {p: -self.pieces[i][1] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == BYTE}
        self.unknown = next((i for i, (*_, kind) in enumerate(self.pieces) if kind == UNKNOWN), 0)
        self.worst = max(self.cost.values(), default=0.0) + UNKNOWN_PENALTY
        self.halves: dict[str, tuple[str, str]] = {}
        self.surface = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.encode() for p, _, kind in self.pieces]
        if self.kind == BPE:
            for p in self.ids:
                if len(p) > 1:
                    self._derive(p)
        self.tree = self._tree()
        self.cut = self._borders()
        self.coded = {p: np.int32(i).tobytes() for p, i in self.ids.items()}
        self.units = _Memory(self._code, REMEMBERED_UNITS)
        self.pairs = _Memory(lambda a: _Memory(lambda b: self._stay_apart(a, b), RIGHT_PIECES), LEFT_PIECES)

    @staticmethod
    def parse(data: bytes) -> Model:
        pieces, kind, switches = [], UNIGRAM, {3: 1, 4: 1}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0], own.get(3, NORMAL)))
            elif number == 2:
                kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                own = dict(_fields(value))
                if own.get(2):
                    raise ValueError("models with a character map are not supported")
                switches |= {k: own[k] for k in (3, 4) if k in own}
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return Model(pieces, kind, bool(switches[3]), bool(switches[4]))

    # the pieces' machine

    def _derive(self, piece: str) -> None:
        """Merge the characters of a piece by rank; note its last merge, if the piece is what they give."""
        parts = list(piece)
        last = None
        while len(parts) > 1:
            cost, i = min((self.cost.get(parts[i] + parts[i + 1], inf), i) for i in range(len(parts) - 1))
            if cost == inf:
                return
            last = (parts[i], parts[i + 1])
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        self.halves[piece] = last

    def _stay_apart(self, a: str, b: str) -> bool:
        """Whether merging the characters of two pieces leaves these two: undo merges at the border, the latest first."""
        limit = inf
        while True:
            merged = self.cost.get(a + b, inf)
            if merged < limit:
                return False
            of_a = self.cost[a] if a in self.halves else -inf
            of_b = self.cost[b] if b in self.halves else -inf
            if of_a == of_b == -inf:
                return True
            # among merges of one rank the leftmost comes first: that of a before the border's, that of b after it
            if of_a > of_b:
                limit, a = of_a, self.halves[a][1]
            else:
                limit, b = float(np.nextafter(of_b, inf)), self.halves[b][0]

    def _tree(self) -> dict[str, tuple]:
        """The pieces as a tree of characters. A node holds the arcs on its way, the longest first and its first character alone (a piece or not) last, and the next nodes."""
        reachable = {p: p for p in self.ids if self.kind != BPE or len(p) == 1 or p in self.halves}
        arcs: dict[str, tuple[str, ...]] = {}
        for p in self.ids:
            own = arcs.setdefault(p[0], (reachable.get(p[0], p[0]),))
            for k in range(2, len(p) + 1):
                head = p[:k]
                known = arcs.get(head)
                if known is None:
                    known = arcs[head] = (reachable[head], *own) if head in reachable else own
                own = known
        none, inner = {}, {"": {}}
        for head in sorted(arcs, key=len, reverse=True):
            inner.setdefault(head[:-1], {})[head[-1]] = (arcs[head], inner.pop(head, none))
        return inner[""]

    def _borders(self) -> re.Pattern:
        """The units of a normalised text: spaces with the run of one class behind them. Characters side by side in a piece are of one class."""
        classes: dict[str, set[str]] = {}
        for a, b in {pair for p in map(str.lstrip, self.ids, repeat(" ")) for pair in zip(p, p[1:])}:
            joined = classes.get(a, {a}) | classes.get(b, {b})
            classes |= dict.fromkeys(joined, joined)
        runs = sorted({id(x): x for x in classes.values()}.values(), key=len, reverse=True)
        either = [f"[{''.join(map(re.escape, sorted(x)))}]+" for x in runs]
        return re.compile(f" *(?:{'|'.join([*either, '[^ ]'])})| +")

    def _arcs(self, unit: str, start: int) -> tuple[str, ...]:
        """The pieces from a position on, the longest first, its character alone (a piece or not) last."""
        arcs, nodes, n = None, self.tree, len(unit)
        end = start
        while end < n:
            node = nodes.get(unit[end])
            if node is None:
                break
            arcs, nodes = node
            end += 1
        return arcs or (unit[start],)

    def _path(self, unit: str) -> list[str]:
        """The best path through the lattice of one unit: its pieces, and characters without one."""
        n = len(unit)
        if self.kind == BPE:
            # a position has one state that a finite path reaches, so none is entered twice; the longest arc goes first
            open_, entered, start, apart = [], bytearray(n + 1), 0, None
            while start < n:
                arcs = iter(self._arcs(unit, start))
                while True:
                    for piece in arcs:
                        end = start + len(piece)
                        if not entered[end] and (apart is None or apart[piece]):
                            break
                    else:
                        _, start, arcs, apart = open_.pop()
                        continue
                    break
                open_.append((piece, start, arcs, apart))
                entered[end] = 1
                start, apart = end, self.pairs[piece]
            return [piece for piece, *_ in open_]
        last = [""] * (n + 1)
        best = [0.0] + [inf] * n
        for start in range(n):
            for piece in reversed(self._arcs(unit, start)):
                end = start + len(piece)
                weight = best[start] + self.cost.get(piece, self.worst)
                if weight < best[end]:
                    best[end], last[end] = weight, piece
        path, end = [], n
        while end:
            path.append(last[end])
            end -= len(last[end])
        return path[::-1]

    def _code(self, unit: str) -> bytes:
        """The ids of one unit, as 32-bit integers."""
        coded = self.coded.get
        return b"".join([coded(piece) or self._spelled(piece) for piece in self._path(unit)])

    def _spelled(self, character: str) -> bytes:
        """The ids of a character without a piece."""
        if len(self.bytes) < 256:
            return np.int32(self.unknown).tobytes()
        return np.array([self.bytes[x] for x in character.replace(" ", SPACE).encode()], np.int32).tobytes()

    # composition with a text

    def normalise(self, text: str) -> str:
        if self.collapse:
            text = re.sub(" +", " ", text.strip(" "))
        return (" " if self.dummy_prefix and text else "") + text.replace(SPACE, " ")

    def encode(self, text: str) -> list[int]:
        return self.encoded(text).tolist()

    def encoded(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.units.__getitem__, self.cut.findall(self.normalise(text)))), np.int32)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


class _Memory(dict):
    """Results by key, in two generations of ``size``: when the young one is full it becomes the old one, whose keys in use come back."""

    def __init__(self, make, size: int):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


@lru_cache(2)
def compiled(data: bytes) -> Model:
    """Compiled once in each worker, which keeps it between tasks."""
    return Model.parse(data)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """The given columns with n_tokens, ids and round_trip (whether decoding gives the text back) added.

    A null or empty text has no ids and comes back as the empty text. round_trip is false where a text
    itself holds the meta symbol, which decodes to a space. Columns of these names are replaced; rows
    are otherwise kept as they are, repeated ones too; an empty table gives an empty result. The model
    is read on the driver and sent to the executors (about half a megabyte).
    """
    data = Path(model_path).read_bytes()
    docs = docs.drop("n_tokens", "ids", "round_trip")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = compiled(data)
        for batch in batches:
            for lo in range(0, max(1, batch.num_rows), 500):
                part = batch.slice(lo, 500)
                ids, same = [], []
                for text in part.column(at).to_pylist():
                    own = model.encoded(text or "")
                    same.append(model.decode(own.tolist()) == (text or ""))
                    ids.append(own)
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(offsets).astype(np.int64)), lists, pa.array(same, pa.bool_())], [*part.schema.names, "n_tokens", "ids", "round_trip"])

    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
    schema = T.StructType([*docs.schema.fields, *added])
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); null ids give an empty text."""
    data = Path(model_path).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = compiled(data)
        for batch in batches:
            texts = [model.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
