"""Fill-in-the-middle documents, assembled by a secondary sort.

A text is cut at two borders of its tokens into prefix, middle and suffix. Its pieces, each of
bounded size and knowing its place in the output, are dealt by document and sorted within the partitions
by that place, so a task reads an output from its start to its end and needs only the digest so far,
however long the text is. On the way the markers that it reads tell which part each piece
belongs to; sorted once more by part, the pieces rebuild the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewright.llm.tokens import SPACE, Chunk, chunks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
SEED = 42
#: Of 100 documents so many are transformed, and of 100 of those so many have their suffix first.
TRANSFORMED, SUFFIX_FIRST = 50, 80
#: Bytes of a piece, and of the pieces of a batch.
PIECE_BYTES, BATCH_BYTES = 1 << 16, 8 << 20
#: Rows of a batch that are taken at once.
ROWS = 500
#: The parts in their order in a text; a plain text is one part.
_PLAIN, _PREFIX, _MIDDLE, _SUFFIX = range(4)
_MARKER_OF = {_PREFIX: PREFIX.encode(), _MIDDLE: MIDDLE.encode(), _SUFFIX: SUFFIX.encode()}
_PART_OF = {marker: part for part, marker in _MARKER_OF.items()}

_FIELDS = [
    ("doc_id", pa.int64(), "long"),
    ("row", pa.int64(), "long"),
    ("form", pa.string(), "string"),
    ("n", pa.int64(), "long"),
    ("prefix_chars", pa.int64(), "long"),
    ("middle_chars", pa.int64(), "long"),
    ("at_output", pa.int64(), "long"),
    ("part", pa.int32(), "int"),
    ("piece", pa.binary(), "binary"),
]
_PIECES = ", ".join(f"{name} {kind}" for name, _, kind in _FIELDS)


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four groups of eight digits of the digest of seed and doc_id, as integers; a null doc_id is written as nothing."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _n_chars(data: memoryview | bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _parts(data: bytes, ends: np.ndarray, draws: tuple[int, ...]) -> tuple[str, int, list[tuple[int, int, int]]]:
    """The form, the number of tokens, and the parts in output order as (part, first byte, past the last byte); markers aren't listed."""
    n = len(ends) - 1
    h1, h2, h3, h4 = draws
    if not data or any(m.encode() in data for m in MARKERS) or h3 % 100 >= TRANSFORMED:
        return "plain", n, [(_PLAIN, 0, len(data))]
    first, second = sorted((int(ends[h1 % (n + 1)]), int(ends[h2 % (n + 1)])))
    prefix, middle, suffix = (_PREFIX, 0, first), (_MIDDLE, first, second), (_SUFFIX, second, len(data))
    return ("spm", n, [suffix, prefix, middle]) if h4 % 100 < SUFFIX_FIRST else ("psm", n, [prefix, suffix, middle])


def _pieces_of(data: bytes, words: np.ndarray, draws: tuple[int, ...]) -> Iterator[tuple]:
    """form, n, prefix_chars, middle_chars, at_output, part, piece of one text; ``words``: where its words end."""
    ends = np.concatenate([[0], words, [len(data)] if len(data) > (words[-1] if len(words) else 0) else []]).astype(np.int64)
    form, n, parts = _parts(data, ends, draws)
    size = {part: (a, b) for part, a, b in parts}
    chars = (None, None) if form == "plain" else tuple(_n_chars(data[slice(*size[p])]) for p in (_PREFIX, _MIDDLE))
    at = 0
    for part, a, b in parts:
        if part != _PLAIN:
            yield form, n, *chars, at, None, _MARKER_OF[part]
            at += 1
        while a < b or (part == _PLAIN and at == 0):
            # As many whole tokens as a piece holds; a longer token lies in several pieces.
            past = min(b, int(ends[np.searchsorted(ends, a + PIECE_BYTES, "right") - 1]))
            past = past if past > a else min(b, a + PIECE_BYTES)
            yield form, n, *chars, at, None, data[a:past]
            a, at = past, at + 1


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(col, kind) for col, (_, kind, _) in zip(zip(*rows, strict=True), _FIELDS, strict=True)], [name for name, _, _ in _FIELDS])


def pieces(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The pieces of every text: doc_id, row, form, n, prefix_chars, middle_chars, at_output, part, piece (UTF-8).

    ``row`` tells rows that share a doc_id apart. ``at_output`` counts the pieces of the output, each marker being
    one; ``part`` is null, it is found out from the output. A piece ends with a token, or within one that is longer than a piece. A null text is an empty one: one empty piece of the plain form.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text", *_draws(F.col("doc_id"), seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                ids, rows = part.column(0).to_pylist(), part.column(1).to_pylist()
                draws = list(zip(*(part.column(i).to_pylist() for i in range(3, 7)), strict=True))
                texts = part.column(2).cast(pa.large_binary())
                for chunk in chunks(part.column(2), SPACE):
                    for r in range(chunk.rows):
                        i = chunk.first + r
                        words = chunk.ends[chunk.bounds[r] : chunk.bounds[r + 1]] - chunk.offsets[r]
                        for found in _pieces_of(texts[i].as_py() or b"", words, draws[i]):
                            made.append((ids[i], rows[i], *found))
                            size += len(found[-1])
                            if size > BATCH_BYTES:
                                yield _batch(made)
                                made, size = [], 0
        if made:
            yield _batch(made)

    return given.mapInArrow(run, _PIECES)


def _by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """The sorted pieces of one text after the other, read as they come."""
    every = (piece for batch in batches for piece in batch.to_pylist())
    return groupby(every, key=lambda p: p["row"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces with the part that the markers before them tell, without markers, and with each output's last piece one that holds its digest."""
    made, size = [], 0
    for _, own in _by_row(batches):
        digest, part = hashlib.sha256(), _PLAIN
        for at, p in enumerate(own):
            if p["at_output"] != at:
                raise ValueError("pieces of an output are missing or repeated")
            piece = p["piece"]
            digest.update(piece)
            if p["form"] != "plain" and piece in _PART_OF:
                part = _PART_OF[piece]
                continue
            p["part"] = part
            made.append(tuple(p.values()))
            size += len(piece)
            if size > BATCH_BYTES:
                yield _batch(made)
                made, size = [], 0
        p |= {"at_output": None, "part": None, "piece": digest.digest()}
        made.append(tuple(p.values()))
    if made:
        yield _batch(made)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text, from its output's digest, which comes first, and its pieces in the text's order."""
    rows = []

    def table() -> pa.RecordBatch:
        kinds = [*(pa.int64(),) * 2, pa.string(), *(pa.int64(),) * 2, pa.string(), pa.string()]
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
        return pa.RecordBatch.from_arrays([pa.array(col, kind) for col, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for _, own in _by_row(batches):
        head = next(own)
        digest = hashlib.sha256()
        for p in own:
            digest.update(p["piece"])
        rows.append((head["doc_id"], head["n"], head["form"], head["prefix_chars"], head["middle_chars"], head["piece"].hex(), digest.hexdigest()))
        if len(rows) == 10_000:
            yield table()
            rows.clear()
    if rows:
        yield table()


def _dealt(parts: DataFrame) -> DataFrame:
    """Pieces dealt by text, so that all of a text are in one partition; rows of one doc_id needn't be together."""
    return parts.repartition("doc_id", "row")


def digests(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every text.

    The form is plain, spm (suffix first) or psm; prefix_chars and middle_chars are null in a plain one, whose output is
    the text. Texts that are empty or hold a marker are plain; null texts are empty. A row without a doc_id
    has the draws of the empty number. Repeated rows each have a row. Other columns are ignored; an empty table
    gives none. A text is whole where it is cut, and a piece at a time afterwards. Pieces move once; the
    second sort is within the same partitions.
    """
    outputs = _dealt(pieces(docs, seed)).sortWithinPartitions("row", "at_output").mapInArrow(_digested, _PIECES)
    restored = outputs.sortWithinPartitions("row", F.col("part").asc_nulls_first(), "at_output")
    return restored.mapInArrow(_restored, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def outputs(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, form and output of every text, for outputs that a row can hold."""
    whole = _dealt(pieces(docs, seed)).groupBy("doc_id", "row", "form").agg(F.array_sort(F.collect_list(F.struct("at_output", "piece"))).alias("all"))
    joined = F.aggregate("all", F.lit(b""), lambda done, p: F.concat(done, p["piece"]))
    return whole.select("doc_id", "form", F.decode(joined, "UTF-8").alias("output"))


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id and text of every (doc_id, form, output): the text that an output was made of."""

    def parts(order: tuple[str, ...], places: tuple[int, ...]) -> Column:
        pattern = "(?s)^" + "".join(f"{marker}(.*)" for marker in order) + "$"
        return F.concat(*(F.regexp_extract("output", pattern, place) for place in places))

    form, spm, psm = F.col("form"), parts((SUFFIX, PREFIX, MIDDLE), (2, 3, 1)), parts((PREFIX, SUFFIX, MIDDLE), (1, 3, 2))
    return outputs.select("doc_id", F.when(form == "spm", spm).when(form == "psm", psm).otherwise(F.col("output")).alias("text"))
