"""Alignment of two vocabularies' tokens over a corpus, with corpus-wide counts of the token pairs that end together.

Tokens of both vocabularies cover the same bytes; where tokens of both end, a group ends, and the two last tokens are
linked. Linked tokens end at the same byte, so one is the end of the other: the distinct pairs are bounded by the
vocabularies, whatever the corpus is. A minimal perfect hash numbers the pairs that occur, each task's
counts become a dense vector in that numbering, and the vectors are summed in a tree. A second pass
aligns the documents again and looks each link up; the key that stands at a hash is compared with the link's own.

Neither vocabulary joins a space with a character before it that isn't white space, so a text falls apart before
such spaces, and units are aligned once for all their occurrences that a task remembers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pacewright.llm.prefix_counts import STABLE, WHITE, Merges, _bytes_of_letters
from pacewright.llm.scratch import Scratch
from pacewright.llm.tokens import mix

#: Units that a task remembers, and their characters; beyond either it begins anew.
REMEMBERED, REMEMBERED_CHARS = 300_000, 16 << 20
#: Characters of texts that are aligned at once, and of a string that is encoded at once.
SLICE_CHARS, ENCODED_CHARS = 1 << 20, 1 << 16
#: Vectors that are summed by one task of the tree.
FAN = 16
#: Room of a hash level's bits for each key.
ROOM = 2
#: A space and all up to the next space that stands behind something else than white space.
_UNIT = re.compile(f" (?:[^ ]+|(?<=[{WHITE}]) )*")
_META = "▁"
#: How byte-level vocabularies cut a text into words before they merge.
_CUT = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b


class PerfectHash:
    """Numbers 0 to n - 1 for n keys. Each level has a bit for every key that met no other there; the others go to the next level."""

    def __init__(self, keys: np.ndarray):
        keys = np.unique(keys.astype(np.int64))
        self.sizes, bits, left = [], [], keys
        while len(left):
            size = ROOM * len(left) + 1
            at = self._at(left, len(self.sizes), size)
            met = np.bincount(at, minlength=size)
            self.sizes.append(size)
            bits.append(met == 1)
            left = left[met[at] > 1]
        self.bits = np.concatenate([*bits, np.zeros(0, bool)])
        self.rank = np.cumsum(self.bits, dtype=np.int64) - 1
        self.keys = np.zeros(len(keys), np.int64)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        found, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._at(keys[open_], level, size)
            hit = self.bits[at]
            found[open_[hit]] = self.rank[at[hit]]
            open_, base = open_[~hit], base + size
        return found

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, verified by the key that has it; -1 for a key that isn't one of those numbered."""
        found = self._slots(keys)
        if len(self.keys):
            found[self.keys[found] != keys] = -1
        return found


def in_merge_order(spec: str) -> bool:
    """Whether ids stand for the order of merges, and each token's bytes merge into it.

    Then merging the two neighbours that make the least id is the same as following the list of merges: before the
    merge that makes a token the listed two stand for its bytes wherever any two tokens do.
    """
    parsed = json.loads(spec)
    model = parsed["model"]
    merges = Merges(model)
    made = [i for _, i in sorted((rank, i) for i, (rank, _, _) in merges.parts.items())]
    special = {t["content"] for t in parsed["added_tokens"]}
    plain = parsed["pre_tokenizer"].get("type") == "ByteLevel" and not parsed["pre_tokenizer"]["add_prefix_space"] and not parsed["normalizer"]
    return plain and made == sorted(made) and len(model["merges"]) == len(made) and len(merges.ids) == len(model["vocab"].keys() - special)


class Vocabularies:
    """Both encoders, and the bytes of their tokens. ``ranked``: the first one's ids are in the order of merges, so that a
    quicker library may merge; characters on which versions of Unicode differ stay with its own."""

    def __init__(self, spec: str, model: bytes, ranked: bool = False):
        self.a = Tokenizer.from_str(spec)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = _bytes_of_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        bytes_a: list[bytes] = [b""] * (1 + max(self.a.get_vocab().values()))
        for piece, i in vocabulary.items():
            bytes_a[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else b""
        self.quick = None
        if ranked:
            self.quick = tiktoken.Encoding("ranked", pat_str=_CUT, mergeable_ranks={b: i for i, b in enumerate(bytes_a) if b}, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.b.vocab_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        if any(_META in p.lstrip(_META) for p in pieces):
            raise ValueError("a piece joins a space with a character before it")
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_META, " ").encode() for i, p in enumerate(pieces)]
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.len_a, self.len_b = (np.array([len(x) for x in own], np.int64) for own in (bytes_a, bytes_b))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Both vocabularies' ids of a string that begins with a space; None if either's bytes aren't the string's."""
        if self.quick and max(text) < STABLE:
            a = self.quick.encode_ordinary(text)
        else:
            a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        # The empty text has no space put before it, so a lone space is read behind a letter.
        b = self.b.encode(text[1:], num_threads=1) if len(text) > 1 else self.b.encode("a ", num_threads=1)[len(self.b.encode("a")) :]
        data = text.encode()
        same = b"".join(map(self.bytes_a.__getitem__, a)) == data == b"".join(map(self.bytes_b.__getitem__, b))
        return (np.array(a, np.int64), np.array(b, np.int64)) if same else None

    def most_pairs(self) -> int:
        """How many pairs of tokens there are of which one is the end of the other."""
        ends = lambda tokens, others: sum(others.get(t[i:], 0) for t in tokens for i in range(len(t)))
        count = lambda tokens: {t: n for t, n in zip(*np.unique(np.array(tokens, object), return_counts=True), strict=True)}
        return ends(self.bytes_a, count(self.bytes_b)) + ends(self.bytes_b, count(self.bytes_a))


@lru_cache(2)
def _vocabularies(spec: str, model: bytes, ranked: bool = False) -> Vocabularies:
    """Made once in each worker, which keeps it between tasks."""
    return Vocabularies(spec, model, ranked)


class Units:
    """Aligned units, by number: tokens of both sides, links, and the groups as text if asked for."""

    def __init__(self, vocabularies: Vocabularies, with_groups: bool):
        self.vocabularies, self.with_groups = vocabularies, with_groups
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.bad: set[int] = set()
        self.tokens: list[np.ndarray] = []  # rows of n_a, n_b, n_links
        self.links: list[np.ndarray] = []
        self.groups: list[str] = []

    @property
    def full(self) -> bool:
        return len(self.number) > REMEMBERED or self.chars > REMEMBERED_CHARS

    def learn(self, units: list[str]) -> None:
        """Align units that aren't known yet. Those that end without white space are encoded many at once, those with other characters by themselves."""
        strings, held, size = [], [], 0
        for unit in sorted(units, key=lambda u: max(u) >= STABLE):
            self.number[unit] = len(self.number)
            self.chars += len(unit)
            held.append(unit)
            size += len(unit)
            if size > ENCODED_CHARS or unit[-1].isspace():
                strings.append(held)
                held, size = [], 0
        for string in [*strings, held] if held else strings:
            self._align(string)

    def _align(self, units: list[str]) -> None:
        encoded = self.vocabularies.encode("".join(units))
        if encoded is None and len(units) > 1:
            for unit in units:
                self._align([unit])
            return
        if encoded is None:
            self.bad.add(self.number[units[0]])
            encoded = np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = encoded
        ends_a, ends_b = np.cumsum(self.vocabularies.len_a[a]), np.cumsum(self.vocabularies.len_b[b])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, both), np.searchsorted(ends_b, both)
        unit_ends = np.cumsum([len(u.encode()) for u in units]) if len(both) else np.zeros(len(units), np.int64)
        past = np.searchsorted(both, unit_ends, "right")
        tokens_past = [np.searchsorted(ends, unit_ends, "right") for ends in (ends_a, ends_b)]
        self.tokens.append(np.stack([np.diff(x, prepend=0) for x in (*tokens_past, past)], axis=1))
        self.links.append(_pair(a[last_a], b[last_b]))
        if self.with_groups:
            ids_a, ids_b, groups, i, j = list(map(str, a.tolist())), list(map(str, b.tolist())), [], 0, 0
            for x, y in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
                groups.append(f"{','.join(ids_a[i:x])}|{','.join(ids_b[j:y])}")
                i, j = x, y
            first = 0
            for end in past.tolist():
                self.groups.append(";".join(groups[first:end]))
                first = end

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """n_a, n_b, n_links of every unit by number, and all links in that order."""
        if len(self.tokens) > 1:
            self.tokens, self.links = [np.concatenate(self.tokens)], [np.concatenate(self.links)]
        return (self.tokens[0], self.links[0]) if self.tokens else (np.zeros((0, 3), np.int64), np.zeros(0, np.int64))

    def of_texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's units; none where a text is null or empty or where an encoding doesn't give back its bytes."""
        units = [_UNIT.findall(f" {t}") if t else [] for t in texts]
        self.learn(list({u: None for u in chain.from_iterable(units) if u not in self.number}))
        found = [np.fromiter(map(self.number.__getitem__, own), np.int64, len(own)) for own in units]
        if self.bad:
            bad = np.fromiter(self.bad, np.int64)
            found = [own if not np.isin(own, bad).any() else own[:0] for own in found]
        return found


def _slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Rows whose texts have about SLICE_CHARS characters together, with the texts; a longer text is a slice of its own."""
    for batch in batches:
        sizes = np.cumsum([len(t) if t else 0 for t in batch.column(at).to_pylist()])
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + SLICE_CHARS, "right")))
            part = batch.slice(lo, hi - lo)
            yield part, part.column(at).to_pylist()
            lo = hi


def _add(pairs: np.ndarray, counts: np.ndarray, more: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct pairs with their counts, after more of them."""
    every, where = np.unique(np.concatenate([pairs, more]), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, where, np.concatenate([counts, times]))
    return every[total > 0], total[total > 0]


@dataclass
class Alignment:
    """What the first pass found: the hash of the pairs, each pair's links, and whether they are the most of its second token."""

    pairs: PerfectHash
    counts: np.ndarray
    best: np.ndarray


def _seen(texts: DataFrame, spec: str, model: bytes, ranked: bool) -> DataFrame:
    """node, pairs, counts: one row per task that saw a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(_vocabularies(spec, model, ranked), False)
        pairs = counts = np.zeros(0, np.int64)
        times, node = np.zeros(0, np.int64), None

        def flush() -> None:
            nonlocal pairs, counts, times
            tokens, links = units.table()
            pairs, counts = _add(pairs, counts, links, np.repeat(times, tokens[: len(times), 2]))
            times = np.zeros(0, np.int64)
            units.clear()

        for part, own in _slices(batches, 1):
            node = part.column(0)[0].as_py()
            found = units.of_texts(own)
            added = np.bincount(np.concatenate(found), minlength=len(units.number))
            added[: len(times)] += times
            times = added
            if units.full:
                flush()
        flush()
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([pairs]), pa.array([counts])], ["node", "pairs", "counts"])

    return texts.select(F.spark_partition_id().cast("long").alias("node"), "text").mapInArrow(run, "node long, pairs array<long>, counts array<long>")


def _tree_sum(seen: DataFrame, pairs: PerfectHash) -> np.ndarray:
    """The sum of all tasks' dense count vectors. Each level's tasks read FAN vectors at most."""
    sent = seen.sparkSession.sparkContext.broadcast(pairs)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                vector = np.zeros(len(sent.value.keys), np.int64)
                vector[sent.value.slots(np.array(batch.column(1)[i].values))] = np.array(batch.column(2)[i].values)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([vector.tobytes()], pa.binary())], ["node", "vector"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, total = None, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["node", "vector"])
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if n != node and node is not None:
                    yield out()
                    total = None
                node, vector = n, np.frombuffer(data.as_buffer(), np.int64)
                total = vector.copy() if total is None else total + vector
        if node is not None:
            yield out()

    nodes = 1 + (seen.agg(F.max("node").alias("n")).first().n or 0)
    vectors = seen.mapInArrow(dense, "node long, vector binary")
    while True:
        nodes = -(-nodes // FAN)
        vectors = vectors.withColumn("node", F.expr(f"node div {FAN}")).repartition(nodes, "node").sortWithinPartitions("node").mapInArrow(sums, "node long, vector binary")
        if nodes == 1:
            row = vectors.first()
            return np.frombuffer(row.vector, np.int64) if row else np.zeros(0, np.int64)


def _learned(docs: DataFrame, spec: str, model: bytes, ranked: bool) -> Alignment:
    seen = Scratch(docs.sparkSession).save(_seen(docs, spec, model, ranked))
    most = _vocabularies(spec, model).most_pairs()
    # Bounded by the vocabularies, not by the corpus.
    found = seen.select(F.explode("pairs").alias("pair")).distinct().limit(most + 1).toPandas().pair.to_numpy(np.int64)
    if len(found) > most:
        raise ValueError("more links than the vocabularies allow")
    pairs = PerfectHash(found)
    counts = _tree_sum(seen, pairs)
    second = pairs.keys & 0xFFFFFFFF
    highest = np.zeros(1 + (second.max() if len(second) else 0), np.int64)
    np.maximum.at(highest, second, counts)
    return Alignment(pairs, counts, counts == highest[second])


def pair_counts(docs: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """a, b, n, best: the links of every pair of ids over all texts, and whether they are the most that b has with any a."""
    spec = Path(tokenizer).read_text(encoding="utf-8")
    learned = _learned(docs, spec, Path(model).read_bytes(), in_merge_order(spec))
    keys = learned.pairs.keys
    table = pa.table({"a": keys >> 32, "b": keys & 0xFFFFFFFF, "n": learned.counts, "best": learned.best})
    return docs.sparkSession.createDataFrame(table)


def align(docs: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of every text.

    ``groups`` writes each group's ids as ``a1,a2|b1``, groups separated by ``;``. n_best counts the links whose pair has the
    most links, over all texts, that its second id has; count_sum adds up the links' counts. Null and empty texts,
    and texts whose tokens' bytes aren't a space and the text in either vocabulary (such as one that holds
    the meta symbol), have zeros and an empty string, and their tokens count nowhere. Repeated rows each count and each have
    a row; other columns are ignored; an empty table gives none. A text and its groups are held whole. Special
    strings inside texts are plain text. Both files are read on the driver and sent to the tasks, as are the
    pairs with their counts, whose number the vocabularies bound (some hundred thousand).
    """
    spec, data = Path(tokenizer).read_text(encoding="utf-8"), Path(model).read_bytes()
    ranked = in_merge_order(spec)
    sent = docs.sparkSession.sparkContext.broadcast(_learned(docs, spec, data, ranked))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, learned = Units(_vocabularies(spec, data, ranked), True), sent.value
        counts, best = np.append(learned.counts, 0), np.append(learned.best, False).astype(np.int64)  # the last entry is that of no pair
        sums = np.zeros((0, 7), np.int64)
        for part, own in _slices(batches, 1):
            found = units.of_texts(own)
            if len(sums) < len(units.number):
                before = int(sums[:, 2].sum())
                tokens, links = units.table()
                tokens, slots = tokens[len(sums) :], learned.pairs.slots(links[before:])
                past = np.cumsum(tokens[:, 2])
                added = [np.diff(np.concatenate([[0], np.cumsum(x)])[past], prepend=0) for x in (best[slots], counts[slots], (slots < 0).astype(np.int64))]
                sums = np.concatenate([sums, np.column_stack([tokens, tokens[:, 2], *added])])
            totals = np.array([sums[x].sum(axis=0) for x in found])
            if totals[:, 6].any():  # texts without tokens aside, the first pass saw the same links
                raise ValueError("a link that the first pass didn't see")
            groups = [";".join(map(units.groups.__getitem__, x.tolist())) for x in found]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(totals[:, i]) for i in range(6)), pa.array(groups, pa.string())], names)
            if units.full:
                units.clear()
                sums = sums[:0]

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ", ".join(f"{n} long" for n in names[:-1]) + ", groups string")
