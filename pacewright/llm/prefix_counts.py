"""Exact token counts at every prefix of a text, for a byte-level merge vocabulary.

A sequence of tokens is what the merges make of its bytes if and only if any two neighbours are: no
merge across their border comes before the merges that take the border's symbols away. So a prefix's
last token is the one token that ends there and fits behind the last token of the prefix before it,
and its count is that prefix's count and one: dynamic programming over the bytes of a word, one
entry a byte, without encoding any prefix anew.

Before the merges a text is cut into words, and a prefix may be cut otherwise than the whole text:
white space before a word leaves it its last space, a contraction's first two characters are two words,
a part of a special string is plain text. A unit (white space and what follows up to the next) hides
all of this from its neighbours, so counts of units are remembered as differences and summed up.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice
from math import inf
from operator import sub
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pacewright.llm.pieces import _Memory

#: Prefixes of a row of the result.
BLOCK = 1 << 16
#: Remembered units and words of a worker, in two generations of so many each; longer ones than KEPT_CHARS aren't remembered.
REMEMBERED, KEPT_CHARS = 200_000, 40
#: Remembered prefixes of words (about 120 bytes each), and a number above all ids, to number pairs.
NODES, _IDS = 800_000, 1 << 20
#: First bytes of a word whose way through the tree is remembered.
HEADS, _ROOT = (9, 5), [0]
#: Characters up to which a text's units are listed at once; of a longer one so many units are summed up at once.
LISTED_CHARS, UNITS_AT_ONCE = 1 << 20, 100_000
#: Unicode's white space, as the pattern of the vocabulary's word cutter has it.
WHITE = "\t-\r \x85\xa0  -     　"
_UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_LEADING = re.compile(f"[{WHITE}]*")
#: The word cutter's pattern, for characters below STABLE only: there all versions of Unicode agree on letters and digits.
_WORD = regex.compile(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+")
STABLE = "\u0530"
#: Contractions of three characters that the word cutter knows; their first two characters alone are two words.
_CONTRACTIONS = frozenset(("'re", "'ve", "'ll"))


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies write a printable Latin-1 byte as itself, and the others as the letters from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(0x100 + n): b for n, b in enumerate(others)}


class Merges:
    """A merge vocabulary: token bytes and ids, and which tokens may stand side by side."""

    def __init__(self, model: dict):
        letters = _bytes_of_letters()
        raw = lambda piece: bytes(map(letters.__getitem__, piece))
        self.ids = {raw(piece): i for piece, i in model["vocab"].items() if all(c in letters for c in piece)}
        self.ranks: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (self.ids[raw(x)] for x in (merge if isinstance(merge, list) else merge.split(" ")))
            self.ranks[left, right] = rank
            made = self.ids[raw("".join(merge if isinstance(merge, list) else merge.split(" ")))]
            parts.setdefault(made, (rank, left, right))
        self.parts = parts
        self._right, self._left = {}, {}
        self.neighbours = _Memory(self._fit, 400_000)
        self._forget()
        self._drop_unreachable()
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("a byte without a token")
        #: Ends of tokens: a run of bytes that is none of them ends no token.
        self.tails = {t[i:] for t in self.ids for i in range(len(t))}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols that stand at one edge of a token as it is merged, from a byte up, each with the rank of the merge that takes it away."""
        known = (self._left, self._right)[side]
        if token not in known:
            if token not in self.parts:
                known[token] = [(token, inf)]
            else:
                rank, *halves = self.parts[token]
                below = self._spine(halves[side], side)
                known[token] = [*below[:-1], (below[-1][0], rank), (token, inf)]
        return known[token]

    def _crossing(self, left: int, right: int) -> tuple[float, int, int] | None:
        """The first merge across the border of two tokens: its rank and the two symbols; None if there is none."""
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (x, x_gone), (y, y_gone) = a[i], b[j]
            rank = self.ranks.get((x, y))
            if rank is not None and rank < x_gone and rank <= y_gone:  # of equal merges the left one comes first
                return rank, x, y
            if x_gone == y_gone == inf:
                return None
            if x_gone <= y_gone:
                i += 1
            else:
                j += 1

    def _fit(self, pair: int) -> bool:
        return self._crossing(*divmod(pair, _IDS)) is None

    def _drop_unreachable(self) -> None:
        """Leave out tokens whose own bytes the merges make into something else."""
        whole = {}
        for token, (rank, left, right) in sorted(self.parts.items(), key=lambda x: x[1][0]):
            whole[token] = whole.get(left, True) and whole.get(right, True) and self._crossing(left, right) == (rank, left, right)
        self.ids = {b: i for b, i in self.ids.items() if len(b) == 1 or whole.get(i, False)}

    def counts(self, data: bytes) -> array:
        """Tokens of data[:n] for n from 0 to the whole."""
        counts, last = array("i", [0]), array("i", [-1])
        id_of, tails, fits = self.ids.get, self.tails, self.neighbours
        for end in range(1, len(data) + 1):
            start = end
            while True:
                start -= 1
                token = data[start:end]
                found = id_of(token)
                if found is not None:
                    if not start or fits[last[start] * _IDS + found]:
                        break
                elif token not in tails:
                    raise ValueError("no token fits behind the one before it")
            counts.append(counts[start] + 1)
            last.append(found)
        return counts

    def counts_of_word(self, data: bytes) -> list[int]:
        """The same for a word, whose prefixes other words may share: each is worked out once, until NODES are known."""
        if len(self.count_at) > NODES:
            self._forget()
        after, counts, last, id_of, fits = self.after, self.count_at, self.last_at, self.ids.get, self.neighbours
        path = self.heads.get(data[:HEADS[0]]) or self.heads.get(data[:HEADS[1]], _ROOT)
        known, path, end = len(path), path[:], len(path)
        node = path[-1]
        for byte in data[known - 1 :]:
            step = node << 8 | byte
            node = after.get(step)
            if node is None:
                start = end - 1
                found = id_of(data[start:end])
                while found is None or start and not fits[last[path[start]] * _IDS + found]:
                    start -= 1
                    found = id_of(data[start:end])
                node = after[step] = len(counts)
                counts.append(counts[path[start]] + 1)
                last.append(found)
            path.append(node)
            end += 1
        for n in HEADS:
            if known <= n < end:
                self.heads[data[:n]] = path[: n + 1]
        return [counts[n] for n in path]

    def _forget(self) -> None:
        """Prefixes of words as a tree: what follows a node by a byte, each node's count and last token, and the nodes along a word's first bytes."""
        self.heads: dict[bytes, list[int]] = {}
        self.after, self.count_at, self.last_at = {}, array("i", [0]), array("i", [-1])


class PrefixCounter:
    """Counts at the prefixes of whole texts, as the library counts them by default: special strings are one token each."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        before, model = parsed["pre_tokenizer"], parsed["model"]
        plain = before == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} | {k: before[k] for k in before.keys() & {"trim_offsets"}}
        if not plain or parsed["normalizer"] or model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("not a plain byte-level merge vocabulary")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in parsed["added_tokens"]):
            raise ValueError("special strings that take in their surroundings")
        self.merges = Merges(model)
        self.cut = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
        special = sorted((t["content"] for t in parsed["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.words = _Memory(self._steps, REMEMBERED)
        self.units = _Memory(self._differences, REMEMBERED)

    def _word(self, word: str) -> list[int] | array:
        """Counts at the prefixes of one word, from one character to all."""
        data = word.encode()
        counts = self.merges.counts_of_word(data) if len(word) <= KEPT_CHARS else self.merges.counts(data)
        if len(data) != len(word):
            counts = [counts[n] for n in range(len(data) + 1) if n in (0, len(data)) or data[n] & 0xC0 != 0x80]
        counts = counts[1:]
        if word in _CONTRACTIONS:
            counts[1] = counts[0] + self._word(word[1])[0]
        return counts

    def _steps(self, word: str) -> bytes:
        """What each character of a word adds to the count."""
        counts = self._word(word)
        return array("i", map(sub, counts, chain((0,), counts))).tobytes()

    def _counts_of(self, word: str) -> array:
        return array("i", accumulate(array("i", self.words[word]))) if len(word) <= KEPT_CHARS else array("i", self._word(word))

    def unit(self, unit: str) -> array:
        """Counts at the prefixes of white space and what follows it, from one character to all."""
        white = _LEADING.match(unit).end()
        counts = self._counts_of(unit[:white]) if white else array("i")
        if white == len(unit):
            return counts
        base = counts[white - 2] if white > 1 else 0
        with_space = white > 0 and unit[white - 1] == " "
        if white and not with_space:
            base += self._counts_of(unit[white - 1])[-1]
        rest = unit[white - with_space :]
        words = _WORD.findall(rest) if max(rest) < STABLE else [rest[start:end] for _, (start, end) in self.cut(rest)]
        for n, word in enumerate(words):
            own = self._counts_of(word)
            if with_space and n == 0:
                own = own[1:]
            counts.extend(own if not base else [base + n for n in own])
            base = counts[-1]
        return counts

    def _differences(self, unit: str) -> bytes:
        if len(unit) <= KEPT_CHARS and max(unit) < STABLE:
            white = _LEADING.match(unit).end()
            if white < 2:  # nothing before the last white space that a word could take away
                alone = white and unit[0] != " "
                return b"".join(map(self.words.__getitem__, [unit[0], *_WORD.findall(unit[1:])] if alone else _WORD.findall(unit) or [unit]))
        counts = self.unit(unit)
        return array("i", map(sub, counts, chain((0,), counts))).tobytes()

    def _plain(self, text: str) -> Iterator[bytes]:
        if len(text) <= LISTED_CHARS:
            units, of_unit = _UNIT.findall(text), self.units.__getitem__
            if max(map(len, units), default=0) <= KEPT_CHARS:
                yield b"".join(map(of_unit, units))
                return
        else:
            units = (m.group() for m in _UNIT.finditer(text))
        for unit in units:
            yield self.units[unit] if len(unit) <= KEPT_CHARS else self._differences(unit)

    def differences(self, text: str) -> Iterator[bytes]:
        """What each character adds to the count of the prefix before it, as runs of 32-bit integers."""
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        for n, part in enumerate(parts):
            if n % 2 == 0:
                yield from self._plain(part)
                continue
            # A part of the special string is plain text behind the last unit; the whole is one token.
            *_, before = chain([""], (m.group() for m in _UNIT.finditer(parts[n - 1])))
            counts = self.unit(before + part[:-1]) if len(before + part) > 1 else array("i")
            now = counts[len(before) - 1] if before else 0
            yield np.diff(np.array([now, *counts[len(before) :], now + 1], np.int32)).tobytes()

    def counts(self, text: str) -> Iterator[np.ndarray]:
        """Counts at the prefixes of one character and more, in order, in several arrays."""
        runs, base = self.differences(text), 0
        while some := b"".join(islice(runs, UNITS_AT_ONCE)):
            counts = np.frombuffer(some, np.int32).cumsum(dtype=np.int32) + np.int32(base)
            base = counts[-1]
            yield counts


@lru_cache(2)
def counter(spec: str) -> PrefixCounter:
    """Made once in each worker, which keeps it between tasks."""
    return PrefixCounter(spec)


def _blocks(runs: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """The counts of all prefixes, the empty one first, in arrays of BLOCK entries; the last may be shorter."""
    held = np.zeros(1, np.int32)
    for run in runs:
        held = np.concatenate([held, run])
        while len(held) > BLOCK:
            yield held[:BLOCK]
            held = held[BLOCK:]
    yield held


def prefix_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, row, block, counts, and on a text's last row n_bytes, n_chars and n_tokens.

    ``counts`` holds the tokens of the text's first block * BLOCK, block * BLOCK + 1, ... characters (code
    points), the empty prefix first. Each count is that of the prefix encoded by itself, so it may fall
    from one prefix to the next. ``row`` tells rows of the input apart that share a doc_id (null too);
    it is fixed for a table that is read, not for one whose rows come in another order when computed again. A null text is an empty one: one row, count 0.
    Special strings inside a text are one token, as the library has them by default. Other columns are
    ignored; an empty table gives none. A text is held whole, its counts a block at a time; the longest
    word without white space takes eight bytes a byte. ``tokenizer`` is the vocabulary's file, read on the driver.
    """
    spec = Path(tokenizer).read_text(encoding="utf-8")
    names = ["doc_id", "row", "block", "counts", "n_bytes", "n_chars", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(spec)
        rows, size = [], 0

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            offsets = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(c) for c in cols[3]], out=offsets[1:])
            counts = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(cols[3])))
            return pa.RecordBatch.from_arrays([*(pa.array(cols[i], pa.int64()) for i in range(3)), counts, *(pa.array(cols[i], pa.int64()) for i in range(4, 7))], names)

        for batch in batches:
            for doc_id, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.as_py() or ""
                block = 0
                for counts in _blocks(count.counts(text)):
                    if rows and size + len(counts) > 16 * BLOCK:
                        yield flush()
                        rows, size = [], 0
                    last = block * BLOCK + len(counts) > len(text)
                    rows.append((doc_id, row, block, counts, *((len(text.encode()), len(text), int(counts[-1])) if last else (None,) * 3)))
                    size += len(counts)
                    block += 1
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, block long, counts array<int>, n_bytes long, n_chars long, n_tokens long"
    )


def totals(prefixes: DataFrame, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text."""
    return prefixes.where("n_tokens is not null").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def counts_at(prefixes: DataFrame, asked: DataFrame) -> DataFrame:
    """doc_id, row, n_chars, n_tokens for every (doc_id, n_chars) of ``asked``: tokens of a text's first n_chars characters.

    A question about more characters than a text has, fewer than none, or an unknown or null document has
    no row; a question asked twice is answered twice, and once for each text of its doc_id.
    """
    where = asked.where("n_chars >= 0").select("doc_id", F.col("n_chars").cast("long").alias("n_chars")).withColumn("block", F.expr(f"n_chars div {BLOCK}"))
    entry = F.get("counts", (F.col("n_chars") % BLOCK).cast("int"))
    return prefixes.select("doc_id", "row", "block", "counts").join(where, ["doc_id", "block"]).select("doc_id", "row", "n_chars", entry.cast("long").alias("n_tokens")).where("n_tokens is not null")


def longest_within(prefixes: DataFrame, budget: int) -> DataFrame:
    """doc_id, row, n_chars, n_tokens: the longest prefix of every text of at most ``budget`` tokens, and its tokens; of a negative budget none."""
    at = F.array_max(F.filter(F.sequence(F.lit(0), F.size("counts") - 1), lambda i: F.get("counts", i) <= budget))
    fits = prefixes.select("doc_id", "row", "block", at.alias("at"), F.get("counts", at).cast("long").alias("n_tokens")).where("at is not null")
    n_chars = F.col("block") * BLOCK + F.col("at")
    best = F.max(F.struct(n_chars.alias("n_chars"), "n_tokens")).alias("best")
    return fits.groupBy("doc_id", "row").agg(best).select("doc_id", "row", "best.n_chars", "best.n_tokens")
