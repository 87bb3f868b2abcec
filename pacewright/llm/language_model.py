"""Language-model scores: prediction by partial matching over bytes, beside a word-frequency base.

One pass over the training documents counts words and windows of five bytes. The context trie of
orders 4 to 0 follows from the windows; nothing of it is pruned, whatever the corpus. A symbol that the
longest known context has is coded there; else an escape (method C) leads to the next shorter one, where
the symbols of the longer one are excluded, down to a uniform choice. The model is pretrained: a
document's score doesn't depend on other documents or on order.

The trie stays in tables. The most frequent windows (2^20 at most) are looked up in the task; each
document's other windows are joined with the table of values, and those that training never had get theirs
by joins with the shorter orders. What is looked up in the task changes no result.

Words: those with at least a 2^17th of all occurrences (at most 2^17 words, by arithmetic) are
looked up in the task; each document's other words are joined with the table of counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pacewright.llm.scratch import Scratch
from pacewright.llm.tokens import SPACE, Chunk, chunks

ORDER = 4
WORD_BITS = 17
#: Windows that a task holds at most; any number gives the same scores.
HELD_WINDOWS = 1 << 20
#: Bytes up to which the whole trie may be built in one process.
SMALL = 1 << 20
#: Additive smoothing of the base.
ADDED = 0.1
WORD, GRAM = 0, 1
#: The end of a text: a byte that UTF-8 never has, and a word hash set aside for it.
END_BYTE, END_WORD = 0xFF, np.int64(0)
_BEFORE = ord("\n")
#: Distinct keys that a task gathers before it passes them on.
GATHERED = 1 << 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _words(chunk: Chunk) -> np.ndarray:
    h = chunk.hashes().view(np.int64)
    h[h == END_WORD] = 1
    return h


def _windows(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """The five bytes up to each byte and each text's end, as numbers, and the rows' first ones. Line ends stand before a text."""
    size = np.diff(chunk.offsets)
    row = np.repeat(np.arange(chunk.rows), size)
    padded = np.full(len(chunk.data) + (ORDER + 1) * chunk.rows, _BEFORE, np.uint8)
    padded[np.arange(len(chunk.data)) + (ORDER + 1) * row + ORDER] = chunk.data
    ends = chunk.offsets[1:] + (ORDER + 1) * np.arange(1, chunk.rows + 1) - 1
    padded[ends] = END_BYTE
    keys = np.zeros(len(padded) - ORDER if len(padded) else 0, np.int64)
    for j in range(ORDER + 1):
        keys = (keys << 8) | padded[j : len(padded) - ORDER + j]
    keep = np.ones(len(keys), bool)
    keep[(ends[:-1, None] + 1 - ORDER + np.arange(ORDER)).ravel()] = False  # windows that end in the next text's padding
    return keys[keep], chunk.offsets[:-1] + np.arange(chunk.rows)


class _Tally:
    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        if len(self.parts) >= 16:
            self.parts = [self._merged()]

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, where = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        return keys, np.bincount(where, np.concatenate([n for _, n in self.parts]), len(keys)).astype(np.int64)

    def take(self, kind: int) -> pa.RecordBatch:
        keys, n = self._merged()
        self.parts = []
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], ["kind", "key", "n"])

    @property
    def full(self) -> bool:
        return sum(len(k) for k, _ in self.parts) >= GATHERED


def counts(texts: DataFrame) -> DataFrame:
    """kind, key, n: how often each word (by hash) and each window of bytes occurs in the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {WORD: _Tally(), GRAM: _Tally()}
        for batch in batches:
            for chunk in chunks(batch.column(0), SPACE):
                tallies[WORD].add(np.concatenate((_words(chunk), np.full(chunk.rows, END_WORD))))
                tallies[GRAM].add(_windows(chunk)[0])
            for kind, tally in tallies.items():
                if tally.full:
                    yield tally.take(kind)
        for kind, tally in tallies.items():
            yield tally.take(kind)

    return texts.select("text").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """The contexts of one order, sorted, with their symbols: keys are context * 256 + symbol."""

    keys: np.ndarray
    n: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    below: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of its symbols in the next shorter context


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


@dataclass
class Trie:
    """The model in one process, for small tables: what the tables of ``_values`` and ``_escaped`` say."""

    levels: list[Level]  # by order

    @staticmethod
    def build(nodes: DataFrame) -> Trie:
        """From (level, key, n) of the symbols of every order."""
        got = nodes.toPandas()
        levels = []
        for k in range(ORDER + 1):
            own = got[got.level == k].sort_values("key")
            keys, n = own.key.to_numpy(np.int64), own.n.to_numpy(float)
            contexts, first = np.unique(keys >> 8, return_index=True)
            total = np.add.reduceat(n, first) if len(first) else np.zeros(0)
            distinct = np.diff(np.append(first, len(keys))).astype(float)
            level = Level(keys, n, contexts, total, distinct)
            if k:
                low = levels[k - 1]
                mask = (1 << 8 * k) - 1
                level.below = np.bincount(np.searchsorted(contexts, keys >> 8), low.n[_find(low.keys, keys & mask)], len(contexts)) if len(keys) else np.zeros(0)
            levels.append(level)
        return Trie(levels)

    def log10(self, windows: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each window after the others."""
        out = np.zeros(len(windows))
        todo = np.arange(len(windows))
        over = np.full(len(windows), -1)  # the context one order above, if known
        for k in range(ORDER, -1, -1):
            level = self.levels[k]
            keys = windows[todo] & ((1 << 8 * (k + 1)) - 1)
            at = _find(level.contexts, keys >> 8)
            known, above = at >= 0, over[todo]
            total, distinct = (np.where(known, x[at] if len(x) else 0.0, 0.0) for x in (level.total, level.distinct))
            if k < ORDER and len(self.levels[k + 1].contexts):
                higher = self.levels[k + 1]
                total = total - np.where(above >= 0, higher.below[above], 0)
                distinct = distinct - np.where(above >= 0, higher.distinct[above], 0)
            escape = np.maximum(1.0, distinct)
            symbol = _find(level.keys, keys)
            found = known & (symbol >= 0)
            out[todo[found]] += np.log10(level.n[symbol[found]] / (total[found] + escape[found]))
            lost = known & ~found
            out[todo[lost]] += np.log10(escape[lost] / (total[lost] + escape[lost]))
            over[todo] = at
            todo = todo[~found]
        left = 256 - (self.levels[0].distinct[0] if len(self.levels[0].contexts) else 0)
        out[todo] -= np.log10(max(1, left))
        return out


def _nodes(grams: DataFrame, total: int) -> DataFrame:
    """level, key, n: the symbols of every order, for a ``Trie``."""
    if total > SMALL:
        raise ValueError(f"{total} bytes are too many for a trie in one process")
    level = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), _low("key", k).alias("key")) for k in range(ORDER + 1)))).alias("x")
    return grams.select(level, "n").groupBy("x.level", "x.key").agg(F.sum("n").alias("n"))


def _low(key: str, k: int) -> Column:
    """The context of order k and the symbol of a window."""
    return F.col(key).bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))


def _values(grams: DataFrame) -> DataFrame:
    """key, n, value: log10 of the probability of every window that training has; all are coded at the longest order."""
    context = W.partitionBy(F.shiftright("key", 8))
    return grams.select("key", "n", F.log10(F.col("n") / (F.sum("n").over(context) + F.count("*").over(context))).alias("value"))


def _escaped(grams: DataFrame, asked: DataFrame, scratch: Scratch) -> DataFrame:
    """key, value of the asked windows, none of which training has: escapes down to the order that has the symbol."""
    nodes = {ORDER: grams.select("key", "n")}
    for k in range(ORDER - 1, -1, -1):
        nodes[k] = scratch.save(nodes[k + 1].groupBy(_low("key", k).alias("key")).agg(F.sum("n").alias("n")))
    fixed = lambda table, most: F.broadcast(table) if most <= 1 << 16 else table
    found = asked.select("key")
    for k in range(ORDER, -1, -1):
        symbols = nodes[k].withColumn("low", F.lit(0))
        if k:
            shorter = nodes[k - 1].select(F.col("key").alias("at"), F.col("n").alias("low"))
            symbols = nodes[k].withColumn("at", _low("key", k - 1)).join(fixed(shorter, 256**k), "at")
        contexts = symbols.groupBy(F.shiftright("key", 8).alias(f"c{k}")).agg(F.sum("n").alias(f"total{k}"), F.count("*").alias(f"distinct{k}"), F.sum("low").alias(f"below{k}"))
        found = found.withColumn(f"c{k}", F.shiftright(_low("key", k), 8)).join(fixed(contexts, 256**k), f"c{k}", "left").drop(f"c{k}")
        if k < ORDER:
            own = nodes[k].select(F.col("key").alias(f"s{k}"), F.col("n").alias(f"n{k}"))
            found = found.withColumn(f"s{k}", _low("key", k)).join(fixed(own, 256 ** (k + 1)), f"s{k}", "left").drop(f"s{k}")
    value, open_ = F.lit(0.0), F.lit(True)
    for k in range(ORDER, -1, -1):
        over = [F.coalesce(f"{x}{k + 1}", F.lit(0)) if k < ORDER else F.lit(0) for x in ("below", "distinct")]
        total, escape = F.col(f"total{k}") - over[0], F.greatest(F.lit(1), F.col(f"distinct{k}") - over[1])
        has = F.col(f"n{k}").isNotNull() if k < ORDER else F.lit(False)
        coded = F.log10(F.when(has, F.col(f"n{k}") if k < ORDER else F.lit(0)).otherwise(escape) / (total + escape))
        value = value + F.when(open_ & F.col(f"total{k}").isNotNull(), coded).otherwise(0.0)
        open_ = open_ & ~has
    left = F.greatest(F.lit(1), 256 - F.coalesce("distinct0", F.lit(0)))
    return found.select("key", (value - F.when(open_, F.log10(left)).otherwise(0.0)).alias("value"))


def _held(values: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, sorted, and values of the most frequent windows: whole classes of counts, while they fit."""
    classed = values.withColumn("size", F.floor(F.log2("n") * 4))
    least, held = None, 0
    for r in sorted(classed.groupBy("size").agg(F.count("*").alias("keys")).collect(), key=lambda r: -r["size"]):
        held += r["keys"]
        if held > most:
            break
        least = r["size"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0)
    got = classed.where(F.col("size") >= least).select("key", "value").toPandas().sort_values("key")
    return got.key.to_numpy(np.int64), got.value.to_numpy(float)


def _by_row(keys: np.ndarray, rows: np.ndarray, n: int) -> pa.ListArray:
    """Each row's distinct keys and how often it has them."""
    order = np.lexsort((keys, rows))
    key, row = keys[order], rows[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(key) != 0) | (np.diff(row) != 0)))[: len(key)])
    offsets = np.searchsorted(row[first], np.arange(n + 1)).astype(np.int32)
    times = pa.array(np.diff(np.append(first, len(key))).astype(np.int64))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(key[first]), times], ["key", "times"]))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability) of every row.

    Learns from rows whose doc_id isn't held out (a row without doc_id is learnt from). A null text is
    empty: its only token is the end. Equal rows count and are scored each. Where nothing is learnt,
    N and V are 0 and bytes are uniform. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    seen = scratch.save(counts(docs.where(~held_out(F.col("doc_id")))))
    words = seen.where(F.col("kind") == WORD)
    size = seen.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    n_words, vocabulary = next(((r.n, r.v) for r in size if r.kind == WORD), (0, 0))
    grams = scratch.save(_values(seen.where(F.col("kind") == GRAM)))
    held_keys, held_values = _held(grams, HELD_WINDOWS)
    frequent = words.where(F.col("n") * (1 << WORD_BITS) >= F.lit(n_words)).select("key", "n").toPandas().sort_values("key")
    frequent_keys, frequent_n = frequent.key.to_numpy(np.int64), frequent.n.to_numpy(float)
    below = n_words + ADDED * (vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), SPACE):
                n = chunk.rows
                tokens, rows = _words(chunk), chunk.word_rows()
                tokens, rows = np.concatenate((tokens, np.full(n, END_WORD))), np.concatenate((rows, np.arange(n)))
                at = _find(frequent_keys, tokens)
                known = at >= 0
                base = np.bincount(rows[known], np.log10((frequent_n[at[known]] + ADDED) / below), n)
                windows, starts = _windows(chunk)
                distinct, where = np.unique(windows, return_inverse=True)
                held = _find(held_keys, distinct)
                values = np.where(held >= 0, held_values[held] if len(held_values) else 0.0, 0.0)
                other = np.flatnonzero((held < 0)[where])
                other_rows = np.searchsorted(starts, other, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, n),
                        pa.array(chunk.counts + 1),
                        pa.array(np.bincount(rows[known], minlength=n)),
                        pa.array(base),
                        pa.array(np.add.reduceat(values[where], starts)),
                        _by_row(tokens[~known], rows[~known], n),
                        _by_row(windows[other], other_rows, n),
                    ],
                    ["doc_id", "n_tokens", "n_known", "base", "score", "rare", "other"],
                )

    listed = "array<struct<key:long,times:long>>"
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_tokens long, n_known long, base double, score double, rare {listed}, other {listed}")
    scored = scratch.save(scored.withColumn("row", F.monotonically_increasing_id()))
    rare, other = (scored.select("row", F.explode(x).alias("x")).select("row", "x.key", "x.times") for x in ("rare", "other"))
    strange = scratch.save(other.select("key").distinct().join(grams, "key", "left_anti"))
    values = grams.select("key", "value")
    if not strange.isEmpty():
        values = values.unionByName(_escaped(grams, strange, scratch))
    met = rare.join(words.select("key", "n"), "key", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    met = met.select("row", F.when(F.col("c") > 0, F.col("times")).alias("more"), (F.col("times") * F.log10((F.col("c") + ADDED) / F.lit(float(below)))).alias("rest"), F.lit(0.0).alias("coded"))
    coded = other.join(values, "key").select("row", F.lit(None).cast("long").alias("more"), F.lit(0.0).alias("rest"), (F.col("times") * F.col("value")).alias("coded"))
    met = met.unionByName(coded).groupBy("row").agg(*(F.sum(x).alias(x) for x in ("more", "rest", "coded")))
    return scored.drop("rare", "other").join(met, "row", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_words).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("coded", F.lit(0.0))).alias("score"),
    )
