"""MinHash near-duplicates from bottom-k sketches of one hash function.

1. Each text becomes its set of distinct five-word shingles; the set's size, a 128-bit
   fingerprint and its ``k`` least hashes (the bottom-k sketch) are kept. Equal sets collapse to
   one representative, so copies never meet as pairs.
2. Inverted lists of retained values. A pair at the threshold shares at least ``needed`` sketch
   values, so the rarest ``size - needed + 1`` of each sketch suffice to meet it (prefix filter over
   document frequency). Values of very common passages are rarely among these.
3. A list links its members to a hub, the member with the most shared values, not to each other.
   A member meets the hub it shares most lists with first, and others only while they are in another
   component. Pairs whose union-sketch estimate is far below the threshold go; the rest are verified on
   full sets.
4. Where members of one hub are still in different components, blocks of them are compared on full
   sets inside tasks, which return links only, so that no link is lost and no table of all pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewright.llm.components import components
from pacewright.llm.scratch import Scratch
from pacewright.llm.tokens import SPACE, U64, Chunk, chunks, mix

SHINGLE = 5
#: Values of a sketch, and the chance at which a linked pair may share fewer of them than are looked up.
K, MISSED = 64, 1e-9
NUMERATOR, DENOMINATOR = 3, 4
#: Shingles of a block (8 bytes each): two blocks are compared in a task. Keys that a hub's facts are dealt over.
BLOCK, SALTS = 1 << 19, 16
#: Rows up to which ids and pairs are sent to every executor (16 bytes each) to pick their texts.
BROADCAST_IDS = 1_000_000
_MULTIPLIERS = [pow(0xD1342543DE82EF95, j + 1, 1 << 64) for j in range(SHINGLE)]


def shingle_sets(chunk: Chunk) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer words than a shingle make one together."""
    h = chunk.hashes()
    n = len(h)
    rolled = np.zeros(n, U64)
    for j, m in enumerate(_MULTIPLIERS):
        rolled[: max(0, n - j)] += h[j:] * U64(m)
    rolled = mix(rolled)
    for a, b in zip(chunk.bounds[:-1], chunk.bounds[1:], strict=True):
        if b - a >= SHINGLE:
            s = np.sort(rolled[a : b - SHINGLE + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            short = sum((int(x) * m for x, m in zip(h[a:b], _MULTIPLIERS, strict=False)), int(b - a)) % (1 << 64)
            yield mix(np.array([short], U64))
        else:
            yield np.zeros(0, U64)


def _signed(x: np.ndarray) -> np.ndarray:
    """Unsigned order as signed order."""
    return (x ^ U64(1 << 63)).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(x) for x in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_shingles, fp1, fp2, sketch (ascending) of every document with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(1), SPACE):
                sets = list(shingle_sets(chunk))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[chunk.first : chunk.first + chunk.rows]),
                        pa.array(np.array([len(s) for s in sets], np.int64)),
                        pa.array(np.array([np.add.reduce(mix(s + U64(1)), dtype=U64) for s in sets], U64).view(np.int64)),
                        pa.array(np.array([np.add.reduce(mix(s ^ U64(0xA0761D6478BD642F)), dtype=U64) for s in sets], U64).view(np.int64)),
                        _lists([_signed(s[:k]) for s in sets]),
                    ],
                    ["doc_id", "n_shingles", "fp1", "fp2", "sketch"],
                )

    schema = "doc_id long, n_shingles long, fp1 long, fp2 long, sketch array<long>"
    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The columns of ``asked`` (rep first) and the whole sorted set of each of its documents, last."""
    few = asked.count() <= BROADCAST_IDS
    names = asked.columns
    docs = docs.withColumnRenamed("doc_id", "rep").join(F.broadcast(asked) if few else asked, "rep").select("text", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0), SPACE):
                rest = [x.slice(chunk.first, chunk.rows) for x in batch.columns[1:]]
                yield pa.RecordBatch.from_arrays([*rest, _lists([_signed(s) for s in shingle_sets(chunk)])], [*names, "shingles"])

    return docs.mapInArrow(run, ", ".join(f"{x} long" for x in names) + ", shingles array<long>")


@cache
def least_overlap(k: int) -> int:
    """The most values that linked sketches of k share but for one pair in ``1 / MISSED``: the tail of a binomial of k at the threshold."""
    share, tail = NUMERATOR / DENOMINATOR, 0.0
    for x in range(k + 1):
        tail += comb(k, x) * share**x * (1 - share) ** (k - x)
        if tail > MISSED:
            return max(1, x)
    return k


def needed(n: Column, k: int = K) -> Column:
    """Least number of values that the sketch of a set of n shingles shares with a linked one's."""
    whole = F.ceil(n * NUMERATOR / DENOMINATOR)  # both sketches are whole sets then
    return F.when(n * DENOMINATOR <= k * NUMERATOR, whole).otherwise(F.lit(least_overlap(k))).cast("int")


def _postings(reps: DataFrame, k: int) -> DataFrame:
    """v, rep, n, weight: the prefix of each sketch in order of rising document frequency."""
    values = reps.select("rep", "n", F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").cast("int").alias("df")).where("df > 1")
    met = values.join(shared, "v").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("met"))
    # values that no other sketch has come first in the order and need no list
    s = F.least(F.col("n"), F.lit(k))
    length = s - needed(F.col("n"), k) + 1 - (s - F.size("met"))
    prefix = F.filter("met", lambda x, i: i < length)
    return met.select("rep", "n", F.size("met").alias("weight"), F.explode(prefix).alias("x")).select(F.col("x.v").alias("v"), "rep", "n", "weight")


def _fits(a: str, b: str) -> Column:
    return (F.col(a) * DENOMINATOR >= F.col(b) * NUMERATOR) & (F.col(b) * DENOMINATOR >= F.col(a) * NUMERATOR)


def _verify(scratch: Scratch, pairs: DataFrame, reps: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The pairs (rep, hub) whose full sets are linked, after the union sketches' estimate has filtered them.

    Only a member's set is sent to its hub's partition, once a pair; the hub's set goes there once. AQE
    cuts the partition of a hub with many members and copies the hub's one row.
    """
    sides = reps.select("rep", "sketch")
    both = pairs.join(sides.toDF("rep", "sa"), "rep").join(sides.toDF("hub", "sb"), "hub")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    agreed = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    likely = scratch.save(both.where((agreed >= least_overlap(k)) | (F.size(union) < k) & (agreed * DENOMINATOR >= F.size(union) * NUMERATOR)).select("rep", "hub"))
    if likely.isEmpty():
        return likely.toDF("a", "b")
    members = full_sets(docs, likely).toDF("rep", "hub", "xa")
    hubs = full_sets(docs, likely.select(F.col("hub").alias("rep")).distinct()).toDF("hub", "xb")
    whole = members.join(hubs, "hub")
    common = F.size(F.array_intersect("xa", "xb"))
    return scratch.save(whole.where(common * DENOMINATOR >= (F.size("xa") + F.size("xb") - common) * NUMERATOR).select(F.col("rep").alias("a"), F.col("hub").alias("b")))


def _compare(cell: pa.Table) -> pa.Table:
    """The links between the left and the right rows of a cell that are in different components."""
    rep, c, left = (cell.column(x).to_numpy() for x in ("rep", "c", "left"))
    lists = cell.column("shingles").combine_chunks()
    values, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    a, b = [], []
    right = np.flatnonzero(~left)
    owner = np.repeat(np.arange(len(size)), size)
    order = np.argsort(values, kind="stable")
    ranked, owned = values[order], owner[order]
    for i in np.flatnonzero(left):
        own = values[offsets[i] : offsets[i + 1]]
        lo, hi = np.searchsorted(ranked, own, "left"), np.searchsorted(ranked, own, "right")
        span = hi - lo
        hits = np.repeat(lo - np.concatenate(([0], np.cumsum(span)[:-1])), span) + np.arange(span.sum())
        common = np.bincount(owned[hits], minlength=len(size))[right]
        linked = right[(common * DENOMINATOR >= (size[i] + size[right] - common) * NUMERATOR) & (c[right] != c[i])]
        a += [max(rep[i], rep[j]) for j in linked]
        b += [min(rep[i], rep[j]) for j in linked]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _blocks(scratch: Scratch, apart: DataFrame, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the members of a hub that are outside its component and all its members.

    The outsiders are dealt into blocks of about ``block`` shingles, all members too, and each pair of
    blocks is a cell, compared in one task: memory is bounded by two blocks and the longest text,
    whatever the number of a hub's members. What is known of a hub reaches its members over salted keys.
    """
    parted = apart.groupBy("hub", "c").agg(F.sum("n").alias("s"), F.bool_or(F.col("rep") == F.col("hub")).alias("own"))
    facts = parted.groupBy("hub").agg(F.max(F.when(F.col("own"), F.col("c"))).alias("hc"), F.sum("s").alias("all"), F.sum(F.when(~F.col("own"), F.col("s"))).alias("outer"))
    parts = lambda n: F.ceil(F.col(n) / block).cast("int")
    facts = facts.where("outer > 0").select("hub", "hc", parts("outer").alias("nl"), parts("all").alias("nr"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    rows = apart.select("hub", "rep", "c").withColumn("salt", salt(F.lit(SALTS))).join(facts, ["hub", "salt"]).drop("salt")
    own = [F.pmod(F.xxhash64("rep", F.lit(1)), F.col(n)).cast("int") for n in ("nl", "nr")]
    cell = lambda i, j, left: F.struct(i.alias("i"), j.alias("j"), F.lit(left).alias("left"))
    right = F.transform(F.sequence(F.lit(0), F.col("nl") - 1), lambda i: cell(i, own[1], False))
    left = F.transform(F.sequence(F.lit(0), F.col("nr") - 1), lambda j: cell(own[0], j, True))
    cells = F.explode(F.when(F.col("c") != F.col("hc"), F.concat(left, right)).otherwise(right)).alias("x")
    rows = scratch.save(rows.select("rep", "hub", "c", cells).select("rep", "hub", "c", "x.*"))
    if rows.isEmpty():
        return rows.select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    sets = full_sets(docs, rows.select("rep").distinct()).toDF("rep", "shingles")
    return scratch.save(rows.join(sets, "rep").groupBy("hub", "i", "j").applyInArrow(_compare, "a long, b long").distinct())


def _merged(scratch: Scratch, label: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after further links, found between the components so far."""
    if label is None:
        return scratch.save(components(scratch, links))
    if links.isEmpty():
        return label
    known = label.select("node", "component")
    ends = links.join(known.toDF("a", "ca"), "a", "left").join(known.toDF("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    over = components(scratch, ends)
    new = over.toDF("component", "top")
    lower = label.join(new, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return scratch.save(lower.unionByName(over.join(label.select("node"), "node", "left_anti")))


def near_duplicates(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Documents are linked where 4 * common shingles >= 3 * shingles of both; component_id is the least
    doc_id that links reach, kept says whether it is the document's own. Null or empty texts and texts
    without words have no shingles, keep themselves and are linked with nothing. Whole texts are read,
    however long: a text's set (8 bytes a word) must fit in a task. Rows that repeat a doc_id each have a
    row and share their links; rows without a doc_id are left out. An empty table gives an empty result;
    further columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select("doc_id", "text")
    base = scratch.save(sketches(docs, k))
    words = base.where("n_shingles > 0")
    # 1. equal sets
    same = words.groupBy("n_shingles", "fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    member = scratch.save(same.where("copies > 1").drop("copies"))
    copies = words.join(member, ["n_shingles", "fp1", "fp2"]).where("doc_id <> rep").select("doc_id")
    reps = words.join(copies, "doc_id", "left_anti").select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sketch")
    # 2. lists and their hubs
    lists = scratch.save(_postings(reps, k))
    score = F.struct(F.col("weight"), (-F.col("rep")).alias("neg"), F.col("n"))
    hubs = lists.groupBy("v").agg(F.max(score).alias("h")).select("v", (-F.col("h.neg")).alias("hub"), F.col("h.n").alias("m"))
    met = scratch.save(lists.join(hubs, "v").select("v", "hub", "m", "rep", "n"))
    # 3. each member and the hub that it shares most lists with, then its other hubs if they are still apart
    near = met.where((F.col("rep") != F.col("hub")) & _fits("n", "m")).groupBy("rep", "hub").agg(F.count("*").alias("lists"))
    near = scratch.save(near)
    best = near.groupBy("rep").agg(F.max(F.struct("lists", (-F.col("hub")).alias("neg"))).alias("x")).select("rep", (-F.col("x.neg")).alias("hub"))
    label = _merged(scratch, None, _verify(scratch, best, reps, docs, k))
    other = _apart(near.join(best, ["rep", "hub"], "left_anti").select("rep", "hub"), label)
    label = _merged(scratch, label, _verify(scratch, other, reps, docs, k))
    # 4. the members of a hub that are in different components
    labelled = met.select("v", "hub", "rep", "n").join(label.toDF("rep", "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    several = labelled.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("v")
    apart = scratch.save(labelled.join(several, "v", "left_semi").select("hub", "rep", "n", "c").distinct())
    label = _merged(scratch, label, _blocks(scratch, apart, docs))
    out = base.select("doc_id", "n_shingles", "fp1", "fp2").join(member, ["n_shingles", "fp1", "fp2"], "left")
    out = out.withColumn("rep", F.when(F.col("n_shingles") > 0, F.coalesce("rep", "doc_id")).otherwise(F.col("doc_id")))
    out = out.join(label.toDF("rep", "component_id"), "rep", "left").withColumn("component_id", F.coalesce("component_id", "rep"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs (rep, hub) whose ends are in different components."""
    ends = pairs.join(label.toDF("rep", "ca"), "rep", "left").join(label.toDF("hub", "cb"), "hub", "left")
    return ends.where(F.coalesce("ca", "rep") != F.coalesce("cb", "hub")).select("rep", "hub")


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents without those that another of their group, with a lower doc_id, stands for.

    Rows without a doc_id stay; rows that repeat a doc_id stay or go together. The ids that go are sent to
    every executor where they are few enough, counted first; else texts are dealt by doc_id.
    """
    gone = Scratch(docs.sparkSession).save(near_duplicates(docs).where("not kept").select("doc_id").distinct())
    few = gone.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
