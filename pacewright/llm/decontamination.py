"""Benchmark decontamination by spaced seeds, in Spark's own functions only.

A mask fixes some token positions and ignores others, so its hash survives a substitution at an
ignored position. Every position of every document is hashed under each mask and joined with the
hashed benchmark items; each hit aligns document and item on a diagonal. Hits are gathered to diagonals,
as bits of 64-bit words, before any token is looked at; then the tokens of documents with a hit are joined with
the items', position by position. A text's tokens move together at most once, if it has a hit. An item is found in a document when the matched positions, over all verified
diagonals, cover enough of it, or when the document quotes a long passage of it, however long the item
is. Items shorter than a mask are met as whole sequences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewright.llm.scratch import Scratch
from pacewright.llm.words import space_words

#: 1: the token counts; 0: any token may stand there.
MASKS = ("11011011", "111010011", "1100110101")
#: Tokens on either side of a hit that verify it, and how many of them must be equal.
REACH, LEAST_EQUAL = 8, 9
#: Share of an item's tokens that a document must have, in place, to contain it.
COVERAGE = 0.6
#: Equal tokens around one hit that are a find whatever the item's length. A run of so many is always seen
#: whole: its fifth token starts a hit of the shortest mask.
LONG_OVERLAP = 13
#: Bytes up to which the seeds of a benchmark, and its items' tokens, are sent to every executor; of a seed, and of a token beside its text.
BROADCAST_BYTES, SEED_BYTES, TOKEN_BYTES = 64 << 20, 48, 32
#: Ids up to which the documents with a leak are sent to every executor to be left out (16 bytes each).
BROADCAST_IDS = 1_000_000


def _seeds(tokens: Column, at: Column, whole: tuple[int, ...], items: bool) -> Column:
    """The hashes of one position under each mask that fits before the end; null under the others. ``whole``: lengths of items met as a whole."""
    found = []
    for m, mask in enumerate((*MASKS, *("1" * n for n in whole))):
        fixed = [F.get(tokens, at + j) for j, bit in enumerate(mask) if bit == "1"]
        fits = F.size(tokens) == len(mask) if items and m >= len(MASKS) else at + len(mask) <= F.size(tokens)
        found.append(F.when(fits, F.xxhash64(F.lit(m if m < len(MASKS) else len(MASKS) + len(mask)), *fixed)))
    return F.array(*found)


def _positions(table: DataFrame, whole: tuple[int, ...], items: bool, *keep: str) -> DataFrame:
    """One row per position and mask, with the seed's hash. Generated inside one code stage; the tokens go no further."""
    shortest = min(*map(len, MASKS), *whole)
    at = F.explode(F.when(F.size("tokens") >= shortest, F.sequence(F.lit(0), F.size("tokens") - shortest)))
    every = table.select(*keep, "tokens", at.alias("at"))
    return every.select(*keep, "at", F.explode(_seeds(F.col("tokens"), F.col("at"), whole, items)).alias("seed")).where("seed is not null")


#: Item positions that are a block's own, and those on either side that its 64-bit word holds as well.
OWN, BESIDE = 32, 16
_DIAGONAL = ("doc_id", "text_key", "tag", "n", "start")


def _bit(at: Column, block: Column) -> Column:
    """The bit of an item's position in a block's word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (at - block * OWN + BESIDE).cast("int"))


def _near(equal: Column, hit: Column) -> Column:
    """The most equal tokens within REACH of a hit of the block; null without a hit."""
    window = (1 << 2 * REACH + 1) - 1
    around = lambda p: F.bit_count(F.shiftrightunsigned(equal, p + BESIDE - REACH).bitwiseAND(F.lit(window).cast("long")))
    return F.greatest(*(F.when(F.shiftrightunsigned(hit, p + BESIDE).bitwiseAND(F.lit(1).cast("long")) == 1, around(p)) for p in range(OWN)))


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, n_item_words, n_matched, coverage, first_word of every item found in a document.

    Tokens are lower-case words between white space. first_word is where the item's first token stands
    or would stand in the document (the least one, if the item is found at several places). Coverage is
    below ``coverage`` where only a long passage of the item is quoted. Items of fewer tokens than the
    shortest mask are found word for word; items without a token are not; null texts and empty tables give no rows;
    equal items are each found, and texts that share an item_id have a row each; repeated rows of a
    document count once; rows without a doc_id or item_id are left out; other columns are ignored. Whole
    texts are searched: a text and the array of its words (some 40 bytes a word) must fit in a task.
    """
    scratch = Scratch(docs.sparkSession)
    items = benchmark.where("item_id is not null").select("item_id", space_words(F.lower("text")).alias("tokens")).distinct()
    items = scratch.save(items.withColumn("tag", F.xxhash64("item_id", "tokens")))
    length = F.size("tokens")
    short = items.where((length > 0) & (length < min(map(len, MASKS)))).select(length.alias("n")).distinct()
    whole = tuple(sorted(r.n for r in short.collect()))
    sized = items.withColumn("n", F.size("tokens"))
    seeds = scratch.save(_positions(sized, whole, True, "tag", "n").withColumnRenamed("at", "item_at"))
    words = items.select("tag", F.posexplode("tokens").alias("j", "token"))
    held = items.agg(F.sum(F.octet_length(F.array_join("tokens", "")) + TOKEN_BYTES * length).alias("n")).first().n or 0
    sent = lambda table, size: F.broadcast(table) if size <= BROADCAST_BYTES else table
    tokens = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("text_key"), space_words(F.lower("text")).alias("tokens"))
    none = F.lit(0).cast("long")
    block = F.floor(F.col("item_at") / OWN)
    hits = _positions(tokens, whole, False, "doc_id", "text_key").join(sent(seeds, seeds.count() * SEED_BYTES), "seed")
    hits = hits.withColumn("start", F.col("at") - F.col("item_at")).withColumn("block", block)
    hits = scratch.save(hits.groupBy(*_DIAGONAL, "block").agg(F.bit_or(_bit(F.col("item_at"), F.col("block"))).alias("hit")))
    # The tokens of the texts with a hit, each once, beside those that the items have on the hits' diagonals.
    hit_texts = hits.select("doc_id", "text_key").distinct()
    read = tokens.dropDuplicates(["doc_id", "text_key"]).join(sent(hit_texts, hit_texts.count() * TOKEN_BYTES), ["doc_id", "text_key"], "left_semi")
    read = read.select("doc_id", "text_key", F.posexplode("tokens").alias("at", "token"))
    wanted = hits.select(*_DIAGONAL).distinct().join(sent(words, held), "tag").withColumn("at", F.col("start") + F.col("j"))
    equal = wanted.where("at >= 0").join(read, ["doc_id", "text_key", "at", "token"]).select(*_DIAGONAL, "j")
    # An equal token is in its own block's word and in that of the block whose side it is on.
    side = F.floor((F.col("j") + BESIDE) / OWN)
    both = equal.withColumn("block", F.explode(F.array(side, side - 1)))
    every = both.select(*_DIAGONAL, "block", _bit(F.col("j"), F.col("block")).alias("equal"), none.alias("hit")).unionByName(hits.withColumn("equal", none))
    blocks = every.groupBy(*_DIAGONAL, "block").agg(F.bit_or("equal").alias("equal"), F.bit_or("hit").alias("hit"))
    near = F.max(_near(F.col("equal"), F.col("hit"))).over(Window.partitionBy(*_DIAGONAL))
    least = F.least(F.lit(LEAST_EQUAL), F.col("n") - F.floor(F.col("n") / 4))
    own = F.shiftrightunsigned("equal", BESIDE).bitwiseAND(F.lit((1 << OWN) - 1).cast("long"))
    verified = blocks.withColumn("near", near).where(F.col("near") >= least).withColumn("own", own)
    found = verified.groupBy("doc_id", "tag", "n", "block").agg(F.bit_or("own").alias("own"), F.min("start").alias("start"), F.max("near").alias("near"))
    found = found.groupBy("doc_id", "tag", F.col("n").cast("long").alias("n_item_words")).agg(F.sum(F.bit_count("own")).alias("n_matched"), F.min("start").cast("long").alias("first_word"), F.max("near").alias("near"))
    share = F.col("n_matched") / F.col("n_item_words")
    found = found.where((share >= coverage) | (F.col("near") >= LONG_OVERLAP))
    named = items.select("tag", "item_id")
    return found.join(sent(named, held), "tag").select("doc_id", "item_id", "n_item_words", "n_matched", share.alias("coverage"), "first_word")


def without_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents in which no benchmark item is found; rows without a doc_id stay."""
    leaks = Scratch(docs.sparkSession).save(contamination(docs, benchmark, coverage).select("doc_id").distinct())
    few = leaks.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(leaks) if few else leaks, "doc_id", "left_anti").select(*docs.columns)
