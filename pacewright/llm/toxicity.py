"""Toxic passages as maximum-scoring segments of token log-odds.

Training: for every hash bucket of tokens, in how many toxic and clean documents it occurs; the
log-odds ratio under a symmetric Dirichlet prior, taken at its lower confidence bound, is the
token's score, less a drift that makes neutral text fall. Scoring: the linear-time scan of Ruzzo
and Tompa finds all maximal segments; a segment of score S in n tokens of clean text is expected
K n exp(-lambda S) times (Karlin and Altschul), lambda from the clean tokens' distribution, K from
the segments of clean documents. A document's evidence is the sum over its significant segments,
and becomes a probability by isotonic regression on the training labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pacewright.llm.scratch import Scratch
from pacewright.llm.tokens import NOT_ALNUM, U64, Chunk, chunks

#: The model's size is fixed: tokens share 2^18 buckets. Exact tokens were tried and are worse: of the held-out labels
#: of check_s (543 toxic, 4556 clean) buckets find 534 and reject 27 clean ones, exact tokens 523 and 71, since
#: rare tokens then pass the bound by chance.
BUCKET_BITS = 18
#: Labelled documents used for training, the first in hash order of their ids.
TRAINING_ROWS = 50_000
PRIOR, CONFIDENCE, DRIFT, MOST = 0.5, 2.58, 0.4, 8.0
#: Evidence (natural-log units) is calibrated in bins of this width up to a last, open one.
BIN, BINS = 0.5, 121
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    scores: np.ndarray  # by bucket
    decay: float  # lambda
    log_k: float
    probability: np.ndarray  # by bin of evidence, rising


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _buckets(chunk: Chunk) -> np.ndarray:
    return (chunk.hashes() >> U64(64 - BUCKET_BITS)).astype(np.int64)


def maximal_segments(runs: list[tuple[int, int, float, float]]) -> list[tuple[int, int, float]]:
    """Ruzzo and Tompa over runs (first, past the last, sum before, sum after) of positive scores: (first, past, score)."""
    kept: list[tuple[int, int, float, float]] = []
    before: list[int] = []  # for each kept one, the nearest earlier one whose left sum is smaller
    for first, past, left, right in runs:
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= left:
                j = before[j]
            if j < 0 or kept[j][3] >= right:
                break
            first, left = kept[j][0], kept[j][2]
            del kept[j:], before[j:]
            j = len(kept) - 1
        kept.append((first, past, left, right))
        before.append(j)
    return [(a, b, r - s) for a, b, s, r in kept]


def _segments(chunk: Chunk, scores: np.ndarray) -> dict[int, list[tuple[int, int, float]]]:
    """The maximal segments of each row that has one, in words from the row's first."""
    s = scores[_buckets(chunk)]
    sums = np.concatenate(([0.0], np.cumsum(s)))
    at = np.flatnonzero(s > 0)
    if not len(at):
        return {}
    rows = np.searchsorted(chunk.bounds, at, "right") - 1
    new = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(rows) > 0)))
    starts, pasts = at[new], np.concatenate((at[np.flatnonzero(new)[1:] - 1], at[-1:])) + 1
    by_row: dict[int, list[tuple[int, int, float, float]]] = {}
    for row, a, b in zip(rows[new].tolist(), starts.tolist(), pasts.tolist(), strict=True):
        by_row.setdefault(row, []).append((a, b, float(sums[a]), float(sums[b])))
    return {row: [(a - int(chunk.bounds[row]), b - int(chunk.bounds[row]), x) for a, b, x in maximal_segments(runs)] for row, runs in by_row.items()}


def _evidence(segments: list[tuple[int, int, float]], n: int, decay: float, log_k: float) -> list[float]:
    """-ln of how often clean text of n words has so good a segment, for the significant ones (once in 20 texts at most)."""
    return [max(0.0, decay * s - log_k - np.log(n)) for _, _, s in segments]


def _count(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents of each class (clean, toxic) with a token in each bucket; words and documents of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        words, documents = np.zeros(2, np.int64), np.zeros(2, np.int64)
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(0), NOT_ALNUM):
                kind = toxic[chunk.first : chunk.first + chunk.rows]
                keys = np.unique((chunk.word_rows() << BUCKET_BITS) | _buckets(chunk))
                for c in (0, 1):
                    own = keys[kind[keys >> BUCKET_BITS] == c] & ((1 << BUCKET_BITS) - 1)
                    seen[c] += np.bincount(own, minlength=1 << BUCKET_BITS)
                    words[c] += chunk.counts[kind == c].sum()
                    documents[c] += (kind == c).sum()
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, [-1, -2])), *(pa.array(np.append(seen[c][at], [words[c], documents[c]])) for c in (0, 1))], ["bucket", "clean", "toxic"]
        )

    got = labelled.select("text", "toxic").mapInArrow(run, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    counts, own = np.zeros((2, 1 << BUCKET_BITS)), got[got.bucket >= 0]
    counts[:, own.bucket] = own[["clean", "toxic"]].to_numpy().T
    whole = [got[got.bucket == b][["clean", "toxic"]].sum().to_numpy(dtype=float) for b in (-1, -2)]
    return counts, whole[0], whole[1]


def _token_scores(counts: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Lower bounds of the log-odds ratio of holding a token, under a symmetric Dirichlet prior on holding it or not."""
    held, free = counts + PRIOR, documents[:, None] - counts + PRIOR
    odds = np.log(held[1] / free[1]) - np.log(held[0] / free[0])
    error = CONFIDENCE * np.sqrt((1 / held + 1 / free).sum(axis=0))
    return np.clip(np.where(odds > 0, np.maximum(0, odds - error), np.minimum(0, odds + error)), -1, MOST) - DRIFT


def _decay(scores: np.ndarray, clean: np.ndarray) -> float:
    """The positive lambda at which the mean of exp(lambda * score) over clean tokens is 1."""
    weight = clean / max(1.0, clean.sum())
    low, high = 1e-3, 5.0
    if not (scores[clean > 0] > 0).any():
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if weight @ np.exp(mid * scores) < 1 else (low, mid)
    return low


def _rising(positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Isotonic regression by pooling neighbours that fall; bins without rows take their left neighbour's value."""
    pools: list[list[float]] = []
    for p, n in zip(positive, total, strict=True):
        pools.append([p, n, 1])
        while len(pools) > 1 and pools[-1][0] * pools[-2][1] <= pools[-2][0] * pools[-1][1]:
            p2, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + p2, pools[-1][1] + n2, pools[-1][2] + k2]
    base = positive.sum() / max(1.0, total.sum())
    return np.maximum.accumulate(np.repeat([(p + base) / (n + 1) for p, n, _ in pools], [k for *_, k in pools]))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents whose id isn't held out.

    Labels other than 0 and 1 and labels of no document are ignored; a document labelled both ways is
    toxic. Without a toxic or without a clean document every score is the training share of toxic ones,
    so nothing is rejected where nothing is labelled.
    """
    scratch = Scratch(docs.sparkSession)
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    labelled = scratch.save(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic"))
    counts, words, documents = _count(labelled)
    scores = _token_scores(counts, documents)
    decay = _decay(scores, counts[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(0), NOT_ALNUM):
                found = _segments(chunk, scores)
                own = [sorted((decay * s for _, _, s in found.get(r, [])), reverse=True) for r in range(chunk.rows)]
                yield pa.RecordBatch.from_arrays([pa.array(toxic[chunk.first : chunk.first + chunk.rows]), pa.array(chunk.counts), pa.array(own, pa.list_(pa.float64()))], ["toxic", "n", "own"])

    seen = scratch.save(labelled.select("text", "toxic").mapInArrow(run, "toxic int, n long, own array<double>"))
    tail = seen.where("toxic = 0").select(F.explode("own").alias("x")).groupBy(F.floor("x").alias("b")).count().toPandas().sort_values("b", ascending=False)
    log_k = -np.log(max(1.0, words[0]))  # if clean text has no segment: one in all of it
    if len(tail):
        # from the better half of the segments: the best ones are from documents with wrong labels
        above = tail["count"].cumsum()
        half = int(np.argmax(above.to_numpy() >= above.iloc[-1] / 2))
        log_k = float(np.log(above.iloc[half]) - np.log(max(1.0, words[0])) + tail["b"].iloc[half])
    total = F.aggregate(F.transform("own", lambda x: F.greatest(F.lit(0.0), x - log_k - F.log(F.col("n").cast("double")))), F.lit(0.0), lambda a, x: a + x)
    bins = seen.select("toxic", F.least(F.floor(total / BIN), F.lit(BINS - 1)).cast("int").alias("b")).groupBy("b").agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).toPandas()
    scratch.drop(labelled, seen)
    positive, number = np.zeros(BINS), np.zeros(BINS)
    positive[bins.b], number[bins.b] = bins.p, bins.n
    return Model(scores.astype(np.float64), decay, log_k, _rising(positive, number))


SCHEMA = "score double, predicted int, n_words long, passages array<struct<first_word:long,last_word:long,score:double,evidence:double>>"
_PASSAGES = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64()), ("evidence", pa.float64())]))


def _scored(docs: DataFrame, at: int, model: Model, threshold: float) -> DataFrame:
    """``docs``, whose text is the column at ``at``, with the columns of ``SCHEMA`` added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(at), NOT_ALNUM):
                total, passages, n = np.zeros(chunk.rows), [[] for _ in range(chunk.rows)], chunk.counts
                for row, found in _segments(chunk, model.scores).items():
                    evidence = _evidence(found, int(n[row]), model.decay, model.log_k)
                    total[row] = sum(evidence)
                    passages[row] = [{"first_word": a, "last_word": b - 1, "score": s, "evidence": e} for (a, b, s), e in zip(found, evidence, strict=True) if e > 0]
                score = np.minimum(1.0, model.probability[np.minimum(total / BIN, BINS - 1).astype(int)] + 1e-6 * np.tanh(total / 100))
                own = batch.slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(n), pa.array(passages, _PASSAGES)],
                    [*own.schema.names, "score", "predicted", "n_words", "passages"],
                )

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *T.StructType.fromDDL(SCHEMA).fields]))


def score_texts(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, n_words, passages (every significant toxic segment, in words) of each document.

    A null or empty text has the least score and no passage; repeated rows are each scored; a row
    without doc_id is scored like others; an empty table gives an empty result. A text of any length is
    scored whole; a task holds its words' hashes and scores (about 50 bytes a word).
    """
    out = _scored(docs.select("doc_id", "text"), 1, model, threshold)
    return out.select("doc_id", "score", "predicted", "n_words", "passages").withColumn("held_out", held_out(F.col("doc_id")))


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the score doesn't reject, each judged by its own text where it stands: nothing is joined or shuffled."""
    names = [f"_{i}" for i in range(len(docs.columns))]  # none clashes with what is added
    return _scored(docs.toDF(*names), docs.columns.index("text"), model, threshold).where("predicted = 0").select(*names).toDF(*docs.columns)
