"""The corpus pipeline: toxic documents go, then poor ones, then near-duplicates, then benchmark leaks; what stays is encoded.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Rows keep their
columns. Toxicity and quality judge a row by itself; copies and leaks are found by doc_id, so for
those a row without one can't be decided on and stays, and rows that share one share the decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pacewright.llm.decontamination import without_leaks
from pacewright.llm.near_duplicates import without_copies
from pacewright.llm.pieces import encode
from pacewright.llm.quality import without_poor
from pacewright.llm.queries import TOKENIZER
from pacewright.llm.scratch import Scratch
from pacewright.llm.toxicity import train, without_toxic

#: Rows of whole texts that go to Python at once. A batch stands several times in an executor's memory: in both Arrow buffers of a task and in its worker.
BATCH_ROWS = 1000


def _in_small_batches(spark: SparkSession) -> None:
    """From now on the session's batches have ``BATCH_ROWS`` rows at most; a smaller number that is set stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without those that the toxicity score rejects, each by its own text."""
    _in_small_batches(spark)
    return without_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rules and their group's robust distance keep, each by its own text."""
    return without_poor(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least doc_id."""
    _in_small_batches(spark)
    return without_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item is found."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their pieces' ids, their number, and whether decoding gives the text back."""
    _in_small_batches(spark)
    return encode(docs, TOKENIZER)


STAGES = [("toxicity", toxicity), ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontamination", decontamination), ("encoding", encoding)]

#: Trained scores and merges by rank have no SQL. The stages' tests check columns, counts and nulls; no brute force says which rows a stage keeps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written to the shared folder before the next."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = scratch.save(docs)
    return docs
