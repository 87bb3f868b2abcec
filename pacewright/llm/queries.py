"""The registered queries over the training-data operators, and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewright.llm import middle_fill, oracles
from pacewright.llm.alignment import align
from pacewright.llm.decontamination import contamination
from pacewright.llm.html_text import main_text
from pacewright.llm.language_model import score
from pacewright.llm.licenses import scan
from pacewright.llm.near_duplicates import near_duplicates
from pacewright.llm.pieces import encode
from pacewright.llm.prefix_counts import prefix_counts, totals
from pacewright.llm.quality import quality
from pacewright.llm.toxicity import score_texts, train
from pacewright.llm.url_filter import judge
from pacewright.llm.warc import round_trip

#: The vocabulary file of the encoding queries; read on the driver only.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
#: Tokens beyond which a text is over the limit.
TOKEN_LIMIT = 512


def vocabulary(name: str) -> str:
    """Where the file of a public vocabulary is; read on the driver only."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents")).drop("lang", "source", "distance")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


#: Host and path prefix of a URL rule, and its verdict.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_table(spark, sf_dir, "documents"), TOKENIZER).select("doc_id", "n_tokens", "ids", "round_trip")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score_texts(docs, train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "held_out", "score", "predicted", "passages")


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(prefix_counts(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")), TOKEN_LIMIT)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return aligned.withColumn("groups_sha256", digest).drop("groups")


def op13_middle_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle_fill.digests(_table(spark, sf_dir, "documents"))


ALL = (
    op1_quality_rules,
    op2_html_text,
    op3_near_duplicates,
    op4_license_scan,
    op5_url_filter,
    op6_warc,
    op7_pieces,
    op8_decontamination,
    op9_toxicity,
    op10_language_model,
    op11_token_counts,
    op12_alignment,
    op13_middle_fill,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
