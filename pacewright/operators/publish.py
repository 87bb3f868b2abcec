"""Publishing: nested documents, provenance ids, table sinks, schema documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def provenance_id(source: Column) -> Column:
    """Names a source: the first 16 hexadecimal digits of SHA-256 over its JSON, fields in their declared order."""
    return F.substring(F.sha2(F.to_json(source), 256), 1, 16)


def race_documents(runs: DataFrame, passings: DataFrame) -> DataFrame:
    """race, event, runs: a nested list of runs in finishing order, each with its passings in course order."""
    own = passings.groupBy("performance").agg(F.sort_array(F.collect_list(F.struct("distance_m", "document", "time_s", "suspect"))).alias("passings"))
    rows = runs.join(own, "performance").select("race", "event", F.struct(F.col("time_s").isNull().alias("out"), "time_s", "performance", "athlete", "passings").alias("run"))
    return rows.groupBy("race", "event").agg(F.sort_array(F.collect_list("run")).alias("runs"))


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Every table as Parquet and as CSV with a header and ``\\N`` for null; a table appears when its write commits."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/parquet/{name}")
        df.write.mode("overwrite").option("header", True).option("nullValue", "\\N").csv(f"{folder}/csv/{name}")


def write_documents(documents: DataFrame, folder: str, by: str) -> None:
    """Nested documents as JSON, a folder for each value of ``by``."""
    documents.write.mode("overwrite").partitionBy(by).json(folder)


def create_database(spark: SparkSession, name: str, tables: dict[str, DataFrame], views: dict[str, str], comments: dict[str, dict[str, str]] | None = None) -> None:
    """Managed tables with column comments, and views over them."""
    spark.sql(f"create database if not exists {name}")
    for table, df in tables.items():
        for column, text in (comments or {}).get(table, {}).items():
            df = df.withMetadata(column, {"comment": text})
        df.write.mode("overwrite").saveAsTable(f"{name}.{table}")
    for view, sql in views.items():
        spark.sql(f"create or replace view {name}.{view} as {sql}")


def columns_document(tables: dict[str, DataFrame]) -> str:
    """What each table holds: its columns, their types and what they mean."""
    lines = ["# What is published"]
    for name, df in tables.items():
        lines += ["", f"## {name}", "", "| name | meaning | stored as |", "| --- | --- | --- |"]
        lines += [f"| {f.name} | {f.metadata.get('comment', '')} | {f.dataType.simpleString()} |" for f in df.schema.fields]
    return "\n".join(lines) + "\n"
