"""Transcribed readings: one value a line, with the place it was read from.

``<path> = <value> [← p<page> (<x0>,<top>,<x1>,<bottom>) '<text>' [<method>]]``; entries, their
points and segments are indexed paths (their names are the input's format). Lines become rows with columns only; no Python touches them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_LINE = r"^(\S.*?) = (.*?)(?: ← p(\d+) \(([\d.-]+),([\d.-]+),([\d.-]+),([\d.-]+)\) '(.*)' \[([^\]]*)\])?$"
_ENTRY = r"^entries\[(\d+):([^\]]*)\]\.(.*)$"


def read_values(spark: SparkSession, path: str) -> DataFrame:
    """document, path, value, page, box, text, method of every line under a path."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).withColumn("file", F.input_file_name()).where("value rlike ' = '")
    part = lambda i: F.nullif(F.regexp_extract("value", _LINE, i), F.lit(""))
    box = F.struct(*(part(i).cast("double").alias(n) for i, n in ((4, "x0"), (5, "top"), (6, "x1"), (7, "bottom"))))
    rows = lines.select("file", part(1).alias("path"), part(2).alias("raw"), part(3).cast("int").alias("page"), box.alias("box"), part(8).alias("text"), part(9).alias("method"))
    document = F.max(F.when(F.col("path") == "document", F.regexp_extract("raw", "'(.*)'", 1))).over(W.partitionBy("file"))
    value = F.regexp_extract("raw", r"^(?:[\w.]+\()?'?(.*?)'?\)?$", 1)
    return rows.select(document.alias("document"), "path", F.when(F.col("raw") != "None", value).alias("value"), "page", "box", "text", "method")


def entries(values: DataFrame) -> DataFrame:
    """document, entry, family, name, country, place, status, time_s, precision: one row per entry."""
    own = values.withColumns({"entry": F.regexp_extract("path", _ENTRY, 1), "family": F.regexp_extract("path", _ENTRY, 2), "field": F.regexp_extract("path", _ENTRY, 3)}).where("entry <> ''")
    get = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    rows = own.groupBy("document", F.col("entry").cast("int").alias("entry"), "family").agg(get("country").alias("country"), get("place").alias("place"), get("result").alias("result"), get("name").alias("name"))
    time = F.regexp_extract("result", r"Decimal\('([\d.]+)", 1)
    return rows.select(
        "document", "entry", "family", "country", F.expr("try_cast(place as int)").alias("place"), F.nullif(F.regexp_extract("result", r"Status\.\w+: '(\w+)", 1), F.lit("")).alias("status"),
        F.nullif(time, F.lit("")).cast("decimal(9,3)").alias("time_s"), F.length(F.regexp_extract(time, r"\.(\d+)$", 1)).alias("precision"),
    )


def passings(values: DataFrame) -> DataFrame:
    """document, entry, point, kind, distance_m, time_s: one row per indexed value of an entry that is timed at a point."""
    part = lambda i: F.regexp_extract("path", r"^entries\[(\d+):[^\]]*\]\.\w+\[([^\]]*)\]\.(\w+)$", i)
    own = values.select("document", part(1).alias("entry"), part(2).alias("point"), part(3).alias("field"), "value").where("entry <> ''")
    get = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    rows = own.groupBy("document", F.col("entry").cast("int").alias("entry"), "point").agg(get("point").alias("label"), get("time").alias("time")).where("label is not null")
    return rows.select("document", "entry", "point", F.regexp_extract("label", r"\((\w+) at", 1).alias("kind"), F.nullif(F.regexp_extract("label", r"at ([\d.]+) m", 1), F.lit("")).cast("decimal(9,3)").alias("distance_m"), F.expr("try_cast(regexp_extract(time, '([0-9.]+)', 1) as decimal(9,3))").alias("time_s"))
