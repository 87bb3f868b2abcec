"""The relational model: flat tables whose values name their sources, with a comment for every column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewright.operators.publish import provenance_id
from pacewright.sources.tables import Tables


def sourced(value: Column, source: Column) -> Column:
    """A value with where it was read; a value that is missing has no source."""
    return F.when(value.isNotNull(), F.struct(value.alias("value"), source.alias("source")))


def relation(records: DataFrame, plain: dict[str, str], read: dict[str, str]) -> DataFrame:
    """One table of records: ``plain`` columns as they are, each ``read`` one as its value beside ``<column>_source``. Both map columns to comments."""
    columns = [F.col(c).alias(c, metadata={"comment": text}) for c, text in plain.items()]
    for c, text in read.items():
        columns += [F.col(f"{c}.value").alias(c, metadata={"comment": text}), provenance_id(F.col(f"{c}.source")).alias(f"{c}_source", metadata={"comment": f"Where {c} was read: sources.id."})]
    return records.select(*columns)


def sources(records: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """id and the fields of every source that a value of the records names, each once."""
    parts = [df.select(F.explode(F.array(*(F.col(f"{c}.source") for c in read))).alias("s")).where("s is not null") for df, read in records]
    return reduce(DataFrame.unionByName, parts).select(provenance_id(F.col("s")).alias("id"), "s.*").dropDuplicates(["id"])


def _performances(t: Tables) -> DataFrame:
    at = lambda field: F.struct(F.col("race").alias("document"), F.lit(field).alias("field"))
    runs = t.runs
    return runs.select(F.col("performance").alias("id"), "race", "athlete", *(sourced(F.col(c), at(c)).alias(c) for c in ("country", "status", "time_s")))


def _passings(t: Tables) -> DataFrame:
    source = F.struct(F.col("document"), F.concat_ws("/", F.lit("passing"), F.col("mark")).alias("field"))
    return t.passings.select("performance", "document", "point", "distance_m", sourced(F.col("time_s"), source).alias("time_s"))


def tables(t: Tables) -> dict[str, DataFrame]:
    """The published tables by name."""
    performances, passings = _performances(t), _passings(t)
    named = lambda df, comments: relation(df, comments, {})
    return {
        "series": named(t.read("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")), {"id": "Series id.", "name": "Its name."}),
        "countries": named(t.read("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("series")), {"id": "Country id.", "name": "Its name.", "series": "series.id."}),
        "athletes": named(t.read("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("country")), {"id": "Athlete id.", "country": "countries.id."}),
        "races": named(t.runs.select("race", "event").distinct(), {"race": "The day of the race.", "event": "Its event."}),
        "performances": relation(performances, {"id": "Performance id.", "race": "races.race.", "athlete": "athletes.id."}, {"country": "Country as printed.", "status": "finished or dnf.", "time_s": "Finishing time in seconds; null unless finished."}),
        "passings": relation(passings, {"performance": "performances.id.", "document": "Where it is printed.", "point": "Number of the point.", "distance_m": "Metres from the start."}, {"time_s": "Seconds since the gun."}),
        "stretches": named(t.stretches, {"performance": "performances.id.", "document": "Where it is printed.", "start_m": "First metre.", "end_m": "Last metre.", "time_s": "Printed seconds."}),
        "sources": named(sources([(performances, ["country", "status", "time_s"]), (passings, ["time_s"])]), {"id": "Source id.", "document": "The document.", "field": "The field in it."}),
    }
