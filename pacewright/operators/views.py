"""The two analytic views and the trace lookup: joins, segment deltas, suspects, union of branches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def results(runs: DataFrame) -> DataFrame:
    """One row per performance with its place: finishers by time within race and event, equal times share a place."""
    order = W.partitionBy("race", "event", "status").orderBy(F.asc_nulls_last("time_s"))
    place = F.when(F.col("time_s").isNotNull() & (F.col("status") == "finished"), F.rank().over(order)).cast("long")
    return runs.withColumn("place", place)


def with_segments(points: DataFrame) -> DataFrame:
    """Metres and seconds since the point before in one performance and document, from the gun at zero."""
    series = W.partitionBy("performance", "document").orderBy("distance_m", "point")
    metres = F.col("distance_m") - F.lag("distance_m", 1, 0).over(series)
    seconds = F.col("time_s") - F.lag("time_s", 1, 0.0).over(series)
    return points.withColumns({"segment_m": metres, "segment_s": seconds})


def split_analysis(passings: DataFrame, runs: DataFrame, flags: DataFrame) -> DataFrame:
    """Segments, speeds and shares of the race of every split, and of a derived finish of each finished series.

    A series' own last point is its printed finish and gives way to the official one. A point is suspect if
    it is flagged, or its performance's result is; the two are equality joins, not one join on either key.
    """
    last = F.max("point").over(W.partitionBy("performance", "document"))
    official = runs.where((F.col("status") == "finished") & F.col("time_s").isNotNull()).select("performance", F.col("time_s").alias("finish_s"), F.col("distance_m").alias("finish_m"))
    inner = passings.withColumn("last", last).where(F.col("point") < F.col("last")).select("performance", "document", "point", "distance_m", "time_s")
    finish = passings.select("performance", "document").distinct().join(official, "performance")
    finish = finish.select("performance", "document", F.lit(None).cast("long").alias("point"), F.col("finish_m").alias("distance_m"), F.col("finish_s").alias("time_s"))
    points = with_segments(inner.unionByName(finish).join(official.select("performance", "finish_s"), "performance", "left"))
    by_split = flags.where("field = 'split'").select("performance", "document", "point").distinct().withColumn("of_split", F.lit(True))
    by_result = flags.where("field = 'result'").select("performance").distinct().withColumn("of_result", F.lit(True))
    flagged = points.join(by_split, ["performance", "document", "point"], "left").join(by_result, "performance", "left")
    return flagged.select(
        "performance", "document", "point", "distance_m", "time_s", "segment_m", "segment_s",
        F.try_divide(F.col("segment_m").cast("double"), F.col("segment_s")).alias("speed_mps"),
        F.try_divide("time_s", "finish_s").alias("share"),
        F.coalesce("of_split", "of_result", F.lit(False)).alias("suspect"),
    )


def trace(passings: DataFrame, runs: DataFrame, prefix: str) -> DataFrame:
    """Values of all records whose id begins with a prefix: results and passings, one union."""
    performance = F.concat_ws("/", "race", "event", "performance")
    named = runs.select("performance", performance.alias("id"), "time_s")
    own = named.where(F.col("id").startswith(prefix))
    points = passings.join(own.select("performance", "id"), "performance")
    points = points.select(F.concat_ws("/", "id", F.concat("point", F.lit("@"), "document")).alias("record"), F.lit("split").alias("kind"), "time_s")
    return own.select(F.col("id").alias("record"), F.lit("result").alias("kind"), "time_s").unionByName(points)
