"""Values of a line given to the columns of its table: by their place, or in order where a row leaves columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: How far a value's left edge may be from its column's.
REACH = 12.0
#: Tasks over which the lines of one table spread.
SHARES = 512


def _beside_columns(lines: DataFrame, listed: DataFrame) -> DataFrame:
    """``lines(table, line, ...)`` beside their table's columns. Tables may be few and large, so each table's row is copied, and lines of one table meet SHARES copies of it in as many tasks."""
    share = F.pmod(F.xxhash64("line"), F.lit(SHARES)).cast("int")
    copies = listed.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return lines.withColumn("share", share).join(copies, ["table", "share"], "left").drop("share")


def by_position(values: DataFrame, columns: DataFrame, fits: Column, reach: float = REACH) -> DataFrame:
    """``values(table, line, x, text)`` with ``column`` and ``error``: each has the column of ``columns(table, column, anchor, kind)`` that is nearest.

    Of columns equally near the first by name is taken. A value that is farther than ``reach`` from any, one in a column that a
    value further left has taken, and one that doesn't fit its column's ``kind`` (``fits`` is a condition on ``text`` and ``kind``)
    have an error and no column. A table's columns are a short list, so a value meets those of its own table only.
    """
    anchors = columns.groupBy("table").agg(F.sort_array(F.collect_list(F.struct("column", "anchor", "kind"))).alias("all"))
    met = _beside_columns(values, anchors)
    nearest = F.array_min(F.transform("all", lambda c: F.struct(F.abs(c["anchor"] - F.col("x")).alias("far"), c["column"].alias("column"), c["kind"].alias("kind"))))
    met = met.withColumn("near", nearest).withColumn("near", F.when(F.col("near.far") <= reach, F.col("near"))).withColumns({"kind": F.col("near.kind"), "k": F.col("near.column")})
    earlier = F.row_number().over(W.partitionBy("table", "line", "k").orderBy("x", "text")) > 1
    error = F.when(F.col("k").isNull(), "under no column").when(earlier, "under a column that is taken").when(~F.coalesce(fits, F.lit(False)), F.concat(F.lit("doesn't fit "), "k"))
    return met.withColumn("error", error).select("table", "line", "x", "text", F.when(F.col("error").isNull(), F.col("k")).alias("column"), "error")


def in_order(values: DataFrame, columns: DataFrame, patterns: dict[str, str], empty: tuple[str, ...] = ("-",)) -> DataFrame:
    """``values(table, line, x, text)`` with ``column`` and ``error``: each has the next column of ``columns(table, column, place, kind)`` that it fits.

    ``patterns`` says which texts fit a kind. A sign of an empty cell passes its column by. From the first value that fits none
    of the columns left, a line's values have an error and no column. A line's values and a table's columns are short lists, folded
    in the order of their places; equal places go by text.
    """
    listed = columns.groupBy("table").agg(F.sort_array(F.collect_list(F.struct("place", "column", "kind"))).alias("all"))
    lines = values.groupBy("table", "line").agg(F.sort_array(F.collect_list(F.struct("x", "text"))).alias("values"))
    lines = _beside_columns(lines, listed)
    lines = lines.withColumn("all", F.coalesce("all", F.array().cast(listed.schema["all"].dataType)))
    fits = lambda text, kind: F.coalesce(*(F.when(kind == k, text.rlike(p)) for k, p in patterns.items()), F.lit(False))
    given = "array<string>"

    def step(state: Column, v: Column) -> Column:
        blank = v["text"].isin(*empty)
        # The index of the next column that fits; -1 if there is none.
        found = F.array_min(F.filter(F.transform(F.col("all"), lambda c, i: F.when((i >= state["next"]) & fits(v["text"], c["kind"]), i)), lambda i: i.isNotNull()))
        at = F.when(state["next"] >= 0, F.when(blank, state["next"]).otherwise(F.coalesce(found, F.lit(-1)))).otherwise(F.lit(-1))
        name = F.when((at >= 0) & ~blank, F.get(F.col("all"), at)["column"])
        return F.struct(F.when(at >= 0, at + 1).otherwise(-1).alias("next"), F.array_append(state["given"], name).alias("given"))

    folded = F.aggregate("values", F.struct(F.lit(0).alias("next"), F.array().cast(given).alias("given")), step)["given"]
    flat = lines.withColumn("given", folded).select("table", "line", F.explode(F.arrays_zip("values", "given")).alias("z")).select("table", "line", "z.values.*", F.col("z.given").alias("column"))
    return flat.withColumn("error", F.when(F.col("column").isNull() & ~F.col("text").isin(*empty), "fits no column that is left"))
