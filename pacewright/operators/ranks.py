"""Exact order statistics of groups of any size: a bounded sketch brackets each rank, then only the bracket is counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Ranks that the sketch may be off are at most rows / ACCURACY; a bracket holds a few times that many rows.
ACCURACY = 10_000


def quantiles(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float], nearest: bool = False) -> DataFrame:
    """The keys, one column per name in ``wanted`` with that quantile of the group's values, and n (values that aren't null).

    Quantiles are interpolated between ranks, or the value at the ``nearest`` rank. No task holds a group:
    of each group only distinct values near a wanted rank are put in order. Groups without a value and
    groups with a null key have no row.
    """
    d = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    reach = 3 / ACCURACY
    sides = [F.lit(p) for q in wanted.values() for p in (max(0.0, q - reach), min(1.0, q + reach))]
    facts = d.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.percentile_approx("_v", F.array(*sides), ACCURACY).alias("_e"))
    small = F.col("n") <= 2 * ACCURACY  # where a rank or two may be more than the reach, the whole group is the bracket
    bracket = [
        F.struct(F.lit(i).alias("i"), F.when(small | F.lit(q <= reach), F.col("_min")).otherwise(F.get("_e", F.lit(2 * i))).alias("lo"), F.when(small | F.lit(q >= 1 - reach), F.col("_max")).otherwise(F.get("_e", F.lit(2 * i + 1))).alias("hi"))
        for i, q in enumerate(wanted.values())
    ]
    facts = facts.select(*keys, "n", F.explode(F.array(*bracket)).alias("_b"))
    near = d.join(facts, keys).where(F.col("_v") <= F.col("_b.hi")).withColumn("_v", F.when(F.col("_v") >= F.col("_b.lo"), F.col("_v")))
    # one row per value in a bracket, and one for all below it
    counted = near.groupBy(*keys, "n", F.col("_b.i").alias("_i"), "_v").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(W.partitionBy(*keys, "_i").orderBy(F.asc_nulls_first("_v")))
    ranked = counted.withColumn("_to", upto)

    def at(i: int, q: float) -> Column:
        place = (F.col("n") - 1) * q
        value_of = lambda rank: F.min(F.when((F.col("_i") == i) & (F.col("_to") > rank), F.col("_v")))
        if nearest:
            return value_of(F.floor(place + 0.5))
        low, high = value_of(F.floor(place)), value_of(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    return ranked.groupBy(*keys).agg(*(at(i, q).alias(name) for i, (name, q) in enumerate(wanted.items())), F.max("n").alias("n"))


def median(rows: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """The keys, the exact median of the group's values, and n."""
    return quantiles(rows, keys, value, {name: 0.5})
