"""The split-time model over the star-schema tables.

A performance is an order, its race all orders of one day, its event the order's priority, its
setting the customer's segment, its athlete the customer. Lines of one status are the timing points
of one document: every 100 m, elapsed time the running sum of quantities.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate")

#: The same tables as common table expressions.
SQL = f"""
lines as (
  select l_orderkey as performance, l_linestatus as document, l_quantity as lap_s, l_discount > 0.09 as suspect, l_returnflag as mark,
    cast(row_number() over (partition by l_orderkey, l_linestatus order by {", ".join(_LINE_ORDER)}) as bigint) as point
  from lineitem),
passings as (
  select performance, document, point, 100 * point as distance_m, suspect, mark, lap_s,
    sum(lap_s) over (partition by performance, document order by point rows between unbounded preceding and current row) as time_s
  from lines),
finishes as (select performance, max(time_s) as time_s, max(distance_m) as distance_m from passings group by performance),
runs as (
  select o_orderkey as performance, strftime(o_orderdate, '%Y-%m-%d') as race, o_orderpriority as event, c_mktsegment as setting, o_custkey as athlete,
    n_name as country, r_name as series, case when o_orderstatus = 'P' then 'dnf' else 'finished' end as status,
    case when o_orderstatus <> 'P' then f.time_s end as time_s, f.distance_m
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    left join finishes f on f.performance = o_orderkey)"""


def oracle(sql: str) -> str:
    """A statement over the model's tables; it may begin with common table expressions of its own."""
    return f"with {SQL},{sql[4:]}" if sql.startswith("with ") else f"with {SQL}\n{sql}"


class Tables:
    """The tables of a folder, and the model's tables over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def passings(self) -> DataFrame:
        # both windows have one order, so lines are sorted once; they lie by performance, as joins with runs need them
        series = W.partitionBy("performance", "document").orderBy(*_LINE_ORDER)
        lines = self.read("lineitem").select(F.col("l_orderkey").alias("performance"), F.col("l_linestatus").alias("document"), *_LINE_ORDER).repartition("performance")
        running = F.sum("l_quantity").over(series.rowsBetween(W.unboundedPreceding, W.currentRow))
        lines = lines.withColumns({"point": F.row_number().over(series).cast("long"), "running": running})
        return lines.select(
            "performance", "document", "point", (100 * F.col("point")).alias("distance_m"), (F.col("l_discount") > 0.09).alias("suspect"),
            F.col("l_returnflag").alias("mark"), F.col("l_quantity").alias("lap_s"), F.col("running").alias("time_s"),
        )

    @cached_property
    def stretches(self) -> DataFrame:
        """Printed times of the stretches between neighbouring points, some of them misprinted."""
        printed = F.col("lap_s") + F.when(F.col("suspect") & (F.col("mark") == "A"), 1.0).otherwise(0.0)
        return self.passings.select("performance", "document", (F.col("distance_m") - 100).alias("start_m"), F.col("distance_m").alias("end_m"), printed.alias("time_s"))

    @cached_property
    def placed_points(self) -> DataFrame:
        """Printed positions at each point of a race's document, some of them two too low."""
        point = W.partitionBy("race", "document", "distance_m").orderBy("time_s", "performance")
        d = self.passings.join(self.runs.select("performance", F.concat_ws("/", "race", "event").alias("race")), "performance")
        rank = F.row_number().over(point) + F.when(F.col("suspect") & (F.col("mark") == "R"), 2).otherwise(0)
        return d.select("race", "document", "point", "distance_m", "performance", "time_s", rank.cast("long").alias("rank"))

    @cached_property
    def births(self) -> DataFrame:
        """The birth year that each performance's document prints."""
        o = self.read("orders")
        year = F.lit(1960) + (F.col("o_custkey") % 40).cast("int") + F.when(F.col("o_totalprice") > 450000, 1).otherwise(0)
        return o.select(F.col("o_orderkey").alias("performance"), F.col("o_custkey").alias("athlete"), year.cast("string").alias("printed"))

    @cached_property
    def runs(self) -> DataFrame:
        # a series ends at the sum of its laps, so its finish needs no window
        series = self.read("lineitem").groupBy(F.col("l_orderkey").alias("performance"), "l_linestatus").agg(F.sum("l_quantity").alias("t"), (100 * F.count("*")).alias("distance_m"))
        finishes = series.groupBy("performance").agg(F.max("t").alias("t"), F.max("distance_m").alias("distance_m"))
        orders = self.read("orders")
        people = self.read("customer").join(F.broadcast(self.read("nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(self.read("region")), F.col("n_regionkey") == F.col("r_regionkey"))
        runs = orders.join(people, F.col("o_custkey") == F.col("c_custkey")).join(finishes, F.col("o_orderkey") == F.col("performance"), "left").drop("performance")
        finished = F.col("o_orderstatus") != "P"
        return runs.select(
            F.col("o_orderkey").alias("performance"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("race"), F.col("o_orderpriority").alias("event"), F.col("c_mktsegment").alias("setting"),
            F.col("o_custkey").alias("athlete"), F.col("n_name").alias("country"), F.col("r_name").alias("series"), F.when(finished, "finished").otherwise("dnf").alias("status"),
            F.when(finished, F.col("t")).alias("time_s"), "distance_m",
        )
