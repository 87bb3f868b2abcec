"""Windows: pairs of neighbours, clean predecessors, ranks, numbering, gaps, smoothing."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pacewright.operators import views
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle

_SERIES = "partition by performance, document order by distance_m, point"


def _series():
    return W.partitionBy("performance", "document").orderBy("distance_m", "point")


@query("segments", oracle(f"select * from (select performance, document, point, distance_m - lag(distance_m, 1, 0) over ({_SERIES}) as segment_m, time_s - lag(time_s, 1, 0.0) over ({_SERIES}) as segment_s from passings) where segment_s > 0"))
def segments(spark, sf_dir):
    d = views.with_segments(Tables(spark, sf_dir).passings)
    return d.where("segment_s > 0").select("performance", "document", "point", "segment_m", "segment_s")


@query("previous_clean", oracle(f"select performance, document, point, last_value(case when not suspect then point end ignore nulls) over ({_SERIES} rows between unbounded preceding and 1 preceding) as clean_before from passings"))
def previous_clean(spark, sf_dir):
    """The last clean point before each; null for the gun."""
    clean = F.last(F.when(~F.col("suspect"), F.col("point")), ignorenulls=True).over(_series().rowsBetween(W.unboundedPreceding, -1))
    return Tables(spark, sf_dir).passings.select("performance", "document", "point", clean.alias("clean_before"))


@query("rank_by_time", oracle("select performance, race, event, cast(rank() over (partition by race, event order by time_s) as bigint) as place, count(*) over (partition by race, event order by time_s range between unbounded preceding and current row) as level from runs where time_s is not null"))
def rank_by_time(spark, sf_dir):
    w = W.partitionBy("race", "event").orderBy("time_s")
    r = Tables(spark, sf_dir).runs.where("time_s is not null")
    return r.select("performance", "race", "event", F.rank().over(w).cast("long").alias("place"), F.count("*").over(w.rangeBetween(W.unboundedPreceding, W.currentRow)).alias("level"))


@query("gap_to_fastest", oracle("select performance, race, s.distance_m, s.time_s - min(case when not suspect then s.time_s end) over (partition by race, s.distance_m) as gap from passings s join runs using (performance)"))
def gap_to_fastest(spark, sf_dir):
    """Seconds behind the fastest clean time at each point of a race."""
    t = Tables(spark, sf_dir)
    fastest = F.min(F.when(~F.col("suspect"), F.col("time_s"))).over(W.partitionBy("race", "distance_m"))
    d = t.passings.join(t.runs.select("performance", "race"), "performance")
    return d.select("performance", "race", "distance_m", (F.col("time_s") - fastest).alias("gap"))


@query("athlete_numbers", oracle("select athlete, 500 + cast(row_number() over (order by first_raced, athlete) as bigint) as number from (select athlete, min(race) as first_raced from runs group by athlete) where athlete % 7 <> 0 union all select distinct athlete, cast(athlete // 7 as bigint) from runs where athlete % 7 = 0"))
def athlete_numbers(spark, sf_dir):
    """Recorded numbers stay; new athletes follow the largest in order of their first race, numbered range by range."""
    firsts = Tables(spark, sf_dir).runs.groupBy("athlete").agg(F.min("race").alias("first_raced"))
    old = firsts.where("athlete % 7 = 0").select("athlete", F.floor(F.col("athlete") / 7).cast("long").alias("number"))
    new = firsts.where("athlete % 7 <> 0")
    # numbers without one task for all: rank within a year, plus how many came in earlier years
    year = F.substring("first_raced", 1, 4)
    within = new.withColumns({"year": year, "i": F.row_number().over(W.partitionBy(year).orderBy("first_raced", "athlete"))})
    years = new.groupBy(year.alias("year")).agg(F.count("*").alias("n"))
    before = years.join(years.select(F.col("year").alias("y"), F.col("n").alias("m")), F.col("y") < F.col("year"), "left").groupBy("year").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("before"))
    return within.join(F.broadcast(before), "year").select("athlete", (500 + F.col("before") + F.col("i")).alias("number")).unionByName(old)


@query("primary_series", oracle("select performance, document, n from (select performance, document, count(*) as n, row_number() over (partition by performance order by count(*) desc, document) as k from passings group by performance, document) where k = 1"))
def primary_series(spark, sf_dir):
    """The document with most passings of each performance."""
    n = Tables(spark, sf_dir).passings.groupBy("performance", "document").agg(F.count("*").alias("n"))
    best = n.groupBy("performance").agg(F.max_by(F.struct("document", "n"), F.struct("n", F.negative(F.ascii("document")))).alias("b"))
    return best.select("performance", "b.document", "b.n")


@query("time_lost", oracle(f"select performance, document, max(abs(run)) as peak, arg_max(point, struct_pack(a := abs(run), b := -point)) as point from (select performance, document, point, sum(lap_s - 25) over ({_SERIES} rows unbounded preceding) as run from passings) group by all"))
def time_lost(spark, sf_dir):
    """Running sum of differences from an even pace, and where it is largest."""
    run = F.sum(F.col("lap_s") - 25).over(_series().rowsBetween(W.unboundedPreceding, W.currentRow))
    d = Tables(spark, sf_dir).passings.withColumn("run", run)
    return d.groupBy("performance", "document").agg(F.max(F.abs("run")).alias("peak"), F.max_by("point", F.struct(F.abs("run"), -F.col("point"))).alias("point"))


@query("every_second_point", oracle("select performance, document, point from (select performance, document, point, count(*) over (partition by performance, document) as n from passings) where (n - point) % 2 = 0"))
def every_second_point(spark, sf_dir):
    """Every second point, always the last."""
    n = F.count("*").over(W.partitionBy("performance", "document"))
    return Tables(spark, sf_dir).passings.withColumn("n", n).where("(n - point) % 2 = 0").select("performance", "document", "point")


@query("stretch_times", oracle("select a.performance, a.document, b.time_s - a.time_s as stretch_s from passings a join passings b using (performance, document) where a.distance_m = 100 and b.distance_m = 300"))
def stretch_times(spark, sf_dir):
    """Time between two points of a run, in one pass instead of a self join."""
    s = Tables(spark, sf_dir).passings.where("distance_m in (100, 300)").groupBy("performance", "document")
    s = s.agg(F.max(F.when(F.col("distance_m") == 100, F.col("time_s"))).alias("a"), F.max(F.when(F.col("distance_m") == 300, F.col("time_s"))).alias("b"))
    return s.where("a is not null and b is not null").select("performance", "document", (F.col("b") - F.col("a")).alias("stretch_s"))


@query("smoothed_values", """select a.event_id, cast(floor(sum(b.value * exp(-0.5 * power((a.event_id - b.event_id) / 3.0, 2))) / sum(exp(-0.5 * power((a.event_id - b.event_id) / 3.0, 2))) * 1000 + 0.5) as bigint) as smooth_m
from events a join events b on a.user_id = b.user_id and b.event_id between a.event_id - 9 and a.event_id + 9 group by a.event_id""")
def smoothed_values(spark, sf_dir):
    """Gaussian-weighted mean over a bounded window of neighbours."""
    e = Tables(spark, sf_dir).read("events")
    near = F.collect_list(F.struct("event_id", "value")).over(W.partitionBy("user_id").orderBy("event_id").rangeBetween(-9, 9))
    weight = lambda x: F.exp(-0.5 * F.pow((F.col("event_id") - x["event_id"]) / 3.0, F.lit(2)))
    total = lambda f: F.aggregate(F.transform("near", f), F.lit(0.0), lambda a, x: a + x)
    d = e.withColumn("near", near)
    return d.select("event_id", F.floor(total(lambda x: x["value"] * weight(x)) / total(weight) * 1000 + 0.5).cast("long").alias("smooth_m"))


@query("finishing_order", oracle("select performance, race, event, cast(row_number() over (partition by race, event order by case status when 'finished' then 0 else 1 end, coalesce(time_s, 0), athlete, performance) as bigint) as line from runs"))
def finishing_order(spark, sf_dir):
    w = W.partitionBy("race", "event").orderBy(F.when(F.col("status") == "finished", 0).otherwise(1), F.coalesce("time_s", F.lit(0.0)), "athlete", "performance")
    return Tables(spark, sf_dir).runs.select("performance", "race", "event", F.row_number().over(w).cast("long").alias("line"))


@query("free_lanes", oracle("with used as (select race, event, list(distinct athlete % 8 + 1) as lanes from runs group by all) select race, event, array_to_string(list_filter(range(1, 9), lambda x: not list_contains(lanes, x)), ',') as free from used"))
def free_lanes(spark, sf_dir):
    used = Tables(spark, sf_dir).runs.groupBy("race", "event").agg(F.collect_set(F.col("athlete") % 8 + 1).alias("lanes"))
    return used.select("race", "event", F.array_join(F.array_except(F.sequence(F.lit(1).cast("long"), F.lit(8).cast("long")), "lanes").cast("array<string>"), ",").alias("free"))
