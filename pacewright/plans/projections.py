"""Projections, filters, orders and small numeric forms."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle


@query("record_ids", oracle("select performance, race || '/' || event as race_id, race || '/' || event || '/' || performance as id, race || '/' || event || '/' || performance || '/' || (100 * (1 + performance % 4)) || '@F' as split_id, race as parent from runs"))
def record_ids(spark, sf_dir):
    """Composite ids, and a parent cut from one."""
    r = Tables(spark, sf_dir).runs
    own = F.concat_ws("/", "race", "event", "performance")
    split = F.concat(own, F.lit("/"), 100 * (1 + F.col("performance") % 4), F.lit("@F"))
    return r.select("performance", F.concat_ws("/", "race", "event").alias("race_id"), own.alias("id"), split.alias("split_id"), F.substring_index(own, "/", 1).alias("parent"))


@query("point_labels", oracle("select performance, document, point, case when distance_m % 400 = 0 then (distance_m // 400) || ' laps' when suspect then 'h' || point else distance_m || 'm' end as label, case when suspect then 1 else 0 end + 10 * distance_m as ordinal from passings"))
def point_labels(spark, sf_dir):
    s = Tables(spark, sf_dir).passings
    m = F.col("distance_m")
    label = F.when(m % 400 == 0, F.concat(F.floor(m / 400), F.lit(" laps"))).when(F.col("suspect"), F.concat(F.lit("h"), "point")).otherwise(F.concat(m, F.lit("m")))
    return s.select("performance", "document", "point", label.alias("label"), (F.col("suspect").cast("int") + 10 * m).alias("ordinal"))


@query("barrier_positions", "select p_partkey, i as barrier, 13.0 + 8.5 * (i - 1) as position_m from (select p_partkey, unnest(range(1, cast(p_size % 5 as bigint) + 1)) as i from part)")
def barrier_positions(spark, sf_dir):
    """Where each barrier of a layout stands."""
    p = Tables(spark, sf_dir).read("part").where("p_size % 5 > 0")
    i = F.explode(F.sequence(F.lit(1).cast("long"), (F.col("p_size") % 5).cast("long")))
    return p.select("p_partkey", i.alias("barrier")).withColumn("position_m", (13.0 + 8.5 * (F.col("barrier") - 1)).cast("double"))


@query("split_types", oracle("select race, event, case when count(distance_m) = 0 then 'none' when bool_or(distance_m > 400) then 'long' else min(distance_m) || 'm' end as kind from runs group by all"))
def split_types(spark, sf_dir):
    r = Tables(spark, sf_dir).runs.groupBy("race", "event")
    kind = F.when(F.count("distance_m") == 0, "none").when(F.bool_or(F.col("distance_m") > 400), "long").otherwise(F.concat(F.min("distance_m"), F.lit("m")))
    return r.agg(kind.alias("kind"))


@query("filtered_runs", oracle("select performance from runs where event in ('1-URGENT', '2-HIGH') and status = 'finished' and country <> 'NATION_1' and time_s between 50 and 150"))
def filtered_runs(spark, sf_dir):
    """A conjunction of chosen filters."""
    chosen = [F.col("event").isin("1-URGENT", "2-HIGH"), F.col("status") == "finished", F.col("country") != "NATION_1", F.col("time_s").between(50, 150)]
    return Tables(spark, sf_dir).runs.where(reduce(lambda a, b: a & b, chosen)).select("performance")


@query("masked_values", oracle("select s.performance, document, point, case when not suspect then s.time_s end as time_s from passings s where performance not in (select performance from runs where status = 'dnf')"))
def masked_values(spark, sf_dir):
    """Flagged values dropped, and whole runs whose result is."""
    t = Tables(spark, sf_dir)
    out = t.passings.join(t.runs.where("status = 'dnf'").select("performance"), "performance", "left_anti")
    return out.select("performance", "document", "point", F.when(~F.col("suspect"), F.col("time_s")).alias("time_s"))


@query("strips", oracle("select race, event, point, count(*) as entries, min(lap_s) as fastest, arg_min(performance, struct_pack(a := lap_s, b := performance)) as leader from passings join (select performance, race, event from runs) r using (performance) where not suspect group by all having count(*) >= 2"))
def strips(spark, sf_dir):
    """Stretches with two entries or more, and the fastest over each."""
    t = Tables(spark, sf_dir)
    d = t.passings.where("not suspect").join(t.runs.select("performance", "race", "event"), "performance")
    out = d.groupBy("race", "event", "point").agg(F.count("*").alias("entries"), F.min("lap_s").alias("fastest"), F.min_by("performance", F.struct("lap_s", "performance")).alias("leader"))
    return out.where("entries >= 2")


@query("grid_descriptions", oracle("select performance, document, case when count(*) = max(point) and max(point) > 1 then 'every 100 m' else 'uneven' end as grid from passings where not suspect group by all"))
def grid_descriptions(spark, sf_dir):
    """Whether the clean points of a series are evenly spaced from the gun."""
    s = Tables(spark, sf_dir).passings.where("not suspect").groupBy("performance", "document").agg(F.sort_array(F.collect_list("point")).alias("p"))
    even = F.forall(F.transform("p", lambda x, i: x == i + 1), lambda b: b) & (F.size("p") > 1)
    return s.select("performance", "document", F.when(even, "every 100 m").otherwise("uneven").alias("grid"))


@query("former_numbers", "select c_custkey as athlete, number from (select c_custkey, unnest([c_custkey * 10, c_custkey * 10 + c_nationkey]) as number from customer) where number % 3 = 0 group by all")
def former_numbers(spark, sf_dir):
    """One row per current and former number; an athlete is found by any of them."""
    c = Tables(spark, sf_dir).read("customer")
    numbers = F.explode(F.array_distinct(F.array(F.col("c_custkey") * 10, F.col("c_custkey") * 10 + F.col("c_nationkey"))))
    return c.select(F.col("c_custkey").alias("athlete"), numbers.alias("number")).where("number % 3 = 0")


@query("from_the_gun", oracle("select s.performance, document, point, (0.15 + s.time_s / r.time_s * (r.time_s - 0.15)) / r.time_s as share from passings s join runs r using (performance) where r.time_s > 0"))
def from_the_gun(spark, sf_dir):
    """A share of the race from the blocks as a share of the time from the gun."""
    t = Tables(spark, sf_dir)
    d = t.passings.join(t.runs.where("time_s > 0").select("performance", F.col("time_s").alias("f")), "performance")
    return d.select("performance", "document", "point", ((0.15 + F.col("time_s") / F.col("f") * (F.col("f") - 0.15)) / F.col("f")).alias("share"))


@query("laps_left", oracle("select race, event, cast(ceil((1500 - max(distance_m)) / 400.0) as bigint) as laps from runs where distance_m is not null group by all"))
def laps_left(spark, sf_dir):
    r = Tables(spark, sf_dir).runs.where("distance_m is not null").groupBy("race", "event")
    return r.agg(F.ceil((1500 - F.max("distance_m")) / 400).cast("long").alias("laps"))


@query("last_two_normal", oracle("with n as (select performance, document, point, lap_s > 10 as normal, row_number() over (partition by performance, document order by point desc) as back from passings) select performance, document, bool_and(normal) filter (where back <= 2) as last_two, count(*) filter (where not normal) as odd from n group by all"))
def last_two_normal(spark, sf_dir):
    w = W.partitionBy("performance", "document").orderBy(F.desc("point"))
    d = Tables(spark, sf_dir).passings.withColumns({"normal": F.col("lap_s") > 10, "back": F.row_number().over(w)})
    return d.groupBy("performance", "document").agg(F.bool_and(F.when(F.col("back") <= 2, F.col("normal"))).alias("last_two"), F.count_if(~F.col("normal")).alias("odd"))


@query("first_pages", oracle("select race, document, min(point) as page, count(*) as n from passings join (select performance, race from runs) r using (performance) group by all"))
def first_pages(spark, sf_dir):
    """The first page of a document that a race was read from."""
    t = Tables(spark, sf_dir)
    return t.passings.join(t.runs.select("performance", "race"), "performance").groupBy("race", "document").agg(F.min("point").alias("page"), F.count("*").alias("n"))


@query("mark_meanings", "select mark, n, case mark when 'A' then 'area record' when 'R' then 'retired' end as meaning from (select l_returnflag as mark, count(*) as n from lineitem group by all)")
def mark_meanings(spark, sf_dir):
    """Every printed mark with its meaning, or none."""
    t = Tables(spark, sf_dir)
    meanings = spark.createDataFrame([("A", "area record"), ("R", "retired")], "mark string, meaning string")
    marks = t.read("lineitem").groupBy(F.col("l_returnflag").alias("mark")).agg(F.count("*").alias("n"))
    return marks.join(F.broadcast(meanings), "mark", "left").select("mark", "n", "meaning")
