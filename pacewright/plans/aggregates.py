"""Roll-ups: event summaries, winners, bests, robust statistics, quantiles, tallies, grouping sets, pivots."""

from pyspark.sql import functions as F

from pacewright.operators import analysis, ranks
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle


@query("event_summary", oracle("select event, count(distinct race) as races, count(*) as performances, count(distinct athlete) as athletes, count(distinct case when distance_m is not null then performance end) as timed, array_to_string(list_sort(list(distinct setting)), ',') as settings, min(time_s) as fastest from runs group by event"))
def event_summary(spark, sf_dir):
    r = Tables(spark, sf_dir).runs
    return r.groupBy("event").agg(
        F.count_distinct("race").alias("races"), F.count("*").alias("performances"), F.count_distinct("athlete").alias("athletes"),
        F.count_distinct(F.when(F.col("distance_m").isNotNull(), F.col("performance"))).alias("timed"), F.array_join(F.sort_array(F.collect_set("setting")), ",").alias("settings"), F.min("time_s").alias("fastest"),
    )


@query("athlete_bests", oracle("select athlete, event, min(time_s) as best, count(time_s) as runs from runs where time_s is not null group by all"))
def athlete_bests(spark, sf_dir):
    r = Tables(spark, sf_dir).runs
    return r.where("time_s is not null").groupBy("athlete", "event").agg(F.min("time_s").alias("best"), F.count("time_s").alias("runs"))


@query("race_winners", oracle("select race, event, arg_min(performance, struct_pack(a := coalesce(time_s, 99999), b := performance)) as winner, min(time_s) as time_s from runs group by all"))
def race_winners(spark, sf_dir):
    r = Tables(spark, sf_dir).runs
    return r.groupBy("race", "event").agg(F.min_by("performance", F.struct(F.coalesce("time_s", F.lit(99999.0)), "performance")).alias("winner"), F.min("time_s").alias("time_s"))


@query("fastest_by_event", oracle("select event, arg_min(performance, struct_pack(a := time_s, b := performance)) as performance, min(time_s) as time_s from runs where time_s is not null group by event"))
def fastest_by_event(spark, sf_dir):
    r = Tables(spark, sf_dir).runs.where("time_s is not null")
    return r.groupBy("event").agg(F.min_by("performance", F.struct("time_s", "performance")).alias("performance"), F.min("time_s").alias("time_s"))


@query("typical_reactions", "select o_orderpriority as event, median(l_tax) as reaction, count(*) as n from lineitem join orders on l_orderkey = o_orderkey where l_tax > 0 and l_linenumber <= 4 group by all")
def typical_reactions(spark, sf_dir):
    """Median of a positive value per event, short races only."""
    t = Tables(spark, sf_dir)
    d = t.read("lineitem").where("l_tax > 0 and l_linenumber <= 4").join(t.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return ranks.median(d.withColumn("event", F.col("o_orderpriority")), ["event"], "l_tax", "reaction")


@query("robust_spread", "with c as (select o_orderpriority as event, median(o_totalprice) as centre from orders group by all) select event, any_value(centre) as centre, 1.4826 * median(abs(o_totalprice - centre)) as spread, count(*) as n from orders join c on event = o_orderpriority group by event")
def robust_spread(spark, sf_dir):
    o = Tables(spark, sf_dir).read("orders").withColumn("event", F.col("o_orderpriority"))
    centre = ranks.median(o, ["event"], "o_totalprice", "centre").drop("n")
    near = o.join(centre, "event").withColumn("off", F.abs(F.col("o_totalprice") - F.col("centre")))
    return ranks.median(near, ["event"], "off", "mad").join(centre, "event").select("event", "centre", (1.4826 * F.col("mad")).alias("spread"), "n")


_QUARTILE = "v[1 + cast(floor((len(v) - 1) * {q}) as int)] + (v[1 + cast(ceil((len(v) - 1) * {q}) as int)] - v[1 + cast(floor((len(v) - 1) * {q}) as int)]) * ((len(v) - 1) * {q} - floor((len(v) - 1) * {q}))"


@query("pace_profile", oracle(f"with v as (select event, point, list_sort(list(lap_s)) as v from passings join runs using (performance) where status = 'finished' group by all having count(*) >= 5) select event, point, {_QUARTILE.format(q=0.25)} as q1, {_QUARTILE.format(q=0.5)} as median, {_QUARTILE.format(q=0.75)} as q3, len(v) as n from v"))
def pace_profile(spark, sf_dir):
    """Quartiles of the time of each stretch by event, five runs and more."""
    t = Tables(spark, sf_dir)
    d = t.passings.join(t.runs.where("status = 'finished'").select("performance", "event"), "performance")
    return analysis.quartiles(d, ["event", "point"], "lap_s").where("n >= 5")


@query("nearest_rank_spread", oracle("with v as (select event, list_sort(list(time_s)) as v from runs where time_s is not null group by event) select event, v[1 + cast(floor((len(v) - 1) * 0.05 + 0.5) as int)] as low, v[1 + cast(floor((len(v) - 1) * 0.95 + 0.5) as int)] as high from v"))
def nearest_rank_spread(spark, sf_dir):
    """The values at the 5th and 95th hundredth of ranks."""
    return ranks.quantiles(Tables(spark, sf_dir).runs, ["event"], "time_s", {"low": 0.05, "high": 0.95}, nearest=True).drop("n")


@query("survey_grains", oracle("select series, event, cast(floor(cast(race[1:4] as int) / 10) * 10 as bigint) as decade, count(*) as races, count(distinct athlete) as athletes, count(*) filter (where race >= '1996') as since from runs group by grouping sets ((series), (event), (series, decade), ())"))
def survey_grains(spark, sf_dir):
    """One fact at four grains."""
    runs = Tables(spark, sf_dir).runs.select("series", "event", (F.floor(F.substring("race", 1, 4).cast("int") / 10) * 10).cast("long").alias("decade"), "athlete", "race")
    return spark.sql("select series, event, decade, count(*) as races, count(distinct athlete) as athletes, count_if(race >= '1996') as since from {runs} group by grouping sets ((series), (event), (series, decade), ())", runs=runs)


@query("survey_tally", oracle("select series, count(distinct race) as editions, cast(sum(greatest(held, 3)) as bigint) as races, cast(sum(least(held, 2)) as bigint) as published from (select series, race, count(*) as held from runs group by all) group by series"))
def survey_tally(spark, sf_dir):
    """Editions and races, at least those held, published ones capped."""
    held = Tables(spark, sf_dir).runs.groupBy("series", "race").agg(F.count("*").alias("held"))
    return held.groupBy("series").agg(F.count_distinct("race").alias("editions"), F.sum(F.greatest("held", F.lit(3))).alias("races"), F.sum(F.least("held", F.lit(2))).alias("published"))


@query("event_pivot", oracle("select event, count(*) filter (where status = 'finished') as finished, count(*) filter (where status = 'dnf') as dnf from runs group by event"))
def event_pivot(spark, sf_dir):
    return Tables(spark, sf_dir).runs.groupBy("event").pivot("status", ["finished", "dnf"]).count().na.fill(0)


@query("top_gaps", "select c_nationkey as nation, c_mktsegment as segment, count(*) as n from customer group by all order by n desc, nation, segment limit 25")
def top_gaps(spark, sf_dir):
    """The 25 largest counts: a report's limit."""
    c = Tables(spark, sf_dir).read("customer")
    return c.groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "nation", "segment").limit(25)


@query("pooled_courses", "select p_brand as course, count(distinct (p_size > 25)) = 1 as pooled, max(p_size) as longest from part group by all")
def pooled_courses(spark, sf_dir):
    """Courses whose layouts are equal for both groups."""
    p = Tables(spark, sf_dir).read("part")
    return p.groupBy(F.col("p_brand").alias("course")).agg((F.count_distinct(F.col("p_size") > 25) == 1).alias("pooled"), F.max("p_size").alias("longest"))


@query("id_clashes", "select c_name as id, count(*) as n, count(distinct c_nationkey) as claims from customer group by all having count(*) > 1 or count(distinct c_nationkey) > 1")
def id_clashes(spark, sf_dir):
    c = Tables(spark, sf_dir).read("customer")
    return c.groupBy(F.col("c_name").alias("id")).agg(F.count("*").alias("n"), F.count_distinct("c_nationkey").alias("claims")).where("n > 1 or claims > 1")


@query("density_outline", oracle("""with g as (select event, time_s as v from runs where time_s is not null),
s as (select event, count(*) as n, min(v) as lo, max(v) as hi, 20.0 as h from g group by event),
x as (select event, n, h, i, lo + (hi - lo) * i / 11 as x from s, range(0, 12) r(i))
select x.event, cast(i as bigint) as i, cast(floor(sum(exp(-0.5 * power((x - v) / h, 2))) * 1000 / n + 0.5) as bigint) as density from x join g on g.event = x.event group by x.event, i, n"""))
def density_outline(spark, sf_dir):
    """A Gaussian density at twelve points per event: the points are fixed, so it's one pass over the runs."""
    g = Tables(spark, sf_dir).runs.where("time_s is not null").select("event", F.col("time_s").alias("v"))
    s = g.groupBy("event").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    x = g.join(F.broadcast(s), "event").select("event", "v", "n", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i"))
    at = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("i") / 11
    weight = F.sum(F.exp(-0.5 * F.pow((at - F.col("v")) / 20.0, F.lit(2))))
    return x.groupBy("event", F.col("i").cast("long").alias("i"), "n").agg(weight.alias("w")).select("event", "i", F.floor(F.col("w") * 1000 / F.col("n") + 0.5).cast("long").alias("density"))
