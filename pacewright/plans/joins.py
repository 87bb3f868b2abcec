"""Joins: dimensions, existence on two keys, as-of, interval and tolerance joins, division, audits."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle


@query("suspect_exists", oracle("""select performance, document, point, exists (select 1 from passings f where f.suspect and f.performance = s.performance and f.document = s.document and f.point = s.point)
  or exists (select 1 from runs r where r.performance = s.performance and r.status = 'dnf') as suspect from passings s"""))
def suspect_exists(spark, sf_dir):
    """An existence test on either of two keys, as two equality joins."""
    t = Tables(spark, sf_dir)
    by_split = t.passings.where("suspect").select("performance", "document", "point").distinct().withColumn("a", F.lit(True))
    by_run = t.runs.where("status = 'dnf'").select("performance").distinct().withColumn("b", F.lit(True))
    out = t.passings.select("performance", "document", "point").join(by_split, ["performance", "document", "point"], "left").join(by_run, "performance", "left")
    return out.select("performance", "document", "point", F.coalesce("a", "b", F.lit(False)).alias("suspect"))


@query("as_of_standings", """select event_id, user_id, cast(floor(epoch(ts) / 86400) as bigint) as day, before_id from (
  select e.event_id, e.user_id, e.ts, p.event_id as before_id, row_number() over (partition by e.event_id order by p.ts desc, p.event_id desc) as k
  from (select * from events where event_type = 'purchase') e left join (select * from events where event_type = 'view') p on p.user_id = e.user_id and p.ts <= e.ts) where k = 1""")
def as_of_standings(spark, sf_dir):
    """The latest earlier view of the same user at each purchase: a union ordered by time and the last value seen, no range join."""
    e = Tables(spark, sf_dir).read("events")
    both = e.where(F.col("event_type").isin("purchase", "view"))
    seen = F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True)
    first_views = F.when(F.col("event_type") == "view", 0).otherwise(1)
    order = W.partitionBy("user_id").orderBy("ts", first_views, "event_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    out = both.withColumn("before_id", seen.over(order)).where("event_type = 'purchase'")
    return out.select("event_id", "user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000).cast("long").alias("day"), "before_id")


@query("interval_overlap", """with i as (select l_orderkey as id, l_suppkey % 50 as country, cast(min(l_shipdate) as date) as first, cast(min(l_shipdate) as date) + cast(min(l_linenumber) as int) as last from lineitem group by l_orderkey, l_suppkey % 50)
select a.id, count(*) as overlaps from i a join i b on a.country = b.country and a.id <> b.id and a.first - 1 <= b.last and b.first <= a.last + 1 group by a.id""")
def interval_overlap(spark, sf_dir):
    """How many entries of its country each one overlaps within a day: those begun by its end less those ended before, from totals by day, no pairs."""
    d = Tables(spark, sf_dir).read("lineitem")
    first = F.min(F.to_date("l_shipdate"))
    i = d.groupBy(F.col("l_orderkey").alias("id"), (F.col("l_suppkey") % 50).alias("country")).agg(first.alias("first"), F.date_add(first, F.min("l_linenumber")).alias("last"))
    steps = i.select("country", F.col("first").alias("day"), F.lit(1).alias("began"), F.lit(0).alias("ended")).unionByName(i.select("country", F.col("last").alias("day"), F.lit(0).alias("began"), F.lit(1).alias("ended")))
    days = steps.groupBy("country", "day").agg(F.sum("began").alias("b"), F.sum("ended").alias("e"))
    # the days asked about take their place among the days on which something began or ended
    asked = i.select("country", F.explode(F.array(F.date_add("last", 1), F.date_sub("first", 2))).alias("day")).distinct().select("country", "day", F.lit(0).alias("b"), F.lit(0).alias("e"))
    upto = W.partitionBy("country").orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = days.unionByName(asked).groupBy("country", "day").agg(F.sum("b").alias("b"), F.sum("e").alias("e")).select("country", "day", F.sum("b").over(upto).alias("begun"), F.sum("e").over(upto).alias("over"))
    begun = totals.select("country", F.date_sub("day", 1).alias("last"), "begun")
    over = totals.select("country", F.date_add("day", 2).alias("first"), "over")
    met = i.join(begun, ["country", "last"]).join(over, ["country", "first"]).select("id", (F.col("begun") - F.col("over") - 1).alias("overlaps"))
    return met.groupBy("id").agg(F.sum("overlaps").alias("overlaps")).where("overlaps > 0")


@query("era_lookup", """select o_orderkey, era from (select o_orderkey, e.era, row_number() over (partition by o_orderkey order by e.era) as k
  from orders join (values (1, 1990, 1995, '1-URGENT,2-HIGH'), (2, 1992, 1999, ''), (3, 1996, 2010, '5-LOW')) e(era, y0, y1, only_of)
  on year(o_orderdate) between y0 and y1 and (only_of = '' or contains(only_of, o_orderpriority))) where k = 1""")
def era_lookup(spark, sf_dir):
    """The first era whose years and disciplines cover each race; the eras are a fixed, small table."""
    eras = spark.createDataFrame([(1, 1990, 1995, "1-URGENT,2-HIGH"), (2, 1992, 1999, ""), (3, 1996, 2010, "5-LOW")], "era int, y0 int, y1 int, only_of string")
    o = Tables(spark, sf_dir).read("orders")
    fits = F.year("o_orderdate").between(F.col("y0"), F.col("y1")) & ((F.col("only_of") == "") | F.contains(F.col("only_of"), F.col("o_orderpriority")))
    return o.join(F.broadcast(eras), fits).groupBy("o_orderkey").agg(F.min("era").alias("era"))


@query("common_points", oracle("select race, event, s.distance_m from passings s join (select performance, race, event, count(*) over (partition by race, event) as field from runs) r using (performance) group by all having count(distinct performance) = max(field)"))
def common_points(spark, sf_dir):
    """Points at which every run of a race was timed: relational division by counting."""
    t = Tables(spark, sf_dir)
    field = t.runs.select("performance", "race", "event", F.count("*").over(W.partitionBy("race", "event")).alias("field"))
    timed = t.passings.select("performance", "distance_m").distinct().join(field, "performance")
    return timed.groupBy("race", "event", "distance_m").agg(F.count("*").alias("n"), F.max("field").alias("field")).where("n = field").select("race", "event", "distance_m")


@query("catalog_audit", """select coalesce(o, l) as id, case when l is null then 'missing' when o is null then 'unlisted' when day is distinct from ship then 'moved' else 'same' end as bucket
from (select o_orderkey as o, cast(o_orderdate as date) as day from orders where o_orderkey % 3 <> 0) a
full join (select l_orderkey as l, cast(min(l_shipdate) as date) as ship from lineitem where l_orderkey % 5 <> 0 group by l_orderkey) b on o = l""")
def catalog_audit(spark, sf_dir):
    """Declared against listed: missing, unlisted, moved or the same, by a full outer join."""
    t = Tables(spark, sf_dir)
    declared = t.read("orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("o"), F.to_date("o_orderdate").alias("day"))
    listed = t.read("lineitem").where("l_orderkey % 5 <> 0").groupBy(F.col("l_orderkey").alias("l")).agg(F.min(F.to_date("l_shipdate")).alias("ship"))
    both = declared.join(listed, F.col("o") == F.col("l"), "full")
    bucket = F.when(F.col("l").isNull(), "missing").when(F.col("o").isNull(), "unlisted").when(~F.col("day").eqNullSafe(F.col("ship")), "moved").otherwise("same")
    return both.select(F.coalesce("o", "l").alias("id"), bucket.alias("bucket"))


@query("time_links", oracle("""select a.performance, min(b.athlete) as athlete from runs a join runs b on a.race = b.race and a.country = b.country and a.performance <> b.performance
  and abs(a.time_s - b.time_s) <= 2 group by a.performance having min(b.athlete) = max(b.athlete)"""))
def time_links(spark, sf_dir):
    """Registry candidates of the same day and country with almost the same time; only a single one links."""
    t = Tables(spark, sf_dir)
    a = t.runs.where("time_s is not null").select("performance", "race", "country", "time_s")
    b = a.join(t.runs.select("performance", "athlete"), "performance").select(F.col("performance").alias("other"), "race", "country", F.col("time_s").alias("listed"), "athlete")
    near = a.join(b, ["race", "country"]).where("performance <> other and abs(time_s - listed) <= 2")
    return near.groupBy("performance").agg(F.min("athlete").alias("athlete"), F.max("athlete").alias("most")).where("athlete = most").select("performance", "athlete")


@query("orphans", "select 'lineitem' as child, count(*) as n from lineitem where l_orderkey not in (select o_orderkey from orders) union all select 'customer', count(*) from customer where c_custkey not in (select o_custkey from orders)")
def orphans(spark, sf_dir):
    """Referential integrity by anti joins."""
    t = Tables(spark, sf_dir)
    lines = t.read("lineitem").join(t.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(F.lit("lineitem").alias("child"), F.count("*").alias("n"))
    people = t.read("customer").join(t.read("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.lit("customer").alias("child"), F.count("*").alias("n"))
    return lines.unionByName(people)


@query("nearest_anchor", """select l_orderkey, l_linenumber, l_partkey, l_quantity, case when best.d <= 3 then best.anchor end as anchor from lineitem,
  lateral (select anchor, abs(l_quantity - anchor) as d from (values (5), (15), (25), (40)) a(anchor) order by d, anchor limit 1) best""")
def nearest_anchor(spark, sf_dir):
    """The nearest column anchor within a tolerance, from a fixed array of anchors."""
    d = Tables(spark, sf_dir).read("lineitem")
    anchors = F.array(*map(F.lit, (5, 15, 25, 40)))
    best = F.array_min(F.transform(anchors, lambda a: F.struct(F.abs(F.col("l_quantity") - a).alias("d"), a.alias("anchor"))))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.when(best["d"] <= 3, best["anchor"]).alias("anchor"))


@query("latest_snapshot", "select user_id, event_type, arg_max(event_id, struct_pack(a := ts, b := event_id)) as event_id from events semi join (select user_id from events where value > 90) w using (user_id) group by all")
def latest_snapshot(spark, sf_dir):
    """The latest row per key of wanted users."""
    e = Tables(spark, sf_dir).read("events")
    wanted = e.where("value > 90").select("user_id").distinct()
    return e.join(wanted, "user_id", "left_semi").groupBy("user_id", "event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("mutual_links", "select o_custkey, o_orderkey from (select o_custkey, o_orderkey, count(*) over (partition by o_custkey, o_orderpriority) as n from orders) where n = 1")
def mutual_links(spark, sf_dir):
    """Links that no other row shares."""
    o = Tables(spark, sf_dir).read("orders")
    n = F.count("*").over(W.partitionBy("o_custkey", "o_orderpriority"))
    return o.withColumn("n", n).where("n = 1").select("o_custkey", "o_orderkey")
