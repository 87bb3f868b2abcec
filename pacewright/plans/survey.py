"""The survey of what could be held, and streaming of new readings."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pacewright.operators import calendar
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle
from pacewright.streaming import readings


@query("first_count_wins", "select o_custkey, o_orderpriority, arg_min(o_shippriority, k) as n from (select o_custkey, o_orderpriority, case when o_orderstatus <> 'P' then o_orderkey % 10 end as o_shippriority, o_orderkey as k from orders) where o_shippriority is not null group by all")
def first_count_wins(spark, sf_dir):
    """The first count that is known, by priority of its source."""
    o = Tables(spark, sf_dir).read("orders").where("o_orderstatus <> 'P'")
    return o.groupBy("o_custkey", "o_orderpriority").agg(F.min_by(F.col("o_orderkey") % 10, "o_orderkey").alias("n"))


@query("held_or_fallback", "select o_orderkey, coalesce(a.n, b.n, 0) as n from orders left join (select c_nationkey as k, c_mktsegment as s, count(*) as n from customer where c_nationkey < 12 group by all) a on a.k = o_custkey % 25 and a.s = 'BUILDING' left join (select c_nationkey as k, count(*) as n from customer where c_nationkey < 20 group by all) b on b.k = o_custkey % 25")
def held_or_fallback(spark, sf_dir):
    """An entry on its full key, else on the key without its last part."""
    t = Tables(spark, sf_dir)
    c = t.read("customer")
    full = c.where("c_nationkey < 12 and c_mktsegment = 'BUILDING'").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("a"))
    part = c.where("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("b"))
    o = t.read("orders").withColumn("k", F.col("o_custkey") % 25)
    return o.join(full, "k", "left").join(part, "k", "left").select("o_orderkey", F.coalesce("a", "b", F.lit(0)).alias("n"))


@query("chosen_edition", "select o_orderkey, arg_min(l_partkey, struct_pack(a := rule, b := l_partkey)) as edition from (select o_orderkey, l_partkey, case when l_suppkey % 10 = o_custkey % 10 then 1 when l_quantity > 40 then 2 else 3 end as rule from orders join lineitem on l_orderkey = o_orderkey) group by o_orderkey")
def chosen_edition(spark, sf_dir):
    """The best match by rule, ties by id."""
    t = Tables(spark, sf_dir)
    d = t.read("orders").join(t.read("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    rule = F.when(F.col("l_suppkey") % 10 == F.col("o_custkey") % 10, 1).when(F.col("l_quantity") > 40, 2).otherwise(3)
    return d.groupBy("o_orderkey").agg(F.min_by("l_partkey", F.struct(rule, "l_partkey")).alias("edition"))


@query("undercard", oracle("select race, avg(case when country = 'NATION_3' then 1.0 else 0.0 end) >= 0.5 as host_field, count(*) as field from runs group by race"))
def undercard(spark, sf_dir):
    """Whether at least half of a field comes from the host."""
    r = Tables(spark, sf_dir).runs
    return r.groupBy("race").agg((F.avg(F.when(F.col("country") == "NATION_3", 1.0).otherwise(0.0)) >= 0.5).alias("host_field"), F.count("*").alias("field"))


@query("calendar_days", "select c_custkey, cast(unnest(range(date '1995-01-01' + cast(c_custkey % 300 as int) - 1, date '1995-01-01' + cast(c_custkey % 300 as int) + 2, interval 1 day)) as date) - date '1995-01-01' as day from customer")
def calendar_days(spark, sf_dir):
    """An entry on every day of its range and a day on either side."""
    c = Tables(spark, sf_dir).read("customer")
    first = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    days = F.sequence(F.date_sub(first, 1), F.date_add(first, 1))
    return c.select("c_custkey", F.explode(days).alias("d")).select("c_custkey", F.datediff("d", F.lit("1995-01-01").cast("date")).cast("long").alias("day"))


@query("windowed_events", "select cast(floor(epoch(ts) / 3600) as bigint) as hour, event_type, count(*) as n from events group by all")
def windowed_events(spark, sf_dir):
    """Hourly counts of a stream of events, read to its end."""
    return readings.hourly_counts(spark, sf_dir)


@query("round_labels", oracle("select performance, count(*) over (partition by race, event) > 1 as labelled from runs"))
def round_labels(spark, sf_dir):
    return Tables(spark, sf_dir).runs.select("performance", (F.count("*").over(W.partitionBy("race", "event")) > 1).alias("labelled"))


_CALENDAR = """with part_city as (select p_partkey, min(p_type) as city from part group by p_partkey),
held as (select o_orderkey as id, o_custkey as country, cast(o_orderdate as date) as first, cast(o_orderdate as date) + cast(o_orderkey % 4 as int) as last, lower(substr(city, 1, 5)) as city from orders left join part_city on p_partkey = o_custkey),
entries as (select l_orderkey || '-' || l_partkey as entry, l_suppkey as country, cast(min(l_shipdate) as date) as first, cast(min(l_shipdate) as date) + cast(min(l_linenumber) as int) as last, cast(min(l_quantity) as int) % 9 as rank, lower(min(city)) as city
  from lineitem left join part_city on p_partkey = l_partkey group by l_orderkey, l_partkey, l_suppkey),
met as (select id, entry, rank, abs(e.first - h.first) as gap, h.city as a, e.city as b from held h join entries e on h.country = e.country and e.first - 1 <= h.last and h.first <= e.last + 1)"""


def _calendar(spark, sf_dir):
    """Orders as editions and line items as entries of a calendar; the customer's number is the country, a part's type the city."""
    t = Tables(spark, sf_dir)
    cities = t.read("part").groupBy("p_partkey").agg(F.min("p_type").alias("city"))
    held = t.read("orders").join(cities, F.col("p_partkey") == F.col("o_custkey"), "left")
    first = F.to_date("o_orderdate")
    held = held.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("country"), first.alias("first"), F.date_add(first, (F.col("o_orderkey") % 4).cast("int")).alias("last"), F.lower(F.substr("city", F.lit(1), F.lit(5))).alias("city"))
    items = t.read("lineitem").join(cities, F.col("p_partkey") == F.col("l_partkey"), "left").groupBy("l_orderkey", "l_partkey", F.col("l_suppkey").alias("country"))
    shipped = F.to_date(F.min("l_shipdate"))
    entries = items.agg(shipped.alias("first"), F.date_add(shipped, F.min("l_linenumber").cast("int")).alias("last"), (F.min("l_quantity").cast("int") % 9).alias("rank"), F.lower(F.min("city")).alias("city"))
    return held, entries.withColumn("entry", F.concat_ws("-", "l_orderkey", "l_partkey")).drop("l_orderkey", "l_partkey")


@query(
    "calendar_best",
    _CALENDAR
    + """, ranked as (select id, entry, row_number() over (partition by id order by rank, gap, entry) as k, count(*) over (partition by id, rank, gap) as ties from met)
select held.id, entry, coalesce(ties, 0)::bigint as ties from held left join (select * from ranked where k = 1) using (id)""",
)
def calendar_best(spark, sf_dir):
    """The calendar's entry of each edition: overlapping days, the best class, the nearest beginning."""
    return calendar.best_entry(*_calendar(spark, sf_dir))


@query(
    "calendar_only",
    _CALENDAR
    + """, near as (select id, min(entry) as entry, count(*) as n from met where coalesce(a, '') = '' or (b <> '' and (starts_with(a, b) or starts_with(b, a))) group by id)
select held.id, case when n = 1 then entry end as entry, coalesce(n, 0)::bigint as candidates from held left join near using (id)""",
)
def calendar_only(spark, sf_dir):
    """The one entry of an edition's city on its days, if there is just one. The cities here are equal or differ by far, so likeness decides none."""
    return calendar.only_entry(*_calendar(spark, sf_dir))
