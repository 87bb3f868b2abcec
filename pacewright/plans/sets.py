"""Sets: unions, differences, overlaps, subset tests, ambiguity."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle


@query("race_points", oracle("select distinct race, distance_m from (select race, s.distance_m from passings s join runs using (performance) union all select race, distance_m from runs where distance_m is not null)"))
def race_points(spark, sf_dir):
    """All points of a race: of passings and of the finish."""
    t = Tables(spark, sf_dir)
    own = t.passings.select("performance", "distance_m").join(t.runs.select("performance", "race"), "performance").select("race", "distance_m")
    return own.union(t.runs.where("distance_m is not null").select("race", "distance_m")).distinct()


@query("declared_not_listed", "select o_orderkey as id from orders where o_orderkey % 3 <> 0 except select l_orderkey from lineitem")
def declared_not_listed(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.read("orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("id")).subtract(t.read("lineitem").select("l_orderkey"))


@query("listed_and_declared", "select o_orderkey as id from orders intersect select l_orderkey from lineitem")
def listed_and_declared(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.read("orders").select(F.col("o_orderkey").alias("id")).intersect(t.read("lineitem").select("l_orderkey"))


@query("own_points", oracle("with common as (select race, s.distance_m from passings s join (select performance, race, count(*) over (partition by race) as field from runs) r using (performance) group by all having count(distinct performance) = max(field)) select distinct performance, race, s.distance_m from passings s join runs using (performance) where (race, s.distance_m) not in (select (race, distance_m) from common)"))
def own_points(spark, sf_dir):
    """Points a run was timed at that its race doesn't share."""
    t = Tables(spark, sf_dir)
    field = t.runs.select("performance", "race", F.count("*").over(W.partitionBy("race")).alias("field"))
    timed = t.passings.select("performance", "distance_m").distinct().join(field, "performance")
    common = timed.groupBy("race", "distance_m").agg(F.count("*").alias("n"), F.max("field").alias("field")).where("n = field")
    return timed.join(common, ["race", "distance_m"], "left_anti").select("performance", "race", "distance_m")


@query("aliases", "select alias, owner from (select lower(c_mktsegment) || '-' || c_nationkey as alias, c_custkey as owner, count(*) over (partition by lower(c_mktsegment) || '-' || c_nationkey) as n from customer) where n = 1 and alias not in (select lower(n_name) from nation)")
def aliases(spark, sf_dir):
    """Aliases of one owner that are nobody's id."""
    t = Tables(spark, sf_dir)
    alias = F.concat(F.lower("c_mktsegment"), F.lit("-"), F.col("c_nationkey"))
    own = t.read("customer").select(alias.alias("alias"), F.col("c_custkey").alias("owner")).withColumn("n", F.count("*").over(W.partitionBy("alias")))
    ids = t.read("nation").select(F.lower("n_name").alias("alias"))
    return own.where("n = 1").join(ids, "alias", "left_anti").select("alias", "owner")


@query("same_field", """with f as (select o_custkey % 300 as race, cast(o_orderdate as date) - date '1992-01-01' as day, list(distinct l_suppkey) as field from orders join lineitem on l_orderkey = o_orderkey group by all),
g as (select race, day, unnest(field) as s, len(field) as n from f)
select a.race, a.day as day_a, b.day as day_b, count(*) as shared from g a join g b on a.race = b.race and a.s = b.s and a.day < b.day group by a.race, a.day, b.day, a.n, b.n having count(*) * 2 > least(a.n, b.n)""")
def same_field(spark, sf_dir):
    """Races listed twice: their fields overlap by more than half of the smaller; met through shared members."""
    t = Tables(spark, sf_dir)
    d = t.read("orders").join(t.read("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1992-01-01").cast("date")).cast("long")
    g = d.select((F.col("o_custkey") % 300).alias("race"), day.alias("day"), F.col("l_suppkey").alias("s")).distinct()
    g = g.join(g.groupBy("race", "day").agg(F.count("*").alias("n")), ["race", "day"])
    b = g.select("race", "s", F.col("day").alias("day_b"), F.col("n").alias("m"))
    pairs = g.join(b, ["race", "s"]).where("day < day_b").groupBy("race", F.col("day").alias("day_a"), "day_b", "n", "m").agg(F.count("*").alias("shared"))
    return pairs.where("shared * 2 > least(n, m)").select("race", "day_a", "day_b", "shared")


@query("faceted", oracle("select 'event' as facet, event as value, count(*) as n from runs where setting = 'BUILDING' and country = 'NATION_3' group by event union all select 'setting', setting, count(*) from runs where event = '1-URGENT' and country = 'NATION_3' group by setting union all select 'country', country, count(*) from runs where event = '1-URGENT' and setting = 'BUILDING' group by country"))
def faceted(spark, sf_dir):
    """Values offered by each facet, its own filter left out: one pass with exploded facets."""
    chosen = {"event": "1-URGENT", "setting": "BUILDING", "country": "NATION_3"}
    r = Tables(spark, sf_dir).runs.select(*chosen)
    passes = {k: F.col(k) == v for k, v in chosen.items()}
    facets = []
    for k in chosen:
        others = [p for j, p in passes.items() if j != k]
        facets.append(F.when(others[0] & others[1], F.struct(F.lit(k).alias("facet"), F.col(k).alias("value"))))
    return r.select(F.explode(F.array_compact(F.array(*facets))).alias("x")).groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))
