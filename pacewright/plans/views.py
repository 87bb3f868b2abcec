"""The analytic views over the model's tables."""

from pyspark.sql import functions as F

from pacewright.operators import views
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle

FLAGS_SQL = """flags as (
  select performance, document, point, 'split' as field from passings where suspect
  union all select performance, null, null, 'result' from runs where distance_m >= 600 and time_s < 100)"""
RESULTS_SQL = "select *, case when time_s is not null and status = 'finished' then cast(rank() over (partition by race, event, status order by time_s) as bigint) end as place from runs"


def flags_of(t: Tables):
    """Stand-ins for findings: marked lines, and results that are too good."""
    split = t.passings.where("suspect").select("performance", "document", "point", F.lit("split").alias("field"))
    result = t.runs.where("distance_m >= 600 and time_s < 100").select("performance", F.lit(None).cast("string").alias("document"), F.lit(None).cast("long").alias("point"), F.lit("result").alias("field"))
    return split.unionByName(result)


@query("results", oracle(RESULTS_SQL))
def results(spark, sf_dir):
    return views.results(Tables(spark, sf_dir).runs)


@query(
    "split_analysis",
    oracle(f"""with {FLAGS_SQL},
official as (select performance, time_s as finish_s, distance_m as finish_m from runs where status = 'finished' and time_s is not null),
points as (
  select performance, document, point, distance_m, time_s from (select *, max(point) over (partition by performance, document) as last from passings) x where point < last
  union all select s.performance, s.document, null, finish_m, finish_s from (select distinct performance, document from passings) s join official using (performance)),
seg as (
  select *, distance_m - lag(distance_m, 1, 0) over w as segment_m, time_s - lag(time_s, 1, 0.0) over w as segment_s
  from points window w as (partition by performance, document order by distance_m, point nulls first))
select performance, document, point, distance_m, time_s, segment_m, segment_s, cast(segment_m as double) / nullif(segment_s, 0) as speed_mps, time_s / nullif(finish_s, 0) as share,
  exists (select 1 from flags f where f.field = 'split' and f.performance = seg.performance and f.document = seg.document and f.point = seg.point)
  or exists (select 1 from flags f where f.field = 'result' and f.performance = seg.performance) as suspect
from seg left join official using (performance)"""),
)
def split_analysis(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return views.split_analysis(t.passings, t.runs, flags_of(t))


@query(
    "trace_prefix",
    oracle("""with own as (select performance, race || '/' || event || '/' || performance as id, time_s from runs)
select id as record, 'result' as kind, time_s from own where starts_with(id, '1995-1')
union all select id || '/' || point || '@' || document, 'split', s.time_s from passings s join own using (performance) where starts_with(id, '1995-1')"""),
)
def trace_prefix(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return views.trace(t.passings, t.runs, "1995-1")
