"""The checks over the model's tables."""

from pyspark.sql import functions as F

from pacewright.operators import assembly as asm
from pacewright.operators import flags, views
from pacewright.plans import assembly
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle

_SCORES = """finished as (select performance, event, setting, time_s as finish_s from runs where status = 'finished' and time_s > 0),
shares as (select s.*, event, setting, time_s / finish_s as share from passings s join finished using (performance)),
centre as (select event, setting, distance_m, median(share) as centre from shares group by all having count(*) >= 20),
near as (select * from shares join centre using (event, setting, distance_m)),
spread as (select event, setting, distance_m, 1.4826 * median(abs(share - centre)) as spread from near group by all),
scores as (select *, (share - centre) / spread as z from near join spread using (event, setting, distance_m) where spread > 0),
back as (select *, row_number() over (partition by performance, document order by distance_m desc, point desc) as back from scores),
late as (select performance, document from back group by all having count(*) >= 2 and max(z) < 0 and min(z) < -5 and max(case when back <= 2 then z end) < -3)"""
_LAST = "(select *, max(point) over (partition by performance, document) as last from passings)"
_PLACED = "(select *, case when time_s is not null and status = 'finished' then rank() over (partition by race, event, status order by time_s) end as place from runs)"

SQL = {
    "split-order": "select performance, document, point, 'split' as field from (select *, lag(time_s) over (partition by performance, document order by distance_m, point) as b from passings) where time_s <= b",
    "split-before-finish": f"select performance, document, point, 'split' as field from {_LAST} s join (select performance, time_s as f from runs) using (performance) where point < last and time_s >= f",
    "finish-matches-result": f"select performance, document, point, 'split' as field from {_LAST} s join (select performance, time_s as f from runs) using (performance) where point = last and (f is null or time_s <> f)",
    "segment-speed": f"""select performance, document, point, 'split' as field from (
  select performance, document, coalesce(point, lag(point) over w) as point, distance_m - lag(distance_m, 1, 0) over w as dm, time_s - lag(time_s, 1, 0.0) over w as ds from (
    select s.performance, document, case when f is null or point < last then point end as point, case when f is null or point < last then s.distance_m else m end as distance_m, case when f is null or point < last then s.time_s else f end as time_s
    from {_LAST} s left join (select performance, time_s as f, distance_m as m from runs where status = 'finished') r using (performance))
  window w as (partition by performance, document order by distance_m, point nulls last))
  where ds > 0 and cast(dm as double) / ds > 12.6 and point is not null""",
    "segment-matches-passings": """select performance, document, end_m as point, 'segment' as field from (
  select s.performance, s.document, s.distance_m as end_m, s.lap_s + case when s.suspect and s.mark = 'A' then 1 else 0 end as printed, s.time_s - coalesce(b.time_s, 0) as expected, coalesce(b.time_s, 0) = 0 as gun
  from passings s left join passings b on b.performance = s.performance and b.document = s.document and b.distance_m = s.distance_m - 100)
  where round(abs(printed - expected), 6) > round(greatest(0.01, 0.005 * case when gun then 2 else 3 end), 6)""",
    "birth-dates-agree": """select o_orderkey as performance, cast(null as varchar) as document, cast(null as bigint) as point, 'birth_date' as field from (select *, count(distinct y) over (partition by o_custkey) as k from (select o_orderkey, o_custkey, o_totalprice > 450000 as y from orders)) where k > 1""",
    "documents-agree": "select subject as performance, cast(null as varchar) as document, cast(null as bigint) as point, field from (CONFLICTS)",
    "athlete-in-race": "select distinct cast(null as bigint) as performance, race || '/' || l_linestatus as document, cast(null as bigint) as point, cast(null as varchar) as field from lineitem join runs on l_orderkey = performance where not exists (select 1 from runs r where r.race = runs.race and r.athlete = l_suppkey)",
    "reader-notes": "select cast(null as bigint) as performance, document, cast(null as bigint) as point, cast(null as varchar) as field from passings where lap_s >= 50 and mark = 'R'",
    "split-outlier": f"with {_SCORES} select performance, document, point, 'split' as field from scores where abs(z) > 5 and (performance, document) not in (select (performance, document) from late)",
    "time-lost-late": f"with {_SCORES} select distinct performance, cast(null as varchar) as document, cast(null as bigint) as point, 'result' as field from late",
    "place-order": f"""select performance, cast(null as varchar) as document, cast(null as bigint) as point, 'place' as field from (
  select *, count(*) over (partition by race, event order by time_s range between unbounded preceding and current row) as level, rank() over (partition by race, event order by time_s) - 1 as faster
  from {_PLACED} where place is not null) where place <= faster or place > level""",
}


SQL["documents-agree"] = SQL["documents-agree"].replace("CONFLICTS", assembly.CONFLICTS)


def _inputs(t: Tables) -> flags.Inputs:
    lines = t.read("lineitem").select(F.col("l_orderkey").alias("performance"), F.col("l_linestatus").alias("document"), F.col("l_suppkey").alias("athlete"))
    return flags.Inputs(
        t.passings, views.results(t.runs), t.stretches, t.placed_points, t.births, asm.merge(assembly.readings(t), ["mark", "lane"])[1],
        lines.join(t.runs.select("performance", "race"), "performance").select("race", "document", "athlete"), t.passings.where("lap_s >= 50 and mark = 'R'").select("document", F.lit("long stretch").alias("text")),
    )


def _misprinted(t: Tables) -> flags.Inputs:
    """The tables with misprints that the checks of order are there to find: times too late or too early, places two too low."""
    off = F.when(F.col("suspect") & (F.col("mark") == "A"), 60.0).when(F.col("suspect") & (F.col("mark") == "N"), -40.0).otherwise(0.0)
    place = F.col("place") + F.when(F.col("athlete") % 10 == 0, 2).otherwise(0)
    return flags.Inputs(t.passings.withColumn("time_s", F.col("time_s") + off), views.results(t.runs).withColumn("place", place))


_MISPRINTS = {
    "split-order": ("from passings", "from (select * replace (time_s + case when suspect and mark = 'A' then 60 when suspect and mark = 'N' then -40 else 0 end as time_s) from passings) p"),
    "split-before-finish": ("from passings", "from (select * replace (time_s + case when suspect and mark = 'A' then 60 when suspect and mark = 'N' then -40 else 0 end as time_s) from passings) p"),
    "place-order": ("end as place from runs", "+ case when athlete % 10 = 0 then 2 else 0 end end as place from runs"),
}


def _register(check_id: str) -> None:
    own = flags.CHECKS[check_id]
    body = oracle(SQL[check_id].replace(*_MISPRINTS[check_id]) if check_id in _MISPRINTS else SQL[check_id])
    sql = f"select '{check_id}' as check_id, '{own.severity}' as severity, {str(own.suspect).lower()} as suspect, * from ({body})"

    @query(f"check_{check_id.replace('-', '_')}", sql)
    def run(spark, sf_dir):
        t = Tables(spark, sf_dir)
        return own.run(_misprinted(t) if check_id in _MISPRINTS else _inputs(t))


for _id in SQL:
    _register(_id)


@query("outlier_scores", oracle(f"with {_SCORES} select performance, document, point, z from scores"))
def outlier_scores(spark, sf_dir):
    return flags.outlier_scores(_inputs(Tables(spark, sf_dir))).select("performance", "document", "point", "z")


@query("flag_counts", oracle("with f as (" + " union all ".join(f"select '{k}' as check_id, '{flags.CHECKS[k].severity}' as severity, performance from ({SQL[k]})" for k in ("split-order", "segment-speed", "finish-matches-result")) + ") select check_id, severity, count(*) as flags, count(distinct race) as races from f join runs using (performance) group by all"))
def flag_counts(spark, sf_dir):
    """Findings by check and severity, and the races they are in."""
    t = Tables(spark, sf_dir)
    return flags.counts(flags.Inputs(t.passings, t.runs))


@query("check_rank_order")
def rank_order(spark, sf_dir):
    """Printed positions that the times at their point don't allow; a longest agreeing sequence has no SQL."""
    return flags.CHECKS["rank-order"].run(_inputs(Tables(spark, sf_dir)))


@query("outlier_verdicts", oracle(f"with {_SCORES} select performance, document, point, count(*) over w > 1 and count(*) filter (where abs(z) >= 3) over w - case when abs(z) >= 3 then 1 else 0 end = 0 as others_normal from scores window w as (partition by performance, document)"))
def outlier_verdicts(spark, sf_dir):
    """Whether the other scored points of a series are normal."""
    return flags.others_normal(flags.outlier_scores(_inputs(Tables(spark, sf_dir)))).select("performance", "document", "point", "others_normal")


@query("check_registry", "select * from (values " + ", ".join(f"('{c.check_id}', '{c.group}', '{c.severity}', {str(c.suspect).lower()})" for c in flags.CHECKS.values()) + ") v(check_id, check_group, severity, suspect)")
def check_registry(spark, sf_dir):
    return flags.registry(spark).drop("title")


@query(
    "printed_precision",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_tax,
  (floor(l_extendedprice / 10) = floor(l_extendedprice / 10) or floor(l_extendedprice / 10) = floor(l_extendedprice / 10 + 0.5)) as agrees,
  case when l_tax = 0 then 0.0 when l_linenumber <= 1 then power(10.0, -l_linenumber) else power(10.0, -l_linenumber) / 2 end as slack from lineitem""",
)
def printed_precision(spark, sf_dir):
    """Equality across printed precisions, and the slack of a printed value."""
    d = Tables(spark, sf_dir).read("lineitem")
    exact = F.col("l_extendedprice") / 10
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_tax", flags.equal_printed(exact, F.floor(exact).cast("double"), F.lit(0)).alias("agrees"), flags.slack(F.col("l_tax"), F.col("l_linenumber")).alias("slack"))
