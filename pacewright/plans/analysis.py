"""Pace analysis, shapes, plans, motion."""

from pyspark.sql import functions as F

from pacewright.operators import analysis as an
from pacewright.operators import motion, ranks
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables, oracle

_SETS = """own as (select performance, list_sort(list(distinct distance_m)) as points from passings where not suspect group by performance),
sets as (select event, points, count(*) as runs from own join runs using (performance) group by all),
held as (select g.event, g.points as grid, len(g.points) as size, cast(sum(s.runs) as bigint) as n from sets g join sets s on g.event = s.event and len(list_intersect(g.points, s.points)) = len(g.points) group by all)"""
_BEST = "best as (select event, arg_max(grid, struct_pack(a := size, b := n, c := grid)) as grid, arg_max(n, struct_pack(a := size, b := n, c := grid)) as n from held where n >= 30 group by event)"


@query("grids", oracle(f"with {_SETS} select event, array_to_string(grid, '-') as grid, size, n from held h where not exists (select 1 from held r where r.event = h.event and r.size > h.size and r.n >= h.n * 0.5 and len(list_intersect(h.grid, r.grid)) = h.size)"))
def grids(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return an.grids(t.runs, t.passings)


@query("finest_grid", oracle(f"with {_SETS}, {_BEST} select event, array_to_string(grid, '-') as grid, n from best"))
def finest_grid(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return an.finest_grid(t.runs, t.passings).select("event", F.array_join(F.col("grid").cast("array<string>"), "-").alias("grid"), "n")


@query("event_shape", oracle(f"""with {_SETS}, {_BEST},
sh as (select event, performance, s.distance_m, min(s.time_s / r.time_s) as share, min(r.time_s) as finish_s from passings s join runs r using (performance) where not suspect and status = 'finished' and r.time_s > 0 group by all),
pts as (select event, performance, list(distinct distance_m) as points, min(finish_s) as finish_s from sh group by all),
okay as (select p.*, grid from pts p join best using (event) where len(list_intersect(grid, points)) = len(grid)),
half as (select event, performance, grid, row_number() over (partition by event order by finish_s, performance) <= floor(count(*) over (partition by event) / 2) as fast from okay)
select event, distance_m, median(share) as share, median(share) filter (where fast) as faster, median(share) filter (where not fast) as slower from sh join half using (event, performance) where list_contains(grid, distance_m) group by all"""))
def event_shape(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return an.shape(t.passings, t.runs)


def _q(q: float) -> str:
    place = f"((len(v) - 1) * {q})"
    lo, hi = f"v[1 + cast(floor({place}) as int)]", f"v[1 + cast(ceil({place}) as int)]"
    return f"({lo} + ({hi} - {lo}) * ({place} - floor({place})))"


_SHARES = "v as (select event, s.distance_m, list_sort(list(s.time_s / r.time_s)) as v from passings s join runs r using (performance) where status = 'finished' and r.time_s > 0 group by all having count(*) >= 5)"


@query("split_plan", oracle(f"with {_SHARES} select event, distance_m, 0.15 + {_q(0.25)} * (50.0 - 0.15) as early_s, 0.15 + {_q(0.5)} * (50.0 - 0.15) as time_s, 0.15 + {_q(0.75)} * (50.0 - 0.15) as late_s, len(v) as n from v"))
def split_plan(spark, sf_dir):
    """Split times for a target of 50 s."""
    t = Tables(spark, sf_dir)
    return an.plan(an.shares(t.passings, t.runs), ["event", "distance_m"], 50.0, 0.15)


@query("half_difference", oracle("select event, median(f.time_s - 2 * s.time_s) as difference, count(*) as n from passings s join runs f using (performance) where f.distance_m = 400 and s.distance_m = 200 and f.status = 'finished' group by event"))
def half_difference(spark, sf_dir):
    """Second half less the first, by event."""
    t = Tables(spark, sf_dir)
    half = t.passings.where("distance_m = 200").select("performance", F.col("time_s").alias("half_s"))
    d = t.runs.where("distance_m = 400 and status = 'finished'").join(half, "performance")
    return ranks.median(d.withColumn("over", F.col("time_s") - 2 * F.col("half_s")), ["event"], "over", "difference")


@query("suggested_target", oracle("select event, case when count(case when setting = 'MACHINERY' then time_s end) >= 5 then median(case when setting = 'MACHINERY' then time_s end) else median(time_s) end as target_s from runs group by event"))
def suggested_target(spark, sf_dir):
    """The median finish of finals if there are five, else of all."""
    r = Tables(spark, sf_dir).runs
    finals = ranks.median(r.where("setting = 'MACHINERY'"), ["event"], "time_s", "of_finals").where("n >= 5").drop("n")
    return ranks.median(r, ["event"], "time_s", "of_all").join(finals, "event", "left").select("event", F.coalesce("of_finals", "of_all").alias("target_s"))


@query("peer_comparison", oracle("with m as (select event, setting, s.distance_m, median(lap_s) as typical_s, count(*) as n from passings s join runs using (performance) group by all having count(*) >= 20) select s.performance, s.document, s.point, s.lap_s - typical_s as difference from passings s join runs r using (performance) join m on m.event = r.event and m.setting = r.setting and m.distance_m = s.distance_m"))
def peer_comparison(spark, sf_dir):
    """Every stretch against the typical one of its event and setting."""
    t = Tables(spark, sf_dir)
    d = t.passings.join(t.runs.select("performance", "event", "setting"), "performance")
    typical = ranks.median(d, ["event", "setting", "distance_m"], "lap_s", "typical_s").where("n >= 20")
    return d.join(typical, ["event", "setting", "distance_m"]).select("performance", "document", "point", (F.col("lap_s") - F.col("typical_s")).alias("difference"))


@query("standings_at", oracle("with p as (select performance, max(distance_m) as d, min_by(time_s, struct_pack(a := -distance_m, b := time_s)) as t from passings where time_s <= 60 group by performance) select race, performance, d as distance_m, t as passed_s, cast(rank() over (partition by race order by d desc, t) as bigint) as place from p join (select performance, race from runs) r using (performance)"))
def standings_at(spark, sf_dir):
    """Standings of every race after 60 s."""
    t = Tables(spark, sf_dir)
    return motion.standings(t.passings, t.runs, 60.0)


@query("motion_positions")
def motion_positions(spark, sf_dir):
    return motion.positions(Tables(spark, sf_dir).passings)
