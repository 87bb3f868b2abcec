"""Pace analysis: quartiles, timing grids, profiles, plans, shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pacewright.operators import ranks


def quartiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """q1, median, q3 by linear interpolation between ranks, and n, per group."""
    return ranks.quantiles(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})


def point_sets(passings: DataFrame) -> DataFrame:
    """performance, points (sorted distances of its clean points), k."""
    clean = passings.where("not suspect").groupBy("performance").agg(F.sort_array(F.collect_set("distance_m")).alias("points"))
    return clean.withColumn("k", F.size("points").cast("long"))


def grids(runs: DataFrame, passings: DataFrame, least_share: float = 0.5) -> DataFrame:
    """event, grid, size, n: point sets races were timed on, and the runs clean at every point.

    A grid goes if a strictly richer one holds all its points with at least half as many runs. Runs meet
    grids as distinct point sets with counts, so the pairs are of sets, not of runs.
    """
    sets = point_sets(passings).join(runs.select("performance", "event"), "performance").groupBy("event", "points").agg(F.count("*").alias("runs"))
    grid = sets.select("event", F.col("points").alias("grid"), F.size("points").cast("long").alias("size"))
    held = grid.join(sets, "event").where(F.size(F.array_except("grid", "points")) == 0).groupBy("event", "grid", "size").agg(F.sum("runs").alias("n"))
    richer = held.select("event", F.col("grid").alias("rich"), F.col("size").alias("rich_size"), F.col("n").alias("rich_n"))
    covers = (F.size(F.array_except("grid", "rich")) == 0) & (F.col("rich_size") > F.col("size")) & (F.col("rich_n") >= F.col("n") * least_share)
    covered = held.join(richer, "event").where(covers).select("event", "grid").distinct()
    return held.join(covered, ["event", "grid"], "left_anti").select("event", F.array_join(F.col("grid").cast("array<string>"), "-").alias("grid"), "size", "n")


def finest_grid(runs: DataFrame, passings: DataFrame, least: int = 30) -> DataFrame:
    """event, grid (array), size, n: the point set with most points that at least ``least`` runs hold."""
    sets = point_sets(passings).join(runs.select("performance", "event"), "performance").groupBy("event", "points").agg(F.count("*").alias("runs"))
    grid = sets.select("event", F.col("points").alias("grid"), F.size("points").cast("long").alias("size"))
    held = grid.join(sets, "event").where(F.size(F.array_except("grid", "points")) == 0).groupBy("event", "grid", "size").agg(F.sum("runs").alias("n"))
    best = F.max(F.struct("size", "n", "grid"))
    return held.where(F.col("n") >= least).groupBy("event").agg(best.alias("b")).select("event", "b.grid", "b.size", "b.n")


def shares(passings: DataFrame, runs: DataFrame) -> DataFrame:
    """Every split with its run's event and the share of the finishing time."""
    finished = runs.where("status = 'finished' and time_s > 0").select("performance", "event", "setting", "athlete", F.col("time_s").alias("finish_s"))
    return passings.join(finished, "performance").withColumn("share", F.col("time_s") / F.col("finish_s"))


def shape(passings: DataFrame, runs: DataFrame, least: int = 30) -> DataFrame:
    """event, distance_m, share, faster, slower: median shares at the points of the finest grid, of all and of the halves by finishing time."""
    best = finest_grid(runs, passings, least)
    rows = shares(passings.where("not suspect"), runs).groupBy("event", "performance", "distance_m").agg(F.min("share").alias("share"), F.min("finish_s").alias("finish_s"))
    own = rows.groupBy("event", "performance").agg(F.collect_set("distance_m").alias("points"), F.min("finish_s").alias("finish_s"))
    on = own.join(F.broadcast(best), "event").where(F.size(F.array_except("grid", "points")) == 0)
    w = W.partitionBy("event")
    halves = on.withColumn("fast", F.row_number().over(w.orderBy("finish_s", "performance")) <= F.floor(F.count("*").over(w) / 2)).select("event", "performance", "grid", "fast")
    met = rows.drop("finish_s").join(halves, ["event", "performance"]).where(F.array_contains("grid", F.col("distance_m")))
    keys = ["event", "distance_m"]
    of = lambda rows, name: ranks.median(rows, keys, "share", name).drop("n")
    return of(met, "share").join(of(met.where("fast"), "faster"), keys, "left").join(of(met.where("not fast"), "slower"), keys, "left")


def plan(rows: DataFrame, keys: list[str], target: float, reaction: float = 0.0, least: int = 5) -> DataFrame:
    """Planned times at each point for a target: the group's quartile shares applied to it, five runs and more."""
    q = quartiles(rows, keys, "share").where(F.col("n") >= least)
    at = lambda c: reaction + F.col(c) * (target - reaction)
    return q.select(*keys, at("q1").alias("early_s"), at("median").alias("time_s"), at("q3").alias("late_s"), "n")
