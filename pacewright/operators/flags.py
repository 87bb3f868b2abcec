"""The check registry and the checks: every check gives (check_id, severity, suspect, performance, document, point, field)."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pacewright.operators import ranks
from pacewright.operators.views import with_segments

#: Fixed values of the checks.
FASTEST_MPS, OUTLIER_Z, LATE_Z, NORMAL_Z, LEAST_GROUP, MAD_SCALE, ROUNDING = 12.6, 5.0, 3.0, 3.0, 20, 1.4826, 0.01
COLUMNS = ("check_id", "severity", "suspect", "performance", "document", "point", "field")


@dataclass(frozen=True)
class Inputs:
    """What checks read. ``passings`` may have a scale (printed decimals); the other tables are for the checks that need them."""

    passings: DataFrame
    runs: DataFrame  # with place
    stretches: DataFrame | None = None  # performance, document, start_m, end_m, time_s, perhaps scale
    placed_points: DataFrame | None = None  # race, document, point, distance_m, performance, time_s, rank
    births: DataFrame | None = None  # performance, athlete, printed
    conflicts: DataFrame | None = None  # subject, field
    entries: DataFrame | None = None  # race, document, athlete: whom a document times
    notes: DataFrame | None = None  # document, text


@dataclass(frozen=True)
class Check:
    check_id: str
    severity: str
    suspect: bool
    find: Callable[[Inputs], DataFrame]
    group: str = "logic"
    needs: tuple[str, ...] = ()

    @property
    def title(self) -> str:
        return (self.find.__doc__ or "").strip().split("\n")[0]

    def run(self, inputs: Inputs) -> DataFrame:
        found = self.find(inputs)
        for name, kind in (("performance", "long"), ("document", "string"), ("point", "long"), ("field", "string")):
            if name not in found.columns:
                found = found.withColumn(name, F.lit(None).cast(kind))
        found = found.withColumns({"check_id": F.lit(self.check_id), "severity": F.lit(self.severity), "suspect": F.lit(self.suspect)})
        return found.select(*COLUMNS)


CHECKS: dict[str, Check] = {}


def check(check_id: str, severity: str, suspect: bool = False, group: str = "logic", needs: tuple[str, ...] = ()):
    """Register a check under its id; ``needs`` are the inputs without which it can't run."""

    def register(find):
        CHECKS[check_id] = Check(check_id, severity, suspect, find, group, needs)
        return find

    return register


def run_checks(inputs: Inputs, only: list[str] | None = None) -> DataFrame:
    """The findings of all checks that the inputs allow, or of those named, one union; ``in_order`` sorts it."""
    able = (c for k, c in CHECKS.items() if (k in only if only is not None else all(getattr(inputs, n) is not None for n in c.needs)))
    return reduce(DataFrame.unionByName, (c.run(inputs) for c in able))


def in_order(findings: DataFrame) -> DataFrame:
    """By subject (performance, document, point), then check and field."""
    return findings.orderBy(*(F.asc_nulls_first(c) for c in ("performance", "document", "point", "check_id", "field")))


def registry(spark) -> DataFrame:
    """check_id, check_group, severity, suspect, title of every registered check."""
    rows = [(c.check_id, c.group, c.severity, c.suspect, c.title) for c in CHECKS.values()]
    return spark.createDataFrame(rows, "check_id string, check_group string, severity string, suspect boolean, title string")


def _split(df: DataFrame) -> DataFrame:
    return df.select("performance", "document", "point", F.lit("split").alias("field"))


@check("split-order", "error", True)
def split_order(x: Inputs) -> DataFrame:
    """A split no later than the one before."""
    return _split(x.passings.withColumn("before", F.lag("time_s").over(W.partitionBy("performance", "document").orderBy("distance_m", "point"))).where("time_s <= before"))


@check("split-before-finish", "error", True)
def split_before_finish(x: Inputs) -> DataFrame:
    """A split on the way at or after the official time."""
    late = x.passings.withColumn("last", F.max("point").over(W.partitionBy("performance", "document"))).where("point < last")
    return _split(late.join(x.runs.select("performance", F.col("time_s").alias("finish_s")), "performance").where("time_s >= finish_s"))


@check("finish-matches-result", "error", True, "consistency")
def finish_matches_result(x: Inputs) -> DataFrame:
    """A document's last point that isn't the official time, or any for a run without one.

    A time with few printed decimals may be the official one cut or rounded to them. A disqualified
    runner usually crossed the line, with no result to compare.
    """
    series = W.partitionBy("performance", "document")
    last = x.passings.withColumn("last", F.max("point").over(series)).where("point = last")
    both = last.join(x.runs.where("status <> 'dq'").select("performance", F.col("time_s").alias("finish_s")), "performance")
    return _split(both.where(_off_result(both, "finish_s")))


def _off_result(rows: DataFrame, result: str) -> Column:
    """Whether a time isn't the official one, in the decimals that are printed if there is a ``scale``."""
    same = F.col("time_s") == F.col(result)
    if "scale" in rows.columns:
        same = same | F.coalesce(equal_printed(F.col(result), F.col("time_s"), F.col("scale")), F.lit(False))
    return F.col(result).isNull() | ~same


@check("segment-matches-passings", "error", True, "consistency", ("stretches",))
def segment_matches_passings(x: Inputs) -> DataFrame:
    """A printed stretch time that isn't the difference of the times at its ends, but for rounding.

    The gun is at zero, and the official time stands for a finish that the document doesn't time. The
    slack is the rounding of all three printed times, a hundredth at least.
    """
    scale = F.col("scale") if "scale" in x.passings.columns else F.lit(2)
    at = x.passings.select("performance", "document", "distance_m", "time_s", scale.alias("scale"))
    finish = x.runs.where("status = 'finished' and time_s is not null").select("performance", F.col("distance_m").alias("finish_m"), F.col("time_s").alias("finish_s"))
    rows = x.stretches.withColumn("own", F.col("scale") if "scale" in x.stretches.columns else F.lit(2))
    rows = rows.join(at.toDF("performance", "document", "start_m", "start_s", "start_scale"), ["performance", "document", "start_m"], "left")
    rows = rows.join(at.toDF("performance", "document", "end_m", "end_s", "end_scale"), ["performance", "document", "end_m"], "left").join(finish, "performance", "left")
    start = F.when(F.col("start_m") == 0, 0.0).otherwise(F.col("start_s"))
    end = F.coalesce("end_s", F.when(F.col("end_m") == F.col("finish_m"), F.col("finish_s")))
    most = slack(F.col("time_s"), F.col("own")) + slack(start, F.coalesce("start_scale", F.lit(2))) + slack(end, F.coalesce("end_scale", F.lit(2)))
    off = F.abs(F.col("time_s") - (end - start))
    wrong = rows.where(F.round(off, 6) > F.round(F.greatest(F.lit(ROUNDING), most), 6))
    return wrong.select("performance", "document", F.col("end_m").cast("long").alias("point"), F.lit("segment").alias("field"))


def _with_official_end(rows: DataFrame) -> DataFrame:
    """``rows`` with ``last``, finish_m and finish_s, where the official finish stands for a series' own last point; its point is null then."""
    ends = F.col("finish_s").isNotNull() & (F.col("point") == F.col("last"))
    there = rows.where(F.col("finish_s").isNull() | (F.col("point") <= F.col("last")))
    point, metres, seconds = F.when(~F.coalesce(ends, F.lit(False)), F.col("point")), F.when(ends, F.col("finish_m")).otherwise(F.col("distance_m")), F.when(ends, F.col("finish_s")).otherwise(F.col("time_s"))
    return there.withColumns({"point": point, "distance_m": metres, "time_s": seconds})


def _with_fast(points: DataFrame) -> DataFrame:
    """``points`` with ``at``, the point of a stretch (that before, for an official finish), where it is covered faster than anyone runs."""
    before = F.lag("point").over(W.partitionBy("performance", "document").orderBy("distance_m", F.asc_nulls_last("point")))
    fast = (F.col("segment_s") > 0) & (F.col("segment_m") / F.col("segment_s") > FASTEST_MPS)
    return with_segments(points.withColumn("before", before)).withColumn("at", F.when(fast, F.coalesce("point", "before")))


@check("segment-speed", "error", True)
def segment_speed(x: Inputs) -> DataFrame:
    """A stretch covered faster than anyone runs; stretches that take no time are another check's.

    The official finish is the last point of a finished run, in place of the document's own last one; a
    stretch to it is held against the point before.
    """
    last = F.max("point").over(W.partitionBy("performance", "document"))
    official = x.runs.where("status = 'finished' and time_s is not null").select("performance", F.col("distance_m").alias("finish_m"), F.col("time_s").alias("finish_s"))
    rows = x.passings.withColumn("last", last).join(official, "performance", "left")
    return _split(_with_fast(_with_official_end(rows)).where("at is not null").withColumn("point", F.col("at")))


def counts(x: Inputs) -> DataFrame:
    """check_id, severity, flags, races: the findings of split-order, finish-matches-result and segment-speed, and the races they are in.

    The three look at the same series beside the same results (one row for a performance), so one pass marks
    a passing with all of them, and findings are summed within races before races are counted.
    """
    series = W.partitionBy("performance", "document")
    rows = x.passings.withColumn("last", F.max("point").over(series)).withColumn("earlier", F.lag("time_s").over(series.orderBy("distance_m", "point")))
    runs = x.runs.select("performance", "race", "status", F.col("distance_m").alias("finish_m"), F.col("time_s").alias("result_s"))
    rows = rows.join(runs, "performance")
    off = (F.col("point") == F.col("last")) & (F.col("status") != "dq") & _off_result(rows, "result_s")
    rows = rows.withColumns({"split-order": F.col("time_s") <= F.col("earlier"), "finish-matches-result": off, "finish_s": F.when(F.col("status") == "finished", F.col("result_s"))})
    rows = _with_fast(_with_official_end(rows)).withColumn("segment-speed", F.col("at").isNotNull())
    ids = ["split-order", "segment-speed", "finish-matches-result"]
    by_race = rows.groupBy("race").agg(*(F.count_if(F.col(f"`{k}`")).alias(k) for k in ids))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("check_id"), F.lit(CHECKS[k].severity).alias("severity"), F.col(f"`{k}`").alias("n")) for k in ids)))
    found = by_race.select("race", each.alias("of")).where("of.n > 0")
    return found.groupBy("of.check_id", "of.severity").agg(F.sum("of.n").alias("flags"), F.count("race").alias("races"))


def outlier_scores(x: Inputs) -> DataFrame:
    """Robust z-score of every split's share of the finish within event, setting and distance.

    Centre and spread are the median and 1.4826 times the median absolute deviation; a group is scored
    with at least 20 shares and a positive spread.
    """
    group = ["event", "setting", "distance_m"]
    finished = x.runs.where("status = 'finished' and time_s > 0").select("performance", "event", "setting", F.col("time_s").alias("finish_s"))
    shares = x.passings.join(finished, "performance").withColumn("share", F.col("time_s") / F.col("finish_s"))
    centre = ranks.median(shares, group, "share", "centre").where(F.col("n") >= LEAST_GROUP)
    near = shares.join(centre, group)
    spread = ranks.median(near.withColumn("off", F.abs(F.col("share") - F.col("centre"))), group, "off", "mad").select(*group, (MAD_SCALE * F.col("mad")).alias("spread")).where("spread > 0")
    return near.join(spread, group).withColumn("z", (F.col("share") - F.col("centre")) / F.col("spread"))


def with_lateness(scores: DataFrame) -> DataFrame:
    """``scores`` with ``late``: whether the series lost time late, with two scores or more, all negative, one below -5, the last two below -3."""
    series = W.partitionBy("performance", "document")
    ranked = scores.withColumn("back", F.row_number().over(series.orderBy(F.desc("distance_m"), F.desc("point"))))
    facts = F.count("*"), F.max("z"), F.min("z"), F.max(F.when(F.col("back") <= 2, F.col("z")))
    n, most, least, last_two = (f.over(series) for f in facts)
    return ranked.withColumn("late", (n >= 2) & (most < 0) & (least < -OUTLIER_Z) & (last_two < -LATE_Z)).drop("back")


def late_runs(scores: DataFrame) -> DataFrame:
    """Series that lost time late."""
    return with_lateness(scores).where("late").select("performance", "document").distinct()


def others_normal(scores: DataFrame) -> DataFrame:
    """``scores`` with whether a series has other scored points and all of them are below three: then an outlier is a timing error, likely."""
    series = W.partitionBy("performance", "document")
    odd = F.count_if(F.abs("z") >= NORMAL_Z).over(series) - (F.abs("z") >= NORMAL_Z).cast("int")
    return scores.withColumn("others_normal", (F.count("*").over(series) > 1) & (odd == 0))


@check("split-outlier", "warning", True, "anomaly")
def split_outlier(x: Inputs) -> DataFrame:
    """A score beyond five, unless the run lost time late."""
    odd = W.partitionBy("performance", "document")
    far = outlier_scores(x).withColumn("far", F.max(F.abs("z")).over(odd)).where(F.col("far") > OUTLIER_Z)
    return _split(with_lateness(far).where((F.abs("z") > OUTLIER_Z) & ~F.col("late")))


@check("time-lost-late", "info", True, "anomaly")
def time_lost_late(x: Inputs) -> DataFrame:
    """One finding per run that lost time late, on its result."""
    return late_runs(outlier_scores(x)).select("performance").distinct().withColumn("field", F.lit("result"))


def longest_rising(ranks: np.ndarray) -> np.ndarray:
    """Which members belong to the longest non-falling subsequence.

    Of equally long ones it is the one that ends earliest, and of a member's possible predecessors the
    first. Members that end sequences of one length fall in rank, so both the length and the first predecessor are found by bisection.
    """
    length, before = np.ones(len(ranks), int), np.full(len(ranks), -1)
    least: list = []  # of each length, the rank of its latest end
    ends: list[tuple[list, list]] = []  # of each length, the ends' ranks with the sign turned, and their places
    for i, rank in enumerate(ranks.tolist()):
        n = bisect_right(least, rank)
        if n == len(least):
            least.append(rank)
            ends.append(([], []))
        least[n] = rank
        ends[n][0].append(-rank)
        ends[n][1].append(i)
        length[i] = n + 1
        if n:
            before[i] = ends[n - 1][1][bisect_left(ends[n - 1][0], -rank)]
    member = np.zeros(len(ranks), bool)
    i = int(np.argmax(length)) if len(ranks) else -1
    while i >= 0:
        member[i] = True
        i = before[i]
    return member


@check("place-order", "warning")
def place_order(x: Inputs) -> DataFrame:
    """A place that the times don't allow: valid from one after the faster to the number of those not slower."""
    race = W.partitionBy("race", "event").orderBy("time_s")
    placed = x.runs.where("status = 'finished' and place is not null and time_s is not null")
    counted = placed.withColumns({"level": F.count("*").over(race.rangeBetween(W.unboundedPreceding, W.currentRow)), "faster": F.rank().over(race) - 1})
    return counted.where("place <= faster or place > level").select("performance", F.lit("place").alias("field"))


def rank_order(points: DataFrame) -> DataFrame:
    """Rows of (race, distance_m, performance, time_s, rank, ...) outside the longest agreeing sequence of ranks in order of time.

    The points of one race at one distance are a field. Rows come sorted by field and time in batches of any cut, and only
    the ranks of the field at hand are kept beside a batch, with the rows of it that are still open.
    """
    names = points.columns

    def outside(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if frame.empty:
                continue
            race, metres = frame["race"].to_numpy(), frame["distance_m"].to_numpy()
            begins = np.concatenate(([0], np.flatnonzero((race[1:] != race[:-1]) | (metres[1:] != metres[:-1])) + 1))
            rest = frame.iloc[begins[-1] :]
            yield beyond(frame.iloc[: begins[-1]], begins)
        if rest is not None:
            yield beyond(rest, np.array([0, len(rest)]))

    def beyond(frame: pd.DataFrame, begins: np.ndarray) -> pd.DataFrame:
        ranks = frame["rank"].to_numpy()
        good = [longest_rising(ranks[i:j]) for i, j in zip(begins[:-1], begins[1:], strict=True)]
        return frame[~np.concatenate(good)] if good else frame

    field = points.repartition("race", "distance_m").sortWithinPartitions("race", "distance_m", "time_s", "rank", "performance")
    return field.select(*names).mapInPandas(outside, points.schema)


@check("rank-order", "warning", needs=("placed_points",))
def misplaced(x: Inputs) -> DataFrame:
    """Printed positions at a point that the times there don't allow, the fewest that explain it."""
    field = x.placed_points.withColumn("race", F.to_json(F.struct("race", "document")))
    found = rank_order(field.select("race", "distance_m", "performance", "document", "point", "time_s", "rank"))
    return found.select("performance", "document", "point", F.lit("rank").alias("field"))


@check("birth-dates-agree", "error", group="consistency", needs=("births",))
def births_agree(x: Inputs) -> DataFrame:
    """Birth dates that documents print for one athlete and that differ."""
    printed = x.births.where("printed is not null")
    several = printed.groupBy("athlete").agg(F.min("printed").alias("lo"), F.max("printed").alias("hi")).where("lo <> hi").select("athlete")
    return printed.join(several, "athlete", "left_semi").select("performance", F.lit("birth_date").alias("field"))


@check("documents-agree", "warning", group="consistency", needs=("conflicts",))
def documents_agree(x: Inputs) -> DataFrame:
    """Facts that a race's documents print differently; the one of most authority is kept."""
    return x.conflicts.select(F.col("subject").alias("performance"), "field")


@check("athlete-in-race", "error", True, "consistency", ("entries",))
def timed_elsewhere(x: Inputs) -> DataFrame:
    """Athletes whom a document times in a race whose results don't name them; the subject is the document."""
    named = x.runs.select("race", "athlete").distinct()
    return x.entries.join(named, ["race", "athlete"], "left_anti").select(F.concat_ws("/", "race", "document").alias("document")).distinct()


@check("reader-notes", "warning", group="reading", needs=("notes",))
def reader_notes(x: Inputs) -> DataFrame:
    """What a reader noted about a document, for a person to look at."""
    return x.notes.select("document")


def equal_printed(exact: Column, printed: Column, scale: Column) -> Column:
    """Whether a printed value is the exact one cut or rounded half-up to its decimals."""
    unit = F.pow(F.lit(10), scale)
    return (printed * unit == F.floor(exact * unit)) | (printed * unit == F.floor(exact * unit + 0.5))


def slack(value: Column, scale: Column) -> Column:
    """How far a printed value may be off: a whole last unit to tenths or coarser, half a unit when finer, nothing at zero."""
    return F.when(value == 0, F.lit(0.0)).when(scale <= 1, F.pow(F.lit(10.0), -scale)).otherwise(F.pow(F.lit(10.0), -scale) / 2)
