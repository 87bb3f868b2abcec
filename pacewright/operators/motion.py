"""Motion of a run through its knots: monotone cubic interpolation, its inverse, standings at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def monotone_slopes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes at the knots of a cubic that never turns between them (harmonic means, limited to three times the chords)."""
    chord = np.diff(y) / np.diff(x)
    if len(chord) < 2:
        return np.repeat(chord, 2)
    left, right = chord[:-1], chord[1:]
    h = np.diff(x)
    w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        inner = np.where(left * right > 0, (w1 + w2) / (w1 / left + w2 / right), 0.0)
    ends = [np.clip(c, 0, 3 * c) if c >= 0 else 0.0 for c in (1.5 * chord[0] - 0.5 * inner[0], 1.5 * chord[-1] - 0.5 * inner[-1])]
    return np.concatenate(([min(ends[0], 3 * chord[0])], inner, [min(ends[1], 3 * chord[-1])]))


def interpolate(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values of the monotone cubic at points, held at the ends."""
    if len(x) < 2:
        return np.full(len(at), y[0] if len(y) else np.nan)
    m = monotone_slopes(x, y)
    at = np.clip(at, x[0], x[-1])
    i = np.clip(np.searchsorted(x, at, "right") - 1, 0, len(x) - 2)
    h = x[i + 1] - x[i]
    t = (at - x[i]) / h
    return y[i] * (2 * t**3 - 3 * t**2 + 1) + h * m[i] * (t**3 - 2 * t**2 + t) + y[i + 1] * (3 * t**2 - 2 * t**3) + h * m[i + 1] * (t**3 - t**2)


def interpolate_runs(x: np.ndarray, y: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps of each run, and all runs' points and values there, as ``interpolate`` has them: x and y have a run's knots in a row, two at least, the first at 0."""
    h = np.diff(x, axis=1)
    chord = np.diff(y, axis=1) / h
    if chord.shape[1] < 2:
        m = np.repeat(chord, 2, axis=1)
    else:
        left, right, w1, w2 = chord[:, :-1], chord[:, 1:], 2 * h[:, 1:] + h[:, :-1], h[:, 1:] + 2 * h[:, :-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            inner = np.where(left * right > 0, (w1 + w2) / (w1 / left + w2 / right), 0.0)
        m = np.empty_like(y)
        m[:, 1:-1] = inner
        for at, edge, beside in ((0, chord[:, 0], inner[:, 0]), (-1, chord[:, -1], inner[:, -1])):
            m[:, at] = np.minimum(np.where(edge >= 0, np.clip(1.5 * edge - 0.5 * beside, 0, 3 * np.abs(edge)), 0.0), 3 * edge)
    count = np.ceil((x[:, -1] + 1e-9) / step).astype(int)
    run = np.repeat(np.arange(len(x)), count)
    points = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * step
    at = np.minimum(points, x[run, -1])
    i = np.zeros(len(at), int)
    for k in range(1, x.shape[1] - 1):
        i += x[run, k] <= at
    h = h[run, i]
    t = (at - x[run, i]) / h
    values = y[run, i] * (2 * t**3 - 3 * t**2 + 1) + h * m[run, i] * (t**3 - 2 * t**2 + t) + y[run, i + 1] * (3 * t**2 - 2 * t**3) + h * m[run, i + 1] * (t**3 - t**2)
    return count, points, values


def knots(passings: DataFrame) -> DataFrame:
    """Clean points of every performance and document from the gun, only those later than all before."""
    clean = passings.where("not suspect and time_s > 0").select("performance", "document", "distance_m", "time_s")
    before = W.partitionBy("performance", "document").orderBy("distance_m").rowsBetween(W.unboundedPreceding, -1)
    return clean.where("time_s is not null").withColumn("latest", F.max("time_s").over(before)).where("latest is null or time_s > latest").drop("latest")


def positions(passings: DataFrame, step_m: float = 25.0) -> DataFrame:
    """performance, document, distance_m, time_s at every step of distance.

    A run's knots are a short list, so a row is a run; the runs of a batch that have as many knots are worked out together.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            knots_of = frame["x"].map(len).to_numpy()
            for n in np.unique(knots_of):
                same = frame[knots_of == n]
                zero = np.zeros((len(same), 1))
                x, y = (np.hstack([zero, np.stack(same[c].to_list())]) for c in ("x", "y"))
                count, at, values = interpolate_runs(x, y, step_m)
                yield pd.DataFrame({"performance": np.repeat(same["performance"].to_numpy(), count), "document": np.repeat(same["document"].to_numpy(), count), "distance_m": at, "time_s": values})

    own = F.sort_array(F.collect_list(F.struct(F.col("distance_m").cast("double").alias("distance_m"), "time_s")))
    rows = knots(passings).groupBy("performance", "document").agg(own.alias("k")).select("performance", "document", F.col("k.distance_m").alias("x"), F.col("k.time_s").alias("y"))
    return rows.mapInPandas(run, "performance long, document string, distance_m double, time_s double")


def standings(passings: DataFrame, runs: DataFrame, at_s: float) -> DataFrame:
    """race, performance, distance_m, place at a time: by distance covered at the last point passed, then by its time."""
    passed = passings.where(F.col("time_s") <= at_s).groupBy("performance").agg(F.max(F.struct("distance_m", (-F.col("time_s")).alias("neg"))).alias("p"))
    met = runs.select("performance", "race").join(passed, "performance").select("race", "performance", "p.distance_m", (-F.col("p.neg")).alias("passed_s"))
    order = W.partitionBy("race").orderBy(F.desc("distance_m"), "passed_s")
    return met.withColumn("place", F.rank().over(order).cast("long"))


def even_ghost(shape: DataFrame, target_s: float) -> DataFrame:
    """event, distance_m, time_s of a runner who covers the typical shares in a target time."""
    return shape.select("event", "distance_m", (F.col("share") * target_s).alias("time_s"))
