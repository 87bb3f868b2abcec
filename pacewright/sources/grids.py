"""Grids of timing points in rows of labels, and the times printed below them.

A document labels its points in one or more rows (tiers). Below each athlete a line of cumulative
times with ranks is followed by a line of the stretches' times without, tier by tier; a value
belongs to the nearest label of its tier. Everything is windows and equality joins by document, so documents
spread over tasks; what can't be read is a row of ``errors``. A document with an error gives no times, and no labels if the
error is in its labels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pacewright.functions.times import elapsed

_LAPS, _HURDLE, _METRES, _FINISH = r"(?:\d+(?:\.\d+)?|\d/\d) ?laps? ?to ?go", r"Hurdle ?\d+", r"\d+m*(?![\d.:])", "Finish"
_LABEL = "|".join((_LAPS, _METRES, _HURDLE, _FINISH))
#: A label that is printed in full; a line of bare numbers labels nothing.
_FULL = "|".join((_LAPS, r"\d+m+(?![\d.:])", _HURDLE, _FINISH))
_TIME, _RANK = r"^(?:\d{1,2}:)?\d{1,2}\.\d{1,3}$", r"^\(=?\d+\)$"
#: How far from a lone label its values may be, and the share of the labels' spacing that is near enough otherwise.
LONE_REACH, REACH = 20.0, 0.4
_DISTANCE = "decimal(12,3)"


@dataclass(frozen=True)
class TieredReading:
    """labels(doc, tier, place, label, metres, finish, x, reach, since), passings(doc, athlete, metres, finish, time, rank),
    stretches(doc, athlete, start_metres, metres, time), notes(doc, note), errors(doc, athlete, error)."""

    labels: DataFrame
    passings: DataFrame
    stretches: DataFrame
    notes: DataFrame
    errors: DataFrame


def _lines_of_labels(words: DataFrame) -> DataFrame:
    """doc, line, is_label, labels(text, x) of every line."""
    word = F.struct("x0", "x1", "text")
    lines = words.groupBy("doc", "line").agg(F.sort_array(F.collect_list(word)).alias("words"))
    text = F.array_join(F.transform("words", lambda w: w["text"]), " ")
    lines = lines.withColumn("text", text)
    is_label = F.col("text").rlike(f"^(?:(?:{_LABEL}) ?)+$") & F.col("text").rlike(_FULL)
    # Where each word and each label begin in the line's text.
    begins = F.aggregate(
        "words", F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("all")), lambda s, w: F.struct((s["next"] + F.length(w["text"]) + 1).alias("next"), F.array_append(s["all"], s["next"]).alias("all"))
    )["all"]
    found = F.regexp_extract_all("text", F.lit(f"({_LABEL})"), 1)
    place = lambda s, f: F.call_function("locate", f, F.col("text"), s["next"])
    at = F.aggregate(
        found, F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("all")), lambda s, f: F.struct((place(s, f) + F.length(f)).alias("next"), F.array_append(s["all"], place(s, f)).alias("all"))
    )["all"]
    lines = lines.withColumn("is_label", is_label).withColumn("begins", begins).withColumn("found", F.when(is_label, found)).withColumn("at", F.when(is_label, at))

    def label(text: Column, begin: Column) -> Column:
        own = F.filter(F.arrays_zip("words", "begins"), lambda z: (z["begins"] < begin + F.length(text)) & (z["begins"] + F.length(z["words"]["text"]) > begin))
        centre = F.aggregate(own, F.lit(0.0), lambda s, z: s + (z["words"]["x0"] + z["words"]["x1"]) / 2) / F.size(own)
        return F.struct(text.alias("text"), centre.alias("x"))

    labels = F.transform(F.arrays_zip("found", "at"), lambda z: label(z["found"], z["at"]))
    return lines.select("doc", "line", "is_label", F.when(is_label, labels).alias("labels"))


def _points(words: DataFrame, races: DataFrame) -> DataFrame:
    """The labels with their points in one pass over the lines: each may have a ``note`` and an ``error``; doc_error is one of its document's."""
    of_doc = W.partitionBy("doc")
    lines = _lines_of_labels(words).withColumn("first", F.min(F.when(F.col("is_label"), F.col("line"))).over(of_doc))
    lines = lines.withColumn("stop", F.min(F.when(~F.col("is_label") & (F.col("line") > F.col("first")), F.col("line"))).over(of_doc))
    grid = lines.where(F.col("is_label") & (F.col("stop").isNull() | (F.col("line") < F.col("stop"))))
    grid = grid.withColumn("tier", F.row_number().over(of_doc.orderBy("line")) - 1).select("doc", "tier", F.posexplode("labels").alias("i", "l")).join(races, "doc")
    text, number = F.col("l.text"), lambda pattern: F.nullif(F.regexp_extract("l.text", pattern, 1), F.lit(""))
    laps = number(r"^(\d+(?:\.\d+)?|\d/\d) ?laps?")
    lap_count = F.when(laps.contains("/"), F.split(laps, "/")[0].cast(_DISTANCE) / F.split(laps, "/")[1].cast(_DISTANCE)).otherwise(laps.cast(_DISTANCE))
    hurdle = number(r"^Hurdle ?(\d+)$").cast("int")
    at = (
        F.when(text == "Finish", F.col("metres"))
        .when(hurdle.isNotNull(), F.col("first_hurdle") + F.col("hurdle_gap") * (hurdle - 1))
        .when(laps.isNotNull(), F.when(~F.col("steeple"), F.col("metres") - lap_count * F.col("lap")))
        .otherwise(number(r"^(\d+)m*$").cast(_DISTANCE))
        .cast(_DISTANCE)
    )
    unplaced = F.when(at.isNull(), F.when(laps.isNotNull(), "laps to go of a steeplechase have no place in metres").otherwise("a label has no place in metres"))
    misread = F.when(text.rlike(r"^\d+(m{2,})?$"), F.concat(F.lit("label "), text, F.lit(" read as "), F.regexp_replace(text, "m+$", ""), F.lit("m")))
    grid = grid.select("doc", "tier", "i", text.alias("label"), F.col("l.x").alias("x"), at.alias("at"), "metres", "full_tier", unplaced.alias("error"), misread.alias("note"))
    grid = grid.withColumn("finish", F.coalesce(F.col("at") == F.col("metres"), F.lit(False)))

    # The spacing of the first tier, and behind the last label the finish where no label has it.
    in_order = of_doc.orderBy("tier", "i")
    grid = grid.withColumn("gap", F.when(F.col("tier") == 0, F.col("x") - F.lag("x").over(W.partitionBy("doc", "tier").orderBy("i"))))
    grid = grid.withColumns({"pitch": F.median("gap").over(of_doc), "labelled": F.bool_or("finish").over(of_doc), "after": F.lead("tier").over(in_order), "first_x": F.first("x").over(in_order)})
    room = F.col("i") + 1 < F.col("full_tier")
    own = F.struct("tier", "i", "label", "x", "at", "finish", "error", "note")
    finish = F.struct(
        F.when(room, F.col("tier")).otherwise(F.col("tier") + 1).alias("tier"),
        F.when(room, F.col("i") + 1).otherwise(0).alias("i"),
        F.lit("Finish").alias("label"),
        F.when(room, F.col("x") + F.col("pitch")).otherwise(F.col("first_x")).alias("x"),
        F.col("metres").alias("at"),
        F.lit(True).alias("finish"),
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("note"),
    )
    unlabelled = F.col("after").isNull() & F.col("pitch").isNotNull() & F.col("full_tier").isNotNull() & ~F.col("labelled")
    points = grid.select("doc", "pitch", F.explode(F.when(unlabelled, F.array(own, finish)).otherwise(F.array(own))).alias("p")).select("doc", "pitch", "p.*")
    points = points.withColumns({"since": F.lag("at").over(in_order), "next": F.lead("at").over(in_order), "place": F.row_number().over(in_order) - 1})
    alone = F.when(F.col("pitch").isNull() & (F.col("tier") > 0), "one label doesn't tell the spacing of the others")
    mixed = F.when(F.col("at") <= F.col("since"), "labels aren't in the order of the race")
    points = points.withColumn("error", F.coalesce("error", alone, mixed)).withColumn("doc_error", F.max("error").over(of_doc))
    # The first point farther from the start than points from each other: what is printed below it begins at a point that isn't timed.
    untimed = F.col("since").isNull() & F.coalesce(F.col("at") > (F.col("next") - F.col("at")) * F.lit("1.01").cast("decimal(4,2)"), F.lit(False))
    since = F.when(F.col("since").isNotNull(), F.col("since")).when(~untimed, F.lit(0).cast(_DISTANCE))
    return points.withColumn("since", since).withColumn("reach", F.coalesce(F.col("pitch") * REACH, F.lit(LONE_REACH)))


def read_tiers(words: DataFrame, races: DataFrame, timed: DataFrame, results: DataFrame) -> TieredReading:
    """The points of documents' grids and the times of their athletes.

    ``words(doc, line, x0, x1, text)`` are a document's words above and beside the grid, ``races(doc, metres, lap, steeple, first_hurdle,
    hurdle_gap, full_tier)`` what it is about (full_tier: labels of a full row where the finish has none; else null),
    ``timed(doc, athlete, line, x0, x1, text)`` the words of an athlete's lines, ``results(doc, athlete, result)`` the results as
    printed. A lone cumulative time equal to the result is the finish. Lines with other words than times, ranks, statuses and
    ``NO VALUE`` are passed over. Documents without labels give nothing; a rank of 0 is unknown.
    """
    points = _points(words, races)
    labels = points.where("doc_error is null").select("doc", "tier", "place", "label", F.col("at").alias("metres"), "finish", "x", "reach", "since")
    notes = points.where("note is not null").select("doc", "note")

    along = W.partitionBy("doc", "athlete", "line").orderBy("x0", "x1")
    before, after = F.lag("text").over(along), F.lead("text").over(along)
    kind = (
        F.when(F.col("text").rlike(_TIME), "time")
        .when(F.col("text").rlike(_RANK), "rank")
        .when(F.col("text").isin("DNF", "DNS", "DQ") | (F.col("text") == "NO") & (after == "VALUE") | (F.col("text") == "VALUE") & (before == "NO"), "void")
    )
    typed = timed.withColumn("kind", kind).withColumn("rank", F.when(after.rlike(_RANK), after))
    is_time = F.col("kind") == "time"
    value = F.when(is_time, F.struct(((F.col("x0") + F.col("x1")) / 2).alias("centre"), "text", "rank"))
    lines = typed.groupBy("doc", "athlete", "line").agg(F.count_if(F.col("kind").isNull()).alias("others"), F.sort_array(F.collect_list(value)).alias("values"))
    tiers = labels.groupBy("doc").agg((F.max("tier") + 1).alias("n_tiers"), F.max(F.when(F.col("finish"), F.col("tier"))).alias("finish_tier"))
    lines = lines.where("others = 0").join(results, ["doc", "athlete"], "left").join(tiers, "doc")
    n, ranked = F.size("values"), F.size(F.filter("values", lambda v: v["rank"].isNotNull()))
    lines = lines.withColumn("ranked", ranked).withColumn("cumulative", F.col("ranked") * 2 > n)
    down = W.partitionBy("doc", "athlete").orderBy("line")
    so_far = down.rowsBetween(W.unboundedPreceding, W.currentRow)
    begins = F.col("cumulative") | ~F.lag("cumulative", 1, False).over(down)
    lone = F.col("cumulative") & (n == 1) & (F.get("values", F.lit(0))["text"] == F.col("result")) & F.col("finish_tier").isNotNull()
    lines = lines.withColumn("begun", F.sum(begins.cast("int")).over(so_far)).withColumn("moved", F.when(lone, F.col("finish_tier") - F.col("begun")))
    lines = lines.withColumn("tier", (F.col("begun") + F.coalesce(F.last("moved", ignorenulls=True).over(so_far), F.lit(-1))).cast("int"))
    wrong = F.when((F.col("ranked") > 0) & ~F.col("cumulative"), "a line has times with and without ranks").when(F.col("tier") >= F.col("n_tiers"), "more lines than tiers")

    # Each value beside the labels of its tier, of which the nearest is its own. A document's labels come as one map by tier, so the join
    # is by document, as all else is, and nothing is shuffled for it.
    label = F.struct("place", "metres", "finish", "since", "reach", "x")
    by_tier = labels.groupBy("doc", "tier").agg(F.collect_list(label).alias("labels")).groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("tier", "labels"))).alias("by_tier"))
    values = lines.join(by_tier, "doc", "left").select("doc", "athlete", "line", "cumulative", wrong.alias("wrong"), F.try_element_at("by_tier", F.col("tier")).alias("near"), F.array_distinct("values").alias("values"))
    values = values.select("doc", "athlete", "line", "cumulative", "wrong", "near", F.explode_outer("values").alias("v"))
    beside = lambda p: F.struct(F.abs(F.col("v.centre") - p["x"]).alias("far"), *(p[c].alias(c) for c in ("place", "metres", "finish", "since", "reach")))
    met = values.withColumn("p", F.array_min(F.transform("near", beside))).drop("near")
    stray = F.when(F.col("p.far") > F.col("p.reach"), F.concat("v.text", F.lit(" is below no label")))
    met = met.withColumn("error", F.coalesce("wrong", stray))
    same = F.count(F.when(F.col("error").isNull() & F.col("v").isNotNull(), 1)).over(W.partitionBy("doc", "athlete", "cumulative", "p.place"))
    twice = F.when(F.col("v").isNotNull() & (same > 1), F.when(F.col("cumulative"), "two cumulative times at a point").otherwise("two times of a stretch"))
    met = met.withColumn("error", F.coalesce("error", twice)).withColumn("doc_error", F.max("error").over(W.partitionBy("doc")))
    of_labels = points.where("error is not null").select("doc", F.lit(None).cast("string").alias("athlete"), "error")
    errors = of_labels.unionByName(met.where("error is not null").select("doc", "athlete", "error")).distinct()
    good = met.where(F.col("doc_error").isNull() & F.col("v").isNotNull())
    rank = F.nullif(F.regexp_extract("v.rank", r"(\d+)", 1).cast("int"), F.lit(0))
    passings = good.where("cumulative").select("doc", "athlete", "p.metres", "p.finish", elapsed(F.col("v.text")).alias("time"), rank.alias("rank"))
    stretches = good.where("not cumulative and p.since is not null").select("doc", "athlete", F.col("p.since").alias("start_metres"), "p.metres", elapsed(F.col("v.text")).alias("time"))
    return TieredReading(labels, passings, stretches, notes, errors)
