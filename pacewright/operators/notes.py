"""Findings beside the runs and splits they are about, at any depth of their ids; short names that tell an athlete's runs apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ancestors(subject: Column) -> Column:
    """An id and all ids above it: ``a/b/c`` is below ``a/b`` and ``a``."""
    parts = F.split(subject, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def notes(findings: DataFrame, runs: DataFrame, splits: DataFrame, checks: DataFrame, citations: DataFrame) -> DataFrame:
    """``findings(finding, subject, check, message)`` with the run that each is on or below, its split, its check's title and what it cites.

    ``runs(run, name)``, ``splits(split, time, source)``, ``checks(check, title)``, ``citations(finding, source)``. A subject meets a run by
    equality of one of its ancestors' ids, so ``1-1`` isn't below ``1``, and no prefix is searched for; the deepest run is taken. A finding
    that cites nothing cites its split's source; one without a run, split or check keeps nulls (a check's id for its title).
    """
    above = findings.select("finding", F.explode(ancestors(F.col("subject"))).alias("run"))
    met = above.join(runs, "run").groupBy("finding").agg(F.max_by(F.struct("run", "name"), F.length("run")).alias("r"))
    cited = citations.where("source is not null").groupBy("finding").agg(F.array_sort(F.collect_set("source")).alias("cited"))
    out = findings.join(met, "finding", "left").join(splits.withColumnRenamed("split", "subject"), "subject", "left").join(checks, "check", "left").join(cited, "finding", "left")
    sources = F.coalesce("cited", F.when(F.col("source").isNotNull(), F.array("source")), F.array().cast("array<string>"))
    return out.select("finding", "subject", "check", F.coalesce("title", "check").alias("title"), F.col("r.run").alias("run"), F.col("r.name").alias("name"), "message", "time", sources.alias("sources"))


def short_names(runs: DataFrame) -> DataFrame:
    """``runs(group, run, athlete, family, place, day, round)`` with ``short``: the family name, and where an athlete has several runs in a group a tag.

    The tag is the first of year, place, place and year, place and round, all three, by which the athlete's runs all differ; the
    last where none tells them apart. Null parts are empty. Counts of distinct tags are by group and athlete, without windows.
    """
    year, place, round_ = F.concat(F.lit("’"), F.date_format("day", "yy")), F.coalesce("place", F.lit("")), F.coalesce("round", F.lit(""))
    schemes = [F.coalesce(year, F.lit("’")), place, F.concat_ws(" ", place, year), F.concat_ws(" ", place, round_), F.concat_ws(" ", place, year, round_)]
    tagged = runs.withColumn("tags", F.array(*schemes))
    own = tagged.groupBy("group", "athlete").agg(F.count("*").alias("n"), F.array(*(F.countDistinct(F.col("tags")[i]) for i in range(len(schemes)))).alias("different"))
    told = F.array_position("different", F.col("n"))
    chosen = F.when(told > 0, told).otherwise(F.lit(len(schemes))).cast("int")
    out = tagged.join(own.withColumn("chosen", chosen), ["group", "athlete"])
    return out.select("group", "run", F.when(F.col("n") == 1, F.col("family")).otherwise(F.concat_ws(" ", "family", F.element_at("tags", F.col("chosen")))).alias("short"))


def place_in_id(text: Column) -> Column:
    """A meeting's place from its id: the words behind series and year, each with a capital."""
    words = F.split(text, "-")
    return F.array_join(F.transform(F.slice(words, 3, F.greatest(F.size(words) - 2, F.lit(0))), lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2)))), " ")
