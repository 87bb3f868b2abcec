"""Editions beside the entries of a calendar: the same country, overlapping days, the better class first; cities as people write them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewright.functions.text import similarity, slug

#: Days on either side that still count as the same ones, and days that an entry without a sane end covers at most.
SLACK, MOST_DAYS = 1, 20
#: Days of a cell in which entries are looked for.
CELL = 32
LEAST_LIKENESS = 0.8


def same_city(a: Column, b: Column, other_names: dict[str, str] | None = None) -> Column:
    """Whether two names are of one city: equal in letters and digits, by ``other_names`` (slug to slug), one the other's beginning, or alike. Null and empty names are no city's."""

    def plain(name: Column) -> Column:
        own = F.coalesce(slug(name), F.lit(""))
        if not other_names:
            return own
        names = F.create_map(*(F.lit(x) for pair in other_names.items() for x in pair))
        return F.coalesce(F.try_element_at(names, own), own)

    x, y = plain(a), plain(b)
    return (x != "") & (y != "") & (x.startswith(y) | y.startswith(x) | F.coalesce(similarity(x, y) >= LEAST_LIKENESS, F.lit(False)))


def _ranged(table: DataFrame, most_days: int) -> DataFrame:
    """With a last day that is never before the first, nor more than ``most_days`` on."""
    last = F.least(F.coalesce("last", "first"), F.date_add("first", most_days - 1))
    return table.where(F.col("first").isNotNull() & F.col("country").isNotNull()).withColumn("last", F.greatest(last, "first"))


def meetings(held: DataFrame, entries: DataFrame, most_days: int = MOST_DAYS) -> DataFrame:
    """The columns of ``held(id, country, first, last, ...)`` beside those of ``entries(entry, country, first, last, ...)``, prefixed with ``entry_``, for every two that overlap within a day.

    Entries are the larger table, so each stays one row, in the CELL of days in which it opens; an edition goes to the two cells or so in which an entry that
    overlaps it may open. They meet by equality on country and cell, and one condition on their days is left.
    """
    h, e = _ranged(held, most_days), _ranged(entries, most_days)
    e = e.select("country", *(F.col(c).alias(c if c.startswith("entry") else f"entry_{c}") for c in e.columns if c != "country"))
    e = e.withColumns({"opens": F.date_sub("entry_first", SLACK), "closes": F.date_add("entry_last", SLACK)})
    cell = lambda day: F.floor(F.unix_date(day) / CELL)
    longest = most_days - 1 + 2 * SLACK  # from an entry's opening to its close
    h = h.withColumn("cell", F.explode(F.sequence(cell(F.date_sub("first", longest)), cell(F.col("last")))))
    met = h.join(e.withColumn("cell", cell(F.col("opens"))), ["country", "cell"])
    return met.where((F.col("opens") <= F.col("last")) & (F.col("first") <= F.col("closes"))).drop("cell", "opens", "closes")


def best_entry(held: DataFrame, entries: DataFrame) -> DataFrame:
    """id, entry, ties of every row of ``held``: the overlapping entry of the best (least) ``rank``, of these the one that begins nearest.

    ``ties`` counts the entries that are equally good; the least of them is taken. Without an overlapping entry, or without a first day, entry
    is null and ties 0. Entries without a rank come last. ids are taken to be unique.
    """
    gap = F.abs(F.datediff("entry_first", "first"))
    ranked = meetings(held, entries).select("id", F.struct(F.coalesce("entry_rank", F.lit(1 << 30)).alias("rank"), gap.alias("gap")).alias("by"), "entry")
    grouped = ranked.groupBy("id", "by").agg(F.min("entry").alias("entry"), F.count("*").alias("ties")).groupBy("id").agg(F.min(F.struct("by", "entry", "ties")).alias("b"))
    return held.select("id").join(grouped, "id", "left").select("id", "b.entry", F.coalesce("b.ties", F.lit(0)).cast("long").alias("ties"))


def only_entry(held: DataFrame, entries: DataFrame, other_names: dict[str, str] | None = None) -> DataFrame:
    """id, entry, candidates of every row of ``held``: the overlapping entry of the same city (``city``, or the entry's ``venue``) if there is just one; several reject each other.

    Without a city of its own an edition takes every overlapping entry for a candidate.
    """
    met = meetings(held, entries)
    venue = F.col("entry_venue") if "entry_venue" in met.columns else F.lit(None).cast("string")
    here = F.coalesce(F.col("city"), F.lit("")) == ""
    met = met.where(here | same_city(F.col("entry_city"), F.col("city"), other_names) | same_city(venue, F.col("city"), other_names))
    counted = met.groupBy("id").agg(F.min("entry").alias("entry"), F.count("*").alias("candidates"))
    return held.select("id").join(counted, "id", "left").select("id", F.when(F.col("candidates") == 1, F.col("entry")).alias("entry"), F.coalesce("candidates", F.lit(0)).cast("long").alias("candidates"))
