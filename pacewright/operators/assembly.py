"""Assembly of readings: merging with conflicts, agreed dates, identities, linking with exactly one candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def merge(readings: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """The first value of each field by authority, and every later one that differs.

    ``readings`` has subject, authority and the fields; gives (subject, fields...) and
    (subject, authority, field, value, kept). All as strings in the conflicts.
    """
    order = W.partitionBy("subject").orderBy("authority").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    kept = readings.withColumns({f"_{f}": F.first(f, ignorenulls=True).over(order) for f in fields})
    merged = kept.select("subject", *(F.col(f"_{f}").alias(f) for f in fields)).distinct()
    each = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), F.col(f"_{f}").cast("string").alias("kept")) for f in fields))
    rows = kept.select("subject", "authority", F.explode(each).alias("x")).select("subject", "authority", "x.*")
    return merged, rows.where("value is not null and value <> kept")


def agreed_birth_date(claims: DataFrame) -> DataFrame:
    """subject, year, month, day: the finest claim that refines all others; null parts where claims disagree."""
    part = lambda c: F.when(F.count_distinct(c) <= 1, F.max(c))
    return claims.groupBy("subject").agg(part("year").alias("year"), part("month").alias("month"), part("day").alias("day"))


def link_once(rows: DataFrame, candidates: DataFrame, on: list[str], condition) -> DataFrame:
    """row, candidate: rows with exactly one fitting candidate, and candidates that no other row of the document got."""
    met = rows.join(candidates, on).where(condition).groupBy("row", "document").agg(F.min("candidate").alias("candidate"), F.max("candidate").alias("most")).where("candidate = most")
    return _only_row(met)


def link_nearest_once(rows: DataFrame, candidates: DataFrame, on: list[str], mark: str, listed: str, reach: float) -> DataFrame:
    """``link_once`` where a row fits candidates whose ``listed`` value is no farther than ``reach`` from its ``mark``.

    Values are dealt to cells of an eighth of the reach. The cells that are certainly within reach of a row are summed up by their least and greatest
    candidate, so a row with several candidates there is out before any pair is formed; the others meet the different values in all cells that may be within reach.
    """
    width = reach / 8
    key = [*on, "_cell"]
    cell = lambda value: F.floor(value / width)
    asked = rows.where(F.col(mark).isNotNull()).select("row", "document", *on, F.col(mark).alias("_mark"))
    known = candidates.groupBy(*on, F.col(listed).alias("_listed")).agg(F.min("candidate").alias("_least"), F.max("candidate").alias("_most")).withColumn("_cell", cell(F.col("_listed")))
    cells = known.groupBy(*key).agg(F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    ends = F.min("_least").alias("_least"), F.max("_most").alias("_most")
    # one cell is left out at either end, so rounding can't bring a value in that isn't within reach
    inside = asked.withColumn("_cell", F.explode(F.sequence(cell(F.col("_mark") - reach) + 2, cell(F.col("_mark") + reach) - 2))).join(cells, key)
    several = inside.groupBy("row", "document").agg(*ends).where("_least <> _most").select("row", "document")
    few = asked.join(several, ["row", "document"], "left_anti").withColumn("_cell", F.explode(F.sequence(cell(F.col("_mark") - reach) - 1, cell(F.col("_mark") + reach) + 1)))
    met = few.join(known, key).where(F.abs(F.col("_mark") - F.col("_listed")) <= reach).groupBy("row", "document").agg(*ends).where("_least = _most").withColumnRenamed("_least", "candidate")
    return _only_row(met)


def _only_row(met: DataFrame) -> DataFrame:
    """row, candidate of (row, document, candidate): those whose candidate no other row of the document has."""
    alone = F.count("*").over(W.partitionBy("document", "candidate"))
    return met.withColumn("n", alone).where("n = 1").select("row", "candidate")


def expand_initials(short: DataFrame, full: DataFrame) -> DataFrame:
    """row, given: initials that begin exactly one full name of the same family and country.

    The different full names are summed up by each of their beginnings, so an initial meets one row, however many names it begins.
    """
    names = full.select("family", "country", "given").distinct()
    begun = names.select("family", "country", "given", F.explode(F.transform(F.sequence(F.lit(0), F.length("given")), lambda n: F.substr("given", F.lit(1), n))).alias("initial"))
    begun = begun.groupBy("family", "country", "initial").agg(F.min("given").alias("given"), F.max("given").alias("most"))
    met = short.select("row", "family", "country", "initial").join(begun, ["family", "country", "initial"])
    return met.groupBy("row").agg(F.min("given").alias("given"), F.max("most").alias("most")).where("given = most").select("row", "given")


def integrity(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of a child without a parent, and ids that a parent has twice: (problem, id)."""
    lost = child.join(parent, child[key] == parent[parent_key], "left_anti").select(F.lit("lost").alias("problem"), F.col(key).alias("id"))
    twice = parent.groupBy(parent_key).count().where("count > 1").select(F.lit("twice").alias("problem"), F.col(parent_key).alias("id"))
    return lost.unionByName(twice)
