"""Common parts of document readers: tokens of a split line, tails of a row, laps, wind, grids of labels."""

from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The signs of records and qualification.
RECORDS = ("WR", "OR", "CR", "NR", "AR", "PB", "SB", "WL", "MR", "DLR")
QUALIFIED = ("Q", "q", "qR", "qJ")


def tail(words: Column) -> tuple[Column, Column, Column]:
    """Records, the qualification and remarks among the words after a result; an equalled record keeps its sign."""
    is_record = lambda w: F.regexp_replace(w, "^=|=$", "").isin(*RECORDS)
    records = F.filter(words, is_record)
    qualified = F.filter(words, lambda w: w.isin(*QUALIFIED))
    remarks = F.filter(words, lambda w: ~is_record(w) & ~w.isin(*QUALIFIED))
    return records, F.get(qualified, 0), remarks


def laps_to_go(text: Column, distance_m: Column, indoors: Column) -> Column:
    """Metres run when some laps are left: 400 m a lap outdoors, 200 m indoors; null for other texts."""
    laps = F.regexp_extract(F.lower(text), r"^(\d+) laps? to go$", 1)
    return F.when(laps != "", distance_m - laps.cast("int") * F.when(indoors, 200).otherwise(400))


def wind_before_unit(words: DataFrame, unit: str = "m/s", within: float = 4.0) -> DataFrame:
    """doc, page, wind: the number that stands just left of a unit word; one line's words meet by their rounded height."""
    band = lambda: F.explode(F.array(*(F.floor(F.col("top") / within) + i for i in (-1, 0, 1))))
    units = words.where(F.col("text") == unit).select("doc", "page", F.col("x0").alias("ux"), F.col("top").alias("ut"), band().alias("band"))
    numbers = words.where(F.col("text").rlike(r"^[+-]?\d+\.\d$")).select("doc", "page", "text", "x1", "top", F.floor(F.col("top") / within).alias("band"))
    met = numbers.join(units, ["doc", "page", "band"]).where((F.abs(F.col("top") - F.col("ut")) < within) & (F.col("ux") - F.col("x1")).between(0, within))
    return met.groupBy("doc", "page").agg(F.max_by("text", "x1").cast("decimal(5,2)").alias("wind"))


@F.udf(T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("x", T.DoubleType())])))
def label_grid(labels, centres, has_finish):
    """Labels with their places; an unlabelled finish is one median pitch to the right of the last."""
    if not labels:
        return []
    found = list(zip(labels, centres, strict=True))
    if not has_finish and len(found) > 1:
        found.append(("Finish", centres[-1] + median(b - a for a, b in zip(centres, centres[1:], strict=False))))
    return found


def partial_date(text: Column) -> Column:
    """struct(year, month, day) of ``1994``, ``JAN 1994`` or ``10 JAN 1994``; null for anything else."""
    months = F.create_map(*(F.lit(x) for i, m in enumerate("JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()) for x in (m, i + 1)))
    pattern = r"^(?:(?:(\d{1,2})\s+)?([A-Z]{3})\s+)?(\d{4})$"
    part = lambda i: F.nullif(F.regexp_extract(F.upper(F.trim(text)), pattern, i), F.lit(""))
    month = F.try_element_at(months, F.coalesce(part(2), F.lit("")))
    good = part(3).isNotNull() & (part(2).isNull() | month.isNotNull())
    return F.when(good, F.struct(part(3).cast("int").alias("year"), month.alias("month"), part(1).cast("int").alias("day")))


def provenance_pointer(*parts: Column | str | int) -> Column:
    """A JSON pointer of its parts, escaped."""
    escaped = [F.replace(F.replace((p if isinstance(p, Column) else F.lit(p)).cast("string"), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")) for p in parts]
    return F.concat(*(x for e in escaped for x in (F.lit("/"), e)))
