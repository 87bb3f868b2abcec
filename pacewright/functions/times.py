"""Times, dates and marks as text: parsing to decimals with their printed precision, partial dates, ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewright.functions.once import with_value

_CLOCK = r"^(?:(?:(\d+):)?([0-5]?\d):([0-5]?\d(?:\.\d{1,3})?)|(\d+(?:\.\d{1,3})?))$"
_LINE_ENDS = "\n\r\u0085\u2028\u2029"
DECIMAL = "decimal(18,3)"


def elapsed(text: Column) -> Column:
    """h:m:s, m:s or s as decimal seconds; null for anything else, and for more seconds than the type holds."""
    tail = F.substring_index(text, ":", -2)
    hours = F.when(tail != text, F.substring_index(text, ":", 1).try_cast(DECIMAL)).otherwise(F.lit(0).cast(DECIMAL))
    minutes = F.when(text.contains(":"), F.substring_index(tail, ":", 1).try_cast("int")).otherwise(0)
    seconds = F.translate(F.substring_index(text, ":", -1), _LINE_ENDS, "").try_cast(DECIMAL)  # the pattern allows a line's end behind the time
    return F.when(text.rlike(_CLOCK), (hours * 3600 + minutes * 60 + seconds).try_cast(DECIMAL))


def precision(text: Column) -> Column:
    """Printed decimals of a time."""
    return F.when(text.rlike(_CLOCK), F.length(F.regexp_extract(text, r"\.(\d+)$", 1))).cast("long")


def target(text: Column) -> Column:
    """A typed target time; null if it isn't one or isn't positive."""
    value = elapsed(F.trim(text))
    return F.when(value > 0, value)


def outcome(text: Column) -> tuple[Column, Column]:
    """Status and time of a printed result."""
    up = F.upper(F.trim(text))
    status = F.when(up.isin("DNF", "DNS"), F.lower(up)).when(up.isin("DQ", "DSQ"), "dq").when(elapsed(text).isNotNull(), "finished")
    return status, F.when(status == "finished", elapsed(text))


def refines(finer: Column, coarser: Column) -> Column:
    """Whether a partial date (year, month, day) says all that another says."""
    same = lambda k: coarser[k].isNull() | F.coalesce(coarser[k] == finer[k], F.lit(False))
    return same("year") & same("month") & same("day")


def weekday_in(first: Column, last: Column, weekday: Column) -> Column:
    """The only day of a range on a weekday (1 Sunday to 7 Saturday); null if none or several."""
    days = F.filter(F.sequence(first, last), lambda d: F.dayofweek(d) == weekday)
    return with_value(days, lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0))))


def laps_left(distance: Column, done: Column, lap: int = 400) -> Column:
    return F.ceil((distance - done) / lap).cast("long")
