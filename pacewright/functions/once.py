"""A column that is worked out once and named several times."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_value(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` names it (in lambdas and branches each mention is an evaluation)."""
    return F.get(F.transform(F.array(value), then), F.lit(0))
