"""Words of a text as column expressions, for the operators that stay inside Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACES = " \t\n\x0b\f\r"


def space_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t-\\r]+"))
