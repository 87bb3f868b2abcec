"""Parts of a line of words: words under characters, matches with their boxes, points that labels name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words_under(words: Column, start: Column, end: Column) -> Column:
    """The words of a line (joined by single spaces) that overlap its characters from ``start`` up to ``end``."""
    size = lambda w: F.length(w["text"])
    before = lambda i: F.aggregate(F.slice(words, F.lit(1), i), F.lit(0), lambda a, w: a + size(w) + 1)
    return F.filter(words, lambda w, i: (before(i) < end) & (before(i) + size(w) > start))


def sourced(words: Column, pattern: str, group: int = 0) -> Column:
    """The first match's group in a line of ``struct(text, x0, top, x1, bottom)`` words, with the box around its words; null if there is none."""
    text = F.array_join(F.transform(words, lambda w: w["text"]), " ")
    value = F.regexp_extract(text, pattern, group)
    at = F.position(value, text, F.greatest(F.lit(1), F.regexp_instr(text, F.lit(pattern)))) - 1
    # one pass over the words: the match's ends, where the next word begins, and the box so far
    none = lambda c: F.lit(None).cast("double").alias(c)
    start = F.struct(value.alias("value"), at.cast("int").alias("from"), F.lit(0).alias("next"), *(none(c) for c in ("x0", "top", "x1", "bottom")))

    def step(s: Column, w: Column) -> Column:
        end = s["next"] + F.length(w["text"])
        covered = (s["next"] < s["from"] + F.length(s["value"])) & (end > s["from"])
        edge = lambda f, c: F.when(covered, f(s[c], w[c].cast("double"))).otherwise(s[c]).alias(c)
        return F.struct(s["value"].alias("value"), s["from"].alias("from"), (end + 1).alias("next"), edge(F.least, "x0"), edge(F.least, "top"), edge(F.greatest, "x1"), edge(F.greatest, "bottom"))

    box = F.aggregate(words, start, step, lambda s: F.struct(s["value"].alias("value"), *(s[c].alias(c) for c in ("x0", "top", "x1", "bottom"))))
    return F.when(value != "", box)


def lap_point(label: Column, distance: Column, lap: Column) -> Column:
    """The metres that a label names: at the end of a whole lap before the finish if the label is that point rounded down, else as printed."""
    at_lap = distance - lap * F.bround((distance - label) / lap)
    return F.when(F.floor(at_lap) == label, at_lap).otherwise(label)


def heading_round(heading: Column) -> Column:
    """struct(round, heat) of a heading: a B race, the final, or a heat by number or letter; both null where it names none."""
    b, heat = r"(?i)\bB[ -]race\b(?: (\d+))?", r"(?i)\bheat (\d+|[A-Z])\b"
    is_b = heading.rlike(b)
    name = F.regexp_extract(heading, heat, 1)
    is_final = heading.rlike(r"(?i)\bfinal\b")
    number = F.when(name.rlike(r"^\d+$"), name.try_cast("int")).otherwise(F.ascii(F.upper(name)) - ord("A") + 1)
    round_ = F.when(is_b, "b-race").when(is_final, "final").when(name != "", "heat")
    return F.struct(round_.alias("round"), F.when(is_b, F.regexp_extract(heading, b, 1).try_cast("int")).when(~is_final & (name != ""), number).alias("heat"))
