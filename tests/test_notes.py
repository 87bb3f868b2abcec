"""Values given to columns against plain loops, findings at any depth, short names."""

import datetime
import random

from pyspark.sql import functions as F

from pacewright.operators import columns, notes

VALUES = "table string, line int, x double, text string"


def lines(seed, n, texts, most):
    """Values of lines whose places differ."""
    rng = random.Random(seed)
    return [("t", i, float(x), rng.choice(texts)) for i in range(n) for x in sorted(rng.sample(range(100), rng.randint(1, most)))]


def by_line(rows):
    out = {}
    for _, line, x, text, *rest in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(line, []).append((x, text, *rest))
    return out


def test_values_are_under_the_nearest_column(spark):
    heads = [("t", "lap", 20.0, "time"), ("t", "rank", 45.0, "rank"), ("t", "total", 80.0, "time")]
    values = lines(1, 200, ["12.5", "(3)", "?"], 5)
    fits = F.when(F.col("kind") == "time", F.col("text").rlike(r"^\d+\.\d$")).otherwise(F.col("text").rlike(r"^\(\d\)$"))
    found = columns.by_position(spark.createDataFrame(values, VALUES), spark.createDataFrame(heads, "table string, column string, anchor double, kind string"), fits, 15.0)
    want = []
    for line, row in by_line(values).items():
        taken = set()
        for x, text in row:
            far, name, kind = min((abs(anchor - x), name, kind) for _, name, anchor, kind in heads)
            if far > 15:
                want.append((line, x, None, "under no column"))
            elif name in taken:
                want.append((line, x, None, "under a column that is taken"))
            else:
                taken.add(name)
                good = text == ("12.5" if kind == "time" else "(3)")
                want.append((line, x, name if good else None, None if good else f"doesn't fit {name}"))
    assert sorted((r.line, r.x, r.column, r.error) for r in found.collect()) == want
    assert {e for *_, e in want} >= {None, "under no column", "under a column that is taken", "doesn't fit rank"}


def test_values_in_the_order_of_the_columns(spark):
    kinds = ["time", "rank", "time", "time", "rank"]
    heads = [("t", f"c{i}", i, k) for i, k in enumerate(kinds)]
    values = lines(2, 300, ["12.5", "(3)", "-", "?"], 6) + [("no columns", 999, 1.0, "12.5")]
    patterns = {"time": r"^\d+\.\d$", "rank": r"^\(\d\)$"}
    found = columns.in_order(spark.createDataFrame(values, VALUES), spark.createDataFrame(heads, "table string, column string, place int, kind string"), patterns)
    want = []
    for line, row in by_line(values).items():
        left = iter([] if line == 999 else heads)
        broken = False
        for x, text in row:
            if text == "-":
                next(left, None)
                want.append((line, x, None, None))
                continue
            kind = {"12.5": "time", "(3)": "rank"}.get(text)
            name = None if broken else next((c for _, c, _, k in left if k == kind), None)
            broken = name is None
            want.append((line, x, name, "fits no column that is left" if broken else None))
    assert sorted((r.line, r.x, r.column, r.error) for r in found.collect()) == want


def test_findings_meet_runs_by_whole_ids(spark):
    findings = spark.createDataFrame([("1", "m/1", "order", "a"), ("2", "m/1/400m", "order", "b"), ("3", "m/1/400m/x", "speed", "c"), ("4", "m/11", "speed", "d"), ("5", "m", None, "e"), ("6", None, "speed", "f")], "finding string, subject string, check string, message string")
    runs = spark.createDataFrame([("m/1", "Ann"), ("m/1/400m/x", "Deep")], "run string, name string")
    splits = spark.createDataFrame([("m/1/400m", 50.5, "s1")], "split string, time double, source string")
    checks = spark.createDataFrame([("order", "Splits in order")], "check string, title string")
    cited = spark.createDataFrame([("1", "s9"), ("1", "s2"), ("1", "s9"), ("4", None)], "finding string, source string")
    got = {r.finding: (r.title, r.run, r.name, r.time, r.sources) for r in notes.notes(findings, runs, splits, checks, cited).collect()}
    assert got == {
        "1": ("Splits in order", "m/1", "Ann", None, ["s2", "s9"]),
        "2": ("Splits in order", "m/1", "Ann", 50.5, ["s1"]),
        "3": ("speed", "m/1/400m/x", "Deep", None, []),
        "4": ("speed", None, None, None, []),
        "5": (None, None, None, None, []),
        "6": ("speed", None, None, None, []),
    }


def test_short_names_differ_where_they_can(spark):
    day = lambda y: datetime.date(y, 8, 1)
    rows = [
        ("g", "1", "a", "GREEN", "Paris", day(2024), "Final"),
        ("g", "2", "b", "BROWN", "Paris", day(2024), "Final"), ("g", "3", "b", "BROWN", "London", day(2017), "Final"),
        ("g", "4", "c", "GREY", "Paris", day(2024), "Final"), ("g", "5", "c", "GREY", "Rome", day(2024), "Final"),
        ("g", "6", "d", "RED", "Paris", day(2024), "Final"), ("g", "7", "d", "RED", "Paris", day(2024), "Heat 1"),
        ("g", "8", "e", "BLUE", None, None, None), ("g", "9", "e", "BLUE", None, None, None),
        ("h", "10", "b", "BROWN", "Paris", day(2024), "Final"),
    ]
    found = notes.short_names(spark.createDataFrame(rows, "group string, run string, athlete string, family string, place string, day date, round string"))
    got = {r.run: r.short for r in found.collect()}
    assert [got[str(i)] for i in range(1, 8)] == ["GREEN", "BROWN ’24", "BROWN ’17", "GREY Paris", "GREY Rome", "RED Paris Final", "RED Paris Heat 1"]
    assert got["10"] == "BROWN" and got["8"] == got["9"]
    assert spark.range(1).select(notes.place_in_id(F.lit("og-2024-los-angeles"))).first()[0] == "Los Angeles"
    assert spark.range(1).select(notes.place_in_id(F.lit("og"))).first()[0] == ""
