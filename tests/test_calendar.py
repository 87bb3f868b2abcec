"""Editions and calendar entries against all pairs in plain Python."""

import random
from datetime import date, timedelta
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from pacewright.operators import calendar

NAMES = {"muenchen": "munich", "wien": "vienna"}
CITIES = ["Paris", "PARIS ", "Paris-Saint-Denis", "München", "Munich", "Vienna", "Wien", "Helsinki", "Helsingfors", "Helsinky", "São Paulo", "Sao Paulo", "", None]


def rows(seed):
    rng = random.Random(seed)
    span = lambda: (lambda d, n: (d, None if n is None else d + timedelta(days=n)))(date(2020, 1, 1) + timedelta(days=rng.randrange(25)), rng.choice([None, -2, 0, 1, 3, 30]))
    held = [(i, rng.choice("AB") if i else None, *span(), rng.choice(CITIES)) for i in range(60)] + [(99, "A", None, None, "Paris")]
    entries = [(i, rng.choice("AB"), *span(), rng.choice([None, 0, 1, 1, 2]), rng.choice(CITIES), rng.choice([None, "Paris", "Wien"])) for i in range(60)] + [(98, "A", None, None, 0, "Paris", None)]
    return held, entries


def frames(spark, seed):
    held, entries = rows(seed)
    return held, entries, spark.createDataFrame(held, "id int, country string, first date, last date, city string"), spark.createDataFrame(entries, "entry int, country string, first date, last date, rank int, city string, venue string")


def range_of(first, last):
    return first, max(first, min(last or first, first + timedelta(days=calendar.MOST_DAYS - 1)))


def overlapping(h, entries):
    if h[1] is None or h[2] is None:
        return []
    a, b = range_of(h[2], h[3])
    day = timedelta(days=1)
    return [e for e in entries if e[1] == h[1] and e[2] and range_of(e[2], e[3])[0] - day <= b and a <= range_of(e[2], e[3])[1] + day]


def test_overlaps_are_those_of_all_pairs(spark):
    held, entries, h, e = frames(spark, 1)
    got = sorted((r.id, r.entry) for r in calendar.meetings(h, e).collect())
    assert got == sorted((x[0], y[0]) for x in held for y in overlapping(x, entries)) and len(got) > 100


def test_best_entry_and_its_ties(spark):
    held, entries, h, e = frames(spark, 2)
    want = set()
    for x in held:
        by = sorted(((y[4] if y[4] is not None else 1 << 30), abs((y[2] - x[2]).days), y[0]) for y in overlapping(x, entries))
        want.add((x[0], by[0][2] if by else None, sum(b[:2] == by[0][:2] for b in by)))
    got = {tuple(r) for r in calendar.best_entry(h, e).collect()}
    assert got == want and any(t > 1 for *_, t in got) and any(y is None for _, y, _ in got)


def city(a, b):
    fold = lambda t: "-".join("".join(c if c.isalnum() else " " for c in (t or "").lower().replace("ü", "ue").replace("ã", "a")).split())
    x, y = (NAMES.get(fold(t), fold(t)) for t in (a, b))
    return bool(x and y and (x.startswith(y) or y.startswith(x) or SequenceMatcher(None, x, y).ratio() >= 0.8))


def test_cities(spark):
    pairs = spark.createDataFrame([(a, b) for a in CITIES for b in CITIES], "a string, b string")
    names = {"munchen": "munich", **NAMES}
    got = {(r.a, r.b): r.same for r in pairs.select("a", "b", calendar.same_city(F.col("a"), F.col("b"), names).alias("same")).collect()}
    assert got == {(a, b): city(a, b) for a in CITIES for b in CITIES}
    assert got["Helsinki", "Helsinky"] and not got["Helsinki", "Helsingfors"] and got["Paris", "Paris-Saint-Denis"] and got["Wien", "Vienna"] and not got[None, None]


def test_only_entry_rejects_several(spark):
    held, entries, h, e = frames(spark, 3)
    want = set()
    for x in held:
        near = [y[0] for y in overlapping(x, entries) if not x[4] or city(y[5], x[4]) or city(y[6], x[4])]
        want.add((x[0], near[0] if len(near) == 1 else None, len(near)))
    got = {tuple(r) for r in calendar.only_entry(h, e, {"munchen": "munich", **NAMES}).collect()}
    assert got == want and any(y is not None for _, y, _ in got)


def test_no_entries(spark):
    held, entries, h, e = frames(spark, 4)
    assert {tuple(r)[1:] for r in calendar.best_entry(h, e.limit(0)).collect()} == {(None, 0)}
    assert calendar.meetings(h.limit(0), e).count() == 0
