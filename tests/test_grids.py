"""Tiered grids: labels, times below them, and what can't be read."""

from decimal import Decimal

import pytest

from pacewright.sources import grids

WORDS, TIMED = "doc string, line int, x0 double, x1 double, text string", "doc string, athlete string, line int, x0 double, x1 double, text string"
RACES = "doc string, metres decimal(12,3), lap decimal(12,3), steeple boolean, first_hurdle decimal(12,3), hurdle_gap decimal(12,3), full_tier int"


def labels(doc, line, *texts, start=80.0, pitch=50.0):
    """Labels a pitch apart; the words of a label stand close together."""
    return [(doc, line, start + pitch * i + 9 * j, start + pitch * i + 9 * j + 8, w) for i, t in enumerate(texts) for j, w in enumerate(t.split())]


def times(doc, athlete, line, *texts, start=80.0, pitch=50.0):
    return [(doc, athlete, line, start + pitch * i + 20 * j, start + pitch * i + 20 * j + 8, w) for i, t in enumerate(texts) if t for j, w in enumerate(t.split())]


def race(doc, metres, steeple=False, lap=400, full=10, hurdle=None):
    return (doc, Decimal(metres), Decimal(lap), steeple, *(map(Decimal, hurdle) if hurdle else (None, None)), full)


@pytest.fixture
def read(spark):
    def run(words, races, timed=(), results=()):
        return grids.read_tiers(spark.createDataFrame(words, WORDS), spark.createDataFrame(races, RACES), spark.createDataFrame(list(timed), TIMED), spark.createDataFrame(list(results), "doc string, athlete string, result string"))

    return run


def points(found):
    return [float(r.metres) for r in found.labels.orderBy("doc", "place").collect()]


def errors(found):
    return sorted((r.doc, r.athlete, r.error) for r in found.errors.collect())


def passed(found):
    return sorted((r.doc, r.athlete, float(r.metres), float(r.time), r.rank) for r in found.passings.collect())


def stretched(found):
    return sorted((r.doc, r.athlete, float(r.start_metres), float(r.metres), float(r.time)) for r in found.stretches.collect())


def test_laps_to_go_count_back_from_the_finish(read):
    words = labels("mile", 1, "3.5 laps to go", "2 laps to go", "1 lap to go", "1/2 lap to go") + labels("in", 1, "2 laps to go", "1 lap to go") + labels("st", 1, "5 laps to go", "4 laps to go")
    found = read(words, [race("mile", "1609.344"), race("in", 800, lap=200), race("st", 3000, steeple=True)])
    assert points(found)[:2] == [400.0, 600.0] and points(found)[2] == 800.0
    assert [float(r.metres) for r in found.labels.where("doc = 'mile'").orderBy("place").collect()] == [209.344, 809.344, 1209.344, 1409.344, 1609.344]
    assert errors(found) == [("st", None, "laps to go of a steeplechase have no place in metres")]


def test_one_label_takes_what_is_near_it(read):
    found = read(labels("d", 1, "400m", start=160.0), [race("d", 800)], times("d", "a", 1, "56.4 (2)", start=172.0) + times("d", "b", 1, "56.9 (3)", start=190.0))
    assert points(found) == [400.0]
    assert errors(found) == [("d", "b", "56.9 is below no label")] and passed(found) == []
    found = read(labels("d", 1, "400m", start=160.0), [race("d", 800)], times("d", "a", 1, "56.4 (2)", start=172.0))
    assert passed(found) == [("d", "a", 400.0, 56.4, 2)] and stretched(found) == []


def test_tiers_alternate_and_the_finish_may_stand_alone(read):
    words = [("d", 0, 10.0, 30.0, "Analysis"), *labels("d", 1, "100m", "200m", "300m"), *labels("d", 2, "400m", "500m"), ("d", 3, 10.0, 30.0, "Lane"), *labels("d", 4, "900m", "950m")]
    own = times("d", "a", 1, "12.00 (1)", "24.10 (2)", "36.3 (0)") + times("d", "a", 2, "12.00", "12.10", "12.20") + times("d", "a", 3, "48.50 (1)", "1:00.80 (1)", "1:13.25 (1)") + times("d", "a", 4, "12.20", "12.30", "12.45")
    lone = times("d", "b", 1, "", "", "1:15.00 (3)")
    late = times("d", "c", 1, "12.40 (3)", "NO VALUE", "DNF (4)") + times("d", "c", 2, "12.40")
    found = read(words, [race("d", 600, full=3)], own + lone + late, [("d", "a", "1:13.25"), ("d", "b", "1:15.00")])
    assert points(found) == [100.0, 200.0, 300.0, 400.0, 500.0, 600.0]
    assert errors(found) == []
    assert passed(found) == sorted(
        [("d", "a", m, t, r) for m, t, r in ((100.0, 12.0, 1), (200.0, 24.1, 2), (300.0, 36.3, None), (400.0, 48.5, 1), (500.0, 60.8, 1), (600.0, 73.25, 1))] + [("d", "b", 600.0, 75.0, 3), ("d", "c", 100.0, 12.4, 3)], key=lambda x: x[:3]
    )
    assert stretched(found) == [("d", "a", m - 100.0, m, t) for m, t in ((100.0, 12.0), (200.0, 12.1), (300.0, 12.2), (400.0, 12.2), (500.0, 12.3), (600.0, 12.45))] + [("d", "c", 0.0, 100.0, 12.4)]


def test_full_rows_put_the_finish_into_a_row_of_its_own(read):
    found = read(labels("d", 1, "100m", "200m"), [race("d", 300, full=2)], times("d", "a", 1, "12.0 (1)", "24.0 (1)") + times("d", "a", 2, "36.0 (1)"))
    assert [(r.tier, float(r.metres), r.finish) for r in found.labels.orderBy("place").collect()] == [(0, 100.0, False), (0, 200.0, False), (1, 300.0, True)]
    assert passed(found)[-1] == ("d", "a", 300.0, 36.0, 1)


def test_labels_as_printed(read):
    words = labels("d", 1, "20m", "30", "40mm", "Hurdle 2", "100m")
    found = read(words, [race("d", 100, hurdle=("45", "10"), full=None)])
    assert points(found) == [20.0, 30.0, 40.0, 55.0, 100.0]
    assert [r.finish for r in found.labels.orderBy("place").collect()] == [False] * 4 + [True]
    assert sorted(r.note for r in found.notes.collect()) == ["label 30 read as 30m", "label 40mm read as 40m"]
    assert read(labels("d", 1, "20", "30"), [race("d", 100)]).labels.count() == 0
    assert errors(read(labels("d", 1, "200m", "100m"), [race("d", 400)])) == [("d", None, "labels aren't in the order of the race")]
    assert errors(read(labels("d", 1, "100m") + labels("d", 2, "200m"), [race("d", 400)])) == [("d", None, "one label doesn't tell the spacing of the others")]


def test_a_stretch_from_an_untimed_point_is_left_out(read):
    found = read(labels("d", 1, "200m", "300m", "400m"), [race("d", 500)], times("d", "a", 1, "30.0 (1)", "45.0 (1)") + times("d", "a", 2, "15.5", "15.0"))
    assert stretched(found) == [("d", "a", 200.0, 300.0, 15.0)] and len(passed(found)) == 2


def test_what_can_t_be_read_is_told_and_gives_nothing(read):
    words = [w for d in "abcde" for w in labels(d, 1, "100m", "200m")]
    timed = (
        times("a", "x", 1, "12.0 (1)", "24.0") + times("a", "x", 2, "12.0 (1)", "24.0", "36.0", start=80.0)
        + times("b", "x", 1, "12.0 (1)") + times("b", "x", 2, "24.0 (1)")
        + [("c", "x", 1, x0, x0 + 4, w) for x0, w in ((75.0, "12.0"), (80.0, "(1)"), (86.0, "12.1"), (91.0, "(2)"))]
        + times("d", "x", 1, "12.0", "14.0") + times("d", "x", 1, "12.5", start=83.0)
        + times("e", "x", 1, "12.0 (1)", "who") + times("e", "y", 1, "12.0 (1)")
    )
    found = read(words, [race(d, 300) for d in "abcde"], timed)
    assert errors(found) == [("a", "x", "a line has times with and without ranks"), ("b", "x", "more lines than tiers"), ("c", "x", "two cumulative times at a point"), ("d", "x", "two times of a stretch")]
    assert passed(found) == [("e", "y", 100.0, 12.0, 1)] and stretched(found) == []


def test_nothing_gives_nothing(read, spark):
    found = read([], [], [])
    assert found.labels.count() == found.passings.count() == found.stretches.count() == found.errors.count() == 0
