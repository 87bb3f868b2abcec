"""Exact small cases of single operators."""

import datetime
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacewright.functions import printed
from pacewright.functions import text as tx
from pacewright.functions import times as tm
from pacewright.operators import assembly, flags, identity, motion, publish, ranks
from pacewright.sources import catalog, layout, transcripts


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("printed", "value", "scale"),
    [("44.2", "44.200", 1), ("44.20", "44.200", 2), ("1:47.50", "107.500", 2), ("2:15:03", "8103.000", None), ("9", "9.000", None), ("1:75", None, None), ("x", None, None)],
)
def test_seconds_keep_their_precision(spark, printed, value, scale):
    got = one(spark, tm.elapsed(F.lit(printed)))
    assert (None if got is None else str(got)) == value
    if value and "." in printed:
        assert one(spark, tm.precision(F.lit(printed))) == scale


@pytest.mark.parametrize(("printed", "status"), [("DNF", "dnf"), ("dsq", "dq"), ("12.5", "finished"), ("?", None)])
def test_results(spark, printed, status):
    assert one(spark, tm.outcome(F.lit(printed))[0]) == status


def test_dates(spark):
    assert one(spark, printed.dated(F.lit("6 JUN 2022"))) == datetime.date(2022, 6, 6)
    assert one(spark, printed.dated(F.lit("06 September 2009"))) == datetime.date(2009, 9, 6)
    assert one(spark, printed.dated(F.lit("soon"))) is None
    assert one(spark, printed.born(F.lit(94), F.lit(2022))) == 1994


def test_partial_dates_refine(spark):
    date = lambda y, m, d: F.struct(F.lit(y).alias("year"), F.lit(m).cast("int").alias("month"), F.lit(d).cast("int").alias("day"))
    assert one(spark, tm.refines(date(1990, 5, 1), date(1990, None, None)))
    assert not one(spark, tm.refines(date(1990, None, None), date(1990, 5, 1)))
    assert not one(spark, tm.refines(date(1990, 6, 1), date(1990, 5, None)))


def test_names(spark):
    assert one(spark, tx.slug(F.lit("Ørsted, Łukasz  ß"))) == "orsted-lukasz-ss"
    assert one(spark, tx.slug(F.lit("--"))) is None
    assert one(spark, tx.word_bag(F.lit("Zoë Ann-Marie"))) == "ann marie zoe"
    for name, family, given in (("VAN DER BERG Jan", "VAN DER BERG", "Jan"), ("Jan van der BERG", "van der BERG", "Jan"), ("Jan Berg", "Berg", "Jan")):
        got = one(spark, tx.split_name(F.lit(name)))
        assert (got.family, got.given) == (family, given)
    assert one(spark, tx.split_name(F.lit(None).cast("string"))) is None
    assert one(spark, tx.alike(F.lit("kowalska"), F.lit("kowalski"))) and not one(spark, tx.alike(F.lit("ab"), F.lit("ac")))
    assert [one(spark, tx.ordinal(F.lit(n))) for n in (1, 12, 22, 113)] == ["1st", "12th", "22nd", "113th"]
    assert one(spark, tx.clock(F.lit("107.509").cast("decimal(9,3)"))) == "1:47.50"


def test_printed_values_agree(spark):
    assert one(spark, flags.equal_printed(F.lit(44.29), F.lit(44.2), F.lit(1)))
    assert one(spark, flags.equal_printed(F.lit(44.29), F.lit(44.3), F.lit(1)))
    assert not one(spark, flags.equal_printed(F.lit(44.29), F.lit(44.4), F.lit(1)))
    assert [one(spark, flags.slack(F.lit(v), F.lit(s))) for v, s in ((0.0, 2), (9.1, 1), (9.12, 2))] == [0.0, 0.1, 0.005]


@pytest.mark.parametrize(("ranks", "outside"), [([1, 2, 3], []), ([1, 3, 2, 4], [2]), ([2, 1], [1]), ([3, 1, 2], [0]), ([1, 1, 1], []), ([], [])])
def test_longest_rising(ranks, outside):
    assert np.flatnonzero(~flags.longest_rising(np.array(ranks))).tolist() == outside


def test_motion_passes_its_knots_and_never_turns():
    rng = np.random.default_rng(3)
    for _ in range(50):
        x = np.concatenate(([0.0], np.cumsum(rng.uniform(1, 100, 6))))
        y = np.concatenate(([0.0], np.cumsum(rng.uniform(0.1, 30, 6))))
        assert np.allclose(motion.interpolate(x, y, x), y)
        assert (np.diff(motion.interpolate(x, y, np.linspace(0, x[-1], 500))) >= -1e-9).all()


def test_merge_notes_what_it_drops(spark):
    rows = [("a", 1, None, "x"), ("a", 2, 5, "y"), ("a", 3, 6, None), ("b", 1, None, None)]
    merged, conflicts = assembly.merge(spark.createDataFrame(rows, "subject string, authority int, lane int, mark string"), ["lane", "mark"])
    assert {tuple(r) for r in merged.collect()} == {("a", 5, "x"), ("b", None, None)}
    assert {tuple(r) for r in conflicts.collect()} == {("a", 3, "lane", "6", "5"), ("a", 2, "mark", "y", "x")}


def test_lines_follow_a_running_centre(spark):
    assert layout.line_numbers(np.array([10, 11, 12, 14.6, 20.0])).tolist() == [0, 0, 0, 1, 2]
    words = [("d", 1, "B", 5.0, 10.0, 6.0, 12.0), ("d", 1, "A", 1.0, 10.5, 2.0, 12.5), ("d", 1, "C", 1.0, 30.0, 2.0, 32.0)]
    got = layout.group_lines(spark.createDataFrame(words, "doc string, page int, text string, x0 double, top double, x1 double, bottom double"))
    assert [r.text for r in got.orderBy("line").collect()] == ["A B", "C"]
    parts = [("d", 1, "Bo", 0.0, 1.0, 5.0, 2.0), ("d", 1, "lt", 5.2, 1.0, 9.0, 2.0), ("d", 1, "9", 9.1, 1.0, 10.0, 2.0)]
    joined = layout.join_fragments(spark.createDataFrame(parts, "doc string, page int, text string, x0 double, top double, x1 double, bottom double"))
    assert sorted(r.text for r in joined.collect()) == ["9", "Bolt"]


def test_html_cells(spark):
    html = "<table><tr><th>Place<th>Time<tr><td>1<td hidden>no</td><td>9.58&nbsp;<tr style='display: none'><td>x</table>"
    got = layout.html_cells(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).collect()
    assert [(r.row, r.cell, r.text) for r in got] == [(0, 0, "Place"), (0, 1, "Time"), (1, 0, "1"), (1, 1, "9.58")]


def test_transcripts(spark, tmp_path):
    (tmp_path / "a.txt").write_text(
        "document = 'm/final/r'\ntitle = '800m' ← p1 (1.0,2.0,3.5,4.0) '800m' [heading]\nwind = None\n"
        "entries[0:BOLT].country = 'JAM' ← p1 (1.0,2.0,3.0,4.0) 'JAM' [row.country]\n"
        "entries[0:BOLT].result = Result(status=<Status.FINISHED: 'finished'>, time=Decimal('9.580')) ← p1 (1.0,2.0,3.0,4.0) '9.58' [row.result]\n"
    )
    values = transcripts.read_values(spark, str(tmp_path))
    title = values.where("path = 'title'").first()
    assert (title.document, title.value, title.page, title.box.x1, title.method) == ("m/final/r", "800m", 1, 3.5, "heading")
    entry = transcripts.entries(values).first()
    assert (entry.family, entry.country, entry.status, str(entry.time_s), entry.precision) == ("BOLT", "JAM", "finished", "9.580", 3)


def test_catalog(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("competition:\n  id: x\n  documents:\n  - race: 100m-men/final\n    url: u1\n  - race: 200m-men/final\n")
    (tmp_path / "bad.yaml").write_text("a: [")
    (tmp_path / "lock.json").write_text(json.dumps({"documents": {"d1": {"sha256": "ab", "url": "u", "retrieved_at": "t"}}}))
    nodes = catalog.read_yaml(spark, str(tmp_path))
    assert nodes.where("error is not null").count() == 1
    rows = catalog.records(nodes, "/competition/documents/[0-9]+", ["race", "url"]).orderBy("line").collect()
    assert [(r.line, r.race, r.url) for r in rows] == [(4, "100m-men/final", "u1"), (6, "200m-men/final", None)]
    assert catalog.read_lock(spark, str(tmp_path)).first().sha256 == "ab"


def test_publishing(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "id long, name string").withMetadata("id", {"comment": "key"})
    publish.write_tables({"t": df}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/parquet/t").count() == 1
    assert "\\N" in "".join(r.value for r in spark.read.text(f"{tmp_path}/csv/t").collect())
    assert "| id | key | bigint |" in publish.columns_document({"t": df})


def test_alike_pairs_are_all_pairs(spark):
    rng = np.random.default_rng(3)
    names = ["".join(rng.choice(list("abcd"), rng.integers(2, 9))) for _ in range(120)] + ["hudson smith", "hudsen smith", "hudson-smith", "hudsonsmith", "smithson hud", "anna", "annas", "anne"]
    got = {(r.name, r.other) for r in tx.alike_pairs(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    from difflib import SequenceMatcher

    kept = sorted({n for n in names if len(n) >= 4})
    want = {(a, b) for a in kept for b in kept if a < b and SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.85}
    assert got == want and want


def test_quantiles_of_large_groups(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(size=60_000), 3)
    frame = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0), ("b", 4.0), ("b", None), ("c", None)], "g string, v double")
    wanted = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "high": 1.0}
    got = {r.g: r for r in ranks.quantiles(frame, ["g"], "v", wanted).collect()}
    assert set(got) == {"a", "b"} and got["a"].n == 60_000 and got["b"].n == 2
    for name, q in wanted.items():
        assert np.isclose(got["a"][name], np.quantile(values, q)) and np.isclose(got["b"][name], np.quantile([1.0, 4.0], q))


PERFORMANCES = "performance long, race string, event string, athlete long, status string, time_s double, distance_m long"


def test_finish_may_be_cut_or_rounded(spark):
    runs = spark.createDataFrame([(1, "r", "e", 1, "finished", 247.64, 200), (2, "r", "e", 2, "dq", None, 200), (3, "r", "e", 3, "dns", None, 200), (4, "r", "e", 4, "finished", 50.0, 200)], PERFORMANCES)
    points = spark.createDataFrame([(1, "a", 1, 100, 100.0, 1), (1, "a", 2, 200, 247.6, 1), (2, "a", 1, 200, 60.0, 2), (3, "a", 1, 200, 60.0, 2), (4, "a", 1, 200, 50.1, 1)], "performance long, document string, point long, distance_m long, time_s double, scale int")
    found = flags.run_checks(flags.Inputs(points, runs), ["finish-matches-result"]).collect()
    assert sorted(r.performance for r in found) == [3, 4]


def test_a_changed_passing_is_found_by_each_check(spark):
    runs = spark.createDataFrame([(1, "r", "e", 1, "finished", 45.0, 400)], PERFORMANCES)
    for changed, check in ((20.5, "segment-matches-passings"), (32.5, "split-order"), (45.0, "split-before-finish")):
        times = [11.0, changed, 32.0, 45.0]
        points = spark.createDataFrame([(1, "a", i + 1, 100 * (i + 1), t) for i, t in enumerate(times)], "performance long, document string, point long, distance_m long, time_s double")
        if check == "split-before-finish":
            points = points.where("point <> 3")
        printed = spark.createDataFrame([(1, "a", 100, 200, 10.5)], "performance long, document string, start_m long, end_m long, time_s double")
        assert flags.run_checks(flags.Inputs(points, runs, printed), [check]).count() > 0, check


def test_rank_order_keeps_the_most(spark):
    import itertools

    rng = np.random.default_rng(9)
    fields = [list(rng.integers(1, 6, size=rng.integers(1, 7))) for _ in range(30)]
    rows = [(f"r{f}", "a", 1, 100, 10 * f + i, float(i), int(k)) for f, field in enumerate(fields) for i, k in enumerate(field)]
    points = spark.createDataFrame(rows, "race string, document string, point long, distance_m long, performance long, time_s double, rank long")
    found = flags.CHECKS["rank-order"].run(flags.Inputs(None, None, placed_points=points)).collect()
    for f, field in enumerate(fields):
        most = max(len(c) for n in range(1, len(field) + 1) for c in itertools.combinations(field, n) if list(c) == sorted(c))
        assert sum(10 * f <= r.performance < 10 * f + 10 for r in found) == len(field) - most


@pytest.mark.parametrize(
    ("text", "want"),
    [("1:01.80 (2) 12.5", [("1:01.80", 2), ("12.5", None)]), ("12.5 NO VALUE (3) 13.0 (=1)", [("12.5", None), ("13.0", 1)]), ("9.9 DNF (12)", [("9.9", None)]), ("Heat 1 7 0.0", []), ("1:01.80 (2) PB", []), ("", []), (None, [])],
)
def test_lines_of_times(spark, text, want):
    assert [tuple(x) for x in one(spark, printed.timed_words(F.lit(text).cast("string")))] == want


def test_printed_values(spark):
    assert str(one(spark, printed.with_thousandths(F.lit("21.00 (.995)")))) == "20.995" and one(spark, printed.with_thousandths(F.lit("21.00 (.895)"))) is None
    assert one(spark, printed.position(F.lit("(=12)"))) == 12 and one(spark, printed.position(F.lit("0"))) is None
    assert one(spark, printed.born(F.lit(1), F.lit(2023))) == 2001 and one(spark, printed.born(F.lit(15), F.lit(2023))) == 1915
    assert str(one(spark, printed.dated(F.lit("FRI 9 AUG 2024")))) == "2024-08-09" and str(one(spark, printed.dated(F.lit("2nd March, 2019 - Doha")))) == "2019-03-02"
    assert one(spark, printed.dated(F.lit("31 Febber 2020"))) is None and one(spark, printed.minutes_of_day(F.lit("24:00"))) is None
    assert one(spark, printed.shown_family(F.lit("McDONALD-O'BRIEN de VRIES"))) is not None


def test_registry_links_in_two_stages(spark):
    rows = spark.createDataFrame(
        [(1, "w", "GBR", ["hodgkinson", "keely"], "finished", 116.9, 1, 2002), (2, "w", "GBR", ["bell"], "dnf", None, 2, None), (3, "w", "GBR", ["reekie", "jemma"], "finished", 120.0, 2, 1998), (4, "w", None, ["reekie"], "dnf", None, 2, None)],
        "row long, sex string, country string, words array<string>, status string, time_s double, scale int, birth_year int",
    )
    listed = spark.createDataFrame(
        [(11, "w", "GBR", ["hodgkinsen", "k"], "finished", 116.96, 2002), (12, "w", "GBR", ["bell", "georgia"], "dnf", None, None), (13, "w", "GBR", ["reekie", "jemma"], "finished", 118.0, 1998), (14, "w", "GBR", ["reekie", "jemma"], "finished", 119.0, 1990)],
        "athlete long, sex string, country string, words array<string>, status string, time_s double, birth_year int",
    )
    got = {(r["row"], r.athlete, r.method) for r in identity.registry_links(rows, listed).collect()}
    assert got == {(1, 11, "time"), (2, 12, "status"), (3, 13, "name")}


def test_registry_links_form_no_pairs_through_common_words(spark):
    """A word that all share, and a time that many have: a row meets the least and greatest athlete only."""
    people = [(i, 0, "NOR", ["Common", "zebra" if i == 7 else f"own{i:05d}"], "finished", float(i % 5), None) for i in range(300)] + [(9000, 0, "NOR", ["Common", "other"], "finished", 77.0, 1990)]
    listed = spark.createDataFrame(people, "athlete long, sex int, country string, words array<string>, status string, time_s double, birth_year int")
    printed = [(i, 0, "NOR", ["Common", "none"], "finished", 3.0, 2, None) for i in range(300)]
    printed += [(5000, 0, "NOR", ["Common", "none"], "finished", 77.004, 2, None), (5001, 0, "NOR", ["Common", "zebra"], "dnf", None, 2, None), (5002, 0, "NOR", ["other"], "dnf", None, 2, 1990), (5003, 0, "NOR", ["other"], "dnf", None, 2, 1991)]
    rows = spark.createDataFrame(printed, "row long, sex int, country string, words array<string>, status string, time_s double, scale int, birth_year int")
    found = identity.registry_links(rows, listed)
    assert sorted(map(tuple, found.collect())) == [(5000, 9000, "time"), (5001, 7, "name"), (5002, 9000, "name")]
