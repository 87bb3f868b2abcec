import json

import pytest
from pyspark.sql import functions as F

from pacewright.operators import relations
from pacewright.sources import listings, spans


def test_registry_results_skip_mixed_relays_and_missing_lists(spark):
    person = lambda slug: {"mark": " 51.20 ", "nationality": "KEN", "competitor": {"name": "Ann OLD", "urlSlug": slug}}
    events = [
        {"event": "400m", "gender": "W", "races": [{"race": "Final", "results": [person("kenya-team"), person("ann-old-77")]}, {"race": "B"}]},
        {"event": "4x400m", "gender": "X", "races": [{"race": "Final", "results": [person("ann-old-77")]}]},
    ]
    body = json.dumps({"days": [{"date": "1", "eventTitles": None}, {"date": "2", "eventTitles": [{"events": events}]}]})
    rows = listings.registry_results(spark.createDataFrame([("a", body), ("b", "no json"), ("c", None), ("d", "{}")], "id string, body string")).collect()
    assert [(r.id, r.pointer, r.sex, r.mark, r.profile) for r in rows] == [("a", "/days/1/eventTitles/0/events/0/races/0/results/1", "women", "51.20", 77)]


def test_audit_buckets(spark):
    declared = spark.createDataFrame([("a1", "a", "x", "u"), ("a2", "a", "x", "u"), ("a3", "a", "hand", "u"), ("c1", "c", "x", "u"), ("d1", "d", "x", "u")], "id string, race string, format string, url string")
    listed = spark.createDataFrame([("a1", "a", "u"), ("b1", "b", "u"), ("d1", "d", "v"), ("e1", "e", "u")], "id string, race string, url string")
    excluded = spark.createDataFrame([("e",), ("e",)], "race string")
    got = {tuple(r) for r in listings.audit(declared, listed, excluded, ["x"]).collect()}
    assert got == {("a1", "same"), ("b1", "missing"), ("d1", "moved"), ("e1", "excluded"), ("a2", "unlisted"), ("c", "by hand")}


def test_analyses_take_their_own_results_before_the_rounds(spark):
    pages = [("d", 3, "Unit W-H-1 Report C77A"), ("d", 2, "Unit W-H-1 Report C77A"), ("d", 5, "Unit W-H-2 Report C77A"), ("d", 7, "Unit W-H-2 Report C73"), ("d", 8, "Unit W-H Report C73"), ("d", 1, "Start list"), ("d", 9, None)]
    got = listings.analyses(listings.book_reports(spark.createDataFrame(pages, "doc string, page int, text string"))).orderBy("unit").collect()
    assert [(r.unit, r.analysis_pages, r.results_pages) for r in got] == [("W-H-1", [2, 3], [8]), ("W-H-2", [5], [7])]


def test_indexed_files(spark):
    files = ["x_C77A_ATHW1500M-------------SFNL000300--.pdf", "x_C73A_ATHW1500M-------------SFNL000000--.pdf", "x_C77A_ATHWLJ----------------FNL-000100--.pdf", "menu.pdf", None]
    got = listings.indexed_races(spark.createDataFrame([(1, f) for f in files], "index int, file string"), {"1500M": "1500"}, {"SFNL": "s"}).collect()
    assert [(r.results, r.heat, r.copy) for r in got] == [(files[1], 3, "AT-1500-W-s--3--.RS7.pdf")]


def test_store_keeps_each_content_once_and_tells_damage(spark, tmp_path):
    folder = str(tmp_path / "store")
    d = spark.createDataFrame([(b"one",), (b"one",), (None,)], "content binary")
    listings.put(d, folder)
    listings.put(d.unionByName(spark.createDataFrame([(b"two",)], "content binary")), folder, spark.read.parquet(folder))
    kept = spark.read.parquet(folder)
    assert sorted(bytes(r.content) for r in kept.collect()) == [b"one", b"two"]
    hurt = kept.withColumn("content", F.when(F.decode("content", "UTF-8") == "two", F.lit(b"tvo")).otherwise(F.col("content")))
    assert sorted(r.intact for r in listings.intact(hurt).collect()) == [False, True]


def test_match_box_covers_whole_words(spark):
    words = [("Wind:", 0.0, 1.0, 20.0, 9.0), ("+1.2", 25.0, 0.5, 40.0, 9.0), ("m/s", 42.0, 1.0, 55.0, 9.5)]
    d = spark.createDataFrame([(words,), ([],)], "words array<struct<text:string,x0:double,top:double,x1:double,bottom:double>>")
    got = [r.m for r in d.select(spans.sourced(F.col("words"), r"Wind: ([+-][\d.]+ m)", 1).alias("m")).collect()]
    assert (got[0].value, got[0].x0, got[0].top, got[0].x1, got[0].bottom) == ("+1.2 m", 25.0, 0.5, 55.0, 9.5) and got[1] is None


def test_lap_points_and_headings(spark):
    d = spark.createDataFrame([(1609.0,), (1209.0,), (1000.0,), (409.0,)], "m double")
    assert [r.p for r in d.select(spans.lap_point(F.col("m"), F.lit(1609.344), F.lit(400.0)).alias("p")).collect()] == pytest.approx([1609.344, 1209.344, 1000.0, 409.344], rel=1e-12)
    h = spark.createDataFrame([("Men 800m Heat B",), ("HEAT 12",), ("Final",), ("B Race",), ("800m",), (None,)], "t string")
    assert [tuple(r.x) for r in h.select(spans.heading_round(F.col("t")).alias("x")).collect()] == [("heat", 2), ("heat", 12), ("final", None), ("b-race", None), (None, None), (None, None)]


def test_missing_values_have_no_source(spark):
    d = spark.createDataFrame([(1, "KEN"), (2, None)], "id int, country string").withColumn("country", relations.sourced(F.col("country"), F.struct(F.lit("doc").alias("document"))))
    got = relations.relation(d, {"id": "Id."}, {"country": "As printed."})
    assert [(r.id, r.country, r.country_source is None) for r in got.orderBy("id").collect()] == [(1, "KEN", False), (2, None, True)]
    assert [f.metadata["comment"] for f in got.schema.fields] == ["Id.", "As printed.", "Where country was read: sources.id."]
    assert relations.sources([(d, ["country"])]).count() == 1
