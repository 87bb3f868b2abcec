from pyspark.sql import functions as F

from pacewright.functions import readings as rd


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_tail(spark):
    records, qualified, remarks = rd.tail(F.array(*map(F.lit, ("=NR", "Q", "PB", "disqualified"))))
    assert (one(spark, records), one(spark, qualified), one(spark, remarks)) == (["=NR", "PB"], "Q", ["disqualified"])


def test_laps_and_dates(spark):
    assert one(spark, rd.laps_to_go(F.lit("2 laps to go"), F.lit(1500), F.lit(False))) == 700
    assert one(spark, rd.laps_to_go(F.lit("1 lap to go"), F.lit(1500), F.lit(True))) == 1300
    assert one(spark, rd.laps_to_go(F.lit("finish"), F.lit(1500), F.lit(True))) is None
    assert tuple(one(spark, rd.partial_date(F.lit("10 Jan 1994")))) == (1994, 1, 10)
    assert tuple(one(spark, rd.partial_date(F.lit("1994")))) == (1994, None, None)
    assert one(spark, rd.partial_date(F.lit("10 Foo 1994"))) is None
    assert one(spark, rd.provenance_pointer("days", 3, "a/b~")) == "/days/3/a~1b~0"


def test_wind_and_grid(spark):
    words = [("d", 1, "+1.3", 10.0, 50.0, 20.0, 58.0), ("d", 1, "m/s", 22.0, 51.0, 30.0, 58.0), ("d", 1, "9.9", 0.0, 50.0, 5.0, 58.0), ("d", 1, "7.7", 10.0, 90.0, 20.0, 98.0)]
    got = rd.wind_before_unit(spark.createDataFrame(words, "doc string, page int, text string, x0 double, top double, x1 double, bottom double")).collect()
    assert [(r.doc, float(r.wind)) for r in got] == [("d", 1.3)]
    grid = one(spark, rd.label_grid(F.array(F.lit("100m"), F.lit("200m")), F.array(F.lit(10.0), F.lit(50.0)), F.lit(False)))
    assert [tuple(x) for x in grid] == [("100m", 10.0), ("200m", 50.0), ("Finish", 90.0)]
