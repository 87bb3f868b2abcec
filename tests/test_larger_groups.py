"""What only large groups, long documents and great values show."""

import itertools
import time

import numpy as np
from pyspark.sql import functions as F

from pacewright.functions import text as tx
from pacewright.functions import times as tm
from pacewright.operators import assembly, calendar, columns, flags, motion
from pacewright.plans import registry
from pacewright.sources import spans, web_results
from tests.parity import engine, same


def test_registry_pairs_of_names_through_what_is_left(spark):
    rng = np.random.default_rng(3)
    names = {"".join(rng.choice(list("abc"), n)) for n in rng.integers(4, 19, 150)}
    names |= {n[:i] + n[i + 1 :] for n in list(names)[:60] for i in (1, 3)}
    want = {(a, b) for a, b in itertools.combinations(sorted(names), 2) if min(len(a), len(b)) >= 4 and tx.SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.85}
    got = {(r.name, r.other) for r in tx.alike_pairs(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == want


def test_times_of_a_million_seconds(spark):
    d = spark.createDataFrame([("5999999.5",), ("99999999999999999999:00:00",), ("1:02.5",)], "t string")
    assert [None if r[0] is None else float(r[0]) for r in d.select(tm.elapsed(F.col("t"))).collect()] == [5999999.5, None, 62.5]


def test_link_nearest_once_is_link_once(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"d{i % 4}", int(i % 3), float(x)) for i, x in enumerate(np.round(rng.uniform(0, 2000, 400), 2))]
    people = [(i, int(i % 3), float(x)) for i, x in enumerate(np.concatenate([np.round(rng.uniform(0, 2000, 150), 2), np.array([r[3] + 20 for r in rows[:60]])]))]
    rows, people = spark.createDataFrame(rows, "row long, document string, country int, mark double"), spark.createDataFrame(people, "candidate long, country int, listed double")
    want = assembly.link_once(rows, people, ["country"], F.abs(F.col("mark") - F.col("listed")) <= 20).collect()
    assert want and sorted(map(tuple, assembly.link_nearest_once(rows, people, ["country"], "mark", "listed", 20).collect())) == sorted(map(tuple, want))


def test_link_nearest_once_forms_no_pairs_in_a_crowd(spark):
    crowd = spark.range(20000).select(F.col("id").alias("row"), F.lit("d").alias("document"), F.lit(1).alias("country"), (F.col("id") % 997).cast("double").alias("mark"))
    people = crowd.select(F.col("row").alias("candidate"), "country", F.col("mark").alias("listed"))
    start = time.time()
    assert assembly.link_nearest_once(crowd, people, ["country"], "mark", "listed", 20).count() == 0
    assert time.time() - start < 60


def test_initials_meet_one_row_of_their_family(spark):
    full = spark.range(20000).select(F.concat(F.lit("A"), F.col("id") % 7).alias("given"), F.lit("f").alias("family"), F.lit("c").alias("country"))
    full = full.unionByName(spark.createDataFrame([("Bo", "f", "c"), ("Bo", "f", "c")], full.schema))
    short = spark.range(20000).select(F.col("id").alias("row"), F.when(F.col("id") == 5, "B").otherwise("A").alias("initial"), F.lit("f").alias("family"), F.lit("c").alias("country"))
    assert [tuple(r) for r in assembly.expand_initials(short, full).collect()] == [(5, "Bo")]


def _folder(spark, tmp_path, orders, lines):
    """The smallest tables with other orders and line items."""
    for name in ("region", "nation", "customer", "supplier", "part", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        (tmp_path / f"{name}.parquet").symlink_to(f"/root/testdata/sf0.001/{name}.parquet")
    for name, rows in (("orders", orders), ("lineitem", lines)):
        rows.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_more_runners_than_lanes(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumns({"o_orderdate": F.lit("1995-01-02").cast("timestamp"), "o_orderpriority": F.lit("5-LOW")})
    folder = _folder(spark, tmp_path, orders, spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"))
    same(registry.queries()["lanes_given"](spark, folder), engine(folder), registry.oracle_sql()["lanes_given"])


def test_documents_of_more_than_twenty_points(spark, tmp_path):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_orderkey < 400")
    lines = lines.withColumn("l_orderkey", F.floor(F.col("l_orderkey") / 20).cast("long"))
    folder = _folder(spark, tmp_path, spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where("o_orderkey < 20"), lines)
    for name in ("tiered_passings", "tiered_stretches"):
        same(registry.queries()[name](spark, folder), engine(folder), registry.oracle_sql()[name])


def test_longest_rising_of_a_large_field():
    def plain(ranks):
        length, before = np.ones(len(ranks), int), np.full(len(ranks), -1)
        for i in range(1, len(ranks)):
            fits = np.flatnonzero(ranks[:i] <= ranks[i])
            if len(fits):
                before[i] = fits[np.argmax(length[fits])]
                length[i] = length[before[i]] + 1
        member, i = np.zeros(len(ranks), bool), int(np.argmax(length))
        while i >= 0:
            member[i], i = True, before[i]
        return member

    rng = np.random.default_rng(1)
    for n in (1, 2, 9, 60, 200):
        for _ in range(20):
            ranks = rng.integers(0, max(2, n // 2), n)
            assert (flags.longest_rising(ranks) == plain(ranks)).all()
    start = time.time()
    assert flags.longest_rising(np.arange(200_000)[::-1].copy()).sum() == 1 and time.time() - start < 10


def test_rank_order_of_fields_across_batches(spark):
    points = spark.range(30).select(F.concat(F.lit("r"), F.col("id") % 2).alias("race"), F.lit(100).alias("distance_m"), F.col("id").alias("performance"), F.col("id").cast("double").alias("time_s"), F.when(F.col("id") == 7, 99).otherwise(F.col("id")).alias("rank"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert [r.performance for r in flags.rank_order(points).collect()] == [7]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_an_entry_of_the_calendar_stays_one_row(spark):
    """Entries of many days aren't copied day by day: the plan explodes editions only."""
    d = spark.createDataFrame([(1, "N", "2020-01-01", "2020-01-25", "x")], "id int, country string, first string, last string, city string").withColumns({c: F.col(c).cast("date") for c in ("first", "last")})
    e = d.drop("id").withColumn("entry", F.lit("e")).withColumn("rank", F.lit(1))
    met = calendar.meetings(d, e)
    assert met._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1 and met.count() == 1


def test_values_of_one_table_spread(spark):
    values = spark.range(2000).select(F.lit("t").alias("table"), F.col("id").alias("line"), F.lit(8.0).alias("x"), F.lit("F").alias("text"))
    heads = spark.createDataFrame([("t", "a", 8.0, "F")], "table string, column string, anchor double, kind string")
    found = columns.by_position(values, heads, F.col("text") == F.col("kind"))
    assert found.where("column = 'a'").count() == 2000 and "share" in found._jdf.queryExecution().analyzed().toString()


def test_a_match_in_a_long_line(spark):
    word = "struct(concat('w', id) as text, double(id) as x0, 1d as top, double(id) + 1 as x1, 2d as bottom)"
    line = spark.range(4000).selectExpr(f"{word} as w", "id").groupBy().agg(F.sort_array(F.collect_list(F.struct("id", "w"))).alias("l")).select(F.transform("l", lambda r: r["w"]).alias("words"))
    start = time.time()
    assert tuple(line.select(spans.sourced(F.col("words"), r"w3998 w3999").alias("m")).first().m) == ("w3998 w3999", 3998.0, 1.0, 4000.0, 2.0)
    assert time.time() - start < 30


def test_runs_of_as_many_knots_are_as_each_alone():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 9):
        x = np.hstack([np.zeros((50, 1)), 100.0 * np.cumsum(rng.integers(1, 4, (50, n)), axis=1)])
        y = np.hstack([np.zeros((50, 1)), np.cumsum(rng.uniform(0.1, 60, (50, n)), axis=1)])
        count, at, values = motion.interpolate_runs(x, y, 25.0)
        each = [np.arange(0.0, r[-1] + 1e-9, 25.0) for r in x]
        assert count.tolist() == [len(a) for a in each] and (at == np.concatenate(each)).all()
        assert np.allclose(values, np.concatenate([motion.interpolate(a, b, p) for a, b, p in zip(x, y, each, strict=True)]), rtol=1e-12, atol=0)


def test_gathered_lines_are_read_as_their_cells(spark):
    texts = [(0, 0, False, "Field | May 25, 2018"), (1, 0, False, "Friday 7:35 PM"), (2, 0, False, "Results: Women 800 M Cup (Finals)")]
    texts += [(3, i, True, t) for i, t in enumerate(("Pl", "Ln", "Athlete", "", "Affiliation", "Time", "400m", "800m"))]
    texts += [(4, i, False, t) for i, t in enumerate(("1", "2", "Ann  NAME", "", "Kenya", "2:00.10", "59.00 [59.00]", "2:00.10 [1:01.10]"))]
    cells = spark.createDataFrame([("d", *t) for t in texts], "doc string, row int, cell int, head boolean, text string")
    races = spark.createDataFrame([("d", 800, 400)], "doc string, metres int, lap int").selectExpr("doc", "cast(metres as decimal(12,3)) metres", "cast(lap as decimal(12,3)) lap")
    lines = cells.groupBy("doc", "row").agg(F.collect_list(F.struct("text", "head", "cell")).alias("cells"))
    read = [web_results.read_results(cells, races), web_results.read_lines(lines, races)]
    assert [tuple(r.stretches.orderBy("metres").collect()) for r in read][0] == tuple(read[1].stretches.orderBy("metres").collect()) and read[1].stretches.count() == 2 and read[1].errors.count() == 0
