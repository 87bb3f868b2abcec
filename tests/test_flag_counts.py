from pyspark.sql import functions as F

from pacewright.operators import flags
from pacewright.plans import registry
from pacewright.sources.tables import Tables

IDS = ["split-order", "segment-speed", "finish-matches-result"]


def test_counts_are_those_of_the_checks(spark, tables_dir):
    t = Tables(spark, tables_dir)
    off = F.when(F.col("suspect") & (F.col("mark") == "A"), 60.0).when(F.col("suspect") & (F.col("mark") == "N"), -40.0).otherwise(0.0)
    runs = t.runs.withColumn("status", F.when(F.col("performance") % 7 == 0, "dq").otherwise(F.col("status")))
    x = flags.Inputs(t.passings.withColumn("time_s", F.col("time_s") + off), runs)
    found = flags.run_checks(x, IDS).join(runs.select("performance", "race"), "performance")
    want = found.groupBy("check_id", "severity").agg(F.count("*").alias("flags"), F.count_distinct("race").alias("races")).collect()
    assert {r.check_id for r in want} == set(IDS)
    assert sorted(map(tuple, flags.counts(x).collect())) == sorted(map(tuple, want))


def test_lines_are_read_once_for_the_checks_and_once_for_the_results(spark, tables_dir):
    plan = registry.queries()["flag_counts"](spark, tables_dir)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("l_linestatus#") and len([f for f in plan.collectLeaves().mkString("\n").split("\n") if "l_linestatus#" in f]) == 2
