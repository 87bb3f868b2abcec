"""Tiered grids are shuffled by document alone."""

import re

from pacewright.plans import registry


def test_nothing_is_shuffled_by_more_than_its_document(spark, tables_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.queries()["tiered_passings"](spark, tables_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)
    assert keys and all(re.fullmatch(r"doc#\d+", k) for k in keys)
