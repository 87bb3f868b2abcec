"""Decontamination of repetitive texts, of shared ids, and beyond the size up to which tables are sent to every executor."""

import random

from pacewright.llm import decontamination

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def rows(found):
    return sorted(tuple(r) for r in found.collect())


def test_equal_words_against_equal_words(spark):
    docs = spark.createDataFrame([(1, "ha " * 20_000), (2, "ha " * 3 + "ho " * 9), (3, "ho " * 500), (4, "ha ho " * 40)], DOCS)
    items = spark.createDataFrame([(5, "ha " * 300), (6, "ho ho ha"), (7, "ho")], ITEMS)
    got = {(r.doc_id, r.item_id): (r.n_item_words, r.n_matched) for r in decontamination.contamination(docs, items).collect()}
    assert got == {(1, 5): (300, 300), (2, 7): (1, 1), (3, 7): (1, 1), (4, 7): (1, 1)}


def test_the_same_finds_when_nothing_is_sent_to_every_executor(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 12, 40, 150])))) for i in range(12)]
    docs = []
    for d in range(60):
        own = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        part = rng.choice(items)[1].split()
        at = rng.randint(0, len(own))
        quoted = [w if rng.random() > 0.08 else "other" for w in part[: rng.randint(1, len(part))]]
        docs.append((d % 50, " ".join(own[:at] + quoted + own[at:])))
    docs, items = spark.createDataFrame([*docs, *docs[:5]], DOCS), spark.createDataFrame(items, ITEMS)
    sent = rows(decontamination.contamination(docs, items))
    kept = sorted(r.doc_id for r in decontamination.without_leaks(docs, items).collect())
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(decontamination, "BROADCAST_IDS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontamination.contamination(docs, items)
        assert rows(found) == sent and len(sent) > 20
        assert sorted(r.doc_id for r in decontamination.without_leaks(docs, items).collect()) == kept
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_join_of_seeds_or_items_carries_a_text_s_tokens(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j")], DOCS)
    items = spark.createDataFrame([(5, "a b c d e f g h i j")], ITEMS)
    table = decontamination._positions(docs.selectExpr("doc_id", "split(text, ' ') as tokens"), (), False, "doc_id")
    assert table.columns == ["doc_id", "at", "seed"]
    plan = decontamination.contamination(docs, items)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert joins and not any("tokens" in line for line in joins)
