import random

import pytest

from pacewright.llm.near_duplicates import near_duplicates

SCHEMA = "doc_id long, text string"


def brute(rows):
    """Component of every document, by comparing all pairs of full sets."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for doc, text in rows:
        for c in "\t\n\x0b\x0c\r":
            text = (text or "").replace(c, " ")
        w = [x for x in text.translate(lower).split(" ") if x]
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {d: d for d in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {d: (len(s), label[d]) for d, s in sets.items()}


def check(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_against_all_pairs(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 30, 100, 140, 400]))]
        rows += [edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 6, 12])) for _ in range(rng.choice([1, 2, 5, 14]))]
    common = " ".join(f"p{i}" for i in range(80))
    rows += [f"{common} {edited(rng, ['q'] * 30, 25)}" for _ in range(12)]
    check(spark, list(enumerate(rows)))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, "ÉÉ bb"), (8, "éé bb"), (9, "a b c d e"), (10, "a b c d e f")]
    check(spark, rows)
    extra = spark.createDataFrame([(1, "a b", 5, "z")], "doc_id long, text string, n_shingles int, kept string")
    assert [tuple(r) for r in near_duplicates(extra).collect()] == [(1, 1, 1, True)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    repeated = near_duplicates(spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e")], SCHEMA)).collect()
    assert [(r.doc_id, r.component_id) for r in repeated] == [(1, 1), (1, 1)]


@pytest.mark.parametrize("n", [60])
def test_copies_are_one_component(spark, n):
    check(spark, [(i, "the same few words for every one of these rows") for i in range(n)] + [(n + 1, "other words in this one entirely here now")])
