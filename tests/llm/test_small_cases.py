"""Defined results of nulls, empty and long texts, repeats, empty tables and extra columns, and exact small cases."""

import base64
import collections
import hashlib
import math
import random
import re
import time
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacewright.llm import decontamination, html_text, language_model, licenses, pieces, quality, tokens, toxicity, url_filter, warc
from pacewright.llm.queries import TOKENIZER, URL_RULES, oracle_sql, queries
from tests.parity import engine, same

DOCS = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(name, spark, tables_dir):
    same(queries()[name](spark, tables_dir), engine(tables_dir), oracle_sql()[name])


# quality


def test_quality_edges(spark):
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, "x " * 60, "en", "a"), (4, " ".join(f"w{i}" for i in range(60)), "en", None), (4, " ".join(f"w{i}" for i in range(60)), "en", None), (None, "a b", "en", "a"), (6, "a\nb\na\n \na", "en", "a")]
    d = spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("clash")).withColumn("x0", F.lit(1))
    got = sorted(((r.doc_id or 0, r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.quality(d).collect()))
    assert got == [(0, 2, 2, 0, 0, True, False), (1, 0, 0, 0, 0, True, False), (2, 0, 0, 0, 0, True, False), (3, 60, 60, 0, 60, True, False), (4, 60, 170, 0, 0, False, True), (4, 60, 170, 0, 0, False, True), (6, 4, 4, 2, 0, True, False)]
    assert quality.quality(spark.createDataFrame([], DOCS)).count() == 0


def test_quality_rejects_what_its_group_isn_t(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(60, 300))), "en", "s") for i in range(200)]
    rows += [(1000 + i, " ".join(word() + "&%$#" for _ in range(80)), "en", "s") for i in range(10)]
    kept = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(kept[i] for i in range(200)) and not any(kept[1000 + i] for i in range(10))


def test_quality_agrees_with_many_random_starts(spark):
    """The verdicts are those of the best of 40 randomly started minimum-covariance estimates in numpy."""
    rng = random.Random(15)
    word = lambda: "".join(rng.choice("abcdefghKLM") for _ in range(rng.randint(2, 9)))
    texts = [" ".join(word() for _ in range(rng.randint(60, 120))) for _ in range(300)]
    texts += [" ".join(word() + "&%$#" for _ in range(80)) for _ in range(25)] + [" ".join(word().upper() for _ in range(80)) for _ in range(25)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert not any(r.base_failed for r in got.values())
    x = np.array([[float(v) for v in r] for r in quality.statistics(docs).orderBy("doc_id").selectExpr(*(f"floor({quality.UNIT} * {f} + 0.5)" for f, _ in quality.FEATURES.values())).collect()])
    assert x.shape == (350, len(quality.FEATURES))
    floors = np.diag([(quality.UNIT * least) ** 2 for _, least in quality.FEATURES.values()])
    h, draw, best = int(np.ceil(quality.SUBSET * len(x))), np.random.default_rng(1), None
    for _ in range(40):
        own = draw.choice(len(x), 8, replace=False)
        for _ in range(15):
            mean, cov = x[own].mean(0), quality.CONSISTENCY * np.cov(x[own].T, bias=True) + floors
            d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            own = np.argsort(d2, kind="stable")[:h]
        if best is None or np.linalg.det(cov) < best[0]:
            best = (np.linalg.det(cov), d2)
    assert {i for i, r in got.items() if not r.kept} == set(np.flatnonzero(best[1] > quality.CUTOFF))
    assert not any(got[i].kept for i in range(300, 325)) and all(got[i].kept for i in range(300))


def test_words_are_hashed_alike_in_pieces(monkeypatch):
    import pyarrow as pa

    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "Bc", " ", "\n", "é", "x" * 40]) for _ in range(200)) for _ in range(5)] + ["", None, "y" * 300]
    whole = [c.hashes().tolist() for c in tokens.chunks(pa.array(texts), tokens.SPACE)]
    monkeypatch.setattr(tokens, "PIECE", 7)
    tokens._powers.cache_clear()
    assert [c.hashes().tolist() for c in tokens.chunks(pa.array(texts), tokens.SPACE)] == whole
    monkeypatch.undo()
    tokens._powers.cache_clear()
    words = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))]
    assert whole[0] == [tokens.word_hash(w) for w in words]


# decontamination


def test_leaks(spark):
    rng = random.Random(2)
    item = [f"t{i}" for i in range(24)]
    changed = list(item)
    for i in (3, 10, 17):
        changed[i] = "other"
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    docs = [(1, " ".join(noise(50) + item + noise(9))), (2, " ".join(noise(5) + changed).upper()), (3, " ".join(noise(200))), (4, " ".join(item[:9] + noise(30))), (5, None), (6, ""), (7, " ".join(item * 3)), (None, " ".join(item))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(0))
    b = spark.createDataFrame([(1, " ".join(item)), (2, "a b c"), (3, None), (1, " ".join(item))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_item_words, r.n_matched, r.first_word) for r in decontamination.contamination(d, b).collect()}
    assert got == {(1, 1): (24, 24, 50), (2, 1): (24, 21, 5), (7, 1): (24, 24, 0)}
    assert sorted(r.doc_id or 0 for r in decontamination.without_leaks(d, b).collect()) == [0, 3, 4, 5, 6]
    assert decontamination.contamination(d.limit(0), b).count() == 0 and decontamination.contamination(d, b.limit(0)).count() == 0


def test_leaks_of_part_of_an_item_and_of_short_items(spark):
    rng = random.Random(12)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    item, long = [f"t{i}" for i in range(59)], [f"u{i}" for i in range(300)]
    parts = [item[20:49], long[100:250], item[:13], item[46:], item[30:43], item[:12], item[40:49]]
    docs = [(i, " ".join(noise(40) + p + noise(40))) for i, p in enumerate(parts)]
    docs += [(10, "x A b C"), (11, "a b x c"), (12, "one two three four five six seven"), (13, "one two three four five six eight"), (14, "solo"), (15, "a b c a b c")]
    items = [(1, " ".join(item)), (2, " ".join(long)), (3, "a b c"), (4, "one two three four five six seven"), (5, "Solo"), (6, "")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_matched, r.first_word) for r in decontamination.contamination(d, b).collect()}
    assert got == {(0, 1): (29, 20), (1, 2): (150, -60), (2, 1): (13, 40), (3, 1): (13, -6), (4, 1): (13, 10), (10, 3): (3, 1), (12, 4): (7, 0), (14, 5): (1, 0), (15, 3): (3, 0)}
    assert sorted(r.doc_id for r in decontamination.without_leaks(d, b).collect()) == [5, 6, 11, 13]


def places(text, item):
    """How many tokens of an item stand in place on the best diagonal of a text, by comparing every alignment."""
    a, b = text.lower().split(), item.lower().split()
    return max((sum(a[i + j] == b[j] for j in range(len(b)) if 0 <= i + j < len(a)) for i in range(-len(b), len(a))), default=0)


def test_leaks_by_every_alignment(spark):
    rng = random.Random(21)
    noise = lambda n: [f"n{rng.randrange(50)}" for _ in range(n)]
    items = [(i, " ".join(f"i{i}x{rng.randrange(400)}" for _ in range(rng.choice([10, 16, 30, 60])))) for i in range(8)]
    docs = []
    for d in range(80):
        item = items[rng.randrange(8)][1].split()
        part = [w if rng.random() < rng.choice([0.5, 0.9, 1.0]) else "zz" for w in item]
        docs.append((d, " ".join(noise(rng.randrange(40)) + part + noise(rng.randrange(40)))))
    got = {(r.doc_id, r.item_id) for r in decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for d, text in docs:
        for i, item in items:
            share = places(text, item) / len(item.split())
            assert ((d, i) in got) if share >= 0.9 else ((d, i) not in got) if share < 0.2 else True, (d, i, share)


# toxicity


def best_segments(scores):
    """All maximal segments by definition: the best one, then those left and right of it."""
    best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return best_segments(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in best_segments(scores[j:])]


def test_maximal_segments():
    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.choice([-3, -2, -1, 1, 2, 5]) + rng.random() * 1e-3 for _ in range(rng.randint(1, 14))]
        runs, total = [], 0.0
        for i, s in enumerate(scores):
            if s > 0 and i and scores[i - 1] > 0:
                runs[-1] = (runs[-1][0], i + 1, runs[-1][2], total + s)
            elif s > 0:
                runs.append((i, i + 1, total, total + s))
            total += s
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(runs)] == best_segments(scores)


def test_toxicity(spark):
    rng = random.Random(3)
    words = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        text = words(80)
        if toxic:
            text[40:44] = ["vile", "scorn", "vile", "hate"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "Vile, scorn! hate " + " ".join(words(20000))), (1002, "clean")]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (5000, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score_texts(docs.withColumn("score", F.lit("clash")), toxicity.train(docs, known)).collect()
    held = [r for r in got if r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert held and all(r.held_out for r in held)
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.95 * len(held)
    hit = next(r for r in held if r.predicted)
    assert any(p.first_word <= 41 <= p.last_word for p in hit.passages)
    empty = [r for r in got if r.doc_id in (1000, 1001)]
    assert all(r.score == min(x.score for x in got) and not r.passages for r in empty) and len(got) == len(rows)
    nothing = toxicity.train(docs, known.limit(0))
    assert toxicity.score_texts(docs.limit(0), nothing).count() == 0


# pieces


def test_pieces_round_trip_and_match_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)
    texts = ["Hello  world", "  lead", "tab\there\n\nnew", "", " " * 37, "日本語🙂 ünïcode", "aaaaaaaaab=-**", "x" * 5000, "a\0b", "ﬁne Å"]
    d = spark.createDataFrame([*enumerate(texts), (99, None)], "i long, text string").withColumn("ids", F.lit("clash"))
    got = {r.i: r for r in pieces.encode(d, TOKENIZER).collect()}
    for i, text in enumerate(texts):
        assert list(got[i].ids) == library.encode(text) and got[i].round_trip and got[i].n_tokens == len(got[i].ids)
    assert list(got[99].ids) == []
    back = pieces.decode(pieces.encode(d.withColumn("doc_id", F.col("i")), TOKENIZER), TOKENIZER)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(texts)) | {99: ""}
    assert pieces.encode(d.limit(0), TOKENIZER).count() == 0


def test_pieces_unigram_path_is_the_best_one():
    own = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -2.5, "▁a": -1.0, "ba": -1.2, "aba": -4.5}
    model = pieces.Model([("<unk>", 0.0, pieces.UNKNOWN), *((p, s, pieces.NORMAL) for p, s in own.items())], pieces.UNIGRAM)

    def best(s):
        return max((own[s[:k]] + best(s[k:]) for k in range(1, len(s) + 1) if s[:k] in own), default=-math.inf) if s else 0.0

    for text in ("a", "abab", "bab", "aabba"):
        found = [model.pieces[i][0] for i in model.encode(text)]
        assert "".join(found) == "▁" + text and math.isclose(sum(own[p] for p in found), best("▁" + text))


def test_pieces_find_no_path_anew_where_only_signs_differ():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)
    model = pieces.Model.parse(Path(TOKENIZER).read_bytes())
    words = ["thstion", "ofonleer", "erhrwo", "слово", "keitbeung"]
    signs = ["", ".", ",", "!!", "***", ")", ".\n", "7", "数据", "🙂"]
    text = " ".join(w + s + v for w in words for s in signs for v in words)
    assert model.encode(text) == library.encode(text) and model.decode(model.encode(text)) == text
    # a word at the beginning, a word behind a sign, two words with nothing between, and the signs
    assert len(model.units) <= 2 * len(words) + len(words) ** 2 + 12


def test_pieces_cut_only_where_no_piece_crosses():
    own = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -1.0, "▁a": -1.5, "1": -2.0, "b1": -1.2, ".": -2.2, "..": -2.3}
    for kind in (pieces.UNIGRAM, pieces.BPE):
        model = pieces.Model([("<unk>", 0.0, pieces.UNKNOWN), *((p, s, pieces.NORMAL) for p, s in own.items())], kind)
        assert model.cut.findall(model.normalise("ab1..ba  é.▁")) == [" ab1", "..", "ba", " é", ".", " "] and model.cut.findall("   ") == ["   "]
    assert [model.pieces[i][0] for i in model.encode("ab1..b1é b")] == ["▁", "ab", "1", "..", "b1", "<unk>", "▁", "b"]


# licences


def test_licenses(spark):
    long = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"
    rows = [(1, "Text. Released under the MIT License. All rights reserved."), (2, None), (3, ""), (4, "x " * 3000 + long), (5, "Licensed under CC BY-NC 4.0."), (6, "mit dem license"), (7, "General Public  LICENSE cc-by cc by"), (7, "none")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("labels", F.lit(1))
    got = sorted(((r.doc_id, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.scan(d).collect()), key=str)
    assert got == sorted(
        [(1, 1, 6, 6, "reserved", "mit,reserved", 1.0), (2, 0, None, None, "", "", 0.0), (3, 0, None, None, "", "", 0.0), (4, 0, None, None, "", "mit", 1.0), (5, 1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0", 1.0), (6, 0, None, None, "", "", 0.0), (7, 3, 0, 5, "cc-by,gpl", "cc-by,gpl", 0.5), (7, 0, None, None, "", "", 0.0)],
        key=str,
    )
    assert licenses.scan(d.limit(0)).count() == 0


def test_licenses_are_placed_as_by_brute_force(spark):
    rng = random.Random(11)
    bsd, isc = next(t.text for t in licenses.TEMPLATES if t.label == "bsd"), next(t.text for t in licenses.TEMPLATES if t.label == "isc")
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in licenses._words(t.text)})
    texts = [f"{bsd}. {isc}. Released under the MIT License.", "the of to " * 400 + "Licensed under CC BY 4.0.", "under the MIT License.", "Released under the MIT"]
    for _ in range(60):
        parts = [[w for w in licenses._words(rng.choice(licenses.TEMPLATES).text) if rng.random() < 0.97] for _ in range(rng.randint(1, 5))]
        texts.append(" ".join(w if rng.random() < 0.95 else rng.choice(vocabulary) for part in parts for w in part))
    slack = licenses.KEY_SLACK
    common = ["released under the mit license"] * 300
    d = spark.createDataFrame([*enumerate(texts), *((1000 + i, t) for i, t in enumerate(common))], "doc_id long, text string").coalesce(2)
    got = {r.doc_id: [(p.label, p.first_word, p.n_words, p.share) for p in r.placements] for r in licenses.scan(d).collect()}
    for i, text in enumerate(texts):
        own, want = licenses._words(text), []
        for t in licenses.TEMPLATES:
            body = licenses._words(t.text)
            for start in range(-len(body), len(own)):
                lo, hi = max(0, start), min(len(own), start + len(body))
                share = sum(own[j] == body[j - start] for j in range(lo, hi)) / len(body)
                if share >= licenses.LEAST_COVERAGE and all(f" {' '.join(licenses._words(k))} " in f" {' '.join(own[max(0, lo - slack):hi + slack])} " for k in t.keys):
                    want.append((t.label, lo, hi - lo, share))
        assert got[i] == want, text
    assert {p[0] for p in got[0]} == {"bsd", "isc", "mit"}


@pytest.mark.parametrize(
    ("label", "text"),
    [
        ("mit", 'MIT License\n\nCopyright (c) 2020 A. Author\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software'),
        ("gpl-2.0", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version."),
        ("gpl-3.0", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
        ("lgpl-2.1", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."),
        ("agpl-3.0", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published\nby the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
        ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above"),
    ],
)
def test_licenses_in_their_own_words(spark, label, text):
    d = spark.createDataFrame([(1, "words before " + text)], "doc_id long, text string")
    labels = licenses.scan(d).first().labels.split(",")
    assert label in labels and set(labels) <= {label, "gpl"}


# URLs


def test_urls(spark):
    rows = [(1, "http://A.Example.ORG/es/1?x=/en/"), (2, "https://example.org/en/12"), (3, "http://x.com/fr/"), (4, "http://x.com/de/9#a"), (5, None), (6, "no scheme"), (7, "http://org"), (8, "ftp://x.net/a?b=1&c=2"), (8, "ftp://x.net/a?b=1&c=2"), (9, "http://notexample.org/es/")]
    d = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("verdict", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(d, URL_RULES).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[2][2:] == ("example.org/en/1", "block")
    assert got[3][2:] == ("com/fr/", "allow") and got[4][:3] == ("x.com", "/de/9", "com/de/") and got[9][2:] == ("org/", "allow")
    assert got[5][:3] == got[6][:3] == ("", "", None) and got[7][:3] == ("org", "", None) and got[8][:3] == ("x.net", "/a", None)
    assert all(v[3] in ("allow", "block") for v in got.values())
    assert url_filter.judge(d.limit(0), URL_RULES).count() == 0 and url_filter.judge(d.where("page_id = 5"), URL_RULES).first().verdict == "allow"


# WARC


def test_warc(spark):
    rows = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, None), (4, "http://c/", ""), (5, "http://d/", "é" * 100_000), (6, None, "WARC/1.1\r\n\r\n\r\n\r\n")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit(1))
    got = {r.page_id: r for r in warc.round_trip(d).collect()}
    digest = lambda s: base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
    assert all((got[i].payload_bytes, got[i].payload_digest) == (len((h or "").encode()), digest(h)) for i, _, h in rows)
    assert [(i, got[i].record_type, got[i].refers_to) for i in range(1, 7)] == [(1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None), (5, "response", None), (6, "response", None)]
    assert warc.round_trip(d.limit(0)).count() == 0


def test_warc_of_repeated_and_missing_ids(spark):
    rows = [(1, "u", "A"), (1, "u", "B"), (2, "u", "A"), (3, "u", "B"), (None, "u", "A"), (None, "v", "C"), (7, "w", "D"), (7, "w", "D")]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got) == [
        (0, "response", 0), (0, "revisit", 2), (1, "revisit", 2), (1, "revisit", 3), (2, "response", 0), (3, "response", 0), (7, "response", 0), (7, "response", 0)
    ]


def test_warc_reader_reports_damage():
    good = warc.record("response", 1, "u", b"payload") + warc.record("response", 2, "u", b"more")
    assert [r.error for r in warc.read([good[i : i + 7] for i in range(0, len(good), 7)])] == [None, None]
    assert list(warc.read([good[:-5]]))[-1].error
    header, rest = zlib.decompressobj(31), good
    text = header.decompress(rest).replace(b"payload", b"paylaod")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    assert "digest" in list(warc.read([packer.compress(text) + packer.flush()]))[0].error


# language model


def test_language_model(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["the", "Cat", "sat", "on", "mat", f"r{rng.randrange(50)}"]) for _ in range(30))) for i in range(120)]
    unseen = next(i for i in range(600, 700) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows += [(500, None), (501, ""), (unseen, "é" * 3000), (unseen, "zzz")]
    got = collections.defaultdict(list)
    for r in language_model.score(spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1))).collect():
        got[r.doc_id].append(r)
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + [0]
    learnt = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    count = collections.Counter(w for t in learnt for w in tokens(t))
    n, v = sum(count.values()), len(count)
    for i, t in rows[:122]:
        r = got[i][0]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)))
        assert r.score <= 0
    assert len(got[unseen]) == 2 and got[unseen][0].held_out
    seen, strange = got[0][0].score / len(rows[0][1]), min(got[unseen], key=lambda r: r.score).score / 6000
    assert seen > strange
    assert language_model.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_trie_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([("abracadabra",), ("abba",), ("bab ac",)], "text string")
    grams = language_model.counts(texts).where("kind = 1")
    total = grams.agg(F.sum("n")).first()[0]
    trie = language_model.Trie.build(language_model._nodes(grams, total))
    for context in (b"\n\n\n\n", b"\n\n\na", b"abra", b"xyza", b"zzzz", b"acad"):
        base = int.from_bytes(context, "big") << 8
        assert math.isclose((10 ** trie.log10(base + np.arange(256))).sum(), 1, rel_tol=1e-9)


def ppm(texts, asked):
    """log10 of each asked text's probability, by definition, after (text, times)."""
    count = [collections.defaultdict(collections.Counter) for _ in range(5)]
    padded = lambda t: b"\n" * 4 + t.encode() + b"\xff"
    for text, times in texts:
        t = padded(text)
        for i in range(4, len(t)):
            for k in range(5):
                count[k][t[i - k : i]][t[i]] += times
    out = []
    for text in asked:
        t, total = padded(text), 0.0
        for i in range(4, len(t)):
            excluded = set()
            for k in range(4, -1, -1):
                own = {s: n for s, n in count[k].get(t[i - k : i], {}).items() if s not in excluded}
                if t[i - k : i] not in count[k]:
                    continue
                escape = max(1, len(own))
                if t[i] in own:
                    total += math.log10(own[t[i]] / (sum(own.values()) + escape))
                    break
                total += math.log10(escape / (sum(own.values()) + escape))
                excluded |= set(own)
            else:
                total -= math.log10(max(1, 256 - len(excluded)))
        out.append(total)
    return out


@pytest.mark.parametrize("held", [None, 0, 40])
def test_scores_keep_rare_contexts_of_a_large_corpus(spark, monkeypatch, held):
    if held is not None:
        monkeypatch.setattr(language_model, "HELD_WINDOWS", held)
    rng = random.Random(8)
    out = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    common = " ".join(rng.choice(["stone", "river", "hill", "road"]) for _ in range(500))
    small = [" ".join(rng.choice(["žluť", "kůň", "pěl", "ódy", "vlk"]) for _ in range(12)) for _ in range(6)]
    learnt = [i for i in range(3000) if not out(i)][: 800 + len(small)]
    asked = [i for i in range(3000) if out(i)][:4]
    texts = ["žluť vlk", "pěl ódy kůň road", "xyz žlu", ""]
    rows = [*zip(learnt, [common] * 800 + small), *zip(asked, texts)]
    got = {r.doc_id: r.score for r in language_model.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(common) * 800 > 2 << 20
    want = ppm([(common, 800), *((t, 1) for t in small)], texts + small + [common])
    for i, w in zip(asked + learnt[800:] + learnt[:1], want, strict=True):
        assert math.isclose(got[i], w, rel_tol=1e-9), i


# HTML


def test_html(spark):
    page = lambda body: f"<html><body><nav><a href=/>Home</a></nav><div class='sidebar-2'>Links</div>{body}<footer>f</footer></body></html>"
    article = "<div class='post post-{}'><h1>Title &amp; more</h1><p>First paragraph, long enough to be the main text of a page.<p>Second  one\n with <b>bold</b> and a<br>break.<script>var t='</p>';</script><div class=comments>I disagree with all of it, and at length, for ever.</div></div>"
    rows = [(i, "http://h.org/1", page(article.format(i))) for i in range(3)] + [(7, None, None), (8, "http://h.org/2", ""), (9, "x", "<p>Un<i>clo</i>sed &#233; &nbsp; text<p hidden>no<!-- <p>no --><form>no</form>"), (9, "x", "plain < text")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit(1))
    got = html_text.main_text(d).collect()
    want = "Title & more\nFirst paragraph, long enough to be the main text of a page.\nSecond one with bold and a\nbreak."
    assert [r.text for r in got if r.page_id < 3] == [want] * 3 and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (7, 8)} == {""}
    assert sorted(r.text for r in got if r.page_id == 9) == ["Unclosed é text", "plain < text"]
    deep = "<div>" * 3000 + "deep text" + "</div>" * 3000
    assert html_text.text_at(html_text.parse(deep), None) == "deep text"
    assert html_text.main_text(d.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<a " * 300_000, '<a "' * 200_000, '<a b="x ' * 100_000, "<div>" * 3000 + "</b>" * 100_000, "<script>" + "</script " * 100_000, "<!-- " * 100_000, "<div>" * 50_000 + "x" * 40])
def test_html_of_broken_markup_takes_linear_time(page):
    began = time.monotonic()
    html_text.text_at(html_text.parse(page), None)
    assert time.monotonic() - began < 20


def test_html_keeps_headlines_and_halves(spark):
    half = "<p>{} half of the article, which runs on for quite a while and says what there is to say.</p>"
    page = f"<body><h1>Headline {{}}</h1><div class=first>{half.format('One')}</div><div class=second>{half.format('Another')}</div></body>"
    rows = [(i, "http://h/", page.format(i)) for i in range(4)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2].split("\n") == ["Headline 2", *(re.sub("<.*?>", "", half.format(x)) for x in ("One", "Another"))]


def test_consensus_overrules_a_page(spark):
    normal = "<body><div class=story><p>{}</p></div><div class=extra><p>tiny</p></div></body>"
    odd = "<body><div class=story><p>The short story of this page.</p></div><div class=extra><p>" + "A very long other part that isn't the story. " * 9 + "</p></div></body>"
    rows = [(i, "http://h/", normal.format("A story of some length that differs by page " * 3 + str(i))) for i in range(5)] + [(9, "http://h/", odd)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "The short story of this page."
