"""Prefix counts, alignment and fill-in-the-middle against the libraries and plain definitions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pacewright.llm import alignment, middle_fill, prefix_counts
from pacewright.llm.queries import vocabulary

JSON, MODEL = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
DOCS = "doc_id long, text string"
FRAGMENTS = ["  ", "\n", " ", "\n\n", "\t", "\r\n", "\xa0", "　", "'re", "'ll", "'", "don't", "they've", " 's", "<|endoftext|>", "<|endof", "|>", "12", "3", " hello", "wörld", "日本語", "😀", "!!", "...", "a", "aaaaaaa", "-----", "ŉ", "Ո", "ՠ", "x", "<0x41>", "<s>", "\x1c", "\x85"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(FRAGMENTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


# prefix counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def by_library(library, text):
    return [len(e.ids) for e in library.encode_batch([text[:n] for n in range(len(text) + 1)], add_special_tokens=False)]


def test_every_prefix_counts_as_the_library_counts_it(library):
    counter = prefix_counts.counter(open(JSON, encoding="utf-8").read())
    for text in texts(250, 5):
        assert [0, *(int(n) for run in counter.counts(text) for n in run)] == by_library(library, text), repr(text)


def test_white_space_and_words_are_the_library_s(library):
    cut = library.pre_tokenizer.pre_tokenize_str
    chars = [chr(c) for c in range(0x3100)]
    white = [c for c in chars if [o for _, o in cut(f"!{c}!")] != [(0, 3)] and [o for _, o in cut(f"a{c}1")] not in ([(0, 2), (2, 3)], [(0, 1), (1, 3)])]
    by_pattern = [c for c in chars if re.fullmatch(f"[{prefix_counts.WHITE}]", c)]
    assert [c for c in white if c not in " "] == [c for c in by_pattern if c != " "]
    for c in chars:
        if c < prefix_counts.STABLE and c not in by_pattern:
            for s in (f"a{c}1", f"1{c}a!", f" {c}{c}", f"!{c}'s"):
                assert prefix_counts._WORD.findall(s) == [s[a:b] for _, (a, b) in cut(s)], repr(s)


def test_long_and_repetitive_texts_in_blocks(spark, library):
    rng = random.Random(3)
    junk = "".join(rng.choice("abcdefghij") for _ in range(70_000))
    long = " ".join(rng.choice(["alpha", "beta", "don't", "日本"]) for _ in range(40_000))
    rows = [(1, "ha " * 30_000), (2, "=" * 20_000), (3, junk), (4, long)]
    found = prefix_counts.prefix_counts(spark.createDataFrame(rows, DOCS), JSON)
    whole = {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in rows}
    assert {r.doc_id: r.n_tokens for r in prefix_counts.totals(found, 512).collect()} == whole
    by_doc = {}
    for r in found.orderBy("doc_id", "block").collect():
        assert r.block * prefix_counts.BLOCK == len(by_doc.setdefault(r.doc_id, []))
        by_doc[r.doc_id] += r.counts
    assert {d: len(c) - 1 for d, c in by_doc.items()} == {d: len(t) for d, t in rows}
    for d, t in rows:
        for n in (1, 2, 65_535, 65_536, 65_537, len(t) // 2):
            if n <= len(t):
                assert by_doc[d][n] == len(library.encode(t[:n], add_special_tokens=False).ids)


def test_edges_and_questions(spark, library):
    own = ["one two  three", "x<|endoftext|>y", "they're", "they're"]
    rows = [(1, None), (2, ""), (3, own[0]), (4, own[1]), (5, own[2]), (5, own[3]), (None, "no id")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("block", F.lit(1))
    found = prefix_counts.prefix_counts(docs, JSON)
    got = Counter(tuple(r) for r in prefix_counts.totals(found, 3).collect())
    want = Counter((d, len((t or "").encode()), len(library.encode(t or "").ids), len(library.encode(t or "").ids) > 3) for d, t in rows)
    assert got == want
    asked = spark.createDataFrame([(3, 0), (3, 5), (3, 9), (3, 14), (3, 15), (3, -1), (4, 8), (5, 6), (9, 0), (None, 1)], "doc_id long, n_chars int")
    answers = sorted((r.doc_id, r.n_chars, r.n_tokens) for r in prefix_counts.counts_at(found, asked).collect())
    n = lambda t: len(library.encode(t).ids)
    assert answers == [(3, 0, 0), *((3, k, n(own[0][:k])) for k in (5, 9, 14)), (4, 8, n(own[1][:8])), *2 * [(5, 6, n(own[2][:6]))]]
    for budget in (-1, 0, 1, 2, 3, 50):
        best = Counter((r.doc_id, r.n_chars, r.n_tokens) for r in prefix_counts.longest_within(found, budget).collect())
        want = Counter()
        for d, t in rows:
            fits = [(k, c) for k, c in enumerate(by_library(library, t or "")) if c <= budget]
            want.update([(d, *fits[-1])] if fits else [])
        assert best == want, budget
    assert prefix_counts.prefix_counts(spark.createDataFrame([], DOCS), JSON).count() == 0


# alignment


def by_definition(rows):
    a_of, b_of = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a_of.encode_special_tokens = True
    piece = {i: p for p, i in a_of.get_vocab().items()}
    letters = prefix_counts._bytes_of_letters()
    links, per = Counter(), []
    for d, text in rows:
        a = a_of.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in piece[i]) for i in a]
        bytes_b = [bytes([int(b_of.id_to_piece(i)[3:5], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == f" {text}".encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = ({int(e): k for k, e in enumerate(np.cumsum([len(x) for x in own]))} for own in (bytes_a, bytes_b))
        groups, own, i, j = [], [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            x, y = ends_a[end] + 1, ends_b[end] + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            own.append((a[x - 1], b[y - 1]))
            i, j = x, y
        links.update(own)
        per.append((d, len(a), len(b), groups, own))
    most = {}
    for (_, b), n in links.items():
        most[b] = max(most.get(b, 0), n)
    return Counter((d, na, nb, len(g), len(own), sum(links[x] == most[x[1]] for x in own), sum(links[x] for x in own), ";".join(g)) for d, na, nb, g, own in per), links, most


def test_alignment_is_the_definition_s(spark):
    rows = [(n, t) for n, t in enumerate(texts(300, 8))] + [(7, "x▁y abc"), (7, None), (8, ""), (None, " "), (9, "a" * 3000), (9, "tail\n \n"), (10, "same text here"), (10, "same text here"), (11, "only▁bad words here"), (12, "word " * 20_000), (13, "<|endoftext|> <s> </s> <unk> <0x41>")]
    docs = spark.createDataFrame(rows, DOCS).repartition(40).withColumn("n_a", F.lit("clash")).withColumn("groups", F.lit(1)).withColumn("node", F.lit(1))
    want, links, most = by_definition(rows)
    assert Counter(tuple(r) for r in alignment.align(docs, JSON, MODEL).collect()) == want
    found = alignment.pair_counts(docs, JSON, MODEL).collect()
    assert {(r.a, r.b): r.n for r in found} == links
    assert all(r.best == (r.n == most[r.b]) for r in found)


def by_one(text):
    ((row, _),) = by_definition([(0, text)])[0].items()
    return row[7]


def test_alignment_forgets_units_and_starts_anew(spark):
    """Small memories and slices change nothing; there is no link outside the vocabularies' bound."""
    model, spec = open(MODEL, "rb").read(), open(JSON, encoding="utf-8").read()
    units = alignment.Units(alignment._vocabularies(spec, model), True)
    rows = texts(200, 9)
    first = [";".join(units.groups[i] for i in own) for own in units.of_texts(rows)]
    again = []
    for text in rows:
        (own,) = units.of_texts([text])
        again.append(";".join(units.groups[i] for i in own))
        units.clear()
    assert first == again
    rng = random.Random(1)
    for _ in range(20):
        some = [*rng.sample(rows, 10), "x▁y", "ends in a space ", "z "]
        rng.shuffle(some)
        units.clear()
        assert [";".join(units.groups[i] for i in own) for own in units.of_texts(some)] == [by_one(t) for t in some]
    assert len(by_definition(list(enumerate(rows)))[1]) <= units.vocabularies.most_pairs() < 10**6


def test_the_quicker_library_gives_the_same_ids(library):
    spec, model = open(JSON, encoding="utf-8").read(), open(MODEL, "rb").read()
    assert alignment.in_merge_order(spec)
    quick, own = alignment.Vocabularies(spec, model, True), alignment.Vocabularies(spec, model, False)
    chars = [chr(c) for c in range(ord(alignment.STABLE))]
    for c in chars:
        s = f" a{c}1{c}{c}a!{c}!  {c}'s {c} {c}{c}a"
        assert list(quick.quick.encode_ordinary(s)) == own.a.encode(s, add_special_tokens=False).ids, repr(s)
    rng = random.Random(6)
    for text in [*texts(200, 3), *("".join(rng.choice("abcde'stre \n") for _ in range(300)) for _ in range(200))]:
        found, want = quick.encode(f" {text}"), own.encode(f" {text}")
        assert (found is None) == (want is None) and (found is None or all((x == y).all() for x, y in zip(found, want, strict=True)))


def test_alignment_of_nothing(spark):
    assert alignment.align(spark.createDataFrame([], DOCS), JSON, MODEL).count() == 0
    assert [tuple(r) for r in alignment.align(spark.createDataFrame([(1, None)], DOCS), JSON, MODEL).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_perfect_hash_is_minimal_and_verifies():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 48, n))
        found = alignment.PerfectHash(rng.permutation(np.concatenate([keys, keys])))
        assert sorted(found.slots(keys)) == list(range(len(keys)))
        others = np.setdiff1d(rng.integers(0, 1 << 48, 1000), keys)
        assert (found.slots(others) == -1).all()


# fill in the middle


def filled(doc_id, text, seed=42):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n, chars = len(units), (None, None)
    form, output = "plain", text
    if text and not any(m in text for m in middle_fill.MARKERS) and h3 % 100 < 50:
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form, chars = ("spm" if h4 % 100 < 80 else "psm"), (len(p), len(m))
        output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, *chars, output, text


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_middle_fill_is_the_definition_s(spark):
    rows = list(enumerate(texts(300, 4))) + [(n, "wörd and\tmore\n" * n + " " * (n % 3)) for n in range(40)] + [(1, None), (1, "<P> x y"), (2, ""), (None, "no id at all"), (None, "no id at all"), (3, "<M"), (3, "a <S> b"), (4, " \n\t "), (5, "x\x0by\x0cz\x85\xa0q")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("form", F.lit("clash")).withColumn("piece", F.lit(1)).withColumn("h1", F.lit(1)).withColumn("row", F.lit(2))
    want = [filled(*r) for r in rows]
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    got = Counter(tuple(r) for r in middle_fill.digests(docs).collect())
    assert got == Counter((*w[:5], sha(w[5]), sha(w[6])) for w in want)
    outputs = middle_fill.outputs(docs)
    assert Counter(tuple(r) for r in outputs.collect()) == Counter((w[0], w[2], w[5]) for w in want)
    assert Counter(tuple(r) for r in middle_fill.restore(outputs).collect()) == Counter((w[0], w[6]) for w in want)
    assert middle_fill.digests(spark.createDataFrame([], DOCS)).count() == 0


def test_middle_fill_of_long_texts_goes_by_pieces(spark):
    rng = random.Random(2)
    rows = [(n, "".join(rng.choice(["ä" * 70_000, "word ", "\n", "日本 "]) for _ in range(60))) for n in range(12)] + [(20, "x" * 300_000), (21, " " * 200_000), (22, "ha " * 100_000)]
    docs = spark.createDataFrame(rows, DOCS)
    got = Counter(tuple(r) for r in middle_fill.digests(docs).collect())
    assert got == Counter((*w[:5], sha(w[5]), sha(w[6])) for w in (filled(*r) for r in rows))
    sizes = middle_fill.pieces(docs).select(F.max(F.octet_length("piece")), F.count("*")).first()
    assert sizes[0] <= middle_fill.PIECE_BYTES and sizes[1] > 100


def test_middle_fill_moves_text_once(spark):
    plan = middle_fill.digests(spark.createDataFrame([(1, "a b")], DOCS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
