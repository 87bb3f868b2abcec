"""URL filters: host and path rules, and gradient-boosted trees on lexical features for the rest.

URLs on which a rule fits are the labelled ones. Trees are grown on a bounded sample of them from
length, depth, digit ratio, character entropy, parameter counts and statistics of the host's suffix,
which are aggregated over all URLs. Columns and Spark's own tree learner only.
"""

from __future__ import annotations


from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewright.llm.scratch import Scratch

ALLOW, BLOCK = "allow", "block"
#: Labelled URLs that trees are grown on, the first in hash order; trees and their depth.
TRAINING_ROWS, TREES, DEPTH = 20_000, 20, 3
#: Rows of prior weight in a suffix's block share; suffixes up to which the statistics are broadcast.
PRIOR_ROWS, BROADCAST_SUFFIXES = 20.0, 100_000
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters", "query_length", "secure", "suffix_share", "suffix_log_count")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits; rules are host and path prefix in one, some dozens at most."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, "(?s)\\?([^#]*)", 1)
    count = lambda where, what: (F.length(where) - F.length(F.replace(where, F.lit(what), F.lit("")))).cast("double")
    shares = F.transform(F.array_distinct(F.split(url, "")), lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n)
    entropy = F.aggregate(F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))
    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": count(path, "/"),
        "labels": count(host, "."),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / n,
        "hyphens": count(host, "-"),
        "entropy": entropy,
        "parameters": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
        "query_length": F.length(query).cast("double"),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
    }


def _with_suffixes(d: DataFrame, suffixes: DataFrame, n_suffixes: int, n_rows: int) -> DataFrame:
    """``d`` with the counts of its suffix: frequent suffixes (a bounded number, by arithmetic) are broadcast, only rows of rare ones are shuffled."""
    if n_suffixes <= BROADCAST_SUFFIXES:
        return d.join(F.broadcast(suffixes), "suffix")
    frequent = F.col("n") * BROADCAST_SUFFIXES >= n_rows
    d = d.join(F.broadcast(suffixes.where(frequent)), "suffix", "left")
    rare = d.where("n is null").drop("n", "m", "b").join(suffixes.where(~frequent), "suffix")
    return d.where("n is not null").unionByName(rare)


def judge(pages: DataFrame, rules: list[tuple[str, str]], rows: int = TRAINING_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, probability (of a block, by the trees) of every row.

    Where no rule fits, the trees decide. If the labelled URLs are of one kind, all others get that
    verdict, and ``allow`` if there are none. A null url has an empty host and path; repeated rows are
    each judged; an empty table gives an empty result; other columns are ignored. Whole URLs are measured,
    however long. Where more are labelled than trees are grown on, those first in order of their hash (equal
    ones by page_id) are taken.
    """
    scratch = Scratch(pages.sparkSession)
    host, path = parts(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    d = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    d = d.withColumns({"rule": rule, "said": verdict, "suffix": F.regexp_extract("host", "[^.]*$", 0)})
    d = scratch.save(d.withColumns(_features(F.col("url"), F.col("host"), F.col("path"))))
    block = (F.col("said") == BLOCK).cast("double")
    suffixes = d.groupBy("suffix").agg(F.count("*").alias("n"), F.count("said").alias("m"), F.coalesce(F.sum(block), F.lit(0.0)).alias("b"))
    suffixes = scratch.save(suffixes)
    total = suffixes.agg(F.sum("m").alias("m"), F.sum("b").alias("b"), F.sum("n").alias("n"), F.count("*").alias("k")).first()
    labelled, blocked = total.m or 0, total.b or 0.0
    if blocked in (0.0, float(labelled)):
        rest = BLOCK if blocked else ALLOW
        return d.select("page_id", "host", "path", "rule", F.coalesce("said", F.lit(rest)).alias("verdict"), F.lit(float(rest == BLOCK)).alias("probability"))
    d = _with_suffixes(d, suffixes, total.k, total.n)
    # a labelled URL's own label isn't part of its feature
    rest_blocked, rest_labelled = F.col("b") - F.coalesce(block, F.lit(0.0)), F.col("m") - F.col("said").isNotNull().cast("int")
    share = (rest_blocked + PRIOR_ROWS * blocked / labelled) / (rest_labelled + PRIOR_ROWS)
    d = d.withColumns({"suffix_share": share, "suffix_log_count": F.log10(F.col("n") + 1.0)})
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    sample = d.where("said is not null").orderBy(F.xxhash64("url"), "page_id").limit(rows)
    sample = scratch.save(sample.select(block.alias("label"), *FEATURES))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=0).fit(vector.transform(sample))
    out = trees.transform(vector.transform(d))
    probability = F.element_at(vector_to_array(F.col("probability")), 2)
    said = F.coalesce("said", F.when(probability >= 0.5, BLOCK).otherwise(ALLOW))
    return out.select("page_id", "host", "path", "rule", said.alias("verdict"), probability.alias("probability"))
