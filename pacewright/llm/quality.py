"""Quality rules by robust multivariate outliers, in Spark's own functions only.

Every text gives a vector of transformed statistics. For each language and source a
minimum-covariance-determinant estimate is found by concentration steps: from medians and absolute
deviations, then again and again the mean and covariance of the share of rows that lie nearest to
the last estimate. Documents whose Mahalanobis distance from their group's estimate is beyond a
cut-off are rejected. All sums are of integers and all ranks of binned distances, so a result
depends neither on the number of partitions nor on the order of rows, and a group of any size is
only ever aggregated, never gathered.
"""

from __future__ import annotations

from math import erf, exp, gamma, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewright.llm.scratch import Scratch
from pacewright.llm.words import space_words

LEAST_WORDS, MOST_REPEATED = 50, 50
#: name -> (SQL over the statistics, least standard deviation); values are kept in units of 1/UNIT.
FEATURES = {
    "length": ("ln(cast(word_chars as double) / n_words)", 0.10),
    "symbols": ("ln(1 + 100.0 * n_symbols / n_words)", 0.30),
    "repeated": ("sqrt(cast(n_repeat_words as double) / n_words)", 0.12),
    "lines": ("sqrt(cast(n_dup_lines as double) / greatest(n_lines, 1))", 0.15),
    "capitals": ("sqrt(cast(n_capitals as double) / word_chars)", 0.08),
}
UNIT = 10_000
#: Rows of the h-subset, concentration steps, rows below which a group is pooled with others.
SUBSET, STEPS, LEAST_ROWS = 0.75, 4, 60
#: Bins to an octave of squared distance.
BINS = 32


def chi_square(x: float, degrees: int) -> float:
    """The distribution function of a chi-square."""
    k, p = (1, erf(sqrt(x / 2))) if degrees % 2 else (2, 1 - exp(-x / 2))
    while k < degrees:
        p -= (x / 2) ** (k / 2) * exp(-x / 2) / gamma(k / 2 + 1)
        k += 2
    return p


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, degrees) < p else (low, mid)
    return low


#: The share of normal rows beyond the cut-off on the squared distance.
REJECTED = 1e-9
CUTOFF = chi_square_quantile(1 - REJECTED, len(FEATURES))
#: The covariance of the nearest SUBSET of normal rows is too small by this factor.
CONSISTENCY = SUBSET / chi_square(chi_square_quantile(SUBSET, len(FEATURES)), len(FEATURES) + 2)
#: Groups up to which their estimates are sent to every executor (about 300 bytes each).
BROADCAST_GROUPS = 100_000

_P = range(len(FEATURES))
_XS = ", ".join(f"x{i}" for i in _P)


def statistics(docs: DataFrame) -> DataFrame:
    """The given columns of ``docs`` (all but the text) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals."""
    text = F.coalesce("text", F.lit(""))
    keep = [c for c in docs.columns if c != "text"]
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    d = docs.select(*keep, space_words(F.col("text")).alias("_w"), lines.alias("_l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).alias("_s"), F.regexp_count(text, F.lit("\\p{Lu}")).alias("_c"))
    window = lambda i: F.struct(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i"))
    windows = F.when(F.size("_w") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size("_w") - 3), window)))
    d = d.withColumn("_t", F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>")))
    twice = F.filter("_t", lambda x, i: x.h.eqNullSafe(F.get("_t", i - 1).h) | x.h.eqNullSafe(F.get("_t", i + 1).h))
    d = d.withColumn("_r", F.sort_array(F.transform(twice, lambda x: x.i)))
    covered = F.aggregate(F.transform("_r", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_r", i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return d.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.col("_s").cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.col("_c").cast("long").alias("n_capitals"),
    )


BASE_FAILED = f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words"
#: The steps below are SQL that Spark and the test engine both read; {names} are earlier tables.
VECTORS = "select *, " + ", ".join(f"cast(floor({UNIT} * {sql} + 0.5) as bigint) as x{i}" for i, (sql, _) in enumerate(FEATURES.values())) + f" from {{stats}} where not ({BASE_FAILED})"
#: Where each language and source takes its estimate from: its own rows, its language's, or all.
GROUPS = f"""
select gl, gs, case when n >= {LEAST_ROWS} or nl >= {LEAST_ROWS} then gl else '*' end as pl,
  case when n >= {LEAST_ROWS} then gs else '*' end as ps
from (select gl, gs, n, sum(n) over (partition by gl) as nl
      from (select gl, gs, count(*) as n from {{vectors}} group by gl, gs) a) b"""
ROWS = f"select pl, ps, {_XS} from (" + " union all ".join(f"select {keys}, {_XS} from {{vectors}}" for keys in ("gl as pl, gs as ps", "gl as pl, '*' as ps", "'*' as pl, '*' as ps")) + ") v join (select distinct pl, ps from {groups}) g using (pl, ps)"
MIDDLE = "select pl, ps, count(*) as n, " + ", ".join(f"percentile_disc(0.5) within group (order by x{i} - x{i} % 100) as m{i}" for i in _P) + " from {rows} group by pl, ps"
SPREAD = "select pl, ps, " + ", ".join(f"percentile_disc(0.5) within group (order by abs(x{i} - m{i}) - abs(x{i} - m{i}) % 100) as s{i}" for i in _P) + " from {rows} join {middle} using (pl, ps) group by pl, ps"
_FLOOR = [UNIT * least for _, least in FEATURES.values()]
#: Two starts, both at the medians with a diagonal covariance: of the absolute deviations, and of the least
#: variances alone. l<i><j> is the Cholesky factor's entry.
FIRST = " union all ".join(
    f"select pl, ps, {start} as st, " + ", ".join(f"cast(m{i} as double) as c{i}" for i in _P) + ", "
    + ", ".join((f"sqrt(1.4826 * s{i} * 1.4826 * s{i} + {_FLOOR[i] ** 2!r})" if start == 0 else f"cast({_FLOOR[i]!r} as double)") + f" as l{i}{i}" for i in _P)
    + "".join(f", cast(0 as double) as l{i}{j}" for i in _P for j in range(i))
    + " from {middle} join {spread} using (pl, ps)"
    for start in range(2)
)


def _distance(source: str, keep: str) -> str:
    """SQL for d2, the squared distance of each row of ``source`` from its group's estimate, by forward substitution."""
    inner, outer = f"select *, (x0 - c0) / l00 as y0 from {source}", ""
    for i in list(_P)[1:]:
        inner = f"select *, (x{i} - c{i}" + "".join(f" - l{i}{j} * y{j}" for j in range(i)) + f") / l{i}{i} as y{i} from ({inner}) q{i}"
    return f"select {keep}, " + " + ".join(f"y{i} * y{i}" for i in _P) + f" as d2 from ({inner}) q"


_BIN = f"cast(floor({BINS} * ln(1 + d2) / ln(cast(2 as double))) as bigint)"
DISTANCES = f"select pl, ps, st, {_XS}, {_BIN} as bin from (" + _distance("{rows} join {estimate} using (pl, ps)", f"pl, ps, st, {_XS}") + ") z"
RANKS = f"select pl, ps, st, percentile_disc({SUBSET}) within group (order by bin) as h from {{distances}} group by pl, ps, st"
_SUM = "cast(sum(cast({} as decimal(20,0))) as double)"
MOMENTS = (
    "select pl, ps, st, cast(count(*) as double) as k, " + ", ".join(_SUM.format(f"x{i}") + f" as t{i}" for i in _P) + ", "
    + ", ".join(_SUM.format(f"x{i} * x{j}") + f" as t{i}{j}" for i in _P for j in range(i + 1)) + " from {distances} join {ranks} using (pl, ps, st) where bin <= h group by pl, ps, st"
)


def _estimate() -> str:
    """SQL for the next estimate: mean, and the Cholesky factor of the consistent covariance with the least variances added."""
    sql = "select pl, ps, st, " + ", ".join(f"t{i} / k as c{i}" for i in _P) + ", "
    sql += ", ".join(f"{CONSISTENCY!r} * (t{i}{j} / k - (t{i} / k) * (t{j} / k))" + (f" + {_FLOOR[i] ** 2!r}" if i == j else "") + f" as v{i}{j}" for i in _P for j in range(i + 1)) + " from {moments}"
    for i in _P:
        for j in range(i + 1):
            rest = f"v{i}{j}" + "".join(f" - l{i}{m} * l{j}{m}" for m in range(j))
            entry = f"sqrt(greatest({rest}, {_FLOOR[i] ** 2 / 100!r}))" if i == j else f"({rest}) / l{j}{j}"
            sql = f"select *, {entry} as l{i}{j} from ({sql}) e{i}{j}"
    return sql


ESTIMATE = _estimate()
#: Of a group's estimates the one with the least determinant; none for groups that are too small even pooled.
LAST = (
    "select * from (select e.*, row_number() over (partition by pl, ps order by " + " * ".join(f"l{i}{i}" for i in _P)
    + f", st) as choice from {{estimate}} e join {{middle}} m using (pl, ps) where m.n >= {LEAST_ROWS}) c where choice = 1"
)
PLACED = f"select *, ({BASE_FAILED}) as base_failed, " + ", ".join(f"case when n_words > 0 then cast(floor({UNIT} * {sql} + 0.5) as bigint) end as x{i}" for i, (sql, _) in enumerate(FEATURES.values())) + " from {stats}"
COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def verdicts(*columns: str, cutoff: float = CUTOFF) -> str:
    """SQL for the given columns of {placed} with the squared distance (null where there is no estimate) and kept."""
    return f"select {', '.join((*columns, *COUNTED))}, d2 as distance, not base_failed and coalesce(d2 <= {cutoff!r}, true) as kept from (" + _distance("{placed}", ", ".join((*columns, *COUNTED))) + ") z"


def _run(sql: str, **tables: DataFrame) -> DataFrame:
    return next(iter(tables.values())).sparkSession.sql(sql, **tables)


def _judged(docs: DataFrame, columns: tuple[str, ...], cutoff: float) -> DataFrame:
    """The given columns of ``docs``, which has text, lang and source, with the statistics, distance and kept."""
    scratch = Scratch(docs.sparkSession)
    stats = statistics(docs)
    stats = scratch.save(stats.withColumn("gl", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("?"))).withColumn("gs", F.coalesce(F.concat(F.lit("="), "source"), F.lit("?"))))
    vectors = _run(VECTORS, stats=stats.drop("row"))
    groups = scratch.save(_run(GROUPS, vectors=vectors))
    small = groups.count() <= BROADCAST_GROUPS
    hint = F.broadcast if small else lambda x: x
    rows = scratch.save(_run(ROWS, vectors=vectors, groups=groups))
    middle = scratch.save(_run(MIDDLE, rows=rows))
    estimate = scratch.save(_run(FIRST, middle=middle, spread=_run(SPREAD, rows=rows, middle=hint(middle))))
    for _ in range(STEPS):
        distances = scratch.save(_run(DISTANCES, rows=rows, estimate=hint(estimate)))
        moments = _run(MOMENTS, distances=distances, ranks=hint(_run(RANKS, distances=distances)))
        estimate = scratch.save(_run(ESTIMATE, moments=moments))
        scratch.drop(distances)
    last = scratch.save(_run(LAST, estimate=estimate, middle=middle))
    placed = _run(PLACED, stats=stats).join(hint(groups), ["gl", "gs"], "left").join(hint(last), ["pl", "ps"], "left")
    return _run(verdicts(*columns, cutoff=cutoff), placed=placed)


def quality(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, lang, source, the statistics, base_failed, distance (squared), kept of every document.

    Null texts are empty. Null languages or sources form a group of their own. Groups of fewer than
    ``LEAST_ROWS`` rows that pass the base rules use the estimate of all rows of their language, else of
    all rows; where even those are too few, only the base rules decide. Equal rows count each. An empty table
    gives an empty result; other columns are ignored. Whole texts are counted: a text and arrays of its
    words and word windows (about 40 bytes a word) must fit in a task.
    """
    return _judged(docs.select("doc_id", "text", "lang", "source"), ("doc_id", "lang", "source"), cutoff)


def without_poor(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows that ``quality`` keeps, with all their columns; rows go beside their statistics, so none is joined back."""
    rows = docs.select("text", "lang", "source", F.struct(*docs.columns).alias("row"))
    return _judged(rows, ("row",), cutoff).where("kept").select("row.*")
