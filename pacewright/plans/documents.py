"""Documents: positioned words, lines, bands, columns, media types, retrieval outcomes."""

from pyspark.sql import functions as F

from pacewright.plans.registry import query
from pacewright.sources import catalog, layout
from pacewright.sources.tables import Tables


def _words(t: Tables):
    """Lines of orders as positioned words: the line number is the height, the quantity the place across."""
    d = t.read("lineitem")
    top = F.col("l_linenumber") * 10.0
    return d.select(F.col("l_orderkey").cast("string").alias("doc"), F.lit(1).alias("page"), F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("text"), (F.col("l_quantity") * 10).alias("x0"), top.alias("top"), (F.col("l_quantity") * 10 + 5).alias("x1"), (top + 8).alias("bottom"))


@query("word_lines", "select cast(l_orderkey as varchar) as doc, cast(dense_rank() over (partition by l_orderkey order by l_linenumber) - 1 as int) as line, array_to_string(list(l_returnflag || l_linestatus order by l_quantity, l_returnflag || l_linestatus), ' ') as text, min(l_quantity * 10) as x0, max(l_quantity * 10 + 5) as x1 from lineitem group by l_orderkey, l_linenumber")
def word_lines(spark, sf_dir):
    return layout.group_lines(_words(Tables(spark, sf_dir))).select("doc", "line", "text", "x0", "x1")


@query("line_bands", "select doc, line, cast(sum(case when n >= 2 then 1 else 0 end) over (partition by doc order by line) as bigint) as band from (select cast(l_orderkey as varchar) as doc, cast(l_linenumber as int) as line, count(*) as n from lineitem group by all)")
def line_bands(spark, sf_dir):
    d = Tables(spark, sf_dir).read("lineitem")
    lines = d.groupBy(F.col("l_orderkey").cast("string").alias("doc"), F.col("l_linenumber").alias("line"), F.lit(1).alias("page")).agg(F.count("*").alias("n"))
    return layout.bands(lines, F.col("n") >= 2).select("doc", "line", "band")


@query("column_anchors", "select l_orderkey, l_linenumber, l_partkey, l_quantity, case when abs(l_quantity - 10) <= 5 and abs(l_quantity - 10) <= abs(l_quantity - 22) then 'bib' when abs(l_quantity - 22) <= 5 and abs(l_quantity - 22) <= abs(l_quantity - 35) then 'name' when abs(l_quantity - 35) <= 5 then 'time' end as col from lineitem")
def column_anchors(spark, sf_dir):
    d = Tables(spark, sf_dir).read("lineitem")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", layout.assign_column(F.col("l_quantity"), {"bib": 10.0, "name": 22.0, "time": 35.0}, 5.0).alias("col"))


@query("media_types", "select page_id, case when starts_with(lower(html), '<!doctype html') then 'text/html' end as kind from pages")
def media_types(spark, sf_dir):
    p = Tables(spark, sf_dir).read("pages")
    return p.select("page_id", catalog.media_type(F.encode("html", "UTF-8")).alias("kind"))


@query("fetch_outcomes", """select o_orderkey, case when served is null then case when stored = pinned then 'stored' else 'failed' end when pinned is null then 'fetched' when served = pinned then case when stored is null then 'restored' else 'stored' end else 'changed' end as outcome
from (select o_orderkey, case when o_orderkey % 7 <> 0 then o_custkey % 3 end as served, case when o_orderkey % 5 <> 0 then o_custkey % 3 + case when o_orderkey % 11 = 0 then 1 else 0 end end as pinned, case when o_orderkey % 2 = 0 then o_custkey % 3 end as stored from orders)""")
def fetch_outcomes(spark, sf_dir):
    o, n, h = Tables(spark, sf_dir).read("orders"), F.col("o_orderkey"), F.col("o_custkey") % 3
    served, stored = F.when(n % 7 != 0, h), F.when(n % 2 == 0, h)
    pinned = F.when(n % 5 != 0, h + F.when(n % 11 == 0, 1).otherwise(0))
    return o.select("o_orderkey", catalog.fetch_outcome(served, pinned, stored).alias("outcome"))


@query("html_cells")
def html_cells(spark, sf_dir):
    """Cells of all tables of the pages (these pages have none; tests have)."""
    return layout.html_cells(Tables(spark, sf_dir).read("pages")).drop("head")
