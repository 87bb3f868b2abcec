"""Findings beside their runs, short names of runs, values given to columns."""

from pyspark.sql import functions as F

from pacewright.operators import columns, notes
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables


@query(
    "run_notes",
    """with f as (select o_orderkey::varchar as finding, 'c/' || o_custkey || case o_orderstatus when 'P' then '' when 'F' then '/' || o_orderkey else '/' || o_orderkey || '/after' end as subject, o_orderpriority as "check", o_orderstatus as message, o_custkey, o_totalprice, o_orderdate, o_orderkey from orders),
  c as (select l_orderkey, list_sort(list(distinct 's' || l_suppkey)) as cited from lineitem where l_returnflag = 'R' group by l_orderkey)
  select finding, subject, "check", case when "check" = '5-LOW' then "check" else lower("check") end as title, case when c_custkey is not null then 'c/' || c_custkey end as run, c_name as name, message, case when message = 'F' then o_totalprice end as time,
    array_to_string(coalesce(cited, case when message = 'F' then [strftime(o_orderdate, '%Y-%m-%d')] end, []), ' ') as sources from f left join customer on c_custkey = o_custkey left join c on l_orderkey = o_orderkey""",
)
def run_notes(spark, sf_dir):
    """Findings on runs (customers), on splits (orders) and below them, with what they cite."""
    t = Tables(spark, sf_dir)
    o, run = t.read("orders"), F.concat(F.lit("c/"), F.col("o_custkey").cast("string"))
    split = F.concat_ws("/", run, F.col("o_orderkey").cast("string"))
    subject = F.when(F.col("o_orderstatus") == "P", run).when(F.col("o_orderstatus") == "F", split).otherwise(F.concat(split, F.lit("/after")))
    findings = o.select(F.col("o_orderkey").cast("string").alias("finding"), subject.alias("subject"), F.col("o_orderpriority").alias("check"), F.col("o_orderstatus").alias("message"))
    runs = t.read("customer").select(F.concat(F.lit("c/"), F.col("c_custkey").cast("string")).alias("run"), F.col("c_name").alias("name"))
    splits = o.select(split.alias("split"), F.col("o_totalprice").alias("time"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("source"))
    checks = o.where("o_orderpriority <> '5-LOW'").select(F.col("o_orderpriority").alias("check"), F.lower("o_orderpriority").alias("title")).distinct()
    cited = t.read("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").cast("string").alias("finding"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("source"))
    return notes.notes(findings, runs, splits, checks, cited).withColumn("sources", F.array_join("sources", " "))


_RUN = "o_orderpriority as g, o_orderkey::varchar as run, o_custkey, c_name, '’' || strftime(o_orderdate, '%y') as y, o_orderstatus as p, case when o_totalprice > 200000 then 'Final' else 'Heat' end as r"


@query(
    "short_names",
    f"""with t as (select *, [y, p, p || ' ' || y, p || ' ' || r, p || ' ' || y || ' ' || r] as tags from (select {_RUN} from orders join customer on c_custkey = o_custkey)),
  n as (select g, o_custkey, count(*) as n, count(distinct tags[1]) as a, count(distinct tags[2]) as b, count(distinct tags[3]) as c, count(distinct tags[4]) as d from t group by g, o_custkey)
  select g as "group", run, case when n = 1 then c_name else c_name || ' ' || tags[case n when a then 1 when b then 2 when c then 3 when d then 4 else 5 end] end as short from t join n using (g, o_custkey)""",
)
def short_names(spark, sf_dir):
    """Runs (orders) of athletes (customers) within each priority, named so that they differ."""
    t = Tables(spark, sf_dir)
    names = t.read("customer").select(F.col("c_custkey").alias("athlete"), F.col("c_name").alias("family"))
    round_ = F.when(F.col("o_totalprice") > 200000, "Final").otherwise("Heat")
    o = t.read("orders").select(F.col("o_orderpriority").alias("group"), F.col("o_orderkey").cast("string").alias("run"), F.col("o_custkey").alias("athlete"), F.col("o_orderstatus").alias("place"), F.col("o_orderdate").alias("day"), round_.alias("round"))
    return notes.short_names(o.join(names, "athlete"))


@query(
    "values_by_position",
    """with v as (select l_returnflag as t, l_orderkey as line, l_quantity as x, l_linestatus as text, case when abs(l_quantity - 8) <= 7 then 'a' when abs(l_quantity - 25) <= 7 then 'b' when abs(l_quantity - 42) <= 7 then 'c' end as k from lineitem),
  r as (select *, row_number() over (partition by t, line, k order by x, text) as n, case k when 'b' then 'O' else 'F' end as kind from v)
  select t as "table", line, x, text, case when n = 1 and text = kind then k end as "column", case when k is null then 'under no column' when n > 1 then 'under a column that is taken' when text <> kind then 'doesn''t fit ' || k end as error from r""",
)
def values_by_position(spark, sf_dir):
    """Line items as values set under one of their table's three columns."""
    d = Tables(spark, sf_dir).read("lineitem")
    values = d.select(F.col("l_returnflag").alias("table"), F.col("l_orderkey").alias("line"), F.col("l_quantity").alias("x"), F.col("l_linestatus").alias("text"))
    column = lambda name, anchor, kind: F.struct(F.lit(name).alias("column"), F.lit(anchor).alias("anchor"), F.lit(kind).alias("kind"))
    heads = values.select("table").distinct().select("table", F.explode(F.array(column("a", 8.0, "F"), column("b", 25.0, "O"), column("c", 42.0, "F"))).alias("c")).select("table", "c.*")
    return columns.by_position(values, heads, F.col("text") == F.col("kind"), 7.0)


@query(
    "values_in_order",
    """with v as (select o_orderstatus as t, l_orderkey as line, l_quantity as x, l_linestatus as text, row_number() over w as k, lag(l_linestatus) over w as before from lineitem join orders on o_orderkey = l_orderkey window w as (partition by l_orderkey order by l_quantity, l_linestatus)),
  r as (select *, sum(case when k = 1 then (text = 'O')::int when text = before then 2 else 1 end) over (partition by line order by k) as i from v)
  select t as "table", line, x, text, case when i < 6 then 'c' || i end as "column", case when i >= 6 then 'fits no column that is left' end as error from r""",
)
def values_in_order(spark, sf_dir):
    """Line items as values in the order of six columns of two kinds by turns, of which a line may leave some out."""
    t = Tables(spark, sf_dir)
    o = t.read("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("table"))
    values = t.read("lineitem").join(o, "l_orderkey").select("table", F.col("l_orderkey").alias("line"), F.col("l_quantity").alias("x"), F.col("l_linestatus").alias("text"))
    place = F.explode(F.sequence(F.lit(0), F.lit(5)))
    heads = o.select("table").distinct().withColumn("place", place).select("table", "place", F.concat(F.lit("c"), F.col("place").cast("string")).alias("column"), F.when(F.col("place") % 2 == 0, "F").otherwise("O").alias("kind"))
    return columns.in_order(values, heads, {"F": "^F$", "O": "^O$"})
