"""Merging, linking and identity."""

from pyspark.sql import functions as F

from pacewright.operators import assembly as asm
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables

_READ = "r as (select l_orderkey as subject, l_partkey * 10000000000 + l_suppkey * 1000000 + cast(floor(l_extendedprice) as bigint) * 10 + l_linenumber as authority, case when l_returnflag <> 'N' then l_returnflag end as mark, case when l_linenumber <= 4 then l_linenumber end as lane from lineitem)"


CONFLICTS = f"with {_READ}, k as (select subject, arg_min(mark, authority) filter (where mark is not null) as mark, arg_min(lane, authority) filter (where lane is not null) as lane from r group by subject) select subject, authority, 'mark' as field, r.mark as value, k.mark as kept from r join k using (subject) where r.mark <> k.mark union all select subject, authority, 'lane', cast(r.lane as varchar), cast(k.lane as varchar) from r join k using (subject) where r.lane <> k.lane"


def readings(t: Tables):
    d = t.read("lineitem")
    authority = F.col("l_partkey") * 10000000000 + F.col("l_suppkey") * 1000000 + F.floor("l_extendedprice").cast("long") * 10 + F.col("l_linenumber")
    return d.select(F.col("l_orderkey").alias("subject"), authority.alias("authority"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("mark"), F.when(F.col("l_linenumber") <= 4, F.col("l_linenumber")).alias("lane"))


@query("merged_values", f"with {_READ} select subject, arg_min(mark, authority) filter (where mark is not null) as mark, arg_min(lane, authority) filter (where lane is not null) as lane from r group by subject")
def merged_values(spark, sf_dir):
    return asm.merge(readings(Tables(spark, sf_dir)), ["mark", "lane"])[0]


@query("merge_conflicts", CONFLICTS)
def merge_conflicts(spark, sf_dir):
    return asm.merge(readings(Tables(spark, sf_dir)), ["mark", "lane"])[1]


@query("agreed_dates", "select o_custkey as subject, case when count(distinct year(o_orderdate)) <= 1 then max(year(o_orderdate)) end as year, case when count(distinct month(o_orderdate)) <= 1 then max(month(o_orderdate)) end as month, case when count(distinct day(o_orderdate)) <= 1 then max(day(o_orderdate)) end as day from orders group by o_custkey")
def agreed_dates(spark, sf_dir):
    o = Tables(spark, sf_dir).read("orders")
    claims = o.select(F.col("o_custkey").alias("subject"), *(f("o_orderdate").cast("long").alias(n) for n, f in (("year", F.year), ("month", F.month), ("day", F.day))))
    return asm.agreed_birth_date(claims)


@query("linked_once", "with m as (select o_orderkey as \"row\", o_orderpriority as document, min(c_custkey) as candidate from orders join customer on o_custkey % 25 = c_nationkey and abs(o_totalprice / 100 - c_acctbal) <= 20 group by all having min(c_custkey) = max(c_custkey)) select \"row\", candidate from (select *, count(*) over (partition by document, candidate) as n from m) where n = 1")
def linked_once(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = t.read("orders").select(F.col("o_orderkey").alias("row"), F.col("o_orderpriority").alias("document"), (F.col("o_custkey") % 25).cast("int").alias("country"), (F.col("o_totalprice") / 100).alias("mark"))
    people = t.read("customer").select(F.col("c_custkey").alias("candidate"), F.col("c_nationkey").alias("country"), F.col("c_acctbal").alias("listed"))
    return asm.link_nearest_once(rows, people, ["country"], "mark", "listed", 20)


@query("expanded_initials", "select s.p_partkey as \"row\", min(f.p_name) as given from part s join part f on s.p_brand = f.p_brand and s.p_size = f.p_size and starts_with(f.p_name, left(s.p_name, 1)) group by s.p_partkey having count(distinct f.p_name) = 1")
def expanded_initials(spark, sf_dir):
    p = Tables(spark, sf_dir).read("part")
    short = p.select(F.col("p_partkey").alias("row"), F.substring("p_name", 1, 1).alias("initial"), F.col("p_brand").alias("family"), F.col("p_size").alias("country"))
    return asm.expand_initials(short, p.select(F.col("p_name").alias("given"), F.col("p_brand").alias("family"), F.col("p_size").alias("country")))


@query("integrity_gate", "select 'lost' as problem, l_orderkey as id from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderkey % 10 <> 0) union all select 'twice', o_orderkey from orders group by o_orderkey having count(*) > 1")
def integrity_gate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lost = asm.integrity(t.read("lineitem"), "l_orderkey", t.read("orders").where("o_orderkey % 10 <> 0"), "o_orderkey")
    return lost
