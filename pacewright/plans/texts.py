"""Names, texts, times and dates."""

from pyspark.sql import functions as F

from pacewright.functions import printed as pr
from pacewright.functions import text as tx
from pacewright.functions import times as tm
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables

_FOLDED = tx.fold_sql("x")
_FIRST = "(select doc_id, list_extract(string_split(text, ' '), 1) as x, text from documents)"


def _first_words(spark, sf_dir):
    d = Tables(spark, sf_dir).read("documents")
    return d.select("doc_id", F.substring_index("text", " ", 1).alias("x"), "text")


@query("folded_words", f"select doc_id, {_FOLDED} as folded, nullif(regexp_replace(regexp_replace({_FOLDED}, '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), '') as slug from {_FIRST}")
def folded_words(spark, sf_dir):
    return _first_words(spark, sf_dir).select("doc_id", tx.fold(F.col("x")).alias("folded"), tx.slug(F.col("x")).alias("slug"))


_BAG = f"array_to_string(list_sort(string_split(trim(regexp_replace({tx.fold_sql('p_name')}, '[^0-9a-z]+', ' ', 'g')), ' ')), ' ')"


@query("word_bags", f"select {_BAG} as bag, count(*) as n, min(p_partkey) as first from part group by 1")
def word_bags(spark, sf_dir):
    """Names that are the same words in any order."""
    p = Tables(spark, sf_dir).read("part")
    return p.groupBy(tx.word_bag(F.col("p_name")).alias("bag")).agg(F.count("*").alias("n"), F.min("p_partkey").alias("first"))


@query("term_search", "select 'part' as kind, p_partkey as id from part where contains(lower(p_name), '1') and contains(lower(p_name), '7') union all select 'customer', c_custkey from customer where contains(lower(c_name), '1') and contains(lower(c_name), '7') order by kind, id limit 40")
def term_search(spark, sf_dir):
    """Entries that hold every term, the first forty: a search box's limit."""
    t = Tables(spark, sf_dir)
    entries = t.read("part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), "p_name").union(t.read("customer").select(F.lit("customer"), "c_custkey", "c_name"))
    terms = F.array(F.lit("1"), F.lit("7"))
    found = entries.where(F.forall(terms, lambda x: F.contains(tx.fold(F.col("p_name")), x)))
    return found.select("kind", "id").orderBy("kind", "id").limit(40)


@query("formatted", """select l_orderkey, l_linenumber, l_partkey, l_extendedprice, cast(l_linenumber as varchar) || case when l_linenumber % 100 between 11 and 13 then 'th' when l_linenumber % 10 = 1 then 'st' when l_linenumber % 10 = 2 then 'nd' when l_linenumber % 10 = 3 then 'rd' else 'th' end as place,
  regexp_replace(regexp_replace(cast(cast(l_quantity as decimal(9,3)) as varchar), '0+$', ''), '\\.$', '') as metres,
  case when l_quantity >= 60 then '' else cast(cast(floor(l_quantity) as bigint) as varchar) || '.00' end as clock from lineitem""")
def formatted(spark, sf_dir):
    d = Tables(spark, sf_dir).read("lineitem")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", tx.ordinal(F.col("l_linenumber")).alias("place"), tx.metres(F.col("l_quantity")).alias("metres"), tx.clock(F.col("l_quantity").cast("decimal(9,2)")).alias("clock"))


@query("clock_times", """with x as (select event_id, case event_id % 5 when 0 then cast(event_id as varchar) || '.5' when 1 then '1:0' || (event_id % 10) || '.25' when 2 then 'DNF' when 3 then '2:15:' || (10 + event_id % 50) else 'x' || event_id end as printed from events)
select event_id, case when printed = 'DNF' then 'dnf' when printed like 'x%' then null else 'finished' end as status,
  case event_id % 5 when 0 then cast(event_id + 0.5 as double) when 1 then cast(60 + event_id % 10 + 0.25 as double) when 3 then cast(2 * 3600 + 15 * 60 + 10 + event_id % 50 as double) end as time_s from x""")
def clock_times(spark, sf_dir):
    """Printed results to status and seconds."""
    e = Tables(spark, sf_dir).read("events")
    n, k = F.col("event_id"), F.col("event_id") % 5
    printed = F.when(k == 0, F.concat(n, F.lit(".5"))).when(k == 1, F.concat(F.lit("1:0"), n % 10, F.lit(".25"))).when(k == 2, "DNF").when(k == 3, F.concat(F.lit("2:15:"), 10 + n % 50)).otherwise(F.concat(F.lit("x"), n))
    status, time_s = tm.outcome(printed)
    return e.select("event_id", status.alias("status"), time_s.cast("double").alias("time_s"))


@query("race_keys", """select o_orderkey, regexp_extract(k, '^(.+)-(men|women|mixed)/(final|heat)(?:-(\\d+))?$', 1) as discipline, regexp_extract(k, '^(.+)-(men|women|mixed)/(final|heat)(?:-(\\d+))?$', 2) as sex,
  regexp_extract(k, '^(.+)-(men|women|mixed)/(final|heat)(?:-(\\d+))?$', 3) as round, nullif(regexp_extract(k, '^(.+)-(men|women|mixed)/(final|heat)(?:-(\\d+))?$', 4), '') as heat
from (select o_orderkey, (100 * (1 + o_custkey % 8)) || 'm-' || case o_orderkey % 3 when 0 then 'men' when 1 then 'women' else 'mixed' end || case when o_orderkey % 2 = 0 then '/final' else '/heat-' || (o_orderkey % 9) end as k from orders)""")
def race_keys(spark, sf_dir):
    """A race key to discipline, sex, round and heat."""
    o, n = Tables(spark, sf_dir).read("orders"), F.col("o_orderkey")
    key = F.concat(100 * (1 + F.col("o_custkey") % 8), F.lit("m-"), F.when(n % 3 == 0, "men").when(n % 3 == 1, "women").otherwise("mixed"), F.when(n % 2 == 0, "/final").otherwise(F.concat(F.lit("/heat-"), n % 9)))
    part = lambda i: F.regexp_extract(key, r"^(.+)-(men|women|mixed)/(final|heat)(?:-(\d+))?$", i)
    return o.select("o_orderkey", part(1).alias("discipline"), part(2).alias("sex"), part(3).alias("round"), F.nullif(part(4), F.lit("")).alias("heat"))


@query("birth_years", "select c_custkey, case when y - here between 10 and 110 then here when y - here + 100 between 10 and 110 then here - 100 end as born from (select c_custkey, 1990 + c_nationkey as y, (1990 + c_nationkey) // 100 * 100 + c_custkey % 100 as here from customer)")
def birth_years(spark, sf_dir):
    c = Tables(spark, sf_dir).read("customer")
    return c.select("c_custkey", pr.born(F.col("c_custkey") % 100, 1990 + F.col("c_nationkey")).alias("born"))


@query("weekday_in_range", "select o_orderkey, strftime(cast(o_orderdate as date) + cast((7 - isodow(o_orderdate)) as int), '%Y-%m-%d') as sunday from orders")
def weekday_in_range(spark, sf_dir):
    """The one Sunday of the seven days from each date."""
    o = Tables(spark, sf_dir).read("orders")
    first = F.to_date("o_orderdate")
    return o.select("o_orderkey", F.date_format(tm.weekday_in(first, F.date_add(first, 6), F.lit(1)), "yyyy-MM-dd").alias("sunday"))


@query("similar_names")
def similar_names(spark, sf_dir):
    """Pairs of different part names that are alike: of so many shared characters that they share a rare one of theirs."""
    return tx.alike_pairs(Tables(spark, sf_dir).read("part").select(F.col("p_name").alias("name")))


@query("first_match_class", "select p_partkey, case when regexp_matches(p_type, 'STEEL|BRASS') then 'metal' when p_size > 40 then 'large' when regexp_matches(p_brand, '[13]$') then 'odd' end as series from part")
def first_match_class(spark, sf_dir):
    """Ordered rules, the first that matches wins."""
    p = Tables(spark, sf_dir).read("part")
    rules = [F.when(F.col("p_type").rlike("STEEL|BRASS"), "metal"), F.when(F.col("p_size") > 40, "large"), F.when(F.col("p_brand").rlike("[13]$"), "odd")]
    return p.select("p_partkey", F.coalesce(*rules).alias("series"))


@query("spoken_enums", """select conv_id, turn, case when regexp_matches(lower(text), '\\bmixed\\b') then 'mixed' when regexp_matches(lower(text), '\\b(women|woman|girls|female)\\b') then 'women' when regexp_matches(lower(text), '\\b(men|man|boys|male)\\b') then 'men' end as sex from conversations""")
def spoken_enums(spark, sf_dir):
    c = Tables(spark, sf_dir).read("conversations")
    return c.select("conv_id", "turn", tx.sex_of(F.col("text")).alias("sex"))
