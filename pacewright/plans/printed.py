"""Printed values: what the scalar forms make of texts composed from the tables."""

from pyspark.sql import functions as F

from pacewright.functions import printed as pr
from pacewright.plans.registry import query
from pacewright.sources.tables import Tables


@query("thousandths", "select o_orderkey, floor(o_totalprice) / 1000 as exact from orders")
def thousandths(spark, sf_dir):
    """A price of so many thousandths, printed as hundredths rounded up with the thousandths in brackets, is read back."""
    o = Tables(spark, sf_dir).read("orders").withColumn("m", F.floor("o_totalprice"))
    shown = (F.ceil(F.col("m") / 10) / 100).cast("decimal(12,2)").cast("string")
    text = F.concat(shown, F.lit(" (."), F.lpad((F.col("m") % 1000).cast("string"), 3, "0"), F.lit(")"))
    return o.select("o_orderkey", pr.with_thousandths(text).cast("double").alias("exact"))


@query("positions_read", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber as place, l_discount as wind from lineitem")
def positions_read(spark, sf_dir):
    d = Tables(spark, sf_dir).read("lineitem")
    place = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("(="), "l_linenumber", F.lit(")"))).otherwise(F.col("l_linenumber").cast("string"))
    wind = F.concat(F.lit("+"), F.col("l_discount").cast("decimal(4,2)").cast("string"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", pr.position(place).alias("place"), pr.reading(wind).cast("double").alias("wind"))


@query("clock_of_events", "select event_id, cast(hour(ts) * 60 + minute(ts) as int) as minutes from events")
def clock_of_events(spark, sf_dir):
    e = Tables(spark, sf_dir).read("events")
    return e.select("event_id", pr.minutes_of_day(F.date_format("ts", "H:mm")).alias("minutes"))


@query("zoned_events", "select event_id, epoch(ts) - 7200 as utc_s from events")
def zoned_events(spark, sf_dir):
    """Local times stay as they are printed; the declared zone gives the instant."""
    e = Tables(spark, sf_dir).read("events")
    return e.select("event_id", (F.unix_micros(pr.in_zone(F.col("ts"), F.lit("+02:00"))) / 1e6).alias("utc_s"))


_NAMES = sorted(pr.COUNTRIES)


@query("country_codes", "select n_nationkey, code from (select n_nationkey, n_nationkey + 1 as i from nation) join (values " + ", ".join(f"({i + 1}, '{pr.COUNTRIES[n]}')" for i, n in enumerate(_NAMES)) + ") c(i, code) using (i)")
def country_codes(spark, sf_dir):
    names = F.get(F.array(*(F.lit(n.replace(" ", "  ")) for n in _NAMES)), F.col("n_nationkey"))
    return Tables(spark, sf_dir).read("nation").select("n_nationkey", pr.country_code(names).alias("code"))


@query("event_ids", "select p_partkey, case p_size % 5 when 0 then 'mile' when 1 then (100 * p_size) || 'm' when 2 then (100 * p_size) || 'mh' when 3 then (100 * p_size) || 'msc' end as event from part")
def event_ids(spark, sf_dir):
    p = Tables(spark, sf_dir).read("part")
    k, metres = F.col("p_size") % 5, (100 * F.col("p_size")).cast("string")
    text = F.when(k == 0, "One  Mile").when(k == 1, F.concat(metres, F.lit("m"))).when(k == 2, F.concat(metres, F.lit(" Metres Hurdles"))).when(k == 3, F.concat(metres, F.lit("m Steeplechase"))).otherwise("Long Jump")
    return p.select("p_partkey", pr.event_id(text).alias("event"))


@query("dates_read", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, case when (year(o_orderdate) - (1900 + o_custkey % 100)) between 10 and 110 and not (year(o_orderdate) - (year(o_orderdate) // 100 * 100 + o_custkey % 100)) between 10 and 110 then year(o_orderdate) // 100 * 100 - 100 + o_custkey % 100 when (year(o_orderdate) - (year(o_orderdate) // 100 * 100 + o_custkey % 100)) between 10 and 110 then year(o_orderdate) // 100 * 100 + o_custkey % 100 when (year(o_orderdate) - (year(o_orderdate) // 100 * 100 - 100 + o_custkey % 100)) between 10 and 110 then year(o_orderdate) // 100 * 100 - 100 + o_custkey % 100 end as born from orders")
def dates_read(spark, sf_dir):
    """Dates with weekday, ordinal and comma; the century of a birth year."""
    o = Tables(spark, sf_dir).read("orders")
    text = F.concat(F.date_format("o_orderdate", "EEE d"), F.lit("th "), F.date_format("o_orderdate", "MMMM"), F.lit(", "), F.date_format("o_orderdate", "yyyy"), F.lit(" - Oslo"))
    return o.select("o_orderkey", F.date_format(pr.dated(text), "yyyy-MM-dd").alias("day"), pr.born(F.col("o_custkey") % 100, F.year("o_orderdate")).cast("long").alias("born"))


@query("timed_words", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, case when l_returnflag = 'R' then '' else l_quantity || case when l_returnflag = 'A' then '/' || l_linenumber else '' end end as words from (select *, cast(cast(l_quantity as decimal(5,1)) as varchar) as q from lineitem)".replace("l_quantity ||", "q ||"))
def timed_words(spark, sf_dir):
    """A time, its rank if it has one, and a column without a value; a line with another word has none."""
    d = Tables(spark, sf_dir).read("lineitem")
    time = F.col("l_quantity").cast("decimal(5,1)").cast("string")
    line = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("Heat 1 "), time)).when(F.col("l_returnflag") == "A", F.concat(time, F.lit(" ("), "l_linenumber", F.lit(") NO VALUE (7)"))).otherwise(F.concat(F.lit("DNF (3) "), time))
    show = F.array_join(F.transform(pr.timed_words(line), lambda x: F.concat_ws("/", x["time"], x["rank"].cast("string"))), " ")
    return d.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", show.alias("words"))


@query("name_spread", "with recursive h as (select p_partkey, p_brand as s, 1 as i, cast(2166136261 as bigint) as h from part union all select p_partkey, s, i + 1, (xor(h, cast(ascii(s[i]) as bigint)) * 16777619) % 4294967296 from h where i <= length(s)) select p_partkey, h / 4294967296.0::double as spread from h where i = length(s) + 1")
def name_spread(spark, sf_dir):
    return Tables(spark, sf_dir).read("part").select("p_partkey", pr.spread_by_name(F.col("p_brand")).alias("spread"))


@query("shown_families", "select p_partkey, 'Mc' || upper(p_type[1]) || lower(p_type[2:]) || ' van O''' || upper(p_type[1]) || lower(p_type[2:]) || '-' || upper(p_type[1]) || lower(p_type[2:]) as family from part")
def shown_families(spark, sf_dir):
    p = Tables(spark, sf_dir).read("part")
    text = F.concat(F.lit("MC"), F.upper("p_type"), F.lit(" van O'"), F.upper("p_type"), F.lit("-"), F.upper("p_type"))
    return p.select("p_partkey", pr.shown_family(text).alias("family"))


@query("mark_keys", "select mark_key, count(*) as n from (select l_returnflag || l_linestatus as mark_key from lineitem) group by all")
def mark_keys(spark, sf_dir):
    d = Tables(spark, sf_dir).read("lineitem")
    return d.groupBy(pr.mark_key(F.concat(F.lit("(= "), F.lower("l_returnflag"), F.lit("."), "l_linestatus", F.lit(")"))).alias("mark_key")).agg(F.count("*").alias("n"))


@query("venues", "select n_nationkey, 'City ' || n_nationkey as city, left(upper(r_name), 3) as country from nation join region on n_regionkey = r_regionkey")
def venues(spark, sf_dir):
    t = Tables(spark, sf_dir)
    d = t.read("nation").join(F.broadcast(t.read("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    city, country = pr.place_of(F.concat(F.lit("Stadium, City "), "n_nationkey", F.lit(" ("), F.substring(F.upper("r_name"), 1, 3), F.lit(")")))
    return d.select("n_nationkey", city.alias("city"), country.alias("country"))
