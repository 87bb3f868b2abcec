"""Listings, registry answers, stored bytes, spans of lines and the relational tables, on texts composed from the tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewright.operators import relations
from pacewright.plans.registry import query
from pacewright.sources import listings, spans
from pacewright.sources.tables import Tables, oracle

_ANSWERS = """select o_custkey as answer, '/days/' || (dense_rank() over (partition by o_custkey order by year(o_orderdate)) - 1) || '/eventTitles/0/events/' || (dense_rank() over (partition by o_custkey, year(o_orderdate) order by o_orderpriority) - 1)
    || '/races/0/results/' || (row_number() over (partition by o_custkey, year(o_orderdate), o_orderpriority order by o_orderkey) - 1) as pointer,
  year(o_orderdate)::varchar as date, o_orderpriority as event, case o_orderpriority when '1-URGENT' then 'men' when '5-LOW' then null else 'women' end as sex, o_orderkey as profile, o_orderstatus as mark from orders"""


@query("registry_results", f"select * from ({_ANSWERS}) where sex is not null and mark <> 'P'")
def registry_results(spark, sf_dir):
    """Results of nested answers with their pointers; mixed events and people without a profile are passed over."""
    o = Tables(spark, sf_dir).read("orders").withColumn("day", F.year("o_orderdate"))
    slug = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("some-name-"), "o_orderkey"))
    who = F.struct(F.lit("Some NAME").alias("name"), slug.alias("urlSlug"))
    result = F.struct(F.col("o_orderstatus").alias("mark"), F.lit("NOR").alias("nationality"), who.alias("competitor"))
    gender = F.when(F.col("o_orderpriority") == "1-URGENT", "M").when(F.col("o_orderpriority") == "5-LOW", "X").otherwise("W")
    listed = lambda *key: F.sort_array(F.collect_list(F.struct(*key)))
    races = o.groupBy("o_custkey", "day", "o_orderpriority", gender.alias("gender")).agg(listed("o_orderkey", result.alias("r")).alias("rs"))
    event = F.struct(F.col("o_orderpriority").alias("event"), "gender", F.array(F.struct(F.lit("1").alias("race"), F.transform("rs", lambda x: x["r"]).alias("results"))).alias("races"))
    days = races.groupBy("o_custkey", "day").agg(F.sort_array(F.collect_list(event)).alias("events"))
    day = F.struct("day", F.array(F.struct("events")).alias("eventTitles"))
    answers = days.groupBy(F.col("o_custkey").alias("answer")).agg(F.sort_array(F.collect_list(day)).alias("days"))
    body = F.to_json(F.struct(F.transform("days", lambda d: F.struct(d["day"].cast("string").alias("date"), d["eventTitles"].alias("eventTitles"))).alias("days")))
    found = listings.registry_results(answers.select("answer", body.alias("body")))
    return found.select("answer", "pointer", "date", "event", "sex", "profile", "mark")


@query("page_data", "select p_partkey, p_brand as brand, p_size::bigint as size from part")
def page_data(spark, sf_dir):
    """The data that a publisher's page carries in a script."""
    p = Tables(spark, sf_dir).read("part")
    html = F.concat(F.lit('<html><script>var a;</script>\n<script type="application/json" id="page-data">\n'), F.to_json(F.struct("p_brand", "p_size")), F.lit("</script></html>"))
    d = p.select("p_partkey", listings.page_data(html, "p_brand string, p_size bigint").alias("x"))
    return d.select("p_partkey", F.col("x.p_brand").alias("brand"), F.col("x.p_size").alias("size"))


@query("book_analyses", """with p as (select l_orderkey as doc, l_partkey as page, 'M-' || l_returnflag || case when l_linestatus = 'O' or l_linenumber % 2 = 1 then '-' || (l_linenumber % 2) else '' end as unit, case when l_linestatus = 'O' then 'C77A' else 'C73' end as report from lineitem),
r as (select doc, unit, report, array_to_string(list(page order by page), ' ') as pages from p group by all)
select a.doc, a.unit, a.pages as analysis_pages, coalesce(o.pages, f.pages) as results_pages from r a left join r o on o.doc = a.doc and o.unit = a.unit and o.report = 'C73'
  left join r f on f.doc = a.doc and f.unit = substr(a.unit, 1, 3) and f.report = 'C73' where a.report = 'C77A'""")
def book_analyses(spark, sf_dir):
    """A results book's pages by unit and report, each analysis with its race's results or its round's."""
    d = Tables(spark, sf_dir).read("lineitem")
    k = (F.col("l_linenumber") % 2).cast("string")
    unit = F.concat(F.lit("M-"), "l_returnflag", F.when((F.col("l_linestatus") == "O") | (k == "1"), F.concat(F.lit("-"), k)).otherwise(""))
    report = F.when(F.col("l_linestatus") == "O", "C77A").otherwise("C73")
    pages = d.select(F.col("l_orderkey").alias("doc"), F.col("l_partkey").alias("page"), F.concat(F.lit("3 JUN 2001 Unit "), unit, F.lit(" Report "), report, F.lit(" page 1")).alias("text"))
    join = lambda c: F.array_join(F.col(c).cast("array<string>"), " ").alias(c)
    return listings.analyses(listings.book_reports(pages)).select("doc", "unit", join("analysis_pages"), join("results_pages"))


_FILE = "'/ATH_' || case when l_linestatus = 'O' then 'C77A' else 'C73' end || '_ATH' || case when l_returnflag = 'A' then 'M' else 'W' end || case when l_tax > 0.06 then '10M' else '800M' end || '--------------' || case when l_discount > 0.05 then 'RND1' else 'FNL-' end || lpad(l_linenumber::varchar, 4, '0') || '00--.pdf'"


@query("indexed_races", f"""with f as (select distinct l_orderkey as index, {_FILE} as file, l_linestatus as s, l_returnflag = 'A' as men, l_tax > 0.06 as ten, l_discount > 0.05 as heats, l_linenumber as n from lineitem),
r as (select index, men, ten, heats, min(file) as results from f where s <> 'O' group by all)
select index, file, results, n::int as heat, 'AT-800-' || case when men then 'M' else 'W' end || '-' || case when heats then 'h' else 'f' end || '--' || n || '--.RS7.pdf' as copy
from f left join r using (index, men, ten, heats) where s = 'O' and not ten""")
def indexed_races(spark, sf_dir):
    """Race analyses among the file names of an index, with the results of their round."""
    d = Tables(spark, sf_dir).read("lineitem")
    name = F.concat(
        F.lit("/ATH_"), F.when(F.col("l_linestatus") == "O", "C77A").otherwise("C73"), F.lit("_ATH"), F.when(F.col("l_returnflag") == "A", "M").otherwise("W"),
        F.when(F.col("l_tax") > 0.06, "10M").otherwise("800M"), F.lit("--------------"), F.when(F.col("l_discount") > 0.05, "RND1").otherwise("FNL-"), F.lpad(F.col("l_linenumber").cast("string"), 4, "0"), F.lit("00--.pdf"),
    )
    files = d.select(F.col("l_orderkey").alias("index"), name.alias("file")).distinct()
    return listings.indexed_races(files, {"800M": "800", "1500M": "1500"}, {"RND1": "h", "FNL-": "f"})


@query("listing_audit", """with d as (select o_orderkey as id, o_custkey as race, o_orderpriority as format, o_orderdate as url from orders where o_orderstatus <> 'P'),
l as (select o_orderkey as id, o_custkey as race, case when o_totalprice > 300000 then null else o_orderdate end as url from orders where o_orderpriority not in ('5-LOW', '4-NOT SPECIFIED'))
select id, case when race in (select c_custkey from customer where c_mktsegment = 'MACHINERY') then 'excluded' when id not in (select id from d) then 'missing' when url is null then 'moved' else 'same' end as bucket from l
union all select id, 'unlisted' from d where format in ('1-URGENT', '5-LOW') and id not in (select id from l) and race in (select race from l)
union all select distinct race, 'by hand' from d where race not in (select race from l)""")
def listing_audit(spark, sf_dir):
    """Listed against declared documents, with races left out and races declared by hand."""
    t = Tables(spark, sf_dir)
    o = t.read("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("race"), F.col("o_orderpriority").alias("format"), F.col("o_orderdate").cast("string").alias("url"), "o_orderstatus", "o_totalprice")
    url = F.when(F.col("o_totalprice") > 300000, "elsewhere").otherwise(F.col("url"))
    listed = o.where(~F.col("format").isin("5-LOW", "4-NOT SPECIFIED")).select("id", "race", url.alias("url"))
    excluded = t.read("customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("race"))
    return listings.audit(o.where("o_orderstatus <> 'P'").select("id", "race", "format", "url"), listed, excluded, ["1-URGENT", "5-LOW"])


@query("permanent_numbers", "select l_orderkey as doc, 'runner-' || l_linenumber as name, min(l_partkey) as number from lineitem group by l_orderkey, l_linenumber")
def permanent_numbers(spark, sf_dir):
    d = Tables(spark, sf_dir).read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("n"))
    texts = d.groupBy(F.col("l_orderkey").alias("doc")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("runner-"), "l_linenumber"), "n")))).alias("body"))
    return listings.numbers(texts, "doc")


@query("lineage_editions", "select 'Meeting ' || o_custkey as meeting, year(o_orderdate)::int as year, count(*) as races, (min(year(o_orderdate)) over (partition by o_custkey))::int as held_from from (select o_custkey, o_orderdate from orders) group by o_custkey, year(o_orderdate)".replace("min(year(o_orderdate)) over", "min(min(year(o_orderdate))) over"))
def lineage_editions(spark, sf_dir):
    """Editions of meetings told as nested histories."""
    o = Tables(spark, sf_dir).read("orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("races"))
    m = o.groupBy("o_custkey").agg(F.min("year").alias("held_from"), F.max("year").alias("held_to"), F.sort_array(F.collect_list(F.struct("year", "races"))).alias("editions"))
    texts = m.select(F.to_json(F.struct(F.concat(F.lit("Meeting "), "o_custkey").alias("name"), "held_from", "held_to", "editions")).alias("body"))
    return listings.meeting_editions(texts).select("meeting", "held_from", "year", "races")


@query("corrected_editions", oracle("""with e as (select event as series, cast(substr(race, 1, 4) as int) as year, 'The ' || setting || ' Games' as name, cast(count(*) as varchar) as races, min(country) as city from runs group by all)
select series, year, name, case when series = '1-URGENT' and name = 'The MACHINERY Games' then case when year = 1995 then '9' else '0' end else races end as races,
  case when series = '2-HIGH' and name = 'The BUILDING Games' then 'Oslo' else city end as city,
  case when series = '1-URGENT' and name = 'The MACHINERY Games' then 'corrected races' when series = '2-HIGH' and name = 'The BUILDING Games' then 'corrected city' when series = '5-LOW' and year < 1994 and name = 'The FURNITURE Games' then 'spurious: twice' else 'verified' end as "check" from e"""))
def corrected_editions(spark, sf_dir):
    """Researched editions with a verifier's corrections."""
    r = Tables(spark, sf_dir).runs
    e = r.groupBy(F.col("event").alias("series"), F.substring("race", 1, 4).cast("int").alias("year"), F.concat(F.lit("The "), "setting", F.lit(" Games")).alias("name"))
    e = e.agg(F.count("*").cast("string").alias("races"), F.min("country").alias("city")).withColumn("check", F.lit("verified"))
    years = range(1990, 2012)
    fixes = [("1-URGENT", y, "machinery", "races", "0", 1) for y in years] + [("2-HIGH", y, "Building", "city", "Oslo", 1) for y in years] + [("1-URGENT", 1995, "MACHINERY", "races", "9", 2), ("1-URGENT", 1995, "machinery", "colour", "red", 3)]
    wrong = [("5-LOW", y, "furniture", "twice") for y in years if y < 1994]
    fixes = spark.createDataFrame(fixes, "series string, year int, name string, field string, should_be string, at int")
    return listings.corrected(e, fixes, spark.createDataFrame(wrong, "series string, year int, name string, reason string"), ["races", "city"])


@query("blobs_intact", "select sha256(coalesce(html, '')) as sha256, not bool_or(contains(url, '/de/')) as intact from (select html, min(url) as url from pages group by html) group by 1")
def blobs_intact(spark, sf_dir):
    """Stored pages read again and verified against their names; some were damaged since."""
    p = Tables(spark, sf_dir).read("pages").groupBy("html").agg(F.min("url").alias("url"))
    p = p.select(F.coalesce("html", F.lit("")).alias("html"), "url")
    kept = listings.stored(p, "html").join(p.select(F.sha2("html", 256).alias("sha256"), F.contains("url", F.lit("/de/")).alias("hurt")).groupBy("sha256").agg(F.bool_or("hurt").alias("hurt")), "sha256")
    return listings.intact(kept.withColumn("content", F.when(F.col("hurt"), F.concat("content", F.lit("?"))).otherwise(F.col("content")))).select("sha256", "intact")


@query("sourced_words", """with w as (select l_orderkey as doc, l_returnflag || l_linestatus as text, l_quantity * 10 as x, row_number() over o as i, lead(l_quantity * 10) over o as x2, lead(l_returnflag || l_linestatus) over o as text2 from lineitem window o as (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus))
select doc, arg_min('NO' || coalesce(' ' || text2, ''), i) as value, arg_min(least(x, coalesce(x2, x)), i) as x0, arg_min(greatest(x, coalesce(x2, x)) + 5, i) as x1 from w where text = 'NO' group by doc""")
def sourced_words(spark, sf_dir):
    """A match in a line with the box around the words that it covers."""
    d = Tables(spark, sf_dir).read("lineitem")
    x = F.col("l_quantity") * 10
    word = F.struct(F.concat("l_returnflag", "l_linestatus").alias("text"), x.alias("x0"), F.lit(1.0).alias("top"), (x + 5).alias("x1"), F.lit(9.0).alias("bottom"))
    lines = d.groupBy(F.col("l_orderkey").alias("doc")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", word.alias("w")))).alias("l"))
    found = lines.select("doc", F.transform("l", lambda r: r["w"]).alias("words")).select("doc", F.inline(F.array_compact(F.array(spans.sourced(F.col("words"), r"NO(?: [ANR][FO])?")))))
    return found.select("doc", "value", "x0", "x1")


@query("lap_points", "select l_orderkey, l_linenumber, l_partkey, case when l_returnflag = 'R' then floor(1609.344 - 400 * (l_linenumber % 4)) + 5 else 1609.344::double - 400 * (l_linenumber % 4) end::double as metres from lineitem")
def lap_points(spark, sf_dir):
    """A mile's laps, printed rounded down, at their exact points."""
    d = Tables(spark, sf_dir).read("lineitem")
    label = F.floor(1609.344 - 400 * (F.col("l_linenumber") % 4)) + F.when(F.col("l_returnflag") == "R", 5).otherwise(0)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", spans.lap_point(label.cast("double"), F.lit(1609.344), F.lit(400.0)).alias("metres"))


@query("heading_rounds", "select o_orderkey, case o_orderpriority when '1-URGENT' then 'final' when '2-HIGH' then 'heat' when '3-MEDIUM' then 'heat' when '5-LOW' then 'b-race' end as round, case o_orderpriority when '2-HIGH' then o_custkey % 9 + 1 when '3-MEDIUM' then o_custkey % 26 + 1 when '5-LOW' then case when o_custkey % 2 = 0 then 2 end end::int as heat from orders")
def heading_rounds(spark, sf_dir):
    """The round and heat that a heading names."""
    o, k, p = Tables(spark, sf_dir).read("orders"), F.col("o_custkey"), F.col("o_orderpriority")
    text = F.when(p == "1-URGENT", "1500m Final").when(p == "2-HIGH", F.concat(F.lit("800m Men HEAT "), k % 9 + 1)).when(p == "3-MEDIUM", F.concat(F.lit("Heat "), F.char(k % 26 + 65), F.lit(" 800m")))
    text = text.when(p == "5-LOW", F.when(k % 2 == 0, "B Race 2").otherwise("5000m B race")).otherwise("5000m Men")
    return o.select("o_orderkey", spans.heading_round(text).alias("x")).select("o_orderkey", "x.round", "x.heat")


_SOURCE = """substr(sha256('{"document":"' || race || '","field":"' || 'FIELD' || '"}'), 1, 16)"""


@query("published_performances", oracle("select performance as id, race, athlete, " + ", ".join(f"{c}, case when {c} is not null then {_SOURCE.replace('FIELD', c)} end as {c}_source" for c in ("country", "status", "time_s")) + " from runs"))
def published_performances(spark, sf_dir):
    """A published table: every value beside the id of its source."""
    return relations.tables(Tables(spark, sf_dir))["performances"]


@query("published_sources", oracle("""select distinct substr(sha256('{"document":"' || document || '","field":"' || field || '"}'), 1, 16) as id, document, field from (
  select race as document, 'country' as field from runs where country is not null union all select race, 'status' from runs union all select race, 'time_s' from runs where time_s is not null union all select document, 'passing/' || mark from passings)"""))
def published_sources(spark, sf_dir):
    """The dictionary of all sources that published values name."""
    return relations.tables(Tables(spark, sf_dir))["sources"]


@query("published_sizes", oracle("""select 'series' as name, count(*) as n, 2 as columns from region union all select 'countries', count(*), 3 from nation union all select 'athletes', count(*), 2 from customer
  union all select 'races', count(distinct (race, event)), 2 from runs union all select 'performances', count(*), 9 from runs union all select 'passings', count(*), 6 from passings union all select 'stretches', count(*), 5 from passings"""))
def published_sizes(spark, sf_dir):
    """Rows and commented columns of the published tables that hold values."""
    found = relations.tables(Tables(spark, sf_dir))
    sizes = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n", F.lit(sum("comment" in f.metadata for f in df.schema.fields)).alias("columns")) for name, df in found.items() if name != "sources"]
    return reduce(DataFrame.unionByName, sizes)
