"""What publishers list: registry answers, page data, results books, file indexes, stored bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The parts of a registry's answer that are read.
ANSWER = (
    "days array<struct<date:string,eventTitles:array<struct<events:array<struct<event:string,gender:string,races:array<struct<race:string,"
    "results:array<struct<mark:string,nationality:string,competitor:struct<name:string,urlSlug:string,birthDate:string>>>>>>>>>>>"
)
LINEAGE = "name string, held_from int, held_to int, editions array<struct<year:int,races:bigint,city:string>>"

#: File names of the results system: report, sex, event, phase and unit.
REPORT_FILE = r"_(C\d\d[A-Z]?)_ATH([MW])([0-9A-Z]+)-+([A-Z]{3}[0-9A-Z-])(\d{6})"


def registry_results(answers: DataFrame, body: str = "body") -> DataFrame:
    """The other columns, pointer, date, event, sex, race, name, country, mark, profile and birth of every result in the answers.

    Results are the leaves of days, titles, events and races; the pointer names the leaf within its
    answer. Mixed events, relays and people without a profile or a country have no rows, nor have texts that are no JSON.
    """
    keys = [c for c in answers.columns if c != body]
    d = answers.select(*keys, F.from_json(body, ANSWER).alias("top"))
    names = ("days", "eventTitles", "events", "races", "results")
    inside = "top"
    for name in names:
        d = d.select("*", F.posexplode(f"{inside}.{name}").alias(f"_{name}_at", f"_{name}"))
        inside = f"_{name}"
    pointer = F.concat(*(part for name in names for part in (F.lit(f"/{name}/"), F.col(f"_{name}_at").cast("string"))))
    who = F.col("_results.competitor")
    profile = F.regexp_extract(who["urlSlug"], r"(\d+)$", 1)
    sex = F.when(F.col("_events.gender") == "M", "men").when(F.col("_events.gender") == "W", "women")
    rows = d.select(
        *keys, pointer.alias("pointer"), F.col("_days.date").alias("date"), F.col("_events.event").alias("event"), sex.alias("sex"), F.col("_races.race").alias("race"),
        who["name"].alias("name"), F.col("_results.nationality").alias("country"), F.trim("_results.mark").alias("mark"), F.when(profile != "", profile.cast("long")).alias("profile"), who["birthDate"].alias("birth"),
    )
    return rows.where("sex is not null and profile is not null and name <> '' and country <> ''")


def page_data(html: Column, schema: str, element: str = "page-data") -> Column:
    """The JSON that a page carries in a script element with an id, as a struct."""
    return F.from_json(F.regexp_extract(html, rf'(?s)<script[^>]*id="{element}"[^>]*>(.*?)</script>', 1), schema)


def book_reports(pages: DataFrame, footer: str = r"Unit (\S+) Report (\S+)") -> DataFrame:
    """doc, unit, report and its pages in order, of ``pages(doc, page, text)`` whose text has a footer; others belong to no report."""
    named = pages.select("doc", "page", F.regexp_extract("text", footer, 1).alias("unit"), F.regexp_extract("text", footer, 2).alias("report"))
    return named.where("unit <> ''").groupBy("doc", "unit", "report").agg(F.sort_array(F.collect_list("page")).alias("pages"))


def analyses(reports: DataFrame, analysis: str = "C77A", results: str = "C73") -> DataFrame:
    """doc, unit, analysis_pages, results_pages: each race's analysis with its own results, else those of its round (the unit without its last part)."""
    found = reports.where(F.col("report") == results).select("doc", "unit", "pages")
    own = found.withColumnRenamed("pages", "own")
    of_round = found.select("doc", F.col("unit").alias("round"), F.col("pages").alias("of_round"))
    wanted = reports.where(F.col("report") == analysis).select("doc", "unit", F.regexp_replace("unit", r"-[^-]*$", "").alias("round"), F.col("pages").alias("analysis_pages"))
    return wanted.join(own, ["doc", "unit"], "left").join(of_round, ["doc", "round"], "left").select("doc", "unit", "analysis_pages", F.coalesce("own", "of_round").alias("results_pages"))


def indexed_races(files: DataFrame, codes: dict[str, str], phases: dict[str, str], analysis: str = "C77A") -> DataFrame:
    """index, file, results, heat, copy of every race analysis in ``files(index, file)``.

    results is the first file of the same sex, event and phase that is no analysis; copy is the name under which a
    mirror has the analysis. ``codes`` and ``phases`` name the wanted events and phases as mirrors write them.
    """
    part = lambda i: F.regexp_extract("file", REPORT_FILE, i)
    d = files.select("index", "file", *(part(i).alias(n) for i, n in enumerate(("report", "sex", "event", "phase", "unit"), 1))).where("report <> ''")
    named = lambda table, c: F.coalesce(*(F.when(F.col(c) == k, v) for k, v in table.items()))
    group = ["index", "sex", "event", "phase"]
    results = d.where(F.col("report") != analysis).groupBy(*group).agg(F.min("file").alias("results"))
    races = d.where(F.col("report") == analysis).withColumns({"code": named(codes, "event"), "mirror": named(phases, "phase")}).where("code is not null and mirror is not null")
    heat = F.substring("unit", 1, 4).cast("int")
    copy = F.concat(F.lit("AT-"), "code", F.lit("-"), "sex", F.lit("-"), "mirror", F.lit("--"), heat.cast("string"), F.lit("--.RS7.pdf"))
    return races.join(results, group, "left").select("index", "file", "results", heat.alias("heat"), copy.alias("copy"))


def audit(declared: DataFrame, listed: DataFrame, excluded: DataFrame, formats: list[str]) -> DataFrame:
    """id, bucket of ``declared(id, race, format, url)`` beside ``listed(id, race, url)`` and ``excluded(race)``.

    Of listed documents: excluded, missing, moved (another address) or same. Of declared ones in the listing's
    formats and races: unlisted. A declared race that isn't listed at all is kept by hand; its id is the race's.
    """
    out = excluded.select("race").distinct().withColumn("out", F.lit(True))
    held = declared.select("id", F.col("url").alias("held"), F.lit(True).alias("has"))
    bucket = F.when(F.col("out"), "excluded").when(F.col("has").isNull(), "missing").when(~F.col("held").eqNullSafe(F.col("url")), "moved").otherwise("same")
    of_listed = listed.join(out, "race", "left").join(held, "id", "left").select("id", bucket.alias("bucket"))
    races = listed.select("race").distinct()
    unlisted = declared.where(F.col("format").isin(formats)).join(listed.select("id"), "id", "left_anti").join(races, "race", "left_semi")
    by_hand = declared.select("race").distinct().join(races, "race", "left_anti")
    return of_listed.unionByName(unlisted.select("id", F.lit("unlisted").alias("bucket"))).unionByName(by_hand.select(F.col("race").alias("id"), F.lit("by hand").alias("bucket")))


def numbers(texts: DataFrame, key: str, body: str = "body") -> DataFrame:
    """key, name, number of every entry of JSON objects that give names their permanent numbers."""
    return texts.select(key, F.explode(F.from_json(body, "map<string,bigint>")).alias("name", "number"))


def meeting_editions(texts: DataFrame, body: str = "body") -> DataFrame:
    """meeting, held_from, held_to, year, races, city of every edition in the meetings' histories."""
    d = texts.select(F.from_json(body, LINEAGE).alias("m")).select("m.*", F.explode("m.editions").alias("e"))
    return d.select(F.col("name").alias("meeting"), "held_from", "held_to", "e.year", "e.races", "e.city")


def corrected(editions: DataFrame, corrections: DataFrame, spurious: DataFrame, fields: list[str]) -> DataFrame:
    """``editions(series, year, name, check, fields...)`` with what a verifier found: ``corrections(series, year, name, field,
    should_be, at)`` and ``spurious(series, year, name, reason)`` hold for an edition of that year whose name has theirs in it.

    The last correction of a field holds (``at``), and a correction's remark hides one about a spurious edition. Fields are text.
    """
    key = ["series", "year", "name"]
    fits = F.contains(F.lower("name"), F.lower("of"))
    fixes = editions.select(*key).distinct().join(corrections.withColumnRenamed("name", "of"), ["series", "year"]).where(fits & F.col("field").isin(fields))
    last = fixes.groupBy(*key).agg(*(F.max_by("should_be", F.when(F.col("field") == f, F.col("at"))).alias(f"_{f}") for f in fields), F.max_by("field", "at").alias("_last"))
    wrong = editions.select(*key).distinct().join(spurious.withColumnRenamed("name", "of"), ["series", "year"]).where(fits).groupBy(*key).agg(F.max("reason").alias("_reason"))
    remark = F.coalesce(F.concat(F.lit("corrected "), "_last"), F.concat(F.lit("spurious: "), "_reason"), "check")
    d = editions.join(last, key, "left").join(wrong, key, "left")
    return d.select(*key, *(F.coalesce(f"_{f}", f).alias(f) for f in fields), remark.alias("check"))


def stored(contents: DataFrame, content: str = "content") -> DataFrame:
    """sha256, content: bytes under the name of their hash, equal ones once."""
    return contents.select(F.sha2(content, 256).alias("sha256"), F.col(content).alias("content")).where("sha256 is not null").dropDuplicates(["sha256"])


def put(contents: DataFrame, folder: str, held: DataFrame | None = None, content: str = "content") -> None:
    """Add to a store, a folder of Parquet files, what it doesn't hold; ``held`` is the store as read before, None for a new one."""
    new = stored(contents, content)
    if held is not None:
        new = new.join(held.select("sha256"), "sha256", "left_anti")
    new.write.mode("append").parquet(folder)


def intact(blobs: DataFrame) -> DataFrame:
    """A store's rows with ``intact``: whether the bytes still have the hash that names them."""
    return blobs.withColumn("intact", F.sha2("content", 256).eqNullSafe(F.col("sha256")))
