"""python -m pacewright.cli: trace, schema, checks, publish and read over a folder of tables."""

import argparse

from pyspark.sql import SparkSession

from pacewright.operators import flags, publish, views
from pacewright.sources import transcripts
from pacewright.sources.tables import Tables


def _published(t: Tables) -> dict:
    return {"results": views.results(t.runs), "passings": t.passings, "flags": flags.run_checks(flags.Inputs(t.passings, views.results(t.runs)))}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pacewright", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, words in {"trace": ("tables", "prefix"), "schema": ("tables",), "checks": ("tables", "out"), "publish": ("tables", "out"), "read": ("transcripts",)}.items():
        own = commands.add_parser(name)
        for word in words:
            own.add_argument(word)
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"pacewright {given.command}").getOrCreate()
    if given.command == "read":
        values = transcripts.read_values(spark, given.transcripts)
        transcripts.entries(values).orderBy("document", "entry").show(100, truncate=False)
        return
    tables = Tables(spark, given.tables)
    if given.command == "trace":
        views.trace(tables.passings, tables.runs, given.prefix).orderBy("record").show(1000, truncate=False)
    elif given.command == "schema":
        print(publish.columns_document(_published(tables)))
    elif given.command == "checks":
        _published(tables)["flags"].write.mode("overwrite").parquet(given.out)
    else:
        publish.write_tables(_published(tables), given.out)
        publish.write_documents(publish.race_documents(tables.runs, tables.passings), f"{given.out}/races", "event")


if __name__ == "__main__":
    main()
