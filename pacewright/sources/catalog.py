"""The declared catalog: YAML files read where Spark reads, with the source line of every row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _rows(node: yaml.Node, pointer: str = "") -> Iterator[tuple[str, int, str | None]]:
    """(JSON pointer, line, scalar or null) of a node and all below it."""
    scalar = None if not isinstance(node, yaml.ScalarNode) or node.tag.endswith(":null") else node.value
    yield pointer, node.start_mark.line + 1, scalar
    if isinstance(node, yaml.MappingNode):
        for key, value in node.value:
            yield from _rows(value, f"{pointer}/{key.value.replace('~', '~0').replace('/', '~1')}")
    elif isinstance(node, yaml.SequenceNode):
        for i, value in enumerate(node.value):
            yield from _rows(value, f"{pointer}/{i}")


def read_yaml(spark: SparkSession, path: str) -> DataFrame:
    """file, pointer, line, value, error: every node of every YAML file; a broken file gives its error as a row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    root = yaml.compose(bytes(content).decode(), Loader=yaml.SafeLoader)
                    rows += [(name, *row, None) for row in (_rows(root) if root is not None else ())]
                except (yaml.YAMLError, UnicodeDecodeError) as e:
                    rows.append((name, "", 0, None, str(e)))
            yield pd.DataFrame(rows, columns=["file", "pointer", "line", "value", "error"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.yaml").load(path).select("path", "content")
    return files.mapInPandas(run, "file string, pointer string, line int, value string, error string")


def records(nodes: DataFrame, pattern: str, fields: list[str]) -> DataFrame:
    """One row per node whose pointer matches a pattern, its named scalar children as columns, with file and line."""
    parent = F.regexp_extract("pointer", f"^({pattern})(?:/([^/]+))?$", 1)
    field = F.regexp_extract("pointer", f"^({pattern})(?:/([^/]+))?$", 2)
    own = nodes.where("error is null").withColumns({"parent": parent, "field": field}).where("parent <> '' or pointer = ''").where(F.col("pointer").rlike(f"^{pattern}(/[^/]+)?$"))
    columns = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    return own.groupBy("file", "parent").agg(F.min("line").alias("line"), *columns)


def read_lock(spark: SparkSession, path: str) -> DataFrame:
    """document, fingerprint of every pinned retrieval in a folder's lock.json files."""
    locks = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "lock.json").schema("documents map<string, struct<sha256:string,url:string,retrieved_at:string>>").json(path)
    return locks.select(F.explode("documents").alias("document", "pin")).select("document", "pin.*")


def media_type(content) -> F.col:
    """The kind of a document from its first bytes; null if it's none of the known ones."""
    head = F.lower(F.ltrim(F.decode(F.substring(content, 1, 64), "ISO-8859-1")))
    return F.when(head.startswith("%pdf-"), "application/pdf").when(head.startswith("<!doctype html") | head.startswith("<html"), "text/html").when(head.startswith("{") | head.startswith("["), "application/json")


def fetch_outcome(served, pinned, stored) -> F.col:
    """What retrieving a document came to, from the served, the pinned and the stored hash."""
    return F.when(served.isNull(), F.when(stored == pinned, "stored").otherwise("failed")).when(pinned.isNull(), "fetched").when(served == pinned, F.when(stored.isNull(), "restored").otherwise("stored")).otherwise("changed")
