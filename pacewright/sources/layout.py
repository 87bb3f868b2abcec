"""Positioned words of a page: lines by running centre, columns by nearest anchor, bands, HTML cells."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

LINE_TOLERANCE, JOIN_GAP = 2.5, 0.5


def line_numbers(centres: np.ndarray, tolerance: float = LINE_TOLERANCE) -> np.ndarray:
    """The line of each word of a page in order of its top: a word joins while its centre is near the mean of the line's."""
    lines, total, count, line = np.zeros(len(centres), int), 0.0, 0, -1
    for i, c in enumerate(centres):
        if not count or abs(c - total / count) > tolerance:
            line, total, count = line + 1, 0.0, 0
        total, count = total + c, count + 1
        lines[i] = line
    return lines


def group_lines(words: DataFrame, tolerance: float = LINE_TOLERANCE) -> DataFrame:
    """doc, page, line, text, x0, top, x1, bottom of the lines of ``words(doc, page, text, x0, top, x1, bottom)``; a page's words are a short list."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc": frame["doc"], "page": frame["page"], "words": frame["words"], "lines": [line_numbers(np.array([w["c"] for w in words]), tolerance).tolist() for words in frame["words"]]})

    word = F.struct(((F.col("top") + F.col("bottom")) / 2).alias("c"), "x0", "top", "x1", "bottom", "text")
    pages = words.groupBy("doc", "page").agg(F.sort_array(F.collect_list(word)).alias("words"))
    numbered = pages.mapInPandas(run, "doc string, page int, words array<struct<c:double,x0:double,top:double,x1:double,bottom:double,text:string>>, lines array<int>")
    flat = numbered.select("doc", "page", F.explode(F.arrays_zip("lines", "words")).alias("z")).select("doc", "page", F.col("z.lines").alias("line"), "z.words.*")
    ordered = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"]), " ")
    return flat.groupBy("doc", "page", "line").agg(ordered.alias("text"), F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"))


def bands(lines: DataFrame, is_row: Column) -> DataFrame:
    """``lines`` with ``band``: how many rows began up to each line of its document; lines before the first have 0."""
    order = W.partitionBy("doc").orderBy("page", "line")
    return lines.withColumn("band", F.sum(is_row.cast("int")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).cast("long"))


def join_fragments(words: DataFrame) -> DataFrame:
    """Letter fragments of one baseline with almost no gap become one word: gaps and islands."""
    order = W.partitionBy("doc", "page", "top").orderBy("x0")
    letters = lambda c: F.col(c).rlike(r"^\p{L}+$")
    new = ~F.coalesce((F.col("x0") - F.lag("x1").over(order) < JOIN_GAP) & letters("text") & F.lag("text").over(order).rlike(r"^\p{L}+$"), F.lit(False))
    marked = words.withColumn("new", new.cast("int"))
    island = marked.withColumn("island", F.sum("new").over(order))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("x0", "text"))), lambda w: w["text"]), "")
    return island.groupBy("doc", "page", "top", "island").agg(text.alias("text"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom")).drop("island")


def assign_column(x: Column, anchors: dict[str, float], tolerance: float) -> Column:
    """The nearest anchor's key within a tolerance, else null."""
    best = F.array_min(F.array(*(F.struct(F.abs(x - v).alias("d"), F.lit(k).alias("k")) for k, v in sorted(anchors.items()))))
    return F.when(best["d"] <= tolerance, best["k"])


class _Cells(HTMLParser):
    """Cells of all table rows; hidden elements are skipped, rows and cells may be unclosed."""

    def __init__(self):
        super().__init__()
        self.rows: list[list[str]] = []
        self.heads: list[list[bool]] = []
        self.open = False
        self.hidden: list[str] = []

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if self.hidden or "hidden" in own or "display:none" in (own.get("style") or "").replace(" ", ""):
            self.hidden.append(tag)
        elif tag == "tr":
            self.rows.append([])
            self.heads.append([])
            self.open = False
        elif tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
                self.heads.append([])
            self.rows[-1].append("")
            self.heads[-1].append(tag == "th")
            self.open = True

    def handle_endtag(self, tag):
        if self.hidden:
            if tag in self.hidden:
                del self.hidden[len(self.hidden) - 1 - self.hidden[::-1].index(tag) :]
        elif tag in ("td", "th", "tr", "table"):
            self.open = False

    def handle_data(self, data):
        if self.open and not self.hidden:
            self.rows[-1][-1] += data


def html_cells(pages: DataFrame) -> DataFrame:
    """page_id, row, cell, text, head (a heading's cell) of every table cell of ``pages(page_id, html)``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for page, html in zip(frame["page_id"], frame["html"], strict=True):
                parser = _Cells()
                parser.feed(html or "")
                rows += [(page, i, j, " ".join(text.split()), head) for i, (cells, heads) in enumerate(zip(parser.rows, parser.heads, strict=True)) for j, (text, head) in enumerate(zip(cells, heads, strict=True))]
            yield pd.DataFrame(rows, columns=["page_id", "row", "cell", "text", "head"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, row int, cell int, text string, head boolean")
