"""License scans with a positional rare-token index.

The index holds, for every word of the license templates, the templates and positions where it
stands. Of each template the words with the highest inverse document frequency are looked up, one more
than may be out of place, so every placement has one of them in place: an occurrence at word i
proposes (template, i - position). The placement counts when enough of the template's words stand
where they should and its mandatory key phrases are there word for word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewright.llm.tokens import NOT_ALNUM, Chunk, chunks, word_hash


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]


#: Notices as licences ask for them, and the phrases without which they aren't that licence.
TEMPLATES = (
    Template("mit", "Released under the MIT License.", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache license version 2 0",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", ("apache license version 2 0", "except in compliance with the license")),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2.", ("gnu general public license version 2",)),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3.", ("gnu general public license version 3",)),
    Template("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", ("redistribute it and or modify it", "gnu general public license", "version 3 of the license")),
    Template("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License", ("redistribute it and or modify it", "gnu general public license", "version 2 of the license")),
    Template("gpl-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation", ("redistribute it and or modify it", "gnu general public license version 2")),
    Template("lgpl-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License", ("gnu library general public license", "version 2 of the license")),
    Template("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License", ("gnu lesser general public license", "version 2 1 of the license")),
    Template("lgpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License", ("gnu lesser general public license", "version 3 of the license")),
    Template("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", ("gnu affero general public license", "version 3 of the license")),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0.", ("cc by nc 4 0",)),
    Template("cc-by-4.0", "Licensed under CC BY 4.0.", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0.", ("cc by sa 4 0",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "following conditions are met")),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla public license v 2 0",)),
    Template("isc", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    Template("proprietary", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.", ("proprietary and confidential",)),
)
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: The share of a template's words that must stand in place.
LEAST_COVERAGE = 0.8
#: Words on either side of a placement in which a key phrase may stand: words put in or left out move it.
KEY_SLACK = 4
#: Proposed placements that are compared at once.
COMPARED = 1 << 14
#: The score of a document whose only sign is a base phrase.
PHRASE_SCORE = 0.5


def _words(text: str) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _hashed(text: str) -> np.ndarray:
    return np.array([word_hash(w) for w in _words(text)], np.uint64)


class Index:
    """Word -> (template, position), as sorted arrays; phrases as hashes."""

    def __init__(self, templates: tuple[Template, ...]):
        self.templates = templates
        self.bodies = [_hashed(t.text) for t in templates]
        self.keys = [[_hashed(k) for k in t.keys] for t in templates]
        self.base = {label: _hashed(p) for label, p in BASE.items()}
        self.words, which = np.unique(np.concatenate(self.bodies), return_inverse=True)
        self.posts: list[list[tuple[int, int]]] = [[] for _ in self.words]
        at = ((t, p) for t, body in enumerate(self.bodies) for p in range(len(body)))
        for w, post in zip(which.tolist(), at, strict=True):
            self.posts[w].append(post)
        self.may = np.zeros(1 << 16, bool)
        self.may[(self.words >> np.uint64(48)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of licence words, and which words they are."""
        at = np.flatnonzero(self.may[(hashes >> np.uint64(48)).astype(np.int64)])
        word = np.minimum(np.searchsorted(self.words, hashes[at]), len(self.words) - 1)
        same = self.words[word] == hashes[at]
        return at[same], word[same]


@lru_cache(4)
def index(templates: tuple[Template, ...]) -> Index:
    return Index(templates)


def _places(hashes: np.ndarray, phrase: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """Where the words of a phrase stand one after another (within a row)."""
    at = np.flatnonzero(hashes[: max(0, len(hashes) - len(phrase) + 1)] == phrase[0])
    for j in range(1, len(phrase)):
        at = at[hashes[at + j] == phrase[j]]
    return at if rows is None else at[rows[at] == rows[at + len(phrase) - 1]]


def frequencies(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> np.ndarray:
    """In how many documents each word of the index stands; counted over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index(templates)
        count = np.zeros(len(own.words), np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0), NOT_ALNUM):
                at, word = own.find(chunk.hashes())
                row = np.searchsorted(chunk.bounds, at, "right") - 1
                count += np.bincount(np.unique(row * len(own.words) + word) % len(own.words), minlength=len(own.words))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(count))), pa.array(count)], ["word", "df"])

    count = np.zeros(len(index(templates).words))
    for row in docs.select("text").mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).collect():
        count[row.word] = row.df
    return count


def _anchors(own: Index, count: np.ndarray) -> list[np.ndarray]:
    """For each template the positions of its rarest words: the least number of which one stands in place in every placement."""
    out = []
    for body in own.bodies:
        words = np.searchsorted(own.words, body)
        least = next(n for n in range(len(body) + 1) if n / len(body) >= LEAST_COVERAGE)
        out.append(np.argsort(count[words], kind="stable")[: len(body) - least + 1])
    return out


def _placed(own: Index, anchors: list[np.ndarray], chunk: Chunk, hashes: np.ndarray, at: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, str, int, int, float]]:
    """(row, label, first word, words, share in place) of every template that stands in a row, in order of row, template and place."""
    order = np.argsort(word, kind="stable")
    edges = np.searchsorted(word[order], np.arange(len(own.words) + 1))
    found = []
    for t, body in enumerate(own.bodies):
        starts, rows = [], []
        for p in anchors[t].tolist():
            w = np.searchsorted(own.words, body[p])
            here = at[order[edges[w] : edges[w + 1]]]
            starts.append(here - p)
            rows.append(np.searchsorted(chunk.bounds, here, "right") - 1)
        proposed = np.unique(np.stack((np.concatenate(rows), np.concatenate(starts)), 1), axis=0)
        for i in range(0, len(proposed), COMPARED):
            row, start = proposed[i : i + COMPARED].T
            place = start[:, None] + np.arange(len(body))
            inside = (place >= chunk.bounds[row][:, None]) & (place < chunk.bounds[row + 1][:, None])
            share = ((hashes[np.clip(place, 0, len(hashes) - 1)] == body) & inside).sum(1) / len(body)
            for j in np.flatnonzero(share >= LEAST_COVERAGE).tolist():
                first, end = int(chunk.bounds[row[j]]), int(chunk.bounds[row[j] + 1])
                lo, hi = max(first, int(start[j])), min(end, int(start[j]) + len(body))
                near = hashes[max(first, lo - KEY_SLACK) : min(end, hi + KEY_SLACK)]
                if all(len(_places(near, k)) for k in own.keys[t]):
                    found.append((int(row[j]), t, int(start[j]), own.templates[t].label, lo - first, hi - lo, float(share[j])))
    yield from ((x[0], *x[3:]) for x in sorted(found))


_FOUND = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("share", pa.float64())]))
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, placements array<struct<label:string,first_word:long,n_words:long,share:double>>"


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """Base phrases and placed license templates of every document.

    doc_id, n_words, n_base (places of base phrases), first_word and last_word (least and largest start
    of these, else null), base_labels and labels (distinct, sorted, comma-joined, empty if none), score
    (the best placement's share of template words in place, at least ``PHRASE_SCORE`` with a base phrase,
    else 0), placements. A null or empty text has no words and no finds; equal rows each have a row; an
    empty table gives an empty result; other columns are ignored.
    """
    count = frequencies(docs, templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index(templates)
        anchors = _anchors(own, count)
        for batch in batches:
            for chunk in chunks(batch.column(1), NOT_ALNUM):
                n = chunk.rows
                hashes, rows = chunk.hashes(), chunk.word_rows()
                number, first, last = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                base: list[set[str]] = [set() for _ in range(n)]
                for label, phrase in own.base.items():
                    at = _places(hashes, phrase, rows)
                    row = rows[at]
                    np.add.at(number, row, 1)
                    np.minimum.at(first, row, at - chunk.bounds[row])
                    np.maximum.at(last, row, at - chunk.bounds[row])
                    for r in np.unique(row):
                        base[r].add(label)
                found: list[list[tuple[str, int, int, float]]] = [[] for _ in range(n)]
                for r, *placement in _placed(own, anchors, chunk, hashes, *own.find(hashes)):
                    found[r].append(tuple(placement))
                score = [max([PHRASE_SCORE * bool(base[r]), *(x[3] for x in found[r])]) for r in range(n)]
                none = number == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, n),
                        pa.array(chunk.counts),
                        pa.array(number),
                        pa.array(first, mask=none),
                        pa.array(last, mask=none),
                        pa.array([",".join(sorted(x)) for x in base]),
                        pa.array([",".join(sorted(x | {y[0] for y in f})) for x, f in zip(base, found, strict=True)]),
                        pa.array(score, pa.float64()),
                        pa.array([[dict(zip(("label", "first_word", "n_words", "share"), y, strict=True)) for y in f] for f in found], _FOUND),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "placements"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
