"""Operator 8: license scans by sparse TF-IDF cosine, then inheritance from the nearest ancestor directory.

Method: lines, blocks of up to ``BLOCK`` neighbouring lines, and the windows of each
template's length that begin and end with a template word are compared
with licence templates as sparse TF-IDF vectors.  Document frequencies of all
words are counted over all files by a group-by; comment marks are no words.  A
block whose cosine reaches ``COSINE`` names the file's licence: the template of
the highest cosine, the first in ``TEMPLATES`` on a tie, of those whose version stands
in the block and whose distinguishing words (lesser, affero, nc, sa, nd) are the
block's.  A first pass keeps the
blocks that would reach it if every other word weighed the least a word can;
only the words of those are joined with their frequencies.

A file of which licence blocks make up ``SHARE`` of the words, or whose name is a
licence file's, states the licence of its directory; a directory with several
takes the one with the highest cosine, then the least name.  Files without a
licence of their own inherit from the nearest ancestor directory that states one:
each distinct directory is joined with its ancestors, and files join their
directory's answer.

Defined cases: null and empty texts have no licence of their own; null paths
have no directory and inherit nothing; repeated rows get equal results; an empty
table gives no rows; very long texts are scanned whole; only the named columns are
read, so others can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quitanda.llm import kernel as K
from quitanda.llm.common import stored

COSINE = 0.6
BLOCK = 3
SHARE = 50
LICENSE_NAMES = r"(?i)^(licen[cs]e|copying|notice)([.\-_].*)?$"

#: Public notices by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

#: Words that tell the licences of a family apart, and what they say; a block and its template must say the same.
FAMILIES = (
    (("gnu",), {"lesser": ("lesser",), "affero": ("affero",)}),
    (("cc", "creative"), {
        **{prefix + "-".join(long[x] for x in parts): parts
           for prefix, long in (("by-", dict(nc="nc", sa="sa", nd="nd")), ("", dict(nc="nc", sa="sa", nd="nd")),
                                ("attribution-", dict(nc="noncommercial", sa="sharealike", nd="noderivatives")),
                                ("", dict(nc="noncommercial", sa="sharealike", nd="noderivatives")))
           for parts in (("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd"))},
        "noderivs": ("nd",), "attribution-noderivs": ("nd",), "attribution-noncommercial-noderivs": ("nc", "nd")}),
)
#: Version numbers as they are written; a template's must stand in the block.
VERSIONS = {form: f"{n}.{m}" for n in range(1, 5) for m in range(6)
            for form in ([f"{n}.{m}", f"v{n}.{m}"] + ([str(n), f"v{n}"] if m == 0 else []))}
#: Words on each side of a block that are read for such words too.
AROUND = 3


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, first of each text + total, start of every word); lower case, without marks."""
    data, offsets = K.text_buffers(texts)
    flat = data.copy()
    flat[np.isin(flat, np.frombuffer(b",;:\"'()[]#*/<>!%", np.uint8))] = 32
    edge = np.concatenate(([True], K._IS_SEP[flat] | (flat == 45), [True]))  # dashes count only between letters
    flat[(flat == 45) & (edge[:-2] | edge[2:])] = 32
    starts, ends, first = K.word_bounds(flat, offsets)
    ends = np.where((ends - starts > 1) & (flat[ends - 1] == 46) if len(ends) else np.zeros(0, bool), ends - 1, ends)
    return K._hash_spans(flat, starts, ends, K._BYTE_LOWER), first, starts


class Templates:
    """TF-IDF vectors of the templates over their own words."""

    def __init__(self, templates=TEMPLATES):
        self.names = [name for name, _ in templates]
        words, first, _ = tokens(pa.array([text for _, text in templates]))
        self.vocabulary = np.unique(words)
        def hashed(table: dict) -> dict:
            keys = list(table)
            return dict(zip(K.signed(tokens(pa.array(keys))[0]).tolist(), (table[k] for k in keys)))

        self.versions = hashed(VERSIONS)
        families = [(set(hashed(dict.fromkeys(signs))), hashed(marks)) for signs, marks in FAMILIES]
        self.demands = []  # of each template: its versions, its family's words, what they say
        for i in range(len(templates)):
            own = K.signed(words[first[i]:first[i + 1]]).tolist()
            marks = next((m for signs, m in families if signs & set(own)), {})
            self.demands.append(({self.versions[w] for w in own if w in self.versions}, marks,
                                 {x for w in own if w in marks for x in marks[w]}))
        self.lengths = np.unique(np.diff(first)).tolist()
        self.counts = np.zeros((len(templates), len(self.vocabulary)))
        for i in range(len(templates)):
            np.add.at(self.counts[i], np.searchsorted(self.vocabulary, words[first[i]:first[i + 1]]), 1)

    def weigh(self, document_counts: np.ndarray, documents: int) -> None:
        self.documents = documents
        self.idf = np.log((documents + 1) / (document_counts + 1)) + 1
        vectors = self.counts * self.idf
        self.vectors = vectors / np.linalg.norm(vectors, axis=1)[:, None]

    def find(self, words: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, -1 outside."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1)

    def agree(self, block: list[int], around: list[int]) -> np.ndarray:
        """Whether the words of a block and those around it tell the same licence of a family as each template."""
        versions = {self.versions[w] for w in block if w in self.versions}
        return np.array([need <= versions and says == {x for w in around if w in marks for x in marks[w]}
                         for need, marks, says in self.demands])

    def cosines(self, places: np.ndarray, others: float) -> np.ndarray:
        """Cosine of one block with every template; ``others``: squared length by the words outside the vocabulary."""
        tf = np.bincount(places[places >= 0], minlength=len(self.vocabulary)) * self.idf
        return self.vectors @ tf / np.sqrt((tf ** 2).sum() + others)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial document frequencies: word, n; the null word counts the rows."""
    for batch in batches:
        for part in K.chunks(batch, "text"):
            words, first, _ = tokens(part.column("text"))
            owner = np.repeat(np.arange(part.num_rows, dtype=np.uint64), np.diff(first))
            _, pick = np.unique(K.mix64(words + K.mix64(owner)), return_index=True)
            words, n = np.unique(words[pick], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([*K.signed(words).tolist(), None], pa.int64()),
                                              pa.array(np.append(n, part.num_rows), pa.int64())], names=["word", "n"])


def _blocks(t: Templates, owner: np.ndarray, line: np.ndarray, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first word, word after the last) of the blocks to compare; none crosses the end of a text."""
    n = len(owner)
    starts = np.append(np.flatnonzero(np.append(True, (np.diff(line) != 0) | (np.diff(owner) != 0))), n)
    for size in range(1, min(BLOCK, len(starts) - 1) + 1):
        a, b = starts[:-size], starts[size:]
        inside = owner[a] == owner[b - 1]
        yield a[inside], b[inside]
    for size in t.lengths:  # from a template word to another, whatever the line breaks
        if size <= n:
            a = np.flatnonzero(known[:n - size + 1] & known[size - 1:])
            a = a[owner[a] == owner[a + size - 1]]
            yield a, a + size


def _candidates(templates, keep: list[str]):
    """Each file with the words of the blocks that may match, and the blocks' bounds among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = templates.value
        for batch in batches:
            for part in K.chunks(batch, "text"):
                text = part.column("text")
                words, first, starts = tokens(text)
                found: list[tuple | None] = [None] * part.num_rows
                if len(words):
                    place = t.find(words)
                    known = place >= 0
                    data, _ = K.text_buffers(text)
                    line = np.searchsorted(np.flatnonzero(data == 10), starts)  # line feeds before each word
                    owner = np.repeat(np.arange(part.num_rows), np.diff(first))
                    # at most this much of a cosine's numerator, at least this much of its squared length
                    up = np.concatenate(([0.0], np.cumsum(np.where(known, (t.vectors.max(0) * t.idf)[place], 0.0))))
                    down = np.concatenate(([0.0], np.cumsum(np.where(known, t.idf[place] ** 2, 1.0))))
                    count = np.concatenate(([0], np.cumsum(known)))
                    spans: dict[int, list[tuple[int, int]]] = {}
                    for a, b in _blocks(t, owner, line, known):
                        may = (count[b] - count[a] >= 2) & (
                            up[b] - up[a] >= (COSINE - 1e-6) * np.sqrt(np.maximum(down[b] - down[a], 0)))
                        for x, y in zip(a[may].tolist(), b[may].tolist()):
                            other = int(y - x - (count[y] - count[x]))
                            if t.cosines(place[x:y], other).max() >= COSINE - 1e-9:
                                spans.setdefault(int(owner[x]), []).append((x, y))
                    for d, pairs in spans.items():
                        held = np.zeros(first[d + 1] - first[d], bool)
                        for x, y in pairs:
                            held[max(0, x - first[d] - AROUND):y - first[d] + AROUND] = True
                        at = np.concatenate(([0], np.cumsum(held)))
                        found[d] = (K.signed(words[first[d]:first[d + 1]][held]).tolist(),
                                    [int(at[x - first[d]]) for x, _ in pairs], [int(at[y - first[d]]) for _, y in pairs])
                lists = [pa.array([f and f[i] for f in found], pa.list_(pa.int64())) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *lists, pa.array(np.diff(first), pa.int64())],
                                                 names=[*keep, "words", "a", "b", "total"])
    return run


def _named(templates, keep: list[str]):
    """License, cosine and share of files with candidates, from their words' frequencies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = templates.value
        for batch in batches:
            best = [_best(t, *row) for row in zip(*(batch.column(c).to_pylist() for c in ("words", "a", "b", "total", "freq")))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([x[0] for x in best], pa.string()),
                 pa.array([x[1] for x in best], pa.float64()), pa.array([x[2] for x in best], pa.float64())],
                names=[*keep, "license", "cosine", "share"])
    return run


def _best(t: Templates, words: list, begins: list, ends: list, total: int, freq: list) -> tuple[str | None, float, float]:
    """(licence, cosine, percent of the words inside matching blocks) of one text."""
    weight = {x["word"]: float(np.log((t.documents + 1) / (x["n"] + 1)) + 1) for x in freq}
    words = np.array(words, np.int64)
    place = t.find(words.view(np.uint64))
    best, name, inside = 0.0, None, np.zeros(len(words), bool)
    for x, y in zip(begins, ends):
        others, n = np.unique(words[x:y][place[x:y] < 0], return_counts=True)
        length = float(((n * np.array([weight[w] for w in others.tolist()])) ** 2).sum())
        cosines = np.where(t.agree(words[x:y].tolist(), words[max(0, x - AROUND):y + AROUND].tolist()),
                           t.cosines(place[x:y], length), 0.0)
        k = int(cosines.argmax())
        if cosines[k] >= COSINE - 1e-12:
            inside[x:y] = True
            if cosines[k] > best + 1e-12:
                best, name = float(cosines[k]), t.names[k]
    return name, best, 100.0 * inside.sum() / total


def _directory(path: Column) -> Column:
    """Directory of a path, without a trailing slash; '' at the top."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def own_licenses(files: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``files`` (key, path, text) -> key, path, license, cosine, share (percent of the words)."""
    t = Templates(templates)
    words = stored(files.select("text").mapInArrow(_frequencies, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")), "licenses-words")
    own = K.signed(t.vocabulary).tolist()
    counts = {r.word: r.n for r in words.where(F.col("word").isNull() | F.col("word").isin(own)).collect()}  # the templates' words
    t.weigh(np.array([counts.get(w, 0) for w in own], np.float64), int(counts.get(None, 0)))
    shared = files.sparkSession.sparkContext.broadcast(t)
    kind = files.schema["key"].dataType.simpleString()
    found = stored(files.mapInArrow(
        _candidates(shared, ["key", "path"]),
        f"key {kind}, path string, words array<long>, a array<long>, b array<long>, total long").withColumn(
        "uid", F.monotonically_increasing_id()), "licenses-blocks")
    some = found.where("words is not null")
    freq = some.select("uid", F.explode(F.array_distinct("words")).alias("word")).join(words, "word").groupBy("uid").agg(
        F.collect_list(F.struct("word", "n")).alias("freq"))
    named = some.join(freq, "uid").select("key", "path", "words", "a", "b", "total", "freq").mapInArrow(
        _named(shared, ["key", "path"]), f"key {kind}, path string, license string, cosine double, share double")
    return named.unionByName(found.where("words is null").select(
        "key", "path", F.lit(None).cast("string").alias("license"), F.lit(0.0).alias("cosine"), F.lit(0.0).alias("share")))


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text",
         templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, path, license, cosine (null if inherited), origin, stated_in.

    origin is ``own``, ``inherited`` or ``none``; stated_in is the directory an inherited licence comes from.
    """
    files = docs.select(F.col(id_col).alias("key"), path.cast("string").alias("path"), F.col(text_col).alias("text"))
    found = stored(own_licenses(files, templates), "licenses-own").withColumn("dir", _directory(F.col("path")))
    name = F.regexp_extract("path", r"[^/]*$", 0)
    stated = found.where(F.col("license").isNotNull() & F.col("dir").isNotNull()
                         & ((F.col("share") >= SHARE) | name.rlike(LICENSE_NAMES)))
    stated = stated.groupBy(F.col("dir").alias("stated_in")).agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("s")).select(
        "stated_in", F.col("s.license").alias("given"))
    # every distinct directory with each of its ancestors and itself; depth is the number of its parts
    dirs = found.where("license is null and dir is not null").select("dir").distinct()
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    up = dirs.select("dir", parts.alias("parts")).select("dir", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("parts")), lambda n: F.struct(
            n.alias("depth"), F.array_join(F.slice("parts", 1, n), "/").alias("at")))).alias("a"))
    nearest = up.select("dir", "a.depth", F.col("a.at").alias("stated_in")).join(stated, "stated_in").groupBy("dir").agg(
        F.max(F.struct("depth", "stated_in", "given")).alias("n")).select("dir", "n.stated_in", "n.given")
    both = found.join(nearest, "dir", "left")
    return both.select(
        F.col("key").alias("doc_id"), "path", F.coalesce("license", "given").alias("license"),
        F.when(F.col("license").isNotNull(), F.col("cosine")).alias("cosine"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("license").isNull(), F.col("stated_in")).alias("stated_in"))
