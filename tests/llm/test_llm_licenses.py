from __future__ import annotations

from pyspark.sql import functions as F

from quitanda.llm import licenses

SCHEMA = "doc_id long, path string, text string"
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this\nsoftware and associated documentation files"
APACHE = "# Licensed under the Apache License, Version 2.0."


def scan(df):
    return {(r.doc_id, r.path): (r.license, r.origin, r.stated_in) for r in licenses.scan(df, F.col("path")).collect()}


def test_headers_and_inheritance(spark):
    filler = "\n".join(f"some other words that say nothing {i}" for i in range(60))
    rows = [
        (1, "a/LICENSE", MIT + "\n" + filler), (2, "a/x.py", "code"), (3, "a/b/c/y.py", "code"),
        (4, "a/b/COPYING.txt", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                               "General Public License as published by the Free Software Foundation, either version 3 of the License\n" + filler),
        (5, "a/b/z.py", filler + "\n" + APACHE + "\n" + filler), (6, "a/b/c/d/e.py", "more"), (7, "other/f.py", "code"),
        (8, "top.py", "code"), (9, None, "code"), (10, None, APACHE), (11, "ab/x.py", "code"),
        (12, "all/header.txt", APACHE), (13, "all/in/it", None), (14, "a/b/c/", "")]
    got = scan(spark.createDataFrame(rows, SCHEMA))
    assert got == {
        (1, "a/LICENSE"): ("MIT", "own", None), (2, "a/x.py"): ("MIT", "inherited", "a"),
        (3, "a/b/c/y.py"): ("GPL-3.0", "inherited", "a/b"), (4, "a/b/COPYING.txt"): ("GPL-3.0", "own", None),
        (5, "a/b/z.py"): ("Apache-2.0", "own", None), (6, "a/b/c/d/e.py"): ("GPL-3.0", "inherited", "a/b"),
        (7, "other/f.py"): (None, "none", None), (8, "top.py"): (None, "none", None), (9, None): (None, "none", None),
        (10, None): ("Apache-2.0", "own", None), (11, "ab/x.py"): (None, "none", None),
        (12, "all/header.txt"): ("Apache-2.0", "own", None), (13, "all/in/it"): ("Apache-2.0", "inherited", "all"),
        (14, "a/b/c/"): ("GPL-3.0", "inherited", "a/b")}


def test_top_level_license_reaches_everything(spark):
    got = scan(spark.createDataFrame([(1, "LICENSE", MIT), (2, "x", "c"), (3, "d/e/x", "c")], SCHEMA))
    assert got[2, "x"] == ("MIT", "inherited", "") and got[3, "d/e/x"] == ("MIT", "inherited", "")


def test_every_planted_line_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    truth = {}
    for r in docs.collect():
        own = {k for k, v in lines.items() if v in r.text.split("\n")}
        if own:
            truth[r.doc_id] = own
    got = {r.doc_id: r.license for r in licenses.scan(docs, F.concat_ws("/", "source", F.col("doc_id").cast("string"))).where(
        "origin = 'own'").collect()}
    assert truth and set(got) == set(truth)
    assert all(got[d] in own for d, own in truth.items())


def test_awkward_rows(spark, awkward, clashing, empty_docs):
    path = F.concat_ws("/", F.col("source"), F.col("doc_id").cast("string"))
    rows = licenses.scan(awkward, path).collect()
    assert len(rows) == awkward.count() and {r.origin for r in rows} == {"none"}
    assert len(licenses.scan(clashing, path).collect()) == len(rows)
    assert licenses.scan(empty_docs, path).collect() == []


def test_same_licence_in_a_larger_corpus(spark):
    """A header's licence does not depend on the number of documents."""
    rows = [(0, None, "Project Foo is released under the MIT License."), (1, None, "// " + APACHE[2:]), (2, None, APACHE)]
    rows += [(i, None, f"a project is number {i % 7} and foo of it") for i in range(3, 40)]
    small = spark.createDataFrame(rows, SCHEMA)
    large = small.crossJoin(spark.range(1000).select(F.col("id").alias("copy"))).drop("copy")
    want = {0: "MIT", 1: "Apache-2.0", 2: "Apache-2.0"}
    for docs in (small, large):
        found = licenses.scan(docs, F.col("path")).where("doc_id < 3").select("doc_id", "license").distinct().collect()
        assert {r.doc_id: r.license for r in found} == want and len(found) == 3


def test_notice_inside_a_long_line(spark):
    prose = "The library parses configuration files quickly and safely on every platform we tried."
    text = f"{prose} Released under the MIT License. {prose}"
    got = scan(spark.createDataFrame([(1, None, text), (2, None, prose), (3, None, f"{prose} {APACHE[2:]} {prose}")], SCHEMA))
    assert [got[i, None][0] for i in (1, 2, 3)] == ["MIT", None, "Apache-2.0"]


def test_confusable_licences(spark):
    gnu = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
           "as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version.")
    cc = "This work is licensed under a Creative Commons Attribution{} {} International License."
    cases = [
        (gnu.format("program", "", "2"), "GPL-2.0"), (gnu.format("program", "", "3"), "GPL-3.0"),
        (gnu.format("library", "Lesser ", "2.1"), "LGPL-2.1"), (gnu.format("program", "Affero ", "3"), "AGPL-3.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        (cc.format("-ShareAlike", "4.0"), "CC-BY-SA-4.0"), (cc.format("", "4.0"), "CC-BY-4.0"), (cc.format("", "3.0"), None),
        (cc.format("-NonCommercial-NoDerivatives", "4.0"), None), (cc.format("-NonCommercial", "4.0"), "CC-BY-NC-4.0"),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Licensed under CC BY-NC-ND 4.0.", None),
        ("Licensed under the Apache License, Version 1.1.", None)]
    rows = [(i, None, text) for i, (text, _) in enumerate(cases)]
    rows += [(100 + i, None, f"other words of no licence {i}") for i in range(50)]
    got = scan(spark.createDataFrame(rows, SCHEMA))
    assert [(text, got[i, None][0]) for i, (text, _) in enumerate(cases)] == cases
