"""Licence rules on published texts, odd rows, and the query next to its SQL."""

import os

import pytest
from pyspark.sql import functions as F

from check import connect, difference
from corpusloom.llm.licences import PUBLISHED, RULES, SENTENCES, cue_words, licence_scan, normal_form
from corpusloom.llm.queries import SQL, op7_licences

MIT = f"""MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

{SENTENCES["mit-condition"]}.
"""
CASES = [
    (None, ""), ("", ""), ("no licence here", ""), (MIT, "MIT"), (MIT.upper(), "MIT"),
    ("words without an end\nReleased under the MIT License.\nmore", "MIT"),
    ("RELEASED   under the\tMIT license!! x", "MIT"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Licensed under the Apache License,\nVersion 2.0.", "Apache-2.0"),
    ("Licensed under CC BY-NC 4.0. Released under the MIT License.", "CC-BY-NC-4.0,MIT"),
    ("It says: Released under the MIT License today.", ""),
    ("Unreleased under the MIT License.", ""),
    (f"{SENTENCES['bsd-grant']}:\n\n{SENTENCES['bsd-source']}.\n{SENTENCES['bsd-binary']}.\n", "BSD-2-Clause"),
    (f"{SENTENCES['bsd-grant']}: {SENTENCES['bsd-source']}. {SENTENCES['bsd-binary']}. {SENTENCES['bsd-names']}.", "BSD-3-Clause"),
    (f"{SENTENCES['bsd-binary']}. {SENTENCES['bsd-source']}. {SENTENCES['bsd-grant']}.", ""),
    ("All rights reserved.\r\n" * 3, "All-rights-reserved"),
    ("word " * 200_000 + ".\nReleased under the MIT License", "MIT"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("licences"))
    rows = [(i, text, "x") for i, (text, _) in enumerate(CASES)]
    spark.createDataFrame(rows, "doc_id long, text string, licences string").write.parquet(os.path.join(path, "documents"))
    (spark.read.parquet(os.path.join(path, "documents")).repartition(1).write.parquet(os.path.join(path, "documents.parquet")))
    return path


def test_cases(spark, folder):
    got = {r["doc_id"]: r["licences"] for r in op7_licences(spark, folder).collect()}
    assert [got[i] for i in range(len(CASES))] == [licences for _, licences in CASES]


def test_cases_equal_sql(spark, folder):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    assert difference(op7_licences(spark, folder), con.sql(SQL["op7_licences"])) is None


def test_query_equals_sql(spark, small):
    query = op7_licences(spark, small)
    assert difference(query, connect(small).sql(SQL["op7_licences"])) is None
    assert query.where("licences <> ''").count() > 0
    assert "Python" not in query._jdf.queryExecution().toString()


def test_every_rule_names_known_sentences():
    assert {part for _, parts in RULES for part in parts} <= set(SENTENCES)
    cues = cue_words(SENTENCES)
    assert all(any(c in normal_form(s) for c in cues) for s in SENTENCES.values())


def test_every_sentence_alone_is_found(spark):
    df = spark.createDataFrame(list(SENTENCES.items()), "name string, text string")
    got = {r["name"]: r["s"]["sentences"] for r in df.select("name", licence_scan(F.col("text")).alias("s")).collect()}
    split = {"mpl-2-notice", "gpl-3-grant"}  # they have an end mark inside
    assert all(got[name] == [name] for name in SENTENCES if name not in split)


GRANT = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU {} General Public License as
    published by the Free Software Foundation, either version 3 of the
    License, or (at your option) any later version.

    This program is distributed in the hope that it will be useful,
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. {}. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


PUBLISHED_CASES = [
    (MPL.format("2.0"), "MPL-2.0"), (MPL.format("1.1"), ""), (SENTENCES["mpl-2-notice"], "MPL-2.0"),
    ("2.0. " + MPL.format("2.0") + "2.0. Released under the MIT License.", "MIT,MPL-2.0"),
    (GRANT.format("Lesser"), "LGPL-3.0-or-later"), (GRANT.format("Affero"), "AGPL-3.0-or-later"),
    (" ".join(GRANT.format("Lesser").replace("program", "library").split()), "LGPL-3.0-or-later"),
    (SENTENCES["gpl-3-grant"] + ".", "GPL-3.0-or-later"),
]


def test_published_headers(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PUBLISHED_CASES)], "i int, text string")
    found = df.select("i", licence_scan(F.col("text")).alias("s")).collect()
    got = {r["i"]: ",".join(r["s"]["licences"]) for r in found}
    assert [got[i] for i in range(len(PUBLISHED_CASES))] == [licences for _, licences in PUBLISHED_CASES]


def test_published_headers_equal_sql(spark, tmp_path):
    import duckdb

    texts = [t for t, _ in PUBLISHED_CASES] + list(SENTENCES.values()) + list(PUBLISHED.values())
    texts += [f"{a}.\n{b}\n" for a, b in zip(texts, texts[1:])]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}/*.parquet'")
    query = op7_licences(spark, str(tmp_path))
    assert difference(query, con.sql(SQL["op7_licences"])) is None
    assert query.where("licences <> ''").count() > 40


def test_no_rows(spark):
    empty = spark.createDataFrame([], "text string")
    assert empty.select(licence_scan(F.col("text"))).collect() == []
