from __future__ import annotations

import textwrap

from pyspark.sql import functions as F

from tests.llm.tables import documents
from tidepool.llm import licences as L

MIT = dict(L.TEXTS)["MIT"]


def test_equivalent_texts_are_found(spark, awkward):
    changed = MIT.upper().replace("COPIES", "COPIES").replace('"', "'").replace(". ", ".\n  ")
    docs = [(1, MIT), (2, f"Copyright (c) 2020 Someone\n\n{changed}"), (3, f"/* (C) 1999 X */\n{MIT}"), (4, MIT + " Extra words."),
            (5, "some prose\n# Licensed under the APACHE Licence, version 2.0\nmore prose"), (6, "Released under the MIT License."),
            (7, "Released under the MIT License.\nReleased under the MIT license"), (8, "a licence to copy"), *[(100 + (k or 0), t) for k, t in awkward]]
    found = {(r["id"], r["scope"], r["licence_id"], r["found"]) for r in
             L.licences(documents(spark, docs).withColumns({"digest": F.lit(1), "unit": F.lit(2), "lines": F.lit(3)}), L.known_licences(spark)).collect()}
    assert found == {(1, "text", "MIT", 1), (2, "text", "MIT", 1), (3, "text", "MIT", 1), (5, "line", "Apache-2.0", 1),
                     (6, "text", "MIT", 1), (6, "line", "MIT", 1), (7, "line", "MIT", 2)}


def test_empty_tables_and_double_texts(spark):
    known = L.known_licences(spark)
    assert L.licences(documents(spark, []), known).count() == 0
    assert L.licences(documents(spark, [(1, MIT)]), known.where("false")).count() == 0
    twice = spark.createDataFrame([("b", "Some Text!"), ("a", "some text"), (None, "other"), ("c", None), ("d", " ")], known.schema)
    assert [r["licence_id"] for r in L.digests(twice).collect()] == ["a"]
    rows = L.licences(documents(spark, [(1, "SOME text"), (1, "some, text"), (None, "some text")]), twice).collect()
    assert {(r["id"], r["scope"], r["found"]) for r in rows} == {(1, "text", 2), (1, "line", 2), (None, "text", 1), (None, "line", 1)}


def test_licences_have_different_digests(spark):
    rows = L.digests(L.known_licences(spark)).collect()
    assert {r["licence_id"] for r in rows} >= {"MIT", "ISC", "0BSD", "Apache-2.0"} and len(rows) >= len(L.NOTICES) + len(L.TEXTS)


def test_every_known_text_with_holders_and_any_line_ends(spark):
    known = L.known_licences(spark)
    ids = [(k, name) for k, (name, _) in enumerate(L.TEXTS)]
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0",
            "CC0-1.0"} <= {name for _, name in ids}
    lines = ["Copyright Jane Doe 2019", "Copyright The Foo Authors", "# Copyright: Ona Holdersson", "(c) Some Body",
             "Copyright (c) 2001, A. B.", "All rights reserved."]
    docs = [(k, "\n".join([*lines, "", text])) for k, (_, text) in enumerate(L.TEXTS)]
    found = {(r["id"], r["licence_id"]) for r in
             L.licences(documents(spark, docs), known).where("scope = 'text'").collect()}
    assert found == set(ids)
    words = ("copyright notice", "copyright holder is", "the", "copyright the", "(c) you must", "copyright law:", "and")
    kept = spark.createDataFrame([("\n".join(words),)], "text string").select(L.joined(L.canonical_lines(F.col("text")))).first()[0]
    assert kept == "copyright notice copyright holder is the copyright the c you must copyright law and"
    for name, text in L.TEXTS:
        if name in ("BSD-3-Clause", "MIT", "GPL-3.0", "LGPL-2.1"):
            own = text.split("\n\n")
            docs = [(w, "\n\n".join(part if "opyright (" in part else textwrap.fill(part, w, break_long_words=False) for part in own))
                    for w in range(30, 110, 8)]
            rows = L.licences(documents(spark, docs), known).where("scope = 'text'").collect()
            assert {(r["id"], r["licence_id"]) for r in rows} == {(w, name) for w, _ in docs}, name
