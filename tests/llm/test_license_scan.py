import random

import pytest

from strata.llm import license_scan as ls


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")


LINES = {
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under CC BY-NC 4.0.": "creative-commons",
    "All rights reserved.": "all-rights-reserved",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.": "lgpl",
    "Redistribution and use in source and binary forms, with or without modification, are permitted.": "bsd",
}
PLAIN = [
    "The licence office is closed on Monday.",
    "A free version of the game was released.",
    "Is the erresh, of of lyestion, was and.",
    "All the seats were reserved.",
]


def test_held_out_lines(spark, docs):
    rows = [(i, f"Some words before. {x}\nOther words after it.") for i, x in enumerate([*LINES, *PLAIN])]
    rows += [(90, None), (91, ""), (92, " \n .. "), (0, rows[0][1]), (93, "word " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as unit", "2 as family")
    got = ls.find_licences(df.unionByName(docs.selectExpr("doc_id + 1000 as doc_id", "text", "1 as unit", "2 as family")))
    found = sorted((r.doc_id, r.family) for r in got.where("confirmed and doc_id < 1000").collect())
    assert found == sorted([(i, f) for i, f in enumerate(LINES.values())] + [(0, "mit")])


def test_query_finds_the_lines_of_the_corpus(spark, docs):
    text = {r.doc_id: r.text for r in docs.collect()}
    want = {(i, f) for i, t in text.items() for line in (t or "").split("\n") for x, f in LINES.items() if line == x}
    got = {(r.doc_id, r.family) for r in ls.op3(spark, "/root/testdata/sf0.001").collect()}
    assert want and got == want


def test_empty_table(spark, docs):
    assert ls.find_licences(docs.limit(0)).count() == 0


def test_notices_inside_longer_sentences(spark, docs):
    texts = {
        "Copyright 2021 Acme Data Systems GmbH, Berlin; released under the MIT License.": "mit",
        "The tool is given to all our partners, licensed under the Apache License, Version 2.0 and available from the project page.": "apache-2.0",
    }
    rows = [(i + 1000, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs)
    got = ls.find_licences(df).where("confirmed and doc_id >= 1000").select("doc_id", "family").collect()
    assert sorted(map(tuple, got)) == [(i + 1000, f) for i, f in enumerate(texts.values())]


def test_parts_of_notices(spark, docs):
    """Openings and clauses of a notice are named by its family."""
    lines = {
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.": "mit",
        "Distributed under the terms of the Apache License 2.0.": "apache-2.0",
        "Redistributions of source code must retain the above copyright notice, this list of conditions.": "bsd",
    }
    rows = [(i + 1000, t) for i, t in enumerate(lines)]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs)
    got = ls.find_licences(df).where("confirmed and doc_id >= 1000").select("doc_id", "family").collect()
    assert sorted(map(tuple, got)) == [(i + 1000, f) for i, f in enumerate(lines.values())]


def _ordinary(spark, n):
    """Rows of 20 sentences each; every tenth ends with a licence line."""
    rng = random.Random(5)
    words = ["the", "of", "and", "to", "in", "this", "is", "with", "mit", "file", "free", *(f"w{i}" for i in range(40))]
    rows = []
    for i in range(n):
        lines = [" ".join(rng.choices(words, k=rng.randint(1, 12))).capitalize() + "." for _ in range(20)]
        rows.append((i, "\n".join(lines + ([list(LINES)[i // 10 % len(LINES)]] if i % 10 == 0 else []))))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_a_larger_corpus_of_the_same_units_gives_the_same_answers(spark):
    """Model and bound come from all units, so they do not change with the corpus's size."""
    small = _ordinary(spark, 200)
    large = small.crossJoin(spark.range(25).withColumnRenamed("id", "copy"))
    answers = [
        {(r.unit, r.family): (r["count"], r.probability) for r in ls.find_licences(df).groupBy("unit", "family", "probability").count().collect()}
        for df in (small, large)
    ]
    assert answers[0] and answers[0].keys() == answers[1].keys()
    for key, (n, p) in answers[0].items():
        assert answers[1][key] == (25 * n, pytest.approx(p, abs=0.002))


def test_every_ordinary_unit_trains(spark):
    rows = [(1, "Of the\nalone.\n\nIn the Of the"), (2, None), (3, "Of the\nAll rights reserved."), (4, "Other words.")]
    kept = ls.kept_units(spark.createDataFrame(rows, "doc_id long, text string"), ("doc_id",))
    got = ls.training_rows(kept).where("n0 + n1 > 0").collect()
    assert {tuple(r.terms): r.n0 + r.n1 for r in got} == {("of the",): 2, ("in the", "of the"): 1, (): 2}
    assert all(r.n == r.n0 + r.n1 and r.label == 0 for r in got)
