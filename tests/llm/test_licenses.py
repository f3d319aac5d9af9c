import re
import time

import __spark_entry__ as driver
from bundlescope.llm import licenses

FOLDER = "/root/testdata/sf0.001"


def test_matches_sql(spark, duck):
    frame = driver.queries()["op9_license_scan"](spark, FOLDER)
    cursor = duck.execute(driver.oracle_sql()["op9_license_scan"])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    want = sorted(cursor.fetchall())
    assert sorted(tuple(r) for r in frame.select(*names).collect()) == want
    assert any(row[names.index("n_base")] for row in want)


def plain(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for t in licenses.BASE:
        for k in range(len(words)):
            if words[k : k + len(t.words)] == t.words:
                starts.append(k)
                labels.add(t.label)
    return len(words), sorted(starts), sorted(labels)


def test_odd_texts(spark, tmp_path):
    texts = [
        None, "", "...", "CC-BY-NC 4.0", "cc by cc by cc by", "gnu general public license, version 3", "All\nrights; reserved!",
        "all rights all rights reserved reserved", "cc byé", "écc by", "Kcc by", "apache license " + "x " * 11 + "version 2.0",
        "apache license " + "x " * 12 + "version 2.0", "by " * 30000 + "cc by", "license public general", "1cc by", "cc 1 by",
    ]
    rows = [*enumerate(texts), (None, "mit license"), (3, "cc by"), (3, "cc by")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, words int")
    got = sorted((repr(r.doc_id), r.n_words, sorted(r.base_starts), r.base_labels) for r in licenses.scanned(docs).collect())
    assert got == sorted((repr(d), *plain(t)) for d, t in rows)
    by_id = {r.doc_id: r.labels for r in licenses.scanned(docs).collect()}
    assert by_id[11] == ["apache", "apache-2.0"] and by_id[12] == ["apache"] and by_id[None] == ["mit"]
    assert licenses.scanned(docs.where("false")).collect() == []


def test_no_python_on_the_main_path(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = licenses.scanned(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_labels(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = {}
    for t in licenses.TEMPLATES:
        long = [(at, w) for at, w in enumerate(t.words) if not t.sentence or len(w) >= 7]
        key = t.key.split()
        held = False
        for s in range(len(words)):
            if all(s + at < len(words) and words[s + at] == w for at, w in long):
                after = range(s + len(t.words), s + len(t.words) + 12)
                held |= not key or any(words[k : k + len(key)] == key for k in after)
        found.setdefault(t.label, []).append(held)
    shares = {label: sum(held) / len(held) for label, held in found.items()}
    return sorted(label for label, share in shares.items() if share), max(shares.values())


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction. The above copyright
notice and this permission notice shall be included in all copies or substantial portions of the Software."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. Unless required by applicable law or agreed to in writing, software distributed under the
License is distributed on an "AS IS" BASIS. See the License for the specific language governing permissions and
limitations under the License."""


def test_headers_of_licences(spark):
    texts = [
        MIT, f"MIT License\n\n{MIT}", APACHE, MIT.replace("hereby", "herewith"), MIT[:120], APACHE.replace("specific", "x y"),
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
        "x " * 500 + MIT + " y" * 500, f"{APACHE}\n{MIT}", "This is free and unencumbered software released into the public domain.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(docs).collect()}
    assert got == {n: plain_labels(t) for n, t in enumerate(texts)}
    assert got[1] == (["mit"], 1.0) and got[2] == (["apache", "apache-2.0"], 1.0) and got[9] == (["unlicense"], 1.0)


def test_long_texts_take_time_in_proportion(spark):
    """Texts of nothing but licence words: four times the words, not sixteen times the time."""
    seconds = []
    for count in (10_000, 10_000, 40_000):
        text = "license version general public " * (count // 4) + "cc by " * (count // 2)
        docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        started = time.perf_counter()
        [row] = licenses.scanned(docs).collect()
        seconds.append(time.perf_counter() - started)
        assert len(row.base_starts) == count // 2 + count // 4 - 1
    assert seconds[2] < seconds[1] * 6 + 2, seconds
