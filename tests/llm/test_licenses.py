"""License scan: places of base phrases by brute force, notices with changed words, odd rows."""

from __future__ import annotations

import re

from partwise.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    starts, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


CASES = [
    None, "", " .,", "CC BY", "cc-by cc by CC.BY", "all rights reserved All Rights Reserved", "General\nPublic\tLICENSE v3", "generals public license",
    "accc by", "cc Kby by", "éall rights reserved", "all rights reservedé", "x " * 3000 + "all rights reserved " + "y " * 3000 + "cc by", "all all rights reserved",
    "Licensed under CC BY-NC 4.0.", "word", "İcc by ß",
]


def test_base(spark):
    rows = [(i, t, 1) for i, t in enumerate(CASES)] + [(3, "CC BY", 1), (3, "CC BY", 2), (None, "cc by x cc by", 1)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string, n_words int")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    assert sorted([tuple(r)[:6] for r in got], key=key) == sorted([(d, *brute(t)) for d, t, _ in rows], key=key)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_notices(spark):
    near = "Permission is hereby granted, free of any charge, to a person obtaining a copy of this software and the associated documentation files"
    texts = {
        1: "Intro words. Licensed under the Apache License, Version 2.0.", 2: "Released under the MIT License.", 3: near, 4: "permission is not what this software is about, free of charge",
        5: "This work is licensed under the GNU General Public License, version 3.", 6: "apache license of the mit people",
    }
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert got[1] == "apache-2.0" and got[2] == "mit" and got[4] == "" and got[6] == ""
    assert "gpl" in got[5].split(",") and "gpl-3.0" in got[5].split(",")
    assert got[3] == "mit"


def test_changed_words_and_versions(spark):
    """One word changed, put in or left out; versions and kinds are told apart."""
    wanted = {
        "Released under the popular MIT license": "mit", "It is released under an MIT license.": "mit", "Released under MIT license": "mit",
        "Licensed under an Apache license, version 2.0": "apache-2.0", "Licensed under the Apache license 2.0": "apache-2.0",
        "Licensed under a CC BY-NC 4.0": "cc-by,cc-by-nc-4.0", "licensed under CC BY-SA 4.0": "cc-by,cc-by-sa-4.0",
        "licensed under the GNU General Public License version 3.": "gpl", "This work is licensed under the GNU General Public License version 3.": "gpl,gpl-3.0",
        "This work is licensed under the GNU General Public License version 2.": "gpl,gpl-2.0", "This work is licensed under the GNU General Public License version 4.": "gpl",
        "This work was licensed under the GNU General Public License, version 2": "gpl,gpl-2.0", "This book is licensed under the GNU General Public License version 3": "gpl,gpl-3.0",
        "Released under the BSD license": "", "Licensed under the Eclipse license version 2.0": "", "licensed under CC BY 4.0": "cc-by",
    }
    rows = list(enumerate(wanted))
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {t: got[i] for i, t in rows} == wanted


def test_texts_are_read_once(spark, scratch):
    spark.createDataFrame([(1, "cc by")], "doc_id bigint, text string").write.parquet(f"{scratch}/docs")
    plan = licenses.scan(spark.read.parquet(f"{scratch}/docs"))._jdf.queryExecution().executedPlan().toString()
    assert f"{scratch}/docs" not in plan  # what is left reads the stored matches


def test_empty(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
