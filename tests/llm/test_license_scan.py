import re

import pytest

from tallyhouse.llm.license_scan import DRIFT, PHRASES, SHARE, TEMPLATES, license_labels, op12_license_scan, template_rows


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_base(text):
    """The contract's base, place by place."""
    w = plain_words(text)
    places = [(i, label) for label, phrase in PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def plain_labels(text):
    """Labels and score with all words of the text against all of each template."""
    w, found, best = plain_words(text), set(plain_base(text)[4].split(",")) - {""}, float(bool(plain_base(text)[1]))
    for label, notice, core in TEMPLATES:
        t, c = notice.split(), core.split()
        hits = [(p - q, q) for p in range(len(w) - 2) for q in range(len(t) - 2) if w[p : p + 3] == t[q : q + 3]]
        for d in {d for d, _ in hits}:
            at = {q for e, q in hits if abs(e - d) <= DRIFT}
            score = len({q + i for q in at for i in range(3)}) / len(t)
            best = max(best, score)
            i = next(i for i in range(len(t)) if t[i : i + len(c)] == c)
            if score >= SHARE and set(range(i, i + len(c) - 2)) <= at:
                found.add(label)
    return ",".join(sorted(found)), best


TEXTS = [
    None, "", "cc", "cc by", "CC BY-NC", "cc by nc by cc by nc", "Ünder the MIT license", "under the mit\x00license", "under the mit license " * 40,
    "Words before. Released under the MIT License. Words after.", "released under the very mit license", "Released under the MIT licence",
    "This work is licensed under the GNU General Public License, version 3.", "this work is now licensed under the gnu general public license",
    "licensed under the gnu affero general public license", "licensed under the gnu affero general public license or the GNU Lesser General Public License",
    "Apache License, Version 2.0", "licensed under the apache license version 2 0", "the apache licence", "licensed under cc by 4.0", "licensed under cc by-sa 4.0",
    "Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and its associated documentation files",
    "permission is hereby granted. " * 30 + "free of charge", "the gnu general public license the gnu general public license", "under the mit license " + "filler words here " * 500 + " cc by nc",
]


def test_against_every_place(spark, stored, tmp_path):
    stored([(i, t, None, None, None) for i, t in enumerate(TEXTS)], "doc_id long, text string, label string, template string, at long")
    found = op12_license_scan(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    assert got == {i: (*plain_base(t), *plain_labels(t)) for i, t in enumerate(TEXTS)}
    label = {t: got[i][5] for i, t in enumerate(TEXTS)}
    assert label["Released under the MIT licence"] == "" and label["released under the very mit license"] == ""
    assert label["this work is now licensed under the gnu general public license"] == "gpl"
    assert label["licensed under the gnu affero general public license"] == "agpl"
    assert label["licensed under cc by-sa 4.0"] == "cc-by-sa" and label["licensed under cc by 4.0"] == ""


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in op12_license_scan(spark, sf).collect()}
    assert got == {r.doc_id: (*plain_base(r.text), *plain_labels(r.text)) for r in docs}


def test_spans(spark):
    notice = "You may not use this file, except in full compliance with the license."
    docs = spark.createDataFrame([(1, "one two three " + notice + " four " + notice)], "doc_id long, text string")
    row = license_labels(docs).first()
    assert [(s["label"], s["first"], s["last"]) for s in row.spans] == [("apache-2", 3, 15), ("apache-2", 17, 29)]
    assert row.n_base == 0 and row.labels == "apache-2"


def test_odd_rows(spark, odd_docs, no_docs):
    assert op12_license_scan(spark, no_docs).collect() == []
    folder = odd_docs(["released under the mit license"])
    got = op12_license_scan(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    key = lambda t: tuple((v is None, str(v)) for v in t)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((r.doc_id, *plain_base(r.text), *plain_labels(r.text)) for r in docs), key=key)


def test_templates_are_checked():
    with pytest.raises(ValueError):
        template_rows((("x", "two words"),), ())
    with pytest.raises(ValueError):
        template_rows((), (("x", "a b c d", "b d e"),))


def test_plan_has_no_python(spark, sf):
    plan = op12_license_scan(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
