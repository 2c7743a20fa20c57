"""The stages against plain versions of them, each on what the one before kept."""

import re

import corpus_pipeline
from tallyhouse.llm.toxicity import op7_toxicity
from tests.llm.conftest import DOCS
from tests.llm.test_decontaminate import WORD, words
from tests.llm.test_packing import by_id, check
from tests.llm.test_repeats import gone
from tests.llm.test_simhash import plain as groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_words(text, own):
    return " ".join(w for w, g in zip(re.findall(r"[^\x20\x09-\x0D]+", text), own.tolist(), strict=True) if not g) if own.any() else text


def without_phrases(text, phrases):
    own, hit = words(text), set()
    for i in range(len(own)):
        for n in {len(p) for p in phrases}:
            if tuple(own[i : i + n]) in phrases:
                hit |= set(range(i, i + n))
    bounds = [m.span() for m in WORD.finditer("".join(c.lower() if "A" <= c <= "Z" else c for c in text))]
    for i in sorted(hit, reverse=True):
        end = bounds[i + 1][0] if i + 1 in hit else bounds[i][1]
        text = text[: bounds[i][0]] + text[end:]
    return text


def test_stages(spark, sf, tmp_path):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    toxic = {r.doc_id for r in op7_toxicity(spark, sf).collect() if r.predicted}
    want = {i: r.text for i, r in docs.items() if i not in toxic}
    steps = [dict(want)]
    want = {i: want[i] for i, _, first in groups(list(want.items())) if i == first}
    steps.append(dict(want))
    texts = {i: re.findall(r"[^\x20\x09-\x0D]+", t) for i, t in want.items()}
    want = {i: without_words(want[i], own) for i, own in zip(texts, gone(list(texts.values()), 35), strict=True)}
    steps.append(dict(want))
    phrases = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        own = words(r.text)
        phrases |= {tuple(own[p : p + 10]) for p in range(max(1, len(own) - 9))} if own else set()
    want = {i: without_phrases(t, phrases) for i, t in want.items()}
    steps.append(dict(want))

    at = spark.read.parquet(f"{sf}/documents.parquet")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, sf).write.parquet(str(tmp_path / str(n)))
        before, at = at, spark.read.parquet(str(tmp_path / str(n)))
        if n < 4:
            assert at.columns == COLUMNS
            rows = at.collect()
            got = {r.doc_id: r.text for r in rows}
            assert got.keys() == steps[n].keys(), n
            assert [(n, i, t, steps[n][i]) for i, t in got.items() if t != steps[n][i]] == []
            assert all(r.n_chars == len(r.text) and (r.lang, r.source) == (docs[r.doc_id].lang, docs[r.doc_id].source) for r in rows)
    check(at.collect(), by_id(before))
    assert len(steps[0]) < len(docs) and steps[1].keys() < steps[0].keys() and steps[2] != steps[1]


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.count() > 0 and "sequence_id" in rows.columns


def test_odd_and_empty_rows(spark, odd_docs, stored, tmp_path):
    path = odd_docs()
    stored([(1, 0, 1), (3, 0, 0)], "doc_id long, quality int, toxic int", "labels")
    stored([(1, "the quick brown fox " * 5)], "item_id long, text string", "benchmark")
    assert corpus_pipeline.run(spark, path).count() > 0
    stored([], DOCS)
    assert corpus_pipeline.run(spark, path).count() == 0
