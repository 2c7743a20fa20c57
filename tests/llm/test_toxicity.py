import os
import zlib

import numpy as np
import pytest

from tallyhouse.llm.toxicity import distinct, drop_toxic, op7_toxicity, places

LABELS = "doc_id long, quality int, toxic int"


def test_grams_of_parts_are_those_of_the_whole():
    text = "Äbc déf gh\U0001f600 " * 50
    whole = sorted(x for p in places(text) for x in p.tolist())
    assert whole == sorted(x for p in places(text, 7) for x in p.tolist())
    assert len(whole) == sum(len(text) - n + 1 for n in (3, 4, 5))
    assert len(distinct("")) == 0 and len(distinct("ab")) == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="given tables not present")
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op7_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    own = [(toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    assert len(own) > 300 and np.mean([a == b for a, b in own]) > 0.96


def test_odd_rows_and_labels(spark, odd_docs, stored):
    clean, bad = "the nice day number %d was long and warm", "you worthless scum number %d of a day"
    path = odd_docs([(bad if i % 4 == 0 else clean) % i for i in range(120)])
    labels = [(i + 8, None, int(i % 4 == 0)) for i in range(120)] + [(3, 1, None), (None, 1, 1), (9999, 1, 1), (9, 0, 0)]
    stored(labels, LABELS, "labels")
    rows = op7_toxicity(spark, path).collect()
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert len(rows) == docs.count() and all(r.held_out is not None and r.score == r.score for r in rows)
    assert all(r.predicted == int((r.doc_id - 8) % 4 == 0) for r in rows if r.doc_id is not None and r.doc_id >= 8)
    kept = drop_toxic(docs, spark.read.parquet(f"{path}/labels.parquet"))
    assert kept.columns == docs.columns and kept.filter("text like '%scum%'").isEmpty() and kept.filter("text is null").count() == 2
    stored([], LABELS, "labels")
    assert {r.predicted for r in op7_toxicity(spark, path).collect()} == {0}


def test_empty_table(spark, no_docs, stored):
    stored([(1, 1, 1)], LABELS, "labels")
    assert op7_toxicity(spark, no_docs).collect() == []
