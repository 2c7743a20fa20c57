"""Recurring bytes and words against counting every window."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm.passages import drop_repeated_words, op9_passages, repeated_words, word_bounds, word_hashes
from tallyhouse.llm.repeats import Rolling, least, runs_of, runs_table
from tallyhouse.llm.suffix_dedup import _symbols, op8_suffix_dedup, repeated_bytes, suffix_array


def gone(texts, width):
    seen = Counter(tuple(t[i : i + width]) if not isinstance(t, bytes) else t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        own = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width] if isinstance(t, bytes) else tuple(t[i : i + width])] > 1:
                own[i : i + width] = True
        out.append(own)
    return out


def plain_bytes(docs, width):
    texts = [(t or "").encode() for _, t in docs]
    out = []
    for (i, _), t, own in zip(docs, texts, gone(texts, width), strict=True):
        kept = bytes(b for b, g in zip(t, own.tolist(), strict=True) if not g)
        edges = sum(g and (k == 0 or not own[k - 1]) for k, g in enumerate(own.tolist()))
        out.append((i, len(t), int(own.sum()), edges, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def plain_words(docs, width):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    out = []
    for (i, _), t, own in zip(docs, texts, gone(texts, width), strict=True):
        kept = " ".join(w for w, g in zip(t, own.tolist(), strict=True) if not g)
        out.append((i, len(t), int(own.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def spans_of(rows):
    out = []
    for r in rows:
        marked = set()
        for s in r._spans or []:
            marked |= set(range(s.start, s.end))
        out.append((str(r.doc_id), len(marked)))
    return sorted(out)


def made_texts(rng, n, alphabet, sep):
    """Texts that share passages, overlap themselves and repeat."""
    bank = [[rng.choice(alphabet) for _ in range(rng.randint(5, 90))] for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            own = list(rng.choice(bank)) if rng.random() < 0.6 else [rng.choice(alphabet) for _ in range(rng.randint(1, 60))]
            if rng.random() < 0.4:
                own[rng.randrange(len(own))] = rng.choice(alphabet)
            parts += own * rng.choice([1, 1, 1, 3])
        texts.append(sep.join(parts))
    return [*texts, *texts[:3]]


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(600):
        s = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 60))]
        assert suffix_array(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_runs_part_all_windows():
    rng = np.random.default_rng(2)
    for n in (0, 5, 9, 10, 11, 300):
        own = rng.integers(0, 3, n).astype(np.uint64)
        seen = [w for _, _, first, count in runs_of(n, lambda a, b, own=own: own[a:b], 10, 3, Rolling()) for f, c in zip(first, count, strict=True) for w in range(f, f + c)]
        assert seen == list(range(max(0, n - 9)))
    values = rng.integers(0, 50, 100).astype(np.uint64)
    assert least(values, 7).tolist() == [values[i : i + 7].min() for i in range(94)]


def test_words_hash_by_content():
    data = ("Ünï a\tbb  ccc\n" + "x" * 100 + " a " + "y" * 63 + " " + "x" * 100 + " \v\f\r").encode()
    starts, ends = word_bounds(data)
    words = [data[a:b] for a, b in zip(starts, ends, strict=True)]
    assert words == data.split()
    hashes = word_hashes(data, starts, ends).tolist()
    assert all((a == b) == (x == y) for a, x in zip(words, hashes, strict=True) for b, y in zip(words, hashes, strict=True))
    assert word_hashes(data, starts[2:4], ends[2:4]).tolist() == hashes[2:4]


@pytest.mark.parametrize("crowd", [2048, 1])
def test_small_windows(spark, stored, crowd):
    rng = random.Random(crowd)
    texts = made_texts(rng, 60, "abcé", "")
    docs = stored([(i, t) for i, t in enumerate(texts)] + [(None, None), (7, "")], "doc_id long, text string")
    want = sorted((str(i), n) for i, _, n, *_ in plain_bytes([(r.doc_id, r.text) for r in docs.collect()], 24))
    assert spans_of(repeated_bytes(docs, width=24, gram=5, batch_bytes=2000, crowd=crowd).collect()) == want
    texts = made_texts(rng, 60, ["a", "bb", "é", "zz", "the"], " ")
    docs = stored([(i, t) for i, t in enumerate(texts)] + [(None, None), (7, "")], "doc_id long, text string", "more")
    want = sorted((str(i), n) for i, _, n, _ in plain_words([(r.doc_id, r.text) for r in docs.collect()], 12))
    assert spans_of(repeated_words(docs, width=12, gram=3, shard_bytes=2000, crowd=crowd).collect()) == want
    assert any(n for _, n in want)


def test_chunked_documents(spark, stored, monkeypatch):
    from tallyhouse.llm import repeats

    monkeypatch.setattr(repeats, "CHUNK", 50)
    docs = stored(list(enumerate(made_texts(random.Random(9), 20, "abc", ""))), "doc_id long, text string")
    want = sorted((str(i), n) for i, _, n, *_ in plain_bytes([(r.doc_id, r.text) for r in docs.collect()], 20))
    assert spans_of(repeated_bytes(docs, width=20, gram=4).collect()) == want


def test_queries(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op8_suffix_dedup(spark, sf).collect()), key=str) == plain_bytes(docs, 400)
    assert sorted((tuple(r) for r in op9_passages(spark, sf).collect()), key=str) == plain_words(docs, 35)


def test_odd_rows(spark, odd_docs):
    path = odd_docs(["x" * 5000, " ".join(str(i) for i in range(200)), "y " + " ".join(str(i) for i in range(100, 160)), "é" * 300])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in op8_suffix_dedup(spark, path).collect()), key=str) == plain_bytes(texts, 400)
    assert sorted((tuple(r) for r in op9_passages(spark, path).collect()), key=str) == plain_words(texts, 35)
    kept = drop_repeated_words(docs)
    assert kept.columns == docs.columns
    assert {r.text for r in kept.collect()} >= {None, "", " ", "y", "x" * 5000}


def test_empty_table(spark, no_docs):
    assert op8_suffix_dedup(spark, no_docs).collect() == [] and op9_passages(spark, no_docs).collect() == []


def test_runs_of_a_common_anchor_are_not_one_task(spark, stored):
    """Each task writes a file of runs; one passage in every document gives one anchor most of them."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "4k",
        "spark.sql.files.openCostInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    passage = "".join(random.Random(3).choices("abcdefgh", k=80))
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs = stored([(i, f"{passage} {i}") for i in range(400)], "_row long, text string", files=8)
        runs = runs_table(docs, "text", _symbols, 60, 8)
        of = runs.groupBy("anchor", runs.metadataColumn("_metadata")["file_path"].alias("file")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert {r.anchor for r in of} == {of[0].anchor} and sum(r["count"] for r in of) == 400
    assert max(r["count"] for r in of) <= 200
