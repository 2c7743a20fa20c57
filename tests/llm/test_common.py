"""Row numbers do not depend on how a scan splits its files."""

import random
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm.common import file_rows, keyed
from tallyhouse.llm.decontaminate import contamination
from tallyhouse.llm.passages import repeated_words
from tallyhouse.llm.sharding import shuffle_to_shards
from tallyhouse.llm.simhash import near_dedup
from tallyhouse.llm.suffix_dedup import repeated_bytes
from tests.llm.test_repeats import made_texts, plain_bytes, plain_words, spans_of
from tests.llm.test_simhash import plain

PARALLELISM = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def changing(spark):
    """From the block on, scans are split as if other executors were there."""

    @contextmanager
    def change():
        spark.conf.set(PARALLELISM, "1")
        try:
            yield
        finally:
            spark.conf.set(PARALLELISM, "12")

    spark.conf.set(PARALLELISM, "12")
    yield change
    spark.conf.unset(PARALLELISM)


def many_files(stored, texts):
    docs = stored(list(enumerate(texts)), "doc_id long, text string", files=40)
    return docs, [tuple(r) for r in docs.collect()]


def test_numbers_are_those_of_another_scan(spark, stored, changing):
    docs, rows = many_files(stored, [str(i) for i in range(400)])
    before, parts = {tuple(r) for r in keyed(docs, "doc_id").collect()}, docs.rdd.getNumPartitions()
    with changing():
        docs = docs.select("*")
        assert docs.rdd.getNumPartitions() != parts
        assert {tuple(r) for r in keyed(docs, "doc_id").collect()} == before
    assert sorted(n for n, _ in before) == list(range(len(rows)))


def test_near_dedup(stored, changing):
    rng = random.Random(4)
    docs, rows = many_files(stored, [" ".join(rng.choice("abcdefgh") * 3 for _ in range(12)) for _ in range(150)] * 2)
    kept = near_dedup(docs)
    with changing():
        assert sorted(r.doc_id for r in kept.collect()) == sorted({first for _, _, first in plain(rows)})


def test_repeated_passages(stored, changing):
    docs, rows = many_files(stored, made_texts(random.Random(6), 120, ["a", "bb", "é", "zz", "the"], " "))
    by_bytes, by_words = repeated_bytes(docs, width=24, gram=5), repeated_words(docs, width=12, gram=3)
    with changing():
        assert spans_of(by_bytes.collect()) == sorted((str(i), n) for i, _, n, *_ in plain_bytes(rows, 24))
        assert spans_of(by_words.collect()) == sorted((str(i), n) for i, _, n, _ in plain_words(rows, 12))


def test_sharding(stored, changing):
    docs, rows = many_files(stored, [str(i) for i in range(400)])
    dealt = shuffle_to_shards(docs, 4, target_rows=7, chunk_rows=64)
    before = sorted(map(tuple, shuffle_to_shards(docs, 4, target_rows=7, chunk_rows=64).select("doc_id", "text", "_shard", "_slot").collect()))
    with changing():
        assert sorted(map(tuple, dealt.select("doc_id", "text", "_shard", "_slot").collect())) == before
    assert Counter(r[:2] for r in before) == Counter(rows)
    assert all(sorted(slot for *_, s, slot in before if s == shard) == list(range(100)) for shard in range(4))


def test_blocks_of_a_benchmark(spark, stored, changing):
    docs, _ = many_files(stored, [f"w{i} w{i + 1} w{i + 2}" for i in range(400)])
    items = spark.createDataFrame([(i, f"w{i} w{i + 1}") for i in range(0, 400, 7)], "item_id long, text string")
    whole = sorted((r.doc_id, r._spans, r._items) for r in contamination(docs, items, phrase_words=2).collect())
    split = contamination(docs, items, phrase_words=2, block_windows=40)
    with changing():
        assert sorted((r.doc_id, r._spans, r._items) for r in split.collect()) == whole


def test_tables_that_are_no_plain_files(spark, stored, tmp_path):
    docs, rows = many_files(stored, [str(i) for i in range(40)])
    path = str(tmp_path / "documents.parquet")
    assert file_rows(docs.select("text"))[0].columns == ["text"] and not file_rows(docs)[0].filter("_metadata.file_path LIKE '%rows-%'").count()
    for other in (spark.read.parquet(path, path), docs.unionByName(docs), docs.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")):
        got = keyed(other, "doc_id").collect()
        assert len({r._row for r in got}) == len(got) == 80
    assert keyed(docs.filter("doc_id < 7"), "doc_id").count() == 7
    assert keyed(spark.createDataFrame(rows, "doc_id long, _metadata string"), "doc_id", "_metadata").count() == 40
    assert near_dedup(docs.filter("doc_id >= 0").checkpoint()).columns == docs.columns
