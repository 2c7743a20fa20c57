import zlib
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm import sharding
from tallyhouse.llm.sharding import hypergeometric, matrix_row, op5_sharding, shuffle_to_shards


def test_matrix_has_exact_sums():
    counts, sizes = [5, 0, 17, 3, 9], [10, 10, 14]
    rows = [matrix_row(lambda c: sum(counts[:c]), len(counts), sizes, r, 7) for r in range(len(counts))]
    assert [sum(r) for r in rows] == counts and [sum(c) for c in zip(*rows, strict=True)] == sizes


def test_draws_follow_the_law():
    rng = np.random.default_rng(1)
    mine = Counter(hypergeometric(rng, 7, 5, 4) for _ in range(20_000))
    theirs = Counter(np.random.default_rng(2).hypergeometric(7, 5, 4, 20_000).tolist())
    assert all(abs(mine[k] - theirs[k]) < 450 for k in range(5))
    big = [hypergeometric(rng, 4 * 10**12, 6 * 10**12, 10**6) for _ in range(200)]
    assert abs(np.mean(big) - 400_000) < 200 and 350 < np.std(big) < 650


def test_draws_of_a_chunk_grow_with_the_halvings_only(monkeypatch):
    draws = []
    real = sharding.hypergeometric
    monkeypatch.setattr(sharding, "hypergeometric", lambda *a: draws.append(1) or real(*a))
    for chunks in (16, 1 << 16, 1 << 24):
        draws.clear()
        total = chunks << 14
        sent = matrix_row(lambda c: c << 14, chunks, [total // 64] * 64, chunks // 3, 5)
        assert sum(sent) == 1 << 14 and len(draws) == 64 * (chunks.bit_length() - 1)


def test_many_chunks_and_ranges(spark, stored):
    docs = stored([(i,) for i in range(500)], "doc_id long", files=4)
    rows = shuffle_to_shards(docs, 3, target_rows=20, chunk_rows=16).collect()
    assert sorted(r.doc_id for r in rows) == list(range(500))
    assert sorted((r._shard, r._slot) for r in rows) == [(s, i) for s, n in enumerate((167, 167, 166)) for i in range(n)]
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r._shard, r._slot))]
    assert abs(np.corrcoef(order, range(500))[0, 1]) < 0.2


@pytest.mark.parametrize("target_rows", [4096, 3])
def test_shards_are_exact_and_gapless(spark, odd_docs, target_rows):
    docs = spark.read.parquet(odd_docs() + "/documents.parquet")
    rows = shuffle_to_shards(docs, 4, target_rows=target_rows).collect()
    assert Counter(str((r.doc_id, r.text)) for r in rows) == Counter(str((r.doc_id, r.text)) for r in docs.collect())
    by = {s: sorted(r._slot for r in rows if r._shard == s) for s in range(4)}
    assert all(v == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = shuffle_to_shards(docs, 4, target_rows=target_rows).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_orders_are_uniform(spark, stored):
    docs = stored([(i,) for i in range(6)], "doc_id long", files=2)
    seen = Counter((r.doc_id, r._shard, r._slot) for seed in range(60) for r in shuffle_to_shards(docs, 2, seed=seed, target_rows=2).collect())
    assert len(seen) == 36 and max(seen.values()) < 25


def test_query(spark, sf, no_docs):
    rows = op5_sharding(spark, sf).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r["size"] == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    assert set(Counter(r.shard for r in rows).values()) <= {len(rows) // 40, len(rows) // 40 + 1}
    assert op5_sharding(spark, no_docs).collect() == []
