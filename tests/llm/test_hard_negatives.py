import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm.hard_negatives import hard_negatives, moduli, op13_hard_negatives, residues, scores, usable

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=100, moved=True, positives=5, negatives=5):
    """The contract with Python's own whole numbers."""
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if moved and i % 7 == 0 else label, tuple(int(np.floor(256 * float(x))) for x in v)))
    anchors = {}
    for i, label, v in kept:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in anchors.items():
        score = [(sum(x * y for x, y in zip(v, w)), j, own) for j, own, w in kept if j != a]  # noqa: B905
        score.sort(key=lambda r: (-r[0], r[1]))
        for ps, pid, _ in [r for r in score if r[2] == label][:positives]:
            chosen = [r for r in score if r[2] != label and 80 * ps <= 100 * r[0] <= 100 * ps][:negatives]
            out += [(a, pid, rank, nid, ps, ns) for rank, (ns, nid, _) in enumerate(chosen, 1)]
    return sorted(out)


def rounded(rows):
    return [(i, v and [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.sampled_from([1, 100, 30000, 1 << 25]), st.integers(0, 1000))
def test_scores_are_exact(width, size, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-size, size + 1, (n, width)) for n in (4, 7))
    a[0], b[0], b[1] = size, size, -size
    primes = moduli(width, width * size * size)
    wanted = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    assert scores(residues(a, primes), residues(b, primes), primes).tolist() == wanted


def test_wide_vectors_are_exact():
    rng = np.random.default_rng(5)
    a, b = rng.integers(-300, 300, (3, 9000)), rng.integers(-300, 300, (5, 9000))
    primes = moduli(9000, 9000 * 300 * 300)
    assert all((p // 2) ** 2 * 4096 < 1 << 24 for p in primes)
    assert (scores(residues(a, primes), residues(b, primes), primes) == a @ b.T).all()


def test_given_vectors(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = op13_hard_negatives(spark, sf)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows)


@pytest.mark.parametrize("block", [7, 8192])
def test_ties_repeats_and_odd_rows(spark, stored, tmp_path, block):
    rng = np.random.default_rng(11)
    rows = [(i, rng.integers(-3, 4, 4).tolist(), int(rng.integers(0, 3))) for i in range(0, 400, 5)]
    rows += [(200, [9.5, 1.0, 1.0, 1.0], 0)] * 3 + [(7, [1.0, 1.0, 1.0, 1.0], 1)] * 40 + [(-100, [1.0, -0.001, 2.0, 0.5], 9)]
    rows += [(None, [1.0], 1), (500, None, 1), (501, [1.0, None], 1), (502, [float("nan")], 1), (503, [float("inf")], 1), (504, [1.0], None), (600, [], 2), (601, [2.0], 2), (602, [3.0, 1.0, 0.0, 0.0, 5.0], 1)]
    rows = rounded(rows)
    stored(rows, SCHEMA, "embeddings")
    read = spark.read.parquet(f"{tmp_path}/embeddings.parquet").withColumns({"_a": F.lit(1), "norm": F.lit("x"), "parts": F.lit(0)})
    own = usable(read)
    assert sorted(tuple(r) for r in hard_negatives(own, row_block=block, anchor_block=2 if block == 7 else block).collect()) == plain(rows, moved=False)
    assert sorted(tuple(r) for r in op13_hard_negatives(spark, str(tmp_path)).collect()) == plain(rows)


def test_large_components_and_none(spark, stored, tmp_path):
    rows = rounded([(0, [30000.0, -1.5], 1), (1, [30000.25, 7.0], 1), (2, [29000.0, 3e4], 2), (3, [1e30, 1.0], 1), (4, [25000.0, -3e4], 3), (5, [29999.0, 0.0], 4)])
    stored(rows, SCHEMA, "embeddings")
    assert sorted(tuple(r) for r in op13_hard_negatives(spark, str(tmp_path)).collect()) == plain([r for r in rows if r[0] != 3])
    stored([], SCHEMA, "embeddings")
    assert op13_hard_negatives(spark, str(tmp_path)).collect() == []
    stored([(0, [1.0], 1), (3, [1.0], 2)], SCHEMA, "embeddings")
    assert op13_hard_negatives(spark, str(tmp_path)).collect() == []
