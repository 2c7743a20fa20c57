import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyhouse.llm.components import connected_components
from tallyhouse.llm.simhash import fingerprint, links, near_dedup, op10_simhash, simhash_groups


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain(docs):
    prints = {}
    for doc_id, text in docs:
        prints.setdefault(plain_fingerprint(text), []).append(doc_id)
    values = sorted(prints)
    linked = [(a, b) for i, a in enumerate(values) for b in values[i:] if (a ^ b).bit_count() <= 2]
    out, roots = [], components(values, linked)
    for fp, ids in prints.items():
        same = [d for v in values if roots[v] == roots[fp] for d in prints[v] if d is not None]
        out += [(d, f"{fp:016x}", min(same, default=None)) for d in ids]
    return sorted(out, key=str)


def test_query_against_all_pairs(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op10_simhash(spark, sf).collect()), key=str) == plain(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    path = odd_docs(["A\tb  c\nd", "a b c d", "a b", "a  B"])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted((tuple(r) for r in op10_simhash(spark, path).collect()), key=str) == want
    kept = near_dedup(docs).collect()
    assert len(kept) == len({w[2] for w in want})
    assert near_dedup(docs).columns == docs.columns


def test_empty_table(spark, no_docs):
    assert op10_simhash(spark, no_docs).collect() == []


@pytest.mark.parametrize(("radius", "segments", "crowd"), [(2, 2, 512), (2, 2, 4), (3, 2, 4), (2, 3, 3), (1, 2, 0)])
def test_links_give_the_components_of_all_pairs(spark, radius, segments, crowd):
    rng = random.Random(radius * 10 + segments)
    values = set()
    for _ in range(8):
        base = rng.getrandbits(64)
        for _ in range(14):
            flips = rng.sample(range(64) if rng.random() < 0.5 else range(32), rng.randint(0, radius + 1))
            values.add(base ^ sum(1 << b for b in flips))
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    both = (1 << 64) - 1
    true = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & both).bit_count() <= radius]
    found = [tuple(r) for r in links(spark.createDataFrame([(v,) for v in values], "_fp long"), radius, segments, crowd).collect()]
    assert {tuple(sorted(p)) for p in found} <= set(true)
    assert components(values, found) == components(values, true)
    if crowd == 512:
        assert {tuple(sorted(p)) for p in found} == set(true)


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(150)] + [(7, 7), (3, 2)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([*edges, (None, 5)], "a long, b long")).collect()}
    nodes = {n for a, b in edges for n in (a, b) if a != b}
    assert got == components(nodes, edges)
    assert connected_components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).collect() == []


def test_fingerprint_of_a_long_text():
    text = " ".join(str(i * i % 977) for i in range(70_000))
    assert fingerprint(text.encode()) == plain_fingerprint(text)
