import hashlib
import random

from tallyhouse.llm.fingerprints import edited, fingerprint, op4_fingerprints, with_next, within_radius


def plain(docs):
    docs = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = []
    for (i, text), (_, following) in zip(docs, [*docs[1:], *docs[:1]], strict=True):
        cut = len(text) // 2
        changed = text[: len(text) - cut] + following[:cut]
        prints = [fingerprint(t.encode()) for t in (text, changed, following)]
        near = [1 - (prints[0] ^ p).bit_count() / 64 for p in prints[1:]]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), f"{prints[0]:016x}", f"{prints[1]:016x}", *near))
    return sorted(out, key=str)


def test_query(spark, sf):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op4_fingerprints(spark, sf).collect()
    assert sorted((tuple(r)[:-1] for r in rows), key=str) == plain(docs)
    prints = {i: fingerprint(t.encode()) for i, t in docs}
    for r in rows:
        near = sum((prints[r.doc_id] ^ p).bit_count() <= 3 for p in prints.values())
        assert r.n_near == (near if r.doc_id % 100 == 0 else None)


def test_odd_rows(spark, odd_docs, stored):
    docs = spark.read.parquet(odd_docs() + "/documents.parquet")
    rows = with_next(docs).collect()
    assert len(rows) == docs.count() and all(r.edited_sha256 for r in rows)
    assert sorted(r.n_chars for r in rows) == sorted(len(r.text or "") for r in docs.collect())
    alone = with_next(stored([(5, "one two three")], "doc_id long, text string", "alone")).first()
    assert alone.edited_sha256 == hashlib.sha256(edited("one two three", "one two three").encode()).hexdigest() and alone.near_next == 1.0


def test_empty_table(spark, no_docs):
    assert op4_fingerprints(spark, no_docs).collect() == []


def test_all_within_the_radius(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(20)})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    prints = spark.createDataFrame(signed, "fp long")
    for radius, blocks in ((3, 5), (2, 4), (0, 1)):
        got = {(r.query % 2**64, r.fp % 2**64, r.distance) for r in within_radius(prints, prints, radius=radius, blocks=blocks).collect()}
        assert got == {(a, b, d) for a in values for b in values if (d := (a ^ b).bit_count()) <= radius}
