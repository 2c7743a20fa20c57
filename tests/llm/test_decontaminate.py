"""Phrase search against a plain scan, and the index against sorted suffixes."""

import hashlib
import random
import re

import numpy as np

from tallyhouse.llm.decontaminate import contamination, decontaminate, item_pieces, op1_decontamination
from tallyhouse.llm.fm_index import FMIndex

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, size=10):
    out, phrases = [], {}
    for item, body in items:
        w = words(body)
        for p in range(max(1, len(w) - size + 1) if w else 0):
            phrases.setdefault(tuple(w[p : p + size]), set()).add(str(item))
    for doc_id, text in docs:
        own, hit, named = words(text), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(own) - n + 1):
                if (p := tuple(own[i : i + n])) in phrases:
                    hit |= set(range(i, i + n))
                    named |= phrases[p]
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=str)


def test_index_finds_every_occurrence():
    rng = random.Random(3)
    for _ in range(30):
        codes = [rng.choice([0, 1, 1, 2, 3]) for _ in range(rng.randint(1, 200))] + [0]
        index = FMIndex(np.array(codes, np.int32), 4, 4)
        for length in (1, 2, 5):
            phrases = np.array([[rng.randint(1, 3) for _ in range(length)] for _ in range(20)], np.int32)
            low, high = index.search(phrases)
            for p, a, b in zip(phrases.tolist(), low, high, strict=True):
                found = sorted(index.locate(np.arange(a, b)).tolist())
                assert found == [i for i in range(len(codes)) if codes[i : i + length] == p]


def test_query_is_a_plain_scan(spark, sf):
    read = lambda n, *c: [tuple(r) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(*c).collect()]
    mine = sorted((tuple(r) for r in op1_decontamination(spark, sf).collect()), key=str)
    assert mine == plain(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert any(r[-1] for r in mine) and not all(r[-1] for r in mine)


def test_small_shards_blocks_and_odd_rows(spark, odd_docs, stored):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    path = odd_docs([f"x {passage.upper()} y", passage + " " + passage, "FOX"])
    items = [(1, passage), (2, "fox"), (3, None), (None, "quick"), (4, " "), (2, "fox"), (5, passage)]
    bench = stored(items, "item_id long, text string, text2 string".replace(", text2 string", ""), "benchmark")
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text")
    want = plain([tuple(r) for r in docs.collect()], [("null" if i is None else i, t) for i, t in items])
    for options in ({}, {"shard_words": 15}, {"block_windows": 3}, {"block_windows": 3, "shard_words": 11}):
        found = contamination(docs, bench, **options).collect()
        got = []
        for r in found:
            hit = sum(s.end - s.start for s in r._spans)
            got.append((r.doc_id, r._words, hit, len(r._items), hashlib.sha256(",".join(sorted(r._items)).encode()).hexdigest(), hit > 0))
        assert sorted(got, key=str) == want
    assert sorted(map(str, decontaminate(docs, bench).collect())) == sorted(map(str, decontaminate(docs, bench, block_windows=3).collect()))
    clean = {r.text for r in decontaminate(docs, bench).collect()}
    assert "x  y" in clean and " " in clean and None in clean and not any("fox" in (t or "").lower() for t in clean)


def test_empty_tables(spark, no_docs, stored):
    stored([], "item_id long, text string", "benchmark")
    assert op1_decontamination(spark, no_docs).collect() == []
    stored([(1, "a b")], "doc_id long, text string")
    assert op1_decontamination(spark, no_docs).first().n_words == 2


def test_a_full_block_stays_small():
    """2^20 windows of 2^17 words, in a process of its own."""
    import subprocess
    import sys

    code = """
import resource
import numpy as np
from tallyhouse.llm.decontaminate import BLOCK_WINDOWS, Phrases
rng = np.random.default_rng(1)
items = [(str(i), b" ".join(b"word%d" % w for w in rng.integers(0, 1 << 17, 4096))) for i in range(BLOCK_WINDOWS >> 12)]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
phrases = Phrases(items)
assert sum(len(p[1]) for p in phrases.by_length) > BLOCK_WINDOWS * 0.99
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120)
    assert int(out.stdout.split()[-1]) < 300


def test_pieces_hold_each_window_once(spark):
    items = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(50))), ("b", "x y"), ("c", " "), ("d", " ".join("uvwxyzabcdef"))], "i string, t string")
    pieces = item_pieces(items, 10, 13).collect()
    seen = sorted((p.i, tuple(w[k : k + 10])) for p in pieces for w in [p.t.split()] for k in range(max(1, len(w) - 9)))
    own = [(r.i, r.t.split()) for r in items.collect()]
    assert seen == sorted((i, tuple(w[k : k + 10])) for i, w in own if w for k in range(max(1, len(w) - 9)))
    assert sum(p.windows for p in pieces) == len(seen)
