import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyhouse.llm.packing import difference, op2_packing, pack, pack_documents
from tallyhouse.llm.tokens import TextEncoder

WHOLE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, capacity=1024):
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for own in windows.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]]
        assert sum(n for _, n in own) <= capacity
    for doc_id, texts in docs.items():
        coded = [ids(t) for t in texts]
        want = []
        for c in coded:
            full = len(c) // capacity * capacity
            cuts = [*range(0, full, capacity), *range(full, len(c), capacity // 2), len(c)]
            want += [(a, b - a, zlib.crc32(np.array(c[a:b], "<u4").tobytes()), len(c)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        want.sort()
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc_id]) == want
    return len(windows)


def by_id(df):
    docs = defaultdict(list)
    for r in df.collect():
        docs[r.doc_id].append(r.text)
    return docs


def test_differencing_is_nearly_equal():
    sizes = np.random.default_rng(1).integers(1, 100, 400)
    loads = [int(sizes[m].sum()) for m in difference(sizes, 20)]
    assert sum(loads) == sizes.sum() and max(loads) - min(loads) <= 2
    assert sorted(x for m in pack(np.array([600, 600, 600]), 1024) for x in m) == [0, 1, 2]
    assert len(pack(np.array([600, 600, 600]), 1024)) == 3
    assert difference(np.array([], np.int64), 2) == [[], []]


def test_ids_are_those_of_the_tokenizers_library(spark, sf):
    encoder = TextEncoder()
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(80).collect()]
    for text in [*texts, "", "<|endoftext|> a", "\x00\x01  　x\r\n\r\n  y", "don't I'LL 1234567 ......   !", "\U0001f600" * 5]:
        assert [*encoder.ids(text).tolist(), 0] == ids(text)


def test_long_runs_of_whitespace(spark, stored):
    texts = [" " * 1_500_000, "a" + "\n" * 1_200_000 + " b", "\u3000 " * 600_000, "c" + " " * 100_001]
    encoder = TextEncoder()
    for text in texts:
        assert [*encoder.ids(text).tolist(), 0] == ids(text)
    docs = stored([(0, texts[0]), (1, "a b")], "doc_id long, text string")
    check(pack_documents(docs).collect(), by_id(docs))


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = op2_packing(spark, sf).collect()
    windows = check(rows, by_id(docs))
    assert windows * 1024 <= 1.01 * sum(r.length for r in rows) + 2048


def test_odd_rows_and_small_blocks(spark, odd_docs, no_docs):
    docs = spark.read.parquet(odd_docs(["<|endoftext|>"]) + "/documents.parquet")
    rows = pack_documents(docs, capacity=16, block_tokens=20, with_tokens=True).collect()
    check(rows, by_id(docs), 16)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_blocks_are_bounded_in_pieces(spark, stored):
    docs = stored([(i, None if i % 2 else "a") for i in range(60_000)], "doc_id long, text string")
    rows = pack_documents(docs).collect()
    check(rows, by_id(docs))
    pieces = Counter(r.sequence_id >> 33 for r in rows)
    assert len(pieces) == 4 and max(pieces.values()) < 16_384 * 1.05


def test_empty_table(spark, no_docs):
    assert op2_packing(spark, no_docs).collect() == []
