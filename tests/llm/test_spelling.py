import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import spelling
from tallyhouse.llm.spelling import compared, near_pairs, op11_spelling, spelling_forms, vocabulary, words_of


def plain_words(docs, min_length=6, min_count=5):
    """The contract, run by run."""
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_forms(words, ratio=5):
    near = {w: [o for o in words if abs(len(o) - len(w)) < 2 and one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def test_query_against_every_pair(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = op11_spelling(spark, sf)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = found.collect()
    assert len(got) == len({r.word for r in got}) > 100
    assert {tuple(r) for r in got} == plain_forms(plain_words(docs))


@pytest.mark.parametrize("block", [3, 512])
def test_hot_groups_and_chains(spark, block):
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("abß"), 7)) + tail: int(rng.integers(5, 4000)) for tail in ("end", "en", "x") for _ in range(60)}
    words |= {"begin" + "".join(rng.choice(list("ab"), 4)): int(rng.integers(5, 90)) for _ in range(30)}
    words |= {"chain" + "a" * i: 5**i for i in range(1, 12)} | {"twoforms": 5, "twofOrms": 50, "twofErms": 50, "ab": 7, "a": 900, "b": 5, "\U0001f600long": 5, "\U0001f601long": 25}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling_forms(df, block=block).collect()} == plain_forms(words)


def test_very_long_words(spark):
    long = "ab" * 30000
    words = {long: 5, long + "c": 50, "z" + long: 6, long[:-1] + "x": 7, long[:-2] + "yy": 8, "c" * 300: 9, "c" * 301: 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling_forms(df).collect()} == plain_forms(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé\0", min_size=1, max_size=6), min_size=2, max_size=12, unique=True), st.integers(1, 7))
def test_tiles(words, size):
    """A tile finds the near pairs of which one word has the group's length."""
    words = [w for w in words if len(w) in (size, size - 1)]
    if len(words) < 2:
        return
    group, i, j = compared([(size, True, words, None), (size, True, words[:1], words)])
    pairs = {(g, a, b) for g, a, b in zip(group.tolist(), i.tolist(), j.tolist(), strict=True) if max(len(words[a]), len(words[b])) == size}
    wanted = {(0, a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if one_edit(words[a], words[b]) and max(len(words[a]), len(words[b])) == size}
    wanted |= {(1, 0, b) for b in range(len(words)) if (words[0] == words[b] or one_edit(words[0], words[b])) and max(len(words[0]), len(words[b])) == size}
    assert pairs == wanted


def test_pieces_end_between_words(monkeypatch):
    text = ("Letters ünd wörds " * 50 + "x" * 500 + " ") * 3
    whole = words_of(text.encode(), "7", 3, 3)
    real = spelling.pieces
    monkeypatch.setattr(spelling, "pieces", lambda t: real(t, 10))
    assert words_of(text.encode(), "7", 3, 3) == whole


def test_odd_rows(spark, odd_docs, no_docs):
    assert op11_spelling(spark, no_docs).collect() == []
    folder = odd_docs(["SPELLING Spelling spelling spelling spelling speling " * 5, "q" * 100000, ("q" * 100000 + "-") * 5])
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in op11_spelling(spark, folder).collect()} == plain_forms(plain_words(docs))


def test_clashing_columns_and_both_directions(spark):
    rows = spark.createDataFrame([(1, "somewhere somewhere", 2, 3), (None, "somewhere", None, None), (2, None, 1, 1)], "doc_id long, text string, n long, word long")
    assert {tuple(r) for r in vocabulary(rows, min_count=1, delete_every=None).collect()} == {("somewhere", 3)}
    words = spark.createDataFrame([("colour", 9, 1), ("color", 8, 1), ("colours", 7, 1)], "word string, n long, size long")
    assert {(r.word, r.other) for r in near_pairs(words.select("word", "n")).collect()} == {("colour", "color"), ("color", "colour"), ("colour", "colours"), ("colours", "colour")}
    assert spelling_forms(words, ratio=2).filter(F.col("form").isNotNull()).count() == 0
    with pytest.raises(ValueError):
        spelling_forms(words, ratio=1)
