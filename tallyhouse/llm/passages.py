"""Substring dedup by repeated-phrase automata: words of passages that recur anywhere are removed.

A word goes when `width` consecutive words cover it that also start anywhere else in the corpus. Which
windows can recur at all is settled by their anchors (see `repeats`): windows with an anchor of their
own are unique, and text whose copies agree as a whole needs no search. The rest is dealt to shards by
anchor, whole groups each. A shard confirms by hash counts which of its windows may recur, compiles an
Aho-Corasick automaton of these over the shard's word numbers, and streams its text through the automaton, which
locates every occurrence; what it locates decides. A shard is bounded in bytes, and so is its automaton; every document is
streamed to exactly the shards of its own anchors.

Words are what lies between ASCII white space, compared as bytes. Null text has no words; texts shorter
than a window stay whole. Repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import binaries, keyed, read, with_texts
from tallyhouse.llm.repeats import CROWD, Rolling, mask_of, mixed, recurring

WIDTH = 35
GRAM = 8
SHARD_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE_HASHES = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0xD6E8FEB86659FD93
_LONG_WORD = 64


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words in bytes."""
    edge = np.diff(np.concatenate([[True], _SPACE[np.frombuffer(data, np.uint8)], [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: its bytes in turn, all words at once."""
    own = np.frombuffer(data, np.uint8)
    h = np.zeros(len(starts), np.uint64)
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    starts, length = starts[order], length[order]
    counts = np.searchsorted(-length, -np.arange(min(_LONG_WORD, int(length[0]) if len(length) else 0)), side="left")
    for i, n in enumerate(counts.tolist()):
        h[:n] = h[:n] * np.uint64(_FACTOR) + _BYTE_HASHES[own[starts[:n] + i]]
    for i in np.flatnonzero(length > _LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i] : starts[i] + length[i]], digest_size=8).digest()
        h[i] = np.frombuffer(digest, np.uint64)[0]
    out = np.empty_like(h)
    out[order] = mixed(h)
    return out


def _symbols(data: bytes) -> tuple[int, Callable[[int, int], np.ndarray]]:
    starts, ends = word_bounds(data)
    return len(starts), lambda a, b: word_hashes(data, starts[a:b], ends[a:b])


def _cut(data: bytes) -> Callable[[int, int], bytes]:
    starts, ends = word_bounds(data)
    return lambda a, b: data[starts[a] : ends[b - 1]]


def located(segments: list[tuple[bytes, int]], width: int) -> list[tuple[int, int] | None]:
    """The first and last recurring window of each segment of a shard.

    Hashes of the windows tell which may recur; these are compiled, and the automaton, which compares
    words, locates every occurrence of them. A window recurs if it is located twice, or in a segment with copies.
    """
    number: dict[bytes, int] = {}
    texts = [tuple(number.setdefault(w, len(number)) for w in s.split()) for s, _ in segments]
    rolling = Rolling()
    hashes = [rolling.load(mixed(np.array(own, np.uint64) + np.uint64(1))).windows(width) for own in texts]
    copies = np.repeat(np.array([c for _, c in segments]), [len(h) for h in hashes])
    _, kind = np.unique(np.concatenate(hashes), return_inverse=True)
    maybe = np.bincount(kind, weights=copies)[kind] > 1
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    known = at = 0
    for own, h in zip(texts, hashes, strict=True):
        for i in np.flatnonzero(maybe[at : at + len(h)]).tolist():
            if not automaton.exists(own[i : i + width]):
                automaton.add_word(own[i : i + width], known)
                known += 1
        at += len(h)
    if not known:
        return [None] * len(texts)
    automaton.make_automaton()
    found = np.zeros(known, np.int64)
    hits = []
    for own, (_, count) in zip(texts, segments, strict=True):
        pairs = np.array(list(automaton.iter(own)), np.int64).reshape(-1, 2)
        np.add.at(found, pairs[:, 1], count)
        hits.append(pairs)
    out: list[tuple[int, int] | None] = []
    for pairs in hits:
        ends = pairs[found[pairs[:, 1]] > 1, 0]
        out.append((int(ends[0]) - width + 1, int(ends[-1]) - width + 1) if len(ends) else None)
    return out


def repeated_words(docs: DataFrame, *, text: str = "text", width: int = WIDTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, crowd: int = CROWD) -> DataFrame:
    """`docs` with `_spans`: (start, end) of the words to remove, null where there are none."""
    rows = keyed(docs, *docs.columns)
    spans = recurring(
        rows.select("_row", F.col(text).alias("_text")),
        "_text",
        symbols_of=_symbols,
        cut=_cut,
        resolve=lambda segments: located(segments, width),
        width=width,
        gram=min(gram, width),
        batch_bytes=shard_bytes,
        crowd=crowd,
    )
    return rows.join(spans.withColumnRenamed("spans", "_spans"), "_row", "left").drop("_row")


def kept_words(data: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """The kept words joined by single spaces, the number of words, and of those removed."""
    words = data.split()
    if not spans:
        return b" ".join(words), len(words), 0
    gone = mask_of(spans, len(words))
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]), len(words), int(gone.sum())


def drop_repeated_words(docs: DataFrame, *, text: str = "text", chars: str | None = None, **options) -> DataFrame:
    """`docs` with the recurring words taken out of the texts that have any; other texts are unchanged.

    `chars` names a column with the texts' code points, to be kept right.
    """
    found = repeated_words(docs, text=text, **options)
    kept = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
            spans = batch.column(batch.schema.get_field_index("_spans")).to_pylist()
            changed = [i for i, own in enumerate(spans) if own]
            for i in changed:
                texts[i] = kept_words(texts[i], spans[i])[0]
            yield with_texts(batch, text, texts, changed, chars).select(kept)

    return found.mapInArrow(run, docs.schema)


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_words(read(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = found.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [kept_words(data, spans) for data, spans in zip(binaries(batch, "text"), batch.column(2).to_pylist(), strict=True)]
            arrays = [pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.int64()), pa.array([hashlib.sha256(r[0]).hexdigest() for r in out])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [ids.name, "n_words", "n_removed", "kept_sha256"])

    longs = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    return found.select("doc_id", "text", "_spans").mapInArrow(run, T.StructType([ids, *longs, T.StructField("kept_sha256", T.StringType())]))
