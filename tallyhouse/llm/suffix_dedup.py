"""Exact-substring dedup by suffix arrays, sorted with a difference cover.

A byte goes when a string of `width` bytes covers it that also starts anywhere else in the corpus.
Sorting all suffixes of a corpus over the network moves every byte's suffix several times. Here the
candidates are dealt out first (see `repeats`): strings with an anchor of their own are unique, copies
of a whole segment are one row, and only distinct segments that share an anchor are sorted, each group
whole in one task. There the difference-cover algorithm sorts the suffixes of the concatenated
segments: the triples at places 1 and 2 modulo 3 are sorted and named, the names are sorted by recursion
while they repeat, the remaining suffixes follow from the ranks of the next ones, and both are merged.
Neighbours in that order that agree in `width` bytes are recurring strings.

Null text is empty; texts shorter than the width stay whole. Repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import binaries, keyed, read
from tallyhouse.llm.repeats import CROWD, Rolling, mask_of, recurring

WIDTH = 400
GRAM = 32
BATCH_BYTES = 1 << 20
_TRIPLE = 1 << 21  # three of these fit in 63 bits

_BYTE_HASHES = np.random.default_rng(8).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of `s` (positive integers under 2^21, fewer than that) in order."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    text = np.concatenate([s, np.zeros(4, np.int64)])
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # with n % 3 = 1, an empty suffix ends the ones
    sample = np.concatenate([ones, twos])
    triple = (text[sample] * _TRIPLE + text[sample + 1]) * _TRIPLE + text[sample + 2]
    order = np.argsort(triple)
    sorted_ = triple[order]
    name = np.cumsum(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    if name[-1] < len(sample):
        names = np.empty(len(sample), np.int64)
        names[order] = name
        order = suffix_array(names)
    sample = sample[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = np.arange(1, len(sample) + 1)
    rest = sample[sample % 3 == 1] - 1
    rest = rest[np.argsort(text[rest], kind="stable")]
    sample = sample[sample < n]
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    pair = lambda i: text[i] * _TRIPLE + rank[i + 1]
    three = lambda i: (text[i] * _TRIPLE + text[i + 1]) * _TRIPLE + rank[i + 2]
    at = np.arange(len(rest)) + np.searchsorted(pair(one), pair(rest)) + np.searchsorted(three(two), three(rest))
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    taken[at] = True
    out[at], out[~taken] = rest, sample
    return out


def first_and_last(segments: list[tuple[bytes, int]], width: int) -> list[tuple[int, int] | None]:
    """The first and last string of each segment that starts anywhere else in them, or in a copy."""
    sizes = np.array([len(s) for s, _ in segments])
    data = np.frombuffer(b"".join(s + b"\0" for s, _ in segments), np.uint8)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    text = data.astype(np.int64) + 2
    text[ends - 1] = 1
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    whole = np.arange(len(text)) + width < ends[owner]
    order = suffix_array(text)
    order = order[whole[order]]
    prefix = Rolling().load(_BYTE_HASHES[data]).slices(order, width)
    same = prefix[1:] == prefix[:-1]
    again = np.zeros(len(text), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    out: list[tuple[int, int] | None] = []
    for start, end, (_, copies) in zip(starts.tolist(), ends.tolist(), segments, strict=True):
        hit = np.flatnonzero(again[start:end]) if copies == 1 else np.array([0, end - start - 1 - width])
        out.append((int(hit[0]), int(hit[-1])) if len(hit) else None)
    return out


def _symbols(data: bytes) -> tuple[int, Callable[[int, int], np.ndarray]]:
    own = np.frombuffer(data, np.uint8)
    return len(own), lambda a, b: _BYTE_HASHES[own[a:b]]


def repeated_bytes(docs: DataFrame, *, text: str = "text", width: int = WIDTH, gram: int = GRAM, batch_bytes: int = BATCH_BYTES, crowd: int = CROWD) -> DataFrame:
    """`docs` with `_spans`: (start, end) of the bytes to remove, null where there are none."""
    rows = keyed(docs, *docs.columns)
    spans = recurring(
        rows.select("_row", F.col(text).alias("_text")),
        "_text",
        symbols_of=_symbols,
        cut=lambda data: lambda a, b: data[a:b],
        resolve=lambda segments: first_and_last(segments, width),
        width=width,
        gram=min(gram, width),
        batch_bytes=batch_bytes,
        crowd=crowd,
    )
    return rows.join(spans.withColumnRenamed("spans", "_spans"), "_row", "left").drop("_row")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes(read(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = found.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, spans in zip(binaries(batch, "text"), batch.column(2).to_pylist(), strict=True):
                gone = mask_of(spans, len(data))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if spans else data
                edges = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
                out.append((len(data), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest()))
            arrays = [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [ids.name, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    longs = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    return found.select("doc_id", "text", "_spans").mapInArrow(run, T.StructType([ids, *longs, T.StructField("kept_sha256", T.StringType())]))
