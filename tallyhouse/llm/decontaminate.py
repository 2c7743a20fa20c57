"""Benchmark decontamination: an FM-index per training shard answers for all benchmark phrases.

Words are lower-cased runs of ASCII letters, digits and non-ASCII characters. Each task reads its
rows in Arrow batches, turns the words that the benchmark knows into codes (other words end a run,
as no phrase holds them), and builds an index for each `shard_words` of them. Phrases are found by
backward search over wavelet ranks, located by sampled suffix positions, and merged to spans.
Documents meet no shuffle and are held a few batches at a time; a document longer than a shard is
cut with an overlap of a phrase.

Phrases go to every task, so their number is checked: a benchmark of more than `block_windows` is searched in
blocks of about so many, one pass over the documents each, and the spans of a document are merged afterwards. Long
items are cut into overlapping pieces for that. A task holds a block's phrases as one matrix of word codes.

Null, empty or wordless text: no words, no spans. Null or wordless items have no phrases. Repeated
rows keep a row each. Items with equal text are all named. A null item id is the text "null".
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import batches_of, bounded_batches, binaries, keyed, read, release, with_texts
from tallyhouse.llm.fm_index import FMIndex

PHRASE_WORDS = 10
SHARD_WORDS = 1 << 20
BLOCK_WINDOWS = 1 << 20
PIECE_WORDS = 1 << 16
GROUP_BYTES = 16 << 20

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SPANS = "array<struct<start:bigint,end:bigint,first_byte:bigint,end_byte:bigint>>"
FOUND = "_words bigint, _spans " + SPANS + ", _items array<string>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Phrases:
    """The distinct phrases of a block of benchmark items as word codes, and the items of each."""

    def __init__(self, items: list[tuple[str, bytes]], size: int = PHRASE_WORDS):
        self.code: dict[bytes, int] = {}
        self.size = size
        self.names = sorted({item for item, _ in items})
        number = {item: i for i, item in enumerate(self.names)}
        windows: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for item, text in items:
            coded = np.array([self.code.setdefault(w, len(self.code) + 1) for w in words(text)], np.int32)
            if len(coded):
                windows[min(size, len(coded))].append((number[item], coded))
        self.by_length = []
        for length, own in sorted(windows.items()):
            matrix = np.concatenate([np.lib.stride_tricks.sliding_window_view(coded, length) for _, coded in own])
            owners = np.repeat(np.array([i for i, _ in own], np.int32), [len(coded) - length + 1 for _, coded in own])
            order = np.lexsort((owners, *matrix.T[::-1]))
            matrix, owners = matrix[order], owners[order]
            fresh = np.ones(len(matrix), bool)
            fresh[1:] = (matrix[1:] != matrix[:-1]).any(axis=1)
            self.by_length.append((length, matrix[fresh], np.append(np.flatnonzero(fresh), len(matrix)), owners))

    def items(self, owners: np.ndarray) -> list[str]:
        return [self.names[i] for i in np.unique(owners).tolist()]


def item_pieces(items: DataFrame, size: int = PHRASE_WORDS, piece_words: int = PIECE_WORDS) -> DataFrame:
    """(i, t, windows): items (i, t) in pieces that hold each of their windows once; wordless items have none."""
    step = max(1, piece_words - size + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), binaries(batch, "t"), strict=True):
                own = words(text)
                for at in range(0, max(1, len(own) - size + 1) if own else 0, step):
                    part = own[at : at + step + size - 1]
                    yield pa.RecordBatch.from_arrays([pa.array([item]), pa.array([b" ".join(part)], pa.binary()).cast(pa.string()), pa.array([max(1, len(part) - size + 1)], pa.int64())], ["i", "t", "windows"])

    return items.mapInArrow(run, "i string, t string, windows long")


def _occurrences(shard: list[tuple[int, int, np.ndarray]], phrases: Phrases) -> Iterator[tuple[int, int, int, list[str]]]:
    """(document, word position, length, items) of each phrase in a shard of (document, offset, codes)."""
    parts, places, owners = [], [], []
    for doc, offset, codes in shard:
        known = codes > 0
        known[1:] |= codes[:-1] > 0  # of a run of unknown words, only the first stays, as an end
        at = np.flatnonzero(known)
        parts += [codes[at], [0]]
        places += [at + offset, [-1]]
        owners += [np.full(len(at) + 1, doc)]
    codes, place, owner = (np.concatenate(x) for x in (parts, places, owners))
    index = FMIndex(codes.astype(np.int32), len(phrases.code) + 1)
    for length, coded, first, owned in phrases.by_length:
        low, high = index.search(coded)
        count = high - low
        hit = np.flatnonzero(count)
        if not len(hit):
            continue
        which = np.repeat(hit, count[hit])
        rows = np.arange(len(which)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit]) + low[which]
        for at, phrase in zip(index.locate(rows), which, strict=True):
            yield int(owner[at]), int(place[at]), length, phrases.items(owned[first[phrase] : first[phrase + 1]])


def _shards(texts: list[bytes], phrases: Phrases, shard_words: int, counts: list[int]) -> Iterator[list]:
    shard, held = [], 0
    get, step = phrases.code.get, max(1, shard_words - phrases.size + 1)
    for doc, text in enumerate(texts):
        coded = np.array([get(w, 0) for w in words(text)], np.int32)
        counts.append(len(coded))
        for start in range(0, max(1, len(coded) - phrases.size + 1) if len(coded) else 0, step):
            part = coded[start : start + shard_words]
            if part.any():
                shard.append((doc, start, part))
                held += len(part)
            if held >= shard_words:
                yield shard
                shard, held = [], 0
    if shard:
        yield shard


def _merged(hits: list[tuple[int, int]]) -> list[list[int]]:
    spans: list[list[int]] = []
    for start, end in sorted(hits):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return spans


def _with_bytes(text: bytes, spans: list[list[int]]) -> list[dict]:
    bounds = [m.span() for m in _WORD.finditer(text)]
    return [{"start": s, "end": e, "first_byte": bounds[s][0], "end_byte": bounds[e - 1][1]} for s, e in spans]


def _merge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of all blocks, sorted by start, become maximal spans."""
    for batch in batches:
        at = batch.schema.get_field_index("_spans")
        merged = []
        for own in batch.column(at).to_pylist():
            out: list[dict] = []
            for s in own:
                if out and s["start"] <= out[-1]["end"]:
                    out[-1] |= {k: max(out[-1][k], s[k]) for k in ("end", "end_byte")}
                else:
                    out.append(s)
            merged.append(out)
        yield batch.set_column(at, "_spans", pa.array(merged, _SPAN_TYPE))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    phrase_words: int = PHRASE_WORDS,
    shard_words: int = SHARD_WORDS,
    block_windows: int = BLOCK_WINDOWS,
    cut: bool = False,
    chars: str | None = None,
) -> DataFrame:
    """`docs` with `_words` (words), `_spans` (merged, in words and in bytes of the UTF-8 text) and
    `_items` (ids of the items found, sorted).
    With `cut`, `docs` alone with the spans taken out of the text, as in `decontaminate`."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"), F.col(item_text).alias("t")).filter("t IS NOT NULL")
    items = item_pieces(items, phrase_words, min(PIECE_WORDS, block_windows + phrase_words - 1))
    windows = items.agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]
    blocks = max(1, -(-windows // block_windows))
    schema = T.StructType([*docs.schema.fields, *T._parse_datatype_string(FOUND).fields])

    def searched(frame: DataFrame, block: int, out: T.StructType) -> DataFrame:
        picked = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast([(r.i, r.t.encode()) for r in picked.toLocalIterator()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = Phrases(shared.value, phrase_words)
            for group in batches_of(batches, text, GROUP_BYTES):
                texts = [t for batch in group for t in binaries(batch, text)]
                counts: list[int] = []
                hits, named = defaultdict(set), defaultdict(set)
                if phrases.by_length:
                    for shard in _shards(texts, phrases, shard_words, counts):
                        for doc, at, length, owners in _occurrences(shard, phrases):
                            hits[doc].add((at, at + length))
                            named[doc].update(owners)
                else:
                    counts = [len(words(t)) for t in texts]
                done = 0
                for batch in group:
                    rows = range(done, done + batch.num_rows)
                    done += batch.num_rows
                    if cleaned:
                        yield without(batch, {i: _with_bytes(texts[r], _merged(list(hits[r]))) for i, r in enumerate(rows) if r in hits}, text, chars)
                        continue
                    extra = [
                        pa.array([counts[r] for r in rows], pa.int64()),
                        pa.array([_with_bytes(texts[r], _merged(list(hits[r]))) if r in hits else [] for r in rows], _SPAN_TYPE),
                        pa.array([sorted(named[r]) if r in named else [] for r in rows], pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "_words", "_spans", "_items"])
            release()

        return frame.mapInArrow(run, out)

    cleaned = cut and blocks == 1
    if blocks == 1:
        return searched(docs, 0, docs.schema if cut else schema)
    whole = keyed(docs, *docs.columns, key="_doc_row")
    passes = [
        searched(whole.select("_doc_row", text), b, T.StructType([T.StructField("_doc_row", T.LongType()), docs.schema[text], *T._parse_datatype_string(FOUND).fields])).drop(text)
        for b in range(blocks)
    ]
    found = passes[0]
    for more in passes[1:]:
        found = found.unionByName(more)
    found = found.groupBy("_doc_row").agg(
        F.max("_words").alias("_words"),
        F.array_sort(F.flatten(F.collect_list("_spans"))).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"),
    )
    found = whole.join(found.mapInArrow(_merge_blocks, found.schema), "_doc_row").drop("_doc_row")
    if not cut:
        return found
    kept = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index("_spans")).to_pylist()
            yield without(batch, {i: own for i, own in enumerate(spans) if own}, text, chars).select(kept)

    return found.mapInArrow(clean, docs.schema)


def without(batch: pa.RecordBatch, spans: dict[int, list[dict]], text: str, chars: str | None) -> pa.RecordBatch:
    """`batch` with the spans of its rows taken out of their texts."""
    texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
    for i, own in spans.items():
        for s in reversed(own):
            texts[i] = texts[i][: s["first_byte"]] + texts[i][s["end_byte"] :]
    return with_texts(batch, text, texts, list(spans), chars)


_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())]))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", chars: str | None = None, **options) -> DataFrame:
    """`docs` with the spans taken out of `text`; what separates words outside of them stays.

    Clean documents are unchanged. `chars` names a column with the texts' code points, to be kept right.
    """
    return contamination(docs, benchmark, text=text, cut=True, chars=chars, **options)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, read(spark, sf_dir, "benchmark"))
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"),
        (F.size("_spans") > 0).alias("contaminated"),
    )
