"""Which windows of consecutive symbols occur more than once in a corpus: what two operators share.

Symbols are bytes or words. Every window of `width` symbols is put down to its anchor, the gram with the
least hash in it (the leftmost of equals). Equal windows have equal anchors at equal places, so a window
whose anchor's hash is found once in the corpus is unique, and only windows that share an anchor have to
be compared. Neighbouring windows with one anchor are a run, about one for each half width, and a run's
segment is all text its windows cover.

    runs        one row per run: document, anchor, hash of the segment, place; only those that share their anchor are kept
    settled     segments that occur again as a whole: all windows of their runs recur
    contested   anchors with several distinct segments: one copy of each goes to its anchor's task, where
                the operator finds the first and the last recurring window of those without copies

All windows of a run hold its anchor, so what recurring ones cover is one interval, from the first to
the last. Counts combine before they are shuffled; a contested anchor gets a row per distinct segment,
and one with more than `crowd` of them is taken to its windows instead, which are counted by content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import binaries, bounded_batches, release
from tallyhouse.session import drop_stored, pin, scratch_path

CROWD = 2048
CHUNK = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_PLACE = np.uint64((1 << 30) - 1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


class Rolling:
    """Hashes of slices of a sequence of 64-bit symbol hashes, from their prefix sums."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def load(self, symbols: np.ndarray) -> Rolling:
        n = len(symbols) + 1
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 12)
            back = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, back))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(symbols * self.up[: n - 1], out=self.sums[1:])
        return self

    def slices(self, start: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.down[start] + np.asarray(length).astype(np.uint64))

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all slices of one length, by their start."""
        n = max(0, len(self.sums) - length)
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n] + np.uint64(length))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each window."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(length: int, symbols: Callable[[int, int], np.ndarray], width: int, gram: int, rolling: Rolling) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, segment, first window, windows) arrays of a document of `length` symbols, chunk by chunk."""
    for at in range(0, max(0, length - width + 1), CHUNK):
        own = rolling.load(symbols(at, min(length, at + CHUNK + width - 1)))
        grams = own.windows(gram)
        keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        anchors = least(keys, width - gram + 1) & _PLACE
        first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        count = np.diff(np.append(first, len(anchors)))
        yield grams[anchors[first].astype(np.int64)], own.slices(first, count + width - 1), first + at, count


def runs_table(rows: DataFrame, text: str, symbols_of: Callable[[bytes], tuple[int, Callable]], width: int, gram: int) -> DataFrame:
    """Runs of all rows (`_row` and a text column) whose anchor is that of another run too, stored in the shared folder.

    Anchors are counted alone first, so those of one run cross the network as one number. Those of several are pinned,
    so that the join is between plain shuffles: beside an aggregate in its own stage, a common anchor's partition is not split.
    """
    names = ["_row", "anchor", "segment", "first", "windows"]
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[] for _ in names]
            for row, data in zip(batch.column(0).to_pylist(), binaries(batch, text), strict=True):
                length, symbols = symbols_of(data)
                for anchor, segment, first, count in runs_of(length, symbols, width, gram, rolling):
                    for part, values in zip(parts, (np.full(len(first), row), anchor.view(np.int64), segment.view(np.int64), first, count), strict=True):
                        part.append(values)
            if parts[0]:
                arrays = [pa.array(np.concatenate(p)) for p in parts]
                yield pa.RecordBatch.from_arrays([*arrays[:4], arrays[4].cast(pa.int32())], names)
        del rolling
        release()

    made = rows.select("_row", text).mapInArrow(run, "_row long, anchor long, segment long, first long, windows int")
    spark, path, kept = rows.sparkSession, scratch_path(rows.sparkSession, "runs"), scratch_path(rows.sparkSession, "shared")
    made.write.parquet(path)
    runs = spark.read.schema(made.schema).parquet(path)
    shared = pin(runs.groupBy("anchor").count().filter("count > 1").select("anchor"))
    runs.join(shared, "anchor", "left_semi").select(names).write.parquet(kept)
    drop_stored(spark, path)
    return spark.read.schema(made.schema).parquet(kept)


def recurring(
    rows: DataFrame,
    text: str,
    *,
    symbols_of: Callable[[bytes], tuple[int, Callable]],
    cut: Callable[[bytes], Callable[[int, int], bytes]],
    resolve: Callable[[list[tuple[bytes, int]]], list[tuple[int, int] | None]],
    width: int,
    gram: int,
    batch_bytes: int,
    crowd: int = CROWD,
) -> DataFrame:
    """(_row, spans) of rows with recurring windows; spans are (start, end) in symbols, sorted.

    `rows` has a `_row` that is the same in each scan. `symbols_of` gives a text's length in symbols and the hashes
    of a slice; `cut` gives the bytes of a slice. `resolve` gets distinct segments with their numbers of
    occurrences, whole anchor groups of `batch_bytes` or a little more, and gives the first and last
    recurring window of each, or None.
    """
    runs = runs_table(rows, text, symbols_of, width, gram)
    segments = runs.groupBy("anchor", "segment").agg(F.count("*").alias("copies"), F.min(F.struct("_row", "first", "windows")).alias("one"))
    anchors = segments.groupBy("anchor").agg(F.count("*").alias("kinds"))
    # pinned, so that the join below is between plain shuffles, whose large partitions are split
    repeated = pin(segments.join(pin(anchors), "anchor").select("anchor", "segment", "copies", "kinds", "one"))
    settled = repeated.filter("copies > 1").select("anchor", "segment", F.lit(0).alias("low"), (F.col("one.windows") - 1).alias("high"))

    wanted = (
        repeated.filter("kinds > 1")
        .groupBy(F.col("one._row").alias("_row"))
        .agg(F.collect_list(F.struct("anchor", "segment", "copies", (F.col("kinds") > crowd).alias("crowded"), F.col("one.first").alias("first"), F.col("one.windows").alias("windows"))).alias("wanted"))
    )
    pieces = ["anchor", "segment", "copies", "crowded", "piece"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def slice_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data, own in zip(binaries(batch, text), batch.column(batch.schema.get_field_index("wanted")).to_pylist(), strict=True):
                part = cut(data)
                out += [(w["anchor"], w["segment"], w["copies"], w["crowded"], part(w["first"], w["first"] + w["windows"] + width - 1)) for w in own]
            for at in range(0, len(out), 1 << 14):
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out[at : at + (1 << 14)]], k) for i, k in enumerate(kinds)], pieces)

    contested = pin(rows.join(wanted, "_row").select(text, "wanted").mapInArrow(slice_out, "anchor long, segment long, copies long, crowded boolean, piece binary"))

    def in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []
        size = grown = 0

        def solved(rows: list[tuple]) -> pa.RecordBatch:
            found = resolve([(piece, copies) for _, _, copies, piece in rows])
            kept = [(r[0], r[1], *own) for r, own in zip(rows, found, strict=True) if own is not None and r[2] == 1]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in kept], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["anchor", "segment", "low", "high"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[0][0]:
                    if held and size + grown > batch_bytes:
                        yield solved(held)
                        held, size = [], 0
                    held += group
                    size += grown
                    group, grown = [], 0
                group.append(row)
                grown += len(row[3]) + 1
        if held and size + grown > batch_bytes:
            yield solved(held)
            held = []
        if held or group:
            yield solved(held + group)
        release()

    groups = contested.filter("NOT crowded").select("anchor", "segment", "copies", "piece")
    found = groups.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(in_groups, "anchor long, segment long, low int, high int")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            for anchor, segment, copies, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                length, symbols = symbols_of(piece)
                hashes = rolling.load(symbols(0, length)).windows(width)
                n = len(hashes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (np.full(n, anchor), np.full(n, segment), np.full(n, copies), hashes.view(np.int64), np.arange(n, dtype=np.int32))],
                    ["anchor", "segment", "copies", "window", "at"],
                )

    crowds = contested.filter("crowded").select("anchor", "segment", "copies", "piece")
    if not crowds.isEmpty():
        each = crowds.mapInArrow(windows, "anchor long, segment long, copies long, window long, at int")
        # equal windows have equal anchors: hash and anchor tell windows apart
        again = pin(each.groupBy("anchor", "window").agg(F.sum("copies").alias("n")).filter("n > 1").select("anchor", "window"))
        found = found.unionByName(each.filter("copies = 1").join(again, ["anchor", "window"]).groupBy("anchor", "segment").agg(F.min("at").alias("low"), F.max("at").alias("high")))

    spread = settled.unionByName(found)
    spans = runs.join(pin(spread), ["anchor", "segment"]).select("_row", F.struct((F.col("first") + F.col("low")).alias("start"), (F.col("first") + F.col("high") + width).alias("end")).alias("span"))
    return spans.groupBy("_row").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def mask_of(spans: list[dict] | None, length: int) -> np.ndarray:
    """Which of `length` symbols lie in a span."""
    change = np.zeros(length + 1, np.int32)
    if spans:
        np.add.at(change, [s["start"] for s in spans], 1)
        np.add.at(change, [s["end"] for s in spans], -1)
    return np.cumsum(change[:-1]) > 0
