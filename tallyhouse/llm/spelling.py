"""Spelling variant groups by dense prefix-suffix tiling of padded code-point matrices.

Two words are near if one inserted, deleted or replaced code point tells them apart: that is so exactly
if the lengths of their common prefix and common suffix sum up to the longer length less one, or more. Of
the two, one is then half of the longer length at least, so near words share the first or the last half
(of that length) and meet in the group of it. A group is cut into blocks of at most about `block` words,
by a hash, and the pairs of blocks are dealt to tasks. A task writes two blocks as matrices of code points, padded to
a common width, once from the left and once from the right, and compares all rows of one with all rows
of the other, column by column. A pair that shares both halves counts in the group of the prefix only.

Words are counted in each task first, document by document, and their sums are shuffled, not their
occurrences. A form has `ratio` times the occurrences of its word at least, so chains of forms end after
some log(n) steps, and doubling the steps finds all roots in a few joins.

Null, empty and blank texts have no words, a null id is written as nothing before the colon, and repeated
rows count each. Very long texts are taken in pieces that end between words; blocks of very long words
hold fewer of them. Ties between forms go by code-point order. No words: no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import bounded_batches, read, release
from tallyhouse.session import pin

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
DELETE_EVERY = 199
BLOCK = 512
TILE_CELLS = 1 << 18
_WIDTH_CELLS = 1 << 22
_HELD_WORDS = 1 << 18
_PIECE = 1 << 20

_LETTER = r"a-zÀ-ÿ"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def pieces(text: str, size: int = _PIECE) -> Iterator[str]:
    """A text in pieces of `size` code points or more, which end between runs of letters."""
    between = re.compile(f"[^{_LETTER}]")
    at = 0
    while len(text) - at > size:
        edge = between.search(text, at + size)
        end = edge.start() if edge else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def words_of(data: bytes, doc_id: str, min_length: int, delete_every: int | None) -> Counter:
    """The words of a text with their occurrences, code points taken out where the hash says so."""
    runs = re.compile(f"[{_LETTER}]{{{max(1, min_length)},}}")
    prefix = zlib.crc32(f"{doc_id}:".encode())
    out: Counter = Counter()
    for piece in pieces(data.translate(_FOLD).decode()):
        for run, n in Counter(runs.findall(piece)).items():
            if delete_every:
                h = zlib.crc32(run.encode(), prefix)
                if h % delete_every == 0:
                    gone = h % len(run)
                    run = run[:gone] + run[gone + 1 :]
                    if len(run) < min_length:
                        continue
            out[run] += n
    return out


def vocabulary(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, delete_every: int | None = DELETE_EVERY
) -> DataFrame:
    """(word, n): words of at least `min_length` code points that occur at least `min_count` times."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for own, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                held.update(words_of(data.as_py() or b"", own, min_length, delete_every))
                if len(held) > _HELD_WORDS:
                    yield flushed()
                    held.clear()
        if held:
            yield flushed()
        release()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"), F.col(text).alias("text"))
    counts = rows.mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def code_points(words: list[list[str]], size: int, width: int, pad: int) -> np.ndarray:
    """Groups of words as a (group, word, code point) array; short words and groups are filled with `pad`."""
    out = np.full((len(words), size, width), pad, np.uint32)
    if width <= 64:
        flat = [w for group in words for w in group]
        rows = np.concatenate([np.arange(len(group)) + i * size for i, group in enumerate(words)])
        length = np.fromiter(map(len, flat), np.int64, len(flat))
        codes = np.array(flat, dtype=f"<U{width}").view("<u4").reshape(len(flat), width)
        codes = np.where(np.arange(width) < length[:, None], codes, np.uint32(pad))
        out.reshape(-1, width)[rows] = codes
    else:
        for i, group in enumerate(words):
            for j, w in enumerate(group):
                out[i, j, : len(w)] = np.frombuffer(w.encode("utf-32-le"), "<u4")
    return out


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many leading code points each row of `left` shares with each row of `right`, group by group."""
    alive = np.ones((left.shape[0], left.shape[1], right.shape[1]), bool)
    total = np.zeros(alive.shape, np.uint8 if left.shape[2] < 256 else np.int32)
    for column in range(left.shape[2]):
        alive &= left[:, :, None, column] == right[:, None, :, column]
        if not alive.any():
            break
        total += alive
    return total


_LEFT, _RIGHT = 0xFFFFFFFF, 0xFFFFFFFE  # no code points, and never equal


def compared(groups: list[tuple[int, bool, list[str], list[str] | None]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, left word, right word) of the near pairs of groups (length, by prefix, words, others).

    Without others, the words are compared with each other. All lengths are at most that of the group, and
    one of each pair has just that.
    """
    width = max(g[0] for g in groups)
    rows = max(len(g[2]) for g in groups)
    columns = max(len(g[2] if g[3] is None else g[3]) for g in groups)
    left, right = [g[2] for g in groups], [g[2] if g[3] is None else g[3] for g in groups]
    back = lambda words: [[w[::-1] for w in group] for group in words]
    prefix = agreement(code_points(left, rows, width, _LEFT), code_points(right, columns, width, _RIGHT))
    suffix = agreement(code_points(back(left), rows, width, _LEFT), code_points(back(right), columns, width, _RIGHT))
    length = np.array([g[0] for g in groups])[:, None, None]
    hit = prefix.astype(np.int64) + suffix >= length - 1
    hit &= np.array([g[1] for g in groups])[:, None, None] | (prefix < length // 2)
    alone = np.array([g[3] is None for g in groups])[:, None, None]
    hit &= ~alone | (np.arange(rows)[:, None] < np.arange(columns))
    filled = lambda side, size: np.arange(size) < np.array([len(group) for group in side])[:, None]
    hit &= filled(left, rows)[:, :, None] & filled(right, columns)[:, None, :]
    return np.nonzero(hit)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows (size, prefix, key, low, high, block, word, n) that come in the order of these."""
    names = ["word", "n", "other", "other_n"]
    stacked: dict[int, list] = {}

    def solve(stack: list) -> Iterator[pa.RecordBatch]:
        group, i, j = (x.tolist() for x in compared([s[:4] for s in stack]))
        found = []
        for g, a, b in zip(group, i, j, strict=True):
            size, _, own, others, counts, other_counts = stack[g]
            others, other_counts = (own, counts) if others is None else (others, other_counts)
            if max(len(own[a]), len(others[b])) == size:
                found.append((own[a], counts[a], others[b], other_counts[b]))
        if found:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for (size, by_prefix, _, low, high), group in groupby(rows(), key=lambda r: r[:5]):
        members = list(group)
        own = [r for r in members if r[5] == low]
        others = None if low == high else [r for r in members if r[5] == high]
        if len(own) < 2 and others is None or not own or others == []:
            continue
        entry = (size, by_prefix, [r[6] for r in own], others and [r[6] for r in others], [r[7] for r in own], others and [r[7] for r in others])
        high_water = max(len(own), len(others or ()))
        if others is not None or high_water > 128 or size > 64:
            yield from solve([entry])
            continue
        padded = 1 << (high_water - 1).bit_length()  # small groups of like sizes are one array
        stack = stacked.setdefault(padded, [])
        stack.append(entry)
        if len(stack) * padded * padded >= TILE_CELLS:
            yield from solve(stacked.pop(padded))
    for stack in stacked.values():
        yield from solve(stack)
    release()


def near_pairs(words: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(word, n, other, other_n) for each two near words, both ways. `words` has each word (not null) once, with n."""
    half = F.floor(F.col("size") / 2).cast("int")
    part = F.when(F.col("prefix"), F.substring("word", F.lit(1), half)).otherwise(F.substring("word", F.length("word") - half + 1, half))
    # a word meets those of its own length and shorter ones, or as the shorter word the longer ones
    sides = F.explode(F.array(*[F.struct((F.length("word") + more).alias("size"), F.lit(prefix).alias("prefix")) for more in (0, 1) for prefix in (True, False)]))
    keyed = words.filter(F.length("word") > 0).select("word", "n", sides.alias("side")).select("word", "n", "side.*").withColumn("key", F.xxhash64(part))
    group = ["size", "prefix", "key"]
    counts = keyed.groupBy(group).agg(F.count("*").alias("members"), F.max(F.length("word")).alias("longest")).filter("members > 1 AND longest = size")
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(_WIDTH_CELLS) / F.col("size"))))
    sized = counts.select(*group, F.ceil(F.col("members") / most).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    placed = keyed.join(sized, group).withColumn("block", own)
    dealt = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = dealt.select(*group, F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "word", "n")
    tile = [*group, "low", "high"]
    found = rows.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(_tiles, "word string, n long, other string, other_n long")
    turned = F.explode(F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))))
    return found.select(turned.alias("pair")).select("pair.*")


def spelling_forms(words: DataFrame, *, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for `words` (word, n)."""
    if ratio < 2:
        raise ValueError("a form needs at least twice the occurrences, or forms could go in circles")
    words = pin(words.select("word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    seen = near_pairs(words, block=block).groupBy("word").agg(F.first("n").alias("n"), F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    near = pin(seen.select("word", "n_near", F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    steps = near.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(math.log(most, ratio) + 2))):  # each join doubles the steps
        onward = steps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        steps = pin(steps.join(onward, steps["root"] == onward["_at"], "left").select("word", F.coalesce("_next", "root").alias("root")))
    return (
        words.join(near, "word", "left")
        .join(steps, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(vocabulary(read(spark, sf_dir, "documents")))
