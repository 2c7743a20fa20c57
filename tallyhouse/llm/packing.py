"""Sequence packing by Karmarkar-Karp multiway differencing.

Documents are tokenised where they are read, each followed by an end token. What fills whole windows
is cut off as windows of its own; the rests are dealt to blocks of about `block_tokens`, and of about
`block_pieces` at most where they are short, by a hash, so that a block is a bounded sample of all rests,
and each block is packed by itself. A rest of more than
half a window is cut in two: with less than two rests to a window, no partition of them is near-equal. In a block, every
rest starts as a partition of one filled window; the two partitions with the largest differences are
merged again and again, fullest windows onto emptiest, until one is left, whose windows are nearly
equal. While the fullest exceeds the capacity, the number of windows rises.

Null or empty text: the end token alone. Repeated rows are packed each. An empty table gives no rows.
`docs` is read once; the pieces (without their tokens) are checkpointed before the blocks are sized.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import binaries, bounded_batches, release, read
from tallyhouse.llm.tokens import TextEncoder, special_strings
from tallyhouse.session import pin

CAPACITY = 1024
BLOCK_TOKENS = 1 << 18
BLOCK_PIECES = 1 << 14  # with 256 windows of eight bytes each, 32 MB of loads
END_TOKEN = 0
_SHIFT = 32  # of the block's number in a sequence id


def difference(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Members of each of `windows` windows after multiway differencing."""
    loads: dict[int, np.ndarray] = {}
    merges: dict[int, tuple] = {}
    heap = []
    for i, size in enumerate(sizes.tolist()):
        loads[i] = np.zeros(windows, np.int64)
        loads[i][0] = size  # in falling order
        heap.append((-size, i))
    heapq.heapify(heap)
    new = len(sizes)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = loads.pop(a) + loads.pop(b)[::-1]
        order = np.argsort(-total, kind="stable")
        loads[new] = total[order]
        merges[new] = (a, b, order)
        heapq.heappush(heap, (int(loads[new][-1] - loads[new][0]), new))
        new += 1
    members: list[list[int]] = [[] for _ in range(windows)]
    todo = [(heap[0][1], np.arange(windows))] if heap else []
    while todo:  # back through the merges: which window each partition's place became
        node, place = todo.pop()
        if node in merges:
            a, b, order = merges.pop(node)
            at = np.empty(windows, np.int64)
            at[order] = place
            todo += [(a, at), (b, at[::-1])]
        else:
            members[place[0]].append(node)
    return members


def pack(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows of at most `capacity`; sizes are positive and at most `capacity`."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        members = difference(sizes, windows)
        if max(int(sizes[m].sum()) for m in members) <= capacity:
            return [m for m in members if m]
        windows += 1


def pack_documents(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = "byte_bpe_50k",
    capacity: int = CAPACITY,
    block_tokens: int = BLOCK_TOKENS,
    block_pieces: int = BLOCK_PIECES,
    end_token: int = END_TOKEN,
    with_tokens: bool = False,
) -> DataFrame:
    """Pieces of documents with their window: `doc_id`, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and the ids themselves if `with_tokens`."""
    bounded_batches(docs.sparkSession)
    ids = docs.schema[doc_id]
    cut_schema = T.StructType([
        T.StructField("doc_id", ids.dataType), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "_from", "_no")),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_tokens else []),
    ])

    special, names = special_strings(vocabulary), cut_schema.names

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, no, half = TextEncoder(vocabulary, special), TaskContext.get().partitionId(), 0, -(-capacity // 2)
        for batch in batches:
            owners, columns, tokens = [], [], []
            for row, data in enumerate(binaries(batch, text)):
                coded = np.append(encoder.ids(data.decode()), np.uint32(end_token)).astype("<u4")
                full = len(coded) - len(coded) % capacity
                cuts = [*range(0, full, capacity), *range(full, len(coded), half), len(coded)]
                for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                    piece = coded[start:end]
                    columns.append((start, len(piece), zlib.crc32(piece.tobytes()), len(coded), part, no))
                    owners.append(row)
                    no += 1
                    if with_tokens:
                        tokens.append(piece.astype(np.int32))
            own = batch.column(batch.schema.get_field_index(doc_id)).take(pa.array(owners, pa.int32()))
            numbers = np.array(columns, np.int64).reshape(-1, 6)
            arrays = [own, *(pa.array(numbers[:, c]) for c in range(6)), *([pa.array(tokens, pa.list_(pa.int32()))] if with_tokens else [])]
            yield pa.RecordBatch.from_arrays(arrays, names)
        del encoder
        release()

    pieces = pin(docs.select(doc_id, text).mapInArrow(cut, cut_schema))
    full = pieces.filter(F.col("length") == capacity).withColumns({
        # windows that are one piece have odd numbers, told apart by where the piece was cut
        "sequence_id": (F.col("_from") * F.lit(1 << _SHIFT) + F.col("_no")) * 2 + 1,
        "offset": F.lit(0).cast("long"),
    })
    rest = pieces.filter(F.col("length") < capacity)
    total, count = rest.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    blocks = max(1, round(total / block_tokens), -(-count // block_pieces))

    def place(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["_from", "_no"], ignore_index=True)
        sequence, offset = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
        sizes = block["length"].to_numpy()
        for window, members in enumerate(pack(sizes, capacity)):
            sequence[members] = ((int(block["_block"].iloc[0]) << _SHIFT) + window) * 2
            offset[members] = np.cumsum(sizes[members]) - sizes[members]
        return block[["_from", "_no"]].assign(sequence_id=sequence, offset=offset)

    packed = (
        rest.select("_from", "_no", "length", F.pmod(F.xxhash64("_from", "_no"), F.lit(blocks)).alias("_block"))
        .groupBy("_block")
        .applyInPandas(place, "_from long, _no long, sequence_id long, offset long")
    )
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_tokens else [])]
    return full.select(columns).unionByName(rest.join(packed, ["_from", "_no"]).select(columns))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
