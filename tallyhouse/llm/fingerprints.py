"""SimHash document fingerprints, and search within a Hamming radius by permuted block tables.

A text's terms are its lower-cased words; a term's 64-bit hash votes with the term's weight (one plus
the logarithm of its count) on each bit, and the sign of the sum is the bit. The 64 bits are cut into
blocks; for each choice of blocks to lead, one table is keyed by the leading blocks. With more than
`radius` blocks, any two fingerprints within the radius agree on the leading blocks of one table at
least, so looking up a query in every table and comparing all 64 bits finds all of them.

The edited text of a document (see `with_next`) needs the next document in order: rows are dealt to
ranges of the order and sorted there, each task pairs neighbours, and the ends of the ranges (two rows
per range) are paired afterwards. Texts move once.

Null text is empty, and an empty text's fingerprint is 0. Ties and repeated rows follow the order of
the text's hash and then of the scan; null ids come last. A single document follows itself.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import bounded_batches, keyed, partitions, read
from tallyhouse.session import pin

BLOCKS = 5
RADIUS = 3
CACHED_TERMS = 200_000

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class TermHashes(dict):
    """64-bit hashes of terms, remembered up to a bound."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= CACHED_TERMS:
            self.clear()
        own = self[term] = xxhash.xxh64_intdigest(term)
        return own


def fingerprint(text: bytes, known: TermHashes | None = None) -> int:
    terms = Counter(text.translate(_FOLD).split())
    if not terms:
        return 0
    known = TermHashes() if known is None else known
    hashes = np.fromiter(map(known.__getitem__, terms), "<u8", len(terms))
    weights = 1 + np.log(np.fromiter(terms.values(), np.float64, len(terms)))
    votes = np.zeros(64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += weights[at : at + (1 << 15)] @ bits
    return int(np.packbits(votes * 2 > weights.sum(), bitorder="little").view("<u8")[0])


def likeness(a: int, b: int) -> float:
    return 1 - (a ^ b).bit_count() / 64


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by the first as many of the next text."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


_ROW = "doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, near_next double"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _paired(doc_id, text: str, own: int, following: str, theirs: int, known: TermHashes) -> tuple:
    changed = edited(text, following).encode()
    other = fingerprint(changed, known)
    return doc_id, len(text), hashlib.sha256(changed).hexdigest(), _signed(own), _signed(other), likeness(own, other), likeness(own, theirs)


def with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with likeness to that and to the next document.

    The next document is that with the next smaller id; the last one's is the first.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = keyed(docs, F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("_row")]
    ranged = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        part, known, held, first = TaskContext.get().partitionId(), TermHashes(), None, None
        for batch in batches:
            out = []
            for own_id, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fp = fingerprint(own.encode(), known)
                if held is None:
                    first = (own_id, own, fp)
                else:
                    out.append((*_paired(*held, own, fp, known), None, None, None))
                held = (own_id, own, fp)
            yield as_batch(out)
        if held is not None:  # the ends of this range wait for their neighbours
            end = (held[0], None, None, _signed(held[2]), None, None, None, part, "last", held[1])
            yield as_batch([end, (None, None, None, _signed(first[2]), None, None, None, part, "first", first[1])])

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.string(), pa.string()]
    names = [c.split()[0] for c in (_ROW + ", part long, end string, text string").split(", ")]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    made = pin(ranged.mapInArrow(run, _ROW + ", part long, `end` string, text string"))
    filled = sorted(r.part for r in made.filter("`end` = 'last'").select("part").collect())  # a number per range
    after = dict(zip(filled, [*filled[1:], *filled[:1]], strict=True))
    follow = spark.createDataFrame(list(after.items()), "part long, next_part long")
    last = made.filter("`end` = 'last'").select("part", "doc_id", "fp", "text").join(F.broadcast(follow), "part")
    heads = made.filter("`end` = 'first'").select(F.col("part").alias("next_part"), F.col("fp").alias("next_fp"), F.col("text").alias("next_text"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TermHashes()
        for batch in batches:
            out = [_paired(r["doc_id"], r["text"], r["fp"] % (1 << 64), r["next_text"], r["next_fp"] % (1 << 64), known) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds[:7])], names[:7])

    return made.filter("`end` IS NULL").select(*names[:7]).unionByName(last.join(heads, "next_part").mapInArrow(close, _ROW))


def _tables(blocks: int, radius: int) -> list[int]:
    """The bits of the leading blocks of each permuted table."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    own = [sum(1 << b for b in range(a, z)) for a, z in zip(bounds[:-1], bounds[1:], strict=True)]
    return [_signed(sum(lead)) for lead in combinations(own, blocks - radius)]


def within_radius(queries: DataFrame, prints: DataFrame, *, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, distance) for all pairs of a fingerprint in `queries` and one in `prints` (columns `fp`,
    distinct values) that differ in at most `radius` bits, the query's own included."""
    if blocks <= radius:
        raise ValueError("more blocks than the radius are needed")
    leads = F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.lit(m).cast("long").alias("lead")) for i, m in enumerate(_tables(blocks, radius))]))
    keys = lambda df, name: df.select(F.col("fp").alias(name), leads.alias("t")).select(name, "t.table", F.col(name).bitwiseAND(F.col("t.lead")).alias("key"))
    away = F.bit_count(F.col("query").bitwiseXOR(F.col("found"))).cast("int")
    met = keys(queries, "query").join(keys(prints, "found"), ["table", "key"]).filter(away <= radius)
    return met.select("query", F.col("found").alias("fp"), away.alias("distance")).distinct()


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also `n_near`: for ids divisible by 100, the documents within 3 bits, itself included; else null."""
    rows = pin(with_next(read(spark, sf_dir, "documents")))
    counted = rows.groupBy("fp").agg(F.count("*").alias("copies"))
    asked = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    near = within_radius(rows.filter(asked).select("fp").distinct(), counted.select("fp")).join(counted, "fp").groupBy("query").agg(F.sum("copies").alias("n_near"))
    text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return rows.join(near, rows["fp"] == near["query"], "left").select(
        "doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next",
        F.when(asked, F.col("n_near")).alias("n_near"),
    )
