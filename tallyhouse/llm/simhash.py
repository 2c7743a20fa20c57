"""SimHash near-duplicate groups by multi-index hashing.

A fingerprint bit is set when it is set in over half of the hashes of a text's word shingles.
Fingerprints within `radius` bits are linked: the 64 bits are cut into segments, and each segment gets
a ball radius so that two linked fingerprints are within the ball of one segment at least. A table of
all fingerprints by (segment, bits) is probed with the balls around the bits of each fingerprint, and
what is found is checked over all 64 bits. Equal texts meet as one fingerprint.

A table bucket of more than `crowd` fingerprints would give pairs with the square of its size. Its
members are linked by wildcard keys instead: two fingerprints that agree on the bucket and differ by
at most t other bits share one of the keys with t other bits blanked, and everyone with that key is
linked to its least member. These are all true links, and they are as many as the members times a
constant; components come out the same.

Null, empty or blank text: fingerprint 0, linked like any other. Fewer words than a shingle: the whole
sequence is the shingle. Repeated rows each get a row. A null id never names a component, unless all
ids of it are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import binaries, bounded_batches, file_rows, keyed, numbered, read, release
from tallyhouse.llm.components import connected_components
from tallyhouse.session import pin

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
SEGMENTS = 2
CROWD = 512

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = text.translate(_FOLD).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    digest, count = xxhash.xxh64_intdigest, max(1, len(words) - size + 1)
    starts = [0, *ends[: count - 1]]
    ends = ends[min(size, len(words)) - 1 :]
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends, strict=True)), "<u8", count)
    votes = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):
        votes += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """`docs` without its text, and with `_fp` (64 bits as a signed long)."""
    kept = [c for c in docs.columns if c != text]
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle_words) for t in binaries(batch, text)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(prints)], [*kept, "_fp"])
        release()

    schema = docs.select(*kept, F.lit(0).cast("long").alias("_fp")).schema
    return docs.mapInArrow(run, schema)


def _segments(count: int, radius: int) -> list[tuple[int, int, int]]:
    """(lowest bit, width, ball radius): the radii and one each sum up to radius + 1, so that
    fingerprints outside of all balls differ by more than `radius` bits."""
    bounds = [64 * i // count for i in range(count + 1)]
    return [(a, b - a, (radius + 1 - i + count - 1) // count - 1) for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _masks(low: int, width: int, most: int) -> list[int]:
    return [sum(1 << (low + b) for b in bits) for n in range(most + 1) for bits in combinations(range(width), n)]


def _literals(values: list[int]) -> Column:
    return F.expr("array(" + ",".join(f"{_signed(v)}L" if _signed(v) > -(1 << 63) else "(-9223372036854775807L - 1L)" for v in values) + ")")


def links(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that give the components of all links within `radius`.

    `prints` has one column `_fp` of distinct values. All links are given, but for crowded buckets,
    where those to the least member stand for the others.
    """
    parts = [(i, *s) for i, s in enumerate(_segments(segments, radius)) if s[2] >= 0]
    whole = {i: sum(1 << b for b in range(low, low + width)) for i, low, width, _ in parts}
    tables, probes = [], []
    for i, low, width, ball in parts:
        own = F.col("_fp").bitwiseAND(F.lit(_signed(whole[i])))
        tables.append(prints.select(F.lit(i).alias("part"), own.alias("key"), F.col("_fp").alias("b")))
        probe = prints.select(F.lit(i).alias("part"), own.alias("own"), F.col("_fp").alias("a"), F.explode(_literals(_masks(low, width, ball))).alias("mask"))
        # of two fingerprints that differ by a mask, the one with the mask's highest bit asks
        top = [m for m in _masks(low, width, ball) if m]
        high = F.col("mask") == 0
        if top:
            ones = F.create_map(*[x for m in top for x in (F.lit(_signed(m)), F.lit(_signed(1 << (m.bit_length() - 1))))])
            high = high | (F.col("own").bitwiseAND(ones[F.col("mask")]) != 0)
        probes.append(probe.filter(high).select("part", F.col("own").bitwiseXOR(F.col("mask")).alias("key"), "a", "mask"))
    table, asked = tables[0], probes[0]
    for t, p in zip(tables[1:], probes[1:], strict=True):
        table, asked = table.unionByName(t), asked.unionByName(p)
    sizes = pin(table.groupBy("part", "key").count().filter(F.col("count") > crowd).select("part", "key"))
    away = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    quiet = table.join(sizes, ["part", "key"], "left_anti")
    found = asked.join(quiet, ["part", "key"]).filter(((F.col("mask") != 0) | (F.col("a") < F.col("b"))) & away).select("a", "b")

    # crowded buckets: members and those that ask for them, by wildcard keys
    crowded = []
    for i, low, width, ball in parts:
        others = [b for b in range(64) if not low <= b < low + width]
        keys = sizes.filter(F.col("part") == i)
        members = table.join(keys, ["part", "key"], "left_semi").select("key", F.col("b").alias("fp"))
        askers = asked.join(keys, ["part", "key"], "left_semi").select("key", F.col("a").alias("fp"), "mask")
        for n in range(ball + 1):
            masks = [m for m in _masks(low, width, ball) if m.bit_count() == n]
            blanks = [sum(1 << b for b in bits) for bits in combinations(others, min(radius - n, len(others)))]
            rows = askers.filter(F.bit_count("mask") == n).unionByName(members.withColumn("mask", F.explode(_literals(masks)))) if n else members.withColumn("mask", F.lit(0).cast("long"))
            rows = rows.withColumn("blank", F.explode(_literals(blanks)))
            rest = F.col("fp").bitwiseAND(F.bitwise_not("blank")).bitwiseAND(F.lit(_signed(~whole[i] & (1 << 64) - 1)))
            rows = rows.select("key", "mask", "blank", rest.alias("rest"), "fp")
            least = rows.groupBy("key", "mask", "blank", "rest").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
            crowded.append(rows.join(least, ["key", "mask", "blank", "rest"]).select("a", F.col("fp").alias("b")))
    if sizes.isEmpty():
        return found
    for more in crowded:
        found = found.unionByName(more)
    return found.filter("a <> b")


def simhash_groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, segments: int = SEGMENTS, crowd: int = CROWD
) -> DataFrame:
    """(_row, doc_id, _fp, _component, _first): the group's smallest id, and the row number of the row that
    stands for it (smallest id, nulls last; then the first row)."""
    prints = pin(fingerprints(keyed(docs, F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text", shingle_words))
    standing = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("least")
    nodes = prints.groupBy("_fp").agg(standing)
    joined = connected_components(links(nodes.select("_fp"), radius, segments, crowd))
    rooted = nodes.join(joined, nodes["_fp"] == joined["node"], "left").select("_fp", "least", F.coalesce("component", "_fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("best"))
    named = rooted.join(groups, "root").select("_fp", F.col("best.doc_id").alias("_component"), F.col("best._row").alias("_first"))
    return prints.join(named, "_fp").select("_row", "doc_id", "_fp", "_component", "_first")


def near_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` with one row of each group: the one with the smallest id."""
    docs, files = file_rows(docs)
    groups = simhash_groups(docs, doc_id=doc_id, text=text, **options)
    return numbered(docs, files, *docs.columns).join(groups.filter("_row = _first").select("_row"), "_row", "left_semi").drop("_row")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_component").alias("component_id"))
