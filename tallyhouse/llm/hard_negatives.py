"""Hard-negative mining with exact scores from a residue-number-system matrix product.

Scores are inner products of whole numbers. A block of anchors and a block of rows are multiplied once for
each of a few small primes: components are taken modulo the prime, between minus and plus half of it, so
that the sums of a float32 product stay under 2^24 and are exact. The residues of a score give its signed value
by the Chinese remainder theorem in mixed radix. As many primes are used as the largest norm of any row
needs: no inner product is larger than it (Cauchy-Schwarz).

The anchors are a stated query set, and meet all rows in blocks: rows are dealt to row blocks, anchors to
anchor blocks, and each pair of blocks is one task's group, of bounded size. First every anchor's best rows
of its own label are its positives. With their scores known, the same pairs of blocks give the best rows of
other labels in each positive's window. A group gives at most `positives`, or `positives` times `negatives`, rows for an anchor,
and windows over these pick the best of all groups. The work is that of the query set times all rows.

Rows with a null label, id or vector, or a null or non-finite component, take no part, nor do those whose
squared norm reaches 2^56, as their scores might not fit. Shorter vectors count as filled up with zeros. Repeated
rows are rows of their own, but no row with the anchor's id is the anchor's positive or negative, and
of anchors with one id the least (label, then components) asks. Ties go by id. No rows: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import read
from tallyhouse.session import pin

EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
ROW_BLOCK = 8192
ANCHOR_BLOCK = 8192
LABELS = 10
MOVED_EVERY = 7
_TILE = 1 << 21  # scores held at once
_SPAN = 4096  # components multiplied at once
_EXACT = 1 << 24
_NORM = 2.0**56


def moduli(dimension: int, bound: int) -> list[int]:
    """The largest primes whose products of residues stay exact over `dimension` components, enough of them for
    values of up to `bound` and as much again on each side."""
    top = 2 * int((_EXACT / max(1, min(dimension, _SPAN))) ** 0.5) + 1
    out: list[int] = []
    product, n = 1, min(top, 1021)
    while product <= 4 * bound + 4:
        while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
            n -= 1
        out.append(n)
        product *= n
        n -= 1
    return out


def centred(values: np.ndarray, p: int) -> np.ndarray:
    """What `values` leave modulo `p`, nearest to zero."""
    return values - np.rint(values / values.dtype.type(p)) * values.dtype.type(p)


def residues(rows: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    own = rows.astype(np.float64)
    return [centred(own, p).astype(np.float32) for p in primes]


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of two blocks, from their residues."""
    digits: list[np.ndarray] = []
    for i, (a, b, p) in enumerate(zip(left, right, primes, strict=True)):
        own = np.zeros((len(a), len(b)), np.float32)
        for at in range(0, a.shape[1], _SPAN):
            own = centred(own + centred(a[:, at : at + _SPAN] @ b[:, at : at + _SPAN].T, p), p)
        for digit, q in zip(digits, primes[:i], strict=True):
            own = centred((own - digit) * np.float32(pow(q, -1, p)), p)
        digits.append(own)
    total = digits[-1].astype(np.int64)
    for digit, p in reversed(list(zip(digits, primes, strict=True))[:-1]):
        total *= p
        total += digit.astype(np.int64)
    return total


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A column of lists as a matrix, short ones filled with zeros."""
    lists = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    offsets = lists.offsets.to_numpy()
    out = np.zeros((len(lists), width), np.int32)
    length = np.diff(offsets)
    values = lists.values.to_numpy()[offsets[0] : offsets[-1]]
    if len(lists) and (length == width).all():
        return values.reshape(len(lists), width)
    out[np.arange(width) < length[:, None]] = values
    return out


def best(rows: np.ndarray, values: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` entries of each row number: larger values first, then smaller ids."""
    order = np.lexsort((ids, -values, rows))
    ordered = rows[order]
    rank = np.arange(len(order)) - np.searchsorted(ordered, ordered, side="left")
    return order[rank < most]


def leading(score: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the allowed entries that are not under the row's `most`-th best allowed value."""
    least = np.iinfo(np.int64).min
    held = np.where(allowed, score, least)
    if held.shape[1] > most:
        bar = np.partition(held, held.shape[1] - most, axis=1)[:, held.shape[1] - most]
        allowed = allowed & (score >= bar[:, None])
    return np.nonzero(allowed)


def _cells(anchors: DataFrame, rows: DataFrame, sizes: tuple[int, int], run, schema: str) -> DataFrame:
    """`run(anchors, rows)` on each pair of an anchor block and a row block."""
    anchor_blocks, row_blocks = sizes
    number = F.monotonically_increasing_id()
    dealt = lambda df, own, n, other, m: df.withColumn(own, F.pmod(number, F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    left = dealt(anchors, "_a", anchor_blocks, "_b", row_blocks)
    right = dealt(rows, "_b", row_blocks, "_a", anchor_blocks)
    return left.groupBy("_a", "_b").cogroup(right.groupBy("_a", "_b")).applyInArrow(run, schema)


def usable(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, parts, norm) of the rows that take part, components in 256ths rounded down."""
    odd = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * 256).cast("double"))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~odd)
    norm = F.aggregate("parts", F.lit(0.0), lambda s, x: s + x * x)
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), whole.alias("parts")).withColumn("norm", norm)
    return rows.filter(F.col("norm") < _NORM).select("vec_id", "label", F.transform("parts", lambda x: x.try_cast("int")).alias("parts"), "norm")


def hard_negatives(
    rows: DataFrame,
    *,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    row_block: int = ROW_BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of `rows` (see `usable`).

    Anchors are the rows whose id `every` divides. Negatives lie between `low` and `high` hundredths of the positive.
    """
    asks = F.col("vec_id") % every == 0
    total = rows.agg(F.count("*").alias("n"), F.count(F.when(asks, 1)).alias("anchors"), F.max("norm").alias("norm"), F.max(F.size("parts")).alias("width")).first()
    width, primes = total.width or 0, moduli(total.width or 1, int(total.norm or 0) + 1)
    sizes = (max(1, -(-total.anchors // anchor_block)), max(1, -(-total.n // row_block)))
    rows = rows.select("vec_id", "label", "parts")
    anchors = pin(rows.filter(asks).groupBy("vec_id").agg(F.min(F.struct("label", "parts")).alias("own")).select("vec_id", "own.*"))

    def tiles(anchors: pa.Table, rows: pa.Table):
        """(first anchor, labels, scores against all rows) of some anchors at a time."""
        right = residues(matrix(rows["parts"], width), primes)
        left = residues(matrix(anchors["parts"], width), primes)
        step = max(1, _TILE // max(1, rows.num_rows))
        for at in range(0, anchors.num_rows, step):
            yield at, scores([x[at : at + step] for x in left], right, primes)

    found = "anchor_id long, positive_id long, score long"

    def own_label(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if anchors.num_rows and rows.num_rows:
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            for own in np.unique(anchors["label"].to_numpy()).tolist():
                mine, theirs = anchors.filter(pc.equal(anchors["label"], own)), np.flatnonzero(labels == own)
                if not len(theirs):
                    continue
                asked = mine["vec_id"].to_numpy()
                for at, score in tiles(mine, rows.take(theirs)):
                    i, j = leading(score, asked[at : at + len(score), None] != ids[theirs], positives)
                    value = score[i, j]
                    picked = best(i, value, ids[theirs][j], positives)
                    for part, values in zip(out, (asked[at + i[picked]], ids[theirs][j[picked]], value[picked]), strict=True):
                        part.append(values)
        return pa.table({name: np.concatenate(part) if part else np.empty(0, np.int64) for name, part in zip(("anchor_id", "positive_id", "score"), out, strict=True)})

    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    near = _cells(anchors, rows, sizes, own_label, found).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    near = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("own"))
    asking = pin(anchors.join(near, anchors["vec_id"] == near["anchor_id"]).select("vec_id", "label", "parts", F.col("own.positive_id").alias("positive"), F.col("own.score").alias("bar")))

    names = ("anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")

    def other_labels(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[] for _ in names]
        if anchors.num_rows and rows.num_rows:
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            asked, own = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
            count = pc.list_value_length(anchors["bar"]).to_numpy()
            held = np.arange(positives) < count[:, None]
            bars, chosen = np.zeros(held.shape, np.int64), np.zeros(held.shape, np.int64)
            bars[held], chosen[held] = pc.list_flatten(anchors["bar"]).to_numpy(), pc.list_flatten(anchors["positive"]).to_numpy()
            limit = np.iinfo(np.int64)
            for at, score in tiles(anchors, rows):
                here = slice(at, at + len(score))
                bar, real = bars[here], held[here]
                # no window reaches under the least lower end or over the largest upper end of the anchor's own
                least = np.where(real, -(-low * bar // 100), limit.max).min(axis=1)
                most = np.where(real, high * bar // 100, limit.min).max(axis=1)
                fits = (score >= least[:, None]) & (score <= most[:, None])
                fits &= (own[here, None] != labels) & (asked[here, None] != ids)
                i, j = np.nonzero(fits)
                value = score[i, j]
                for place in range(positives):
                    level = bar[i, place]
                    inside = np.flatnonzero(real[i, place] & (low * level <= 100 * value) & (100 * value <= high * level))
                    picked = inside[best(i[inside], value[inside], ids[j[inside]], negatives)]
                    rows_of = at + i[picked]
                    for part, values in zip(out, (asked[rows_of], np.full(len(picked), place), chosen[rows_of, place], bars[rows_of, place], ids[j[picked]], value[picked]), strict=True):
                        part.append(values)
        return pa.table({name: np.concatenate(part) if part else np.empty(0, np.int64) for name, part in zip(names, out, strict=True)})

    mined = _cells(asking, rows, sizes, other_labels, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = mined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(read(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


SQL = {
    "op13_hard_negatives": f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % {MOVED_EVERY} = 0 THEN (label::BIGINT + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), anchors AS (
  SELECT vec_id, min({{'label': label, 'parts': parts}}) AS own FROM v WHERE vec_id % {EVERY} = 0 GROUP BY vec_id
), scored AS (
  SELECT a.vec_id AS anchor_id, a.own.label = v.label AS same, v.vec_id,
         coalesce(list_sum(list_transform(list_zip(a.own.parts, v.parts), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
  FROM anchors a JOIN v ON a.vec_id <> v.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same QUALIFY place <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.vec_id))::INT AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND {LOW} * p.positive_score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
""",
}
