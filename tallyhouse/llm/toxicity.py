"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of 3 to 5 code points of a lower-cased text, hashed to 2^20 places.
From the fitting rows come, per place, the rows of each label that have it; its log-count ratio scales
the feature, and a ratio that its standard error does not tell from zero is taken as zero, so that
long texts do not add up noise. Weights are fitted by logistic regression with a ridge.

The model is fitted on a bounded sample: at most `fit_rows` labelled rows (smallest hashes of their
ids first); a row that would take their texts over `fit_bytes` is left out of the fit, as only whole
texts are learnt from. One task fits it. Everything else is one pass over all documents, whole texts.
The model has a fixed size and is sent to every task.

Null or empty text has no features, and scores as the intercept says. Null labels and ids are not
learnt from. An id with several labels counts once for each. Without rows of both labels, or a ratio
told from zero, every score is 0.5 less a hair (nothing is predicted toxic). Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import bounded_batches, read, release

SIZES = (3, 4, 5)
BITS = 20
FIT_ROWS = 8_192
FIT_BYTES = 96 << 20
HELD_OUT = 5
_SENSE = 3.0  # standard errors from zero
_RIDGE = 1.0
_ROUNDS = 300
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def places(text: str, part: int = 1 << 18) -> Iterator[np.ndarray]:
    """Hashed places of the n-grams of a text, in parts, with repeats."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    longest = max(SIZES)
    for at in range(0, len(points), part):
        own = points[at : at + part + longest - 1]
        h = np.zeros(len(own), np.uint32)
        for n in range(1, longest + 1):
            if len(own) < n:
                break
            h = h[: len(own) - n + 1] + own[n - 1 :] * np.uint32(_FACTORS[n - 1])
            if n in SIZES:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
                # n-grams that begin in the next part belong to it
                yield (mixed >> np.uint32(32 - BITS))[:part]


def distinct(text: str) -> np.ndarray:
    own = list(places(text))
    return np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint32)


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(places, weights, intercept)."""
    y = labels.astype(np.float64)
    toxic, clean = y.sum(), len(y) - y.sum()
    if not toxic or not clean:
        return np.zeros(0, np.uint32), np.zeros(0), -1e-6
    # features are made twice and not kept, since only a few of their places get a weight
    counts = np.zeros((2, 1 << BITS), np.float32)
    for text, label in zip(texts, labels.tolist(), strict=True):
        counts[label, distinct(text)] += 1
    with_, without = counts[1].astype(np.float64) + 0.5, counts[0].astype(np.float64) + 0.5
    ratio = np.log(with_ / (toxic + 1)) - np.log(without / (clean + 1))
    error = np.sqrt(1 / with_ - 1 / (toxic + 1) + 1 / without - 1 / (clean + 1))
    kept = np.flatnonzero(np.abs(ratio) > _SENSE * error)
    if not len(kept):
        return np.zeros(0, np.uint32), np.zeros(0), -1e-6
    number = np.full(1 << BITS, -1, np.int32)
    number[kept] = np.arange(len(kept), dtype=np.int32)
    columns = []
    for text in texts:
        own = [number[p] for p in places(text)]
        columns.append(np.unique(np.concatenate([p[p >= 0] for p in own])) if own else np.zeros(0, np.int32))
    row = np.repeat(np.arange(len(y)), [len(c) for c in columns])
    column = np.concatenate([*columns, np.zeros(0, np.int64)]).astype(np.int64)
    scale = ratio[kept]

    def forward(w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(row, weights=(w * scale)[column], minlength=len(y)) + b

    # accelerated gradient steps; the step length follows the largest curvature
    weights, bias = np.zeros(len(kept)), float(np.log(toxic / clean))
    probe = np.ones(len(kept))
    norm = 1.0
    for _ in range(20):
        back = np.bincount(column, weights=forward(probe, 0.0)[row], minlength=len(kept)) * scale
        norm = max(1.0, float(np.linalg.norm(back) / max(1e-12, np.linalg.norm(probe))))
        probe = back / max(1e-12, np.linalg.norm(back))
    step = 1 / ((norm + len(y)) / 4 + _RIDGE)
    ahead, ahead_bias, momentum = weights, bias, 1.0
    for _ in range(_ROUNDS):
        slope = 1 / (1 + np.exp(-np.clip(forward(ahead, ahead_bias), -30, 30))) - y
        new = ahead - step * (np.bincount(column, weights=slope[row], minlength=len(kept)) * scale + _RIDGE * ahead)
        new_bias = ahead_bias - step * slope.sum()
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, ahead_bias = new + (momentum - 1) / grown * (new - weights), new_bias + (momentum - 1) / grown * (new_bias - bias)
        weights, bias, momentum = new, new_bias, grown
    return kept.astype(np.uint32), weights * scale, float(bias)


def fitted(docs: DataFrame, labels: DataFrame, *, fit_rows: int = FIT_ROWS, fit_bytes: int = FIT_BYTES) -> tuple:
    """The model from the labelled rows that are not held out."""
    spark = docs.sparkSession
    bounded_batches(spark)
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_label"))
        .filter(~held_out("_id") & F.col("_label").isin(0, 1))
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(fit_rows)
    )
    kind = docs.schema["doc_id"].dataType
    bounded = spark.createDataFrame([tuple(r) for r in chosen.collect()], T.StructType([T.StructField("_id", kind), T.StructField("_label", T.IntegerType())]))
    sample = docs.select("doc_id", "text").join(F.broadcast(bounded), F.col("doc_id") == F.col("_id")).select(F.coalesce("text", F.lit("")).alias("text"), F.col("_label").alias("label"), F.col("doc_id").alias("id"))

    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, own, held = [], [], 0
        for part in parts:
            for text, label in zip(part["text"], part["label"], strict=True):
                if held + len(text) <= fit_bytes:
                    held += len(text)
                    texts.append(text)
                    own.append(label)
        where, weights, bias = fit(texts, np.array(own, np.int64))
        del texts
        release()
        yield pd.DataFrame({"place": [-1, *where.tolist()], "weight": [bias, *weights.tolist()]})

    # in the order of the sample, so that the same rows are learnt from in each run
    model = sample.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", "label", "text").mapInPandas(learn, "place long, weight double").collect()
    bias = next((r.weight for r in model if r.place < 0), -1e-6)
    rest = [r for r in model if r.place >= 0]
    return np.array([r.place for r in rest], np.int64), np.array([r.weight for r in rest]), bias


def held_out(column: str):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """`docs` with `_score`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, weights, bias = shared.value
        table = np.zeros(1 << BITS, np.float32)
        table[where] = weights
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(batch.schema.get_field_index("text")).to_pylist()):
                found = [own[table[own] != 0] for own in places(text or "")]
                own = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
                scores[i] = bias + table[own].sum(dtype=np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(scores, -500, 500))))], [*kept, "_score"])
        release()

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of `docs` that score under `threshold`."""
    return score(docs, fitted(docs, labels, **options)).filter(F.col("_score") < threshold).select(docs.columns)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fitted(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))
