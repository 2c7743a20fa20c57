"""Repeatable fact generator over existing dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import clamp, lcg
from tallyhouse.operators.joins import cross_cells


def generate_facts(dims: Sequence[DataFrame], order: Sequence[Sequence[str]], n: int, base: float = 3.5) -> DataFrame:
    """n answers for every combination of the dimensions' rows, scores on a 1-5 scale in tenths.

    Ids and scores are integer arithmetic on the cell number, so any engine and
    any partitioning gives the same rows.
    """
    cells = cross_cells(dims, order)
    answers = cells.withColumn("respondent_no", F.explode(F.sequence(F.lit(1), F.lit(n))))
    response_id = F.col("cell_no") * n + F.col("respondent_no")
    noise = (lcg(response_id, salt=1) % 31 - 15).cast("double") / 10
    return (
        answers.withColumn("response_id", response_id)
        .withColumn("score", F.round(clamp(F.lit(base) + noise, 1.0, 5.0), 1))
        .drop("cell_no")
    )
