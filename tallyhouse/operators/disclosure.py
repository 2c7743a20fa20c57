"""Two-way tables published with their totals: which hidden cells the totals give away, and how to stop it.

A table with totals is a graph. Rows and columns are nodes, the column of row totals and the row of
column totals are two more, and every cell, a total too, is an edge between its row and its column.
Each line sums to nothing (cells less their total), so a hidden cell follows from what is shown exactly
if its edge is a bridge among the hidden edges: on a cycle, its value could be moved around the cycle.

Bridges are found without walking the graph from one place. A spanning forest grows by rounds from the
smallest node of each component; every other edge puts a random 64-bit label on both of its ends, and the
labels are combined by XOR over each subtree, by doubling the distance in each round. A tree edge whose subtree
is left with 0 is crossed by no other edge. The forest needs about as many rounds as the graph is
wide: two for each line of the table's shorter side at most, as paths change sides with each step.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import pin_step as pin

_HOPS = 2  # steps of the forest between two checkpoints


def _forest(edges: DataFrame) -> DataFrame:
    """(node, root, depth, parent) for the nodes of edges (u, v): shortest paths to the least node of each component."""
    both = pin(edges.select(F.col("u").alias("node"), F.col("v").alias("near")).unionByName(edges.select(F.col("v").alias("node"), F.col("u").alias("near"))))
    state = pin(both.select("node").distinct().select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent")))
    best = F.min(F.struct("root", (F.col("depth") + 1).alias("depth"), F.col("near").alias("parent"))).alias("best")
    takes = F.col("best.root") < F.col("node")
    while True:
        step = state.withColumn("before", F.struct("root", "depth", "parent"))
        for _ in range(_HOPS):
            offered = both.join(step.select(F.col("node").alias("near"), "root", "depth"), "near").groupBy("node").agg(best)
            step = step.join(offered, "node").select(
                "node",
                F.when(takes, F.col("best.root")).otherwise(F.col("node")).alias("root"),
                F.when(takes, F.col("best.depth")).otherwise(0).alias("depth"),
                F.when(takes, F.col("best.parent")).alias("parent"),
                "before",
            )
        step = pin(step.withColumn("moved", ~F.struct("root", "depth", "parent").eqNullSafe(F.col("before"))))
        state = step.drop("before", "moved")
        if step.filter("moved").isEmpty():
            return state


def blocks(edges: DataFrame, seed: int = 1) -> DataFrame:
    """(node, root, parent, bridge, block) for the nodes of edges (u, v), each pair once.

    `bridge`: whether the edge to the parent is on no cycle. `block` names the part that stays together without bridges.
    """
    forest = _forest(edges)
    pair = lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).alias("pair")
    tree = forest.filter("parent IS NOT NULL").select(pair("node", "parent"))
    rest = edges.select("u", "v", pair("u", "v")).join(tree, "pair", "left_anti")
    ends = rest.select(F.explode(F.array("u", "v")).alias("node"), F.xxhash64(F.lit(seed), "u", "v").alias("label"))
    labels = ends.groupBy("node").agg(F.bit_xor("label").alias("label"))
    rounds = math.ceil(math.log2((forest.agg(F.max("depth")).first()[0] or 0) + 1))
    up = pin(forest.join(labels, "node", "left").select("node", F.coalesce("label", F.lit(0).cast("long")).alias("label"), F.col("parent").alias("jump")))
    for _ in range(rounds):  # the labels of all descendants nearer than the jump, twice as far each time
        more = up.filter("jump IS NOT NULL").groupBy("jump").agg(F.bit_xor("label").alias("more")).withColumnRenamed("jump", "node")
        onward = up.select(F.col("node").alias("jump"), F.col("jump").alias("next"))
        up = pin(up.join(more, "node", "left").join(onward, "jump", "left").select("node", F.col("label").bitwiseXOR(F.coalesce("more", F.lit(0).cast("long"))).alias("label"), F.col("next").alias("jump")))
    known = pin(forest.join(up.select("node", "label"), "node").select("node", "root", "parent", (F.col("parent").isNotNull() & (F.col("label") == 0)).alias("bridge")))
    top = known.select("node", F.when(F.col("parent").isNull() | F.col("bridge"), F.col("node")).otherwise(F.col("parent")).alias("block"))
    for _ in range(rounds):
        onward = top.select(F.col("node").alias("block"), F.col("block").alias("next"))
        top = pin(top.join(onward, "block").select("node", F.col("next").alias("block")))
    return known.join(top, "node")


def with_totals(cells: DataFrame, row: str, col: str, n: str) -> DataFrame:
    """`cells` and rows for their totals, told apart by `kind`, with the nodes `_u` and `_v` of each.

    Each pair of `row` and `col` occurs once. Totals have null keys where they sum over them, and only `n`.
    """
    own = pin(cells)
    kinds = {f.name: f.dataType for f in own.schema.fields}

    def totals(kind: str, keys: list[str]) -> DataFrame:
        grouped = own.groupBy(*keys).agg(F.sum(n).cast(kinds[n]).alias(n)).filter(F.col(n).isNotNull() | F.lit(bool(keys)))
        return grouped.select(F.lit(kind).alias("kind"), *[F.col(c) if c in (*keys, n) else F.lit(None).cast(kinds[c]).alias(c) for c in kinds])

    whole = own.select(F.lit("cell").alias("kind"), *kinds)
    for kind, keys in (("row_total", [row]), ("col_total", [col]), ("grand_total", [])):
        whole = whole.unionByName(totals(kind, keys))
    node = lambda mark, c: F.concat(F.lit(mark), F.to_json(F.struct(F.col(c).alias("k"))))
    inner = lambda *kinds: F.col("kind").isin(*kinds)
    return whole.withColumns({"_u": F.when(inner("cell", "row_total"), node("r", row)).otherwise("R"), "_v": F.when(inner("cell", "col_total"), node("c", col)).otherwise("C")})


def recoverable(table: DataFrame, hidden: Column) -> DataFrame:
    """The hidden rows of a table with totals (see `with_totals`) whose `n` follows from what is shown."""
    gone = pin(table.filter(hidden))
    known = blocks(gone.select(F.col("_u").alias("u"), F.col("_v").alias("v"))).filter("bridge")
    ends = known.select(F.least("node", "parent").alias("_a"), F.greatest("node", "parent").alias("_b"))
    return gone.withColumns({"_a": F.least("_u", "_v"), "_b": F.greatest("_u", "_v")}).join(ends, ["_a", "_b"], "left_semi").drop("_a", "_b")


def suppress_with_totals(cells: DataFrame, row: str, col: str, n: str, measures: Sequence[str], k: int = 4) -> DataFrame:
    """`cells` and their totals, with `kind` and `suppression_reason`, such that no hidden one can be computed.

    What is under `k` is hidden, totals too, and then the bridges are closed: every part of the hidden
    graph that hangs on one bridge hides its smallest open cell that leads out of it, preferring
    those that close a cycle at once, then cells to totals, until no bridge is left. There is always such a cell, as
    with its totals every cell of a table is on a cycle. Ties go by row and column. Measures are NULL where hidden.
    """
    small = F.coalesce(F.col(n) < k, F.lit(True))
    table = pin(with_totals(cells, row, col, n).withColumn("suppression_reason", F.when(small, "small_group")))
    rank = F.when(F.col("kind") == "cell", 0).when(F.col("kind") == "grand_total", 2).otherwise(1)
    while True:
        known = pin(blocks(table.filter("suppression_reason IS NOT NULL").select(F.col("_u").alias("u"), F.col("_v").alias("v"))))
        bridges = known.filter("bridge")
        if bridges.isEmpty():
            return table.withColumns({m: F.when(F.col("suppression_reason").isNull(), F.col(m)) for m in measures}).drop("_u", "_v")
        far = known.select(F.col("node").alias("parent"), F.col("block").alias("other"))
        ends = bridges.join(far, "parent").select(F.explode(F.array("block", "other")).alias("block"))
        hanging = ends.groupBy("block").count().filter("count = 1").select("block", F.lit(True).alias("hangs"))
        place = known.join(hanging, "block", "left").select("node", F.struct("root", "block", "hangs").alias("at"))
        side = lambda end: place.select(F.col("node").alias(end), F.col("at").alias(f"{end}_at"))
        open_ = table.filter("suppression_reason IS NULL").select("_u", "_v", "kind", F.col(n).alias("n")).join(side("_u"), "_u", "left").join(side("_v"), "_v", "left")
        leads_out = ~F.col("_u_at.block").eqNullSafe(F.col("_v_at.block"))
        choice = F.struct((~F.col("_u_at.root").eqNullSafe(F.col("_v_at.root"))).alias("far"), rank.alias("rank"), "n", "_u", "_v")
        offers = open_.filter(leads_out).select(choice.alias("choice"), F.explode(F.array("_u_at", "_v_at")).alias("at")).filter("at.hangs")
        picked = offers.groupBy("at.block").agg(F.min("choice").alias("choice")).select("choice._u", "choice._v").distinct().withColumn("_hit", F.lit(True))
        table = pin(table.join(picked, ["_u", "_v"], "left").withColumn("suppression_reason", F.coalesce("suppression_reason", F.when(F.col("_hit"), "complementary"))).drop("_hit"))
