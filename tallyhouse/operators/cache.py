"""Replaying a request log against a TTL cache, cache reports and tier routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import publish
from tallyhouse.operators.spread import neighbour, null_safe_join
from tallyhouse.session import pin


def _ttl_cell(t: Column, ttl: int) -> Column:
    """Cells much shorter than the TTL, so a busy key is spread over many tasks."""
    return F.floor(t / F.lit(max(ttl * 1_000_000 // 256, 1)))


def ttl_replay(log: DataFrame, key: str, ts: str, request_id: str, ttl: int) -> DataFrame:
    """HIT, MISS or EXPIRED per request; the entry's age runs from its load, not from its last use.

    A request more than the TTL after its predecessor is always a load, so the
    log falls into runs. Inside a run each request points to the first one past
    its TTL; loads are what can be reached from the run's start. Reachability is
    found by doubling the pointers, in log2(longest chain) rounds of joins on
    (key, time), so even a key with a third of the log stays spread over tasks.
    Keys are not NULL.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    life = ttl * 1_000_000
    moments = log.groupBy(key, micros.alias("_t")).agg(F.min(request_id).alias("_first_id"))
    previous = neighbour(moments, [key], ["_t"], ["_t"], _ttl_cell(F.col("_t"), ttl))
    root = F.col("prev__t").isNull() | (F.col("_t") - F.col("prev__t") > life)

    # next moment past the TTL: probes and moments in one order, the nearest moment after each probe
    both = moments.select(key, F.col("_t").alias("_at"), F.col("_t").alias("_moment"), F.lit(None).cast("bigint").alias("_from")).unionByName(
        moments.select(key, (F.col("_t") + life).alias("_at"), F.lit(None).cast("bigint").alias("_moment"), F.col("_t").alias("_from"))
    )
    pointers = _next_moment(both, key, ttl)
    nodes = pin(
        previous.select(key, "_t", "_first_id", root.alias("_root"), F.col("prev__t").isNull().alias("_cold"))
        .join(pointers, [key, "_t"], "left")
    )
    # a pointer that leaves its run lands on the next run's start, a load already: it is dropped,
    # so every run is one chain and no moment is reached twice
    roots = nodes.filter("_root").select(key, F.col("_t").alias("_to"))
    inside = nodes.filter(F.col("_to").isNotNull()).join(roots, [key, "_to"], "left_anti")
    jumps = pin(inside.select(key, "_t", "_to"))
    reached = nodes.filter("_root").select(key, "_t")
    while not jumps.isEmpty():
        step = reached.join(jumps, [key, "_t"]).select(key, F.col("_to").alias("_t"))
        reached = pin(reached.unionByName(step))
        further = jumps.select(key, F.col("_t").alias("_to"), F.col("_to").alias("_to2"))
        jumps = pin(jumps.join(further, [key, "_to"]).select(key, "_t", F.col("_to2").alias("_to")))
    loads = nodes.join(reached, [key, "_t"], "left_semi").select(key, "_t", "_first_id", "_cold")

    tagged = log.withColumn("_t", micros)
    joined = null_safe_join(tagged, loads, [key, "_t"], "left")
    is_load = F.col("_first_id").eqNullSafe(F.col(request_id))
    outcome = F.when(is_load & F.col("_cold"), "MISS").when(is_load, "EXPIRED").otherwise("HIT")
    return joined.withColumn("outcome", outcome).select(*log.columns, "outcome")


def _next_moment(both: DataFrame, key: str, ttl: int) -> DataFrame:
    """For every probe the first moment strictly after it."""
    tagged = both.withColumn("_cell", _ttl_cell(F.col("_at"), ttl))
    # descending order keeps both frames growing, one step per row
    firsts = tagged.groupBy(key, "_cell").agg(F.min("_moment").alias("_first"))
    later = Window.partitionBy(key).orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select(key, "_cell", F.min("_first").over(later).alias("_outer"))
    inside = Window.partitionBy(key, "_cell").orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn("_inner", F.min("_moment").over(inside)).filter(F.col("_from").isNotNull())
    return null_safe_join(local, firsts, [key, "_cell"]).select(
        key, F.col("_from").alias("_t"), F.coalesce("_inner", "_outer").alias("_to")
    )


def cache_report(replayed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Calls, hits and hit percent."""
    hits = F.count_if(F.col("outcome") == "HIT")
    calls = F.count(F.lit(1))
    return replayed.groupBy(*keys).agg(
        calls.alias("calls"),
        hits.alias("hits"),
        F.count_if(F.col("outcome") == "MISS").alias("misses"),
        F.count_if(F.col("outcome") == "EXPIRED").alias("expired"),
        publish(F.try_divide(F.lit(100.0) * hits, calls), 1).alias("hit_pct"),
    )


def route_requests(requests: DataFrame, serving: DataFrame, live: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Answer from the serving table, else from the live recompute; say which tier and why a value is missing.

    `serving` and `live` have one row per key with the measure and is_suppressed.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(F.col(measure).alias("v"), F.col("is_suppressed").alias("s")).alias(name))

    joined = null_safe_join(null_safe_join(requests, side(serving, "_serving"), keys, "left"), side(live, "_live"), keys, "left")
    source = F.coalesce("_serving", "_live")
    tier = F.when(F.col("_serving").isNotNull(), "serving").when(F.col("_live").isNotNull(), "analytical").otherwise("none")
    reason = F.when(source.isNull(), "no_data").when(source.s, "suppressed")
    return joined.select(*requests.columns, tier.alias("tier"), source.v.alias(measure), reason.alias("reason"))
