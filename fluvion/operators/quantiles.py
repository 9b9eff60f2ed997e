"""Exact percentiles of few keys with many values, by repeated counting: no task ever holds or sorts a key's values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written

#: Bins that a range is cut into in each pass.
BINS = 1024
#: More keys than this are better served by an aggregate for each: the state is broadcast.
MOST_KEYS = 20_000


def percentiles(rows: DataFrame, key: list[str], value: str, shares: dict[str, float], passes: int = 40) -> DataFrame:
    """key, n and a column for each of shares (name: share from 0 to 1): the percentile, interpolated between neighbours as usual.

    A first pass counts a key's values and finds their range. Each further pass counts values in equal bins of the ranges in which the wanted
    ranks lie, and keeps the bin of each rank, shrunk to the values in it, until its values are all equal. A pass is an aggregate with partial
    sums over the rows, which are written once; ranges shrink a thousandfold in each. Null and NaN values don't count; null keys are a key. A key without
    values has no row.
    """
    given, key = key, [f"_k{i}" for i in range(len(key))]  # names of their own
    held = written(rows.select(*(F.col(g).alias(k) for g, k in zip(given, key, strict=True)), F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)"), "quantile-rows")
    sums = written(held.groupBy(*key).agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")), "quantile-keys")
    if key and sums.count() > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} keys: use F.percentile")
    wanted = []
    for name, share in shares.items():
        at = F.lit(float(share)) * (F.col("n") - 1)
        wanted += [F.struct(F.lit(f"{name}-lo").alias("which"), F.floor(at).alias("rank")), F.struct(F.lit(f"{name}-hi").alias("which"), F.ceil(at).alias("rank"))]
    state = sums.select(*key, "lo", "hi", F.explode(F.array(*wanted)).alias("w")).select(*key, "w.which", F.col("w.rank").cast("long").alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"))
    state = written(state, "quantile-state")
    names = [*key, "which"]
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key]
    for _ in range(passes):
        todo = state.where("lo < hi")
        if not todo.take(1):
            break
        inside = F.col("_v").between(F.col("lo"), F.col("hi"))
        for k in same:
            inside = inside & k
        # at most MOST_KEYS keys and two ranks for each share
        met = held.alias("r").join(F.broadcast(todo.alias("s")), inside).select(*(F.col(f"s.{k}").alias(k) for k in names), "rank", "below", "_v", ((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo"))).alias("_part"))
        bins = met.groupBy(*names, "rank", "below", F.least(F.floor(F.col("_part") * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.count("*").alias("c"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        before = Window.partitionBy(*names).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("below", F.col("below") + F.coalesce(F.sum("c").over(before), F.lit(0)))
        found = bins.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("c"))).select(*names, "rank", "lo", "hi", "below")
        state = written(found.unionByName(state.where("lo >= hi").select(*names, "rank", "lo", "hi", "below")), "quantile-state")
    of = lambda which: F.max(F.when(F.col("which") == which, F.col("lo")))
    out = state.groupBy(*key).agg(*(of(f"{n}-{side}").alias(f"{n}_{side}") for n in shares for side in ("lo", "hi")))
    met = sums.alias("k").join(out.alias("o"), _all([F.col(f"k.{k}").eqNullSafe(F.col(f"o.{k}")) for k in key]))
    values = []
    for name, share in shares.items():
        at = F.lit(float(share)) * (F.col("n") - 1)
        values.append((F.col(f"{name}_lo") + (at - F.floor(at)) * (F.col(f"{name}_hi") - F.col(f"{name}_lo"))).alias(name))
    return met.select(*(F.col(f"k.{k}").alias(g) for g, k in zip(given, key, strict=True)), "n", *values)


def _all(conditions):
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
