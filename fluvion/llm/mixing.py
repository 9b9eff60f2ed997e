"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Words: runs of other characters than U+0020 and U+0009 to U+000D.
WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix"
#: Seeds that are tried for each source.
SEEDS = 16
#: With at most this many sources their table is broadcast.
BROADCAST_SOURCES = 20_000


def size_of(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh weights in turn and share the sum of all sizes. A target stops at
    most times its source's size; the excess is shared again by weight. The fixed point is a water level: in
    order of capacity for each unit of weight, the sources below the level are full and the others get weight
    times the level. One row a source, so the windows run over few rows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("k", F.row_number().over(order)).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("k") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    w = w.withColumn("cap", F.col("source_size") * most)
    level = Window.orderBy(F.col("cap") / F.col("weight"), "k")
    upto, everything = level.rowsBetween(Window.unboundedPreceding, Window.currentRow), level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (
        w.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.sum("cap").over(upto))
        .withColumn("light", F.sum("weight").over(upto))
        .withColumn("heavy", F.sum("weight").over(everything) - F.col("light"))
    )
    # the cap of this row holds if, with all rows up to it full, what is left for each further unit of weight is no less than its own
    fits = (F.col("total") - F.col("full") + F.col("cap")) * F.col("weight") >= F.col("cap") * (F.col("heavy") + F.col("weight"))
    w = w.withColumn("capped", fits)
    w = w.withColumn("left", F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0)))
    w = w.withColumn("open", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("left") / F.col("open"))
    return w.select("source", "source_size", F.least(target, F.col("cap").cast("double")).alias("target"))


def draw(seed: Column, doc_id: str = "doc_id") -> Column:
    """A number in [0, 1) from the seed and the id: the first 48 bits of an MD5."""
    digest = F.md5(F.concat(seed, F.lit(":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(1 << 48)


def mix(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seeds: int = SEEDS) -> DataFrame:
    """All columns of docs, with size, source_size, target and copies: how often the mix takes the document.

    A document is taken floor(rate) times, and once more if its hash-seeded draw is below the fraction of the
    rate target / source_size; the draw depends on the source's seed and the id alone, so reruns agree. A few very long
    documents can take a source far from its target, so each source has the one of seeds seeds whose sum comes nearest; one
    aggregate over all documents finds it.
    Null texts have size 0, a null source is a source of its own, a source without words gets rate 0; rows
    with equal ids share a draw. An empty table gives an empty one. Clashing columns of docs (size,
    source_size, target, copies) are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies")
    sizes = stored(docs.select("source", size_of().alias("size")).groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    plan = stored(targets(sizes, weights, most), "mix-targets").withColumnRenamed("source", "__source")
    few = plan.count() <= BROADCAST_SOURCES
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)

    def planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
        return rows.withColumn("size", size_of()).join(F.broadcast(plan) if few else plan, F.col("source").eqNullSafe(F.col("__source")))

    def copies(seed: Column) -> Column:
        return (F.floor(rate) + F.when(draw(seed) < rate - F.floor(rate), 1).otherwise(0)).cast("int")

    tried = [F.sum(F.col("size") * copies(F.lit(f"{seed}-{k}"))).alias(f"taken_{k}") for k in range(seeds)]
    tried = planned(docs.select("doc_id", "source", "text"), plan).groupBy("__source").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), *tried)
    off = [F.struct(F.abs(F.col(f"taken_{k}") - F.col("target")).alias("off"), F.lit(k).alias("k")) for k in range(seeds)]
    best = F.array_min(F.array(*off))["k"]
    chosen = stored(tried.select("__source", "source_size", "target", F.concat(F.lit(f"{seed}-"), best.cast("string")).alias("__seed")), "mix-seeds")
    return planned(docs, chosen).withColumn("copies", copies(F.col("__seed"))).drop("__source", "__seed")


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document copies times, without the columns that mix() added."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("size", "source_size", "target", "copies", "__copy")
