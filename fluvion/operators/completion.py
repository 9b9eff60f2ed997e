"""Products that cover the whole prior database, their names and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType

from ..functions import quality
from . import network

# Fills of products by type, the bits of nodes and reaches that nothing was seen of, the crossover quality of these.
FILL_FLOAT, FILL_LONG, FILL_INT = -999999999999.0, -999999999, -999
NODE_UNSEEN = quality.mask_of(("wse_bad", "no_sig0", "no_area", "no_wse", "no_pixels"))
REACH_UNSEEN = quality.mask_of(("no_area", "no_wse", "no_pixels"), quality.REACH_BITS)
DISCHARGE_UNSEEN = quality.mask_of(("reach_bad", "none"), quality.DISCHARGE_BITS)
BAD, NO_CROSSOVER = 3, 2


def _filled(joined: DataFrame, columns: list[str], fixed: dict[str, int]) -> DataFrame:
    """Rows without _seen get the fixed values and, elsewhere in columns, the fill of the type; so do nulls of rows that were seen."""
    fills = {DoubleType: FILL_FLOAT, FloatType: FILL_FLOAT, LongType: FILL_LONG, IntegerType: FILL_INT}
    out = {}
    for c in columns:
        kind = joined.schema[c].dataType
        fill = F.lit(fills.get(type(kind))).cast(kind)
        out[c] = F.when(F.col("_seen").isNull(), F.lit(fixed[c]).cast(kind)).otherwise(F.coalesce(c, fill)) if c in fixed else F.coalesce(c, fill)
    return joined.withColumns(out).drop("_seen")


def complete_nodes(prior: DataFrame, observed: DataFrame) -> DataFrame:
    """Every prior node with what was observed of it, or fills, quality 3 and the bits that say that nothing was seen; and node_dist.

    prior: reach_id, node_id, x_prior, y_prior and other columns. observed: reach_id, node_id, x, y, node_q, node_q_b, xovr_cal_q and others. Ghost reaches and
    reaches of one node aren't in the product. node_dist is the distance from the prior place, a fill where the observed one is.
    """
    sizes = prior.groupBy("reach_id").agg(F.count("*").alias("_nodes")).where(F.col("_nodes") > 1).drop("_nodes")
    wanted = prior.where(F.col("reach_id") % 10 != network.GHOST).join(sizes, "reach_id", "left_semi")
    columns = [c for c in observed.columns if c not in ("reach_id", "node_id")]
    met = wanted.join(observed.withColumn("_seen", F.lit(True)), ["reach_id", "node_id"], "left")
    out = _filled(met, columns, {"node_q": BAD, "node_q_b": NODE_UNSEEN, "xovr_cal_q": NO_CROSSOVER})
    missing = (F.col("x") == FILL_FLOAT) | (F.col("y") == FILL_FLOAT)
    return out.withColumn("node_dist", F.when(missing, FILL_FLOAT).otherwise(F.hypot(F.col("x") - F.col("x_prior"), F.col("y") - F.col("y_prior"))))


def complete_reaches(prior: DataFrame, observed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every prior reach with what was observed of it, or fills and the fixed qualities; neighbours' ids and counts, and partial_f.

    prior: reach_id, up, down. observed: reach_id, obs_frac_n, reach_q, reach_q_b, dschg_q_b, dschg_gq_b, xovr_cal_q and others. nodes: the prior nodes. Ids of 0
    become fills. partial_f is 1 if less than half of the reach was observed, as for one that wasn't at all.
    """
    sizes = nodes.groupBy("reach_id").agg(F.count("*").alias("_nodes")).where(F.col("_nodes") > 1).drop("_nodes")
    ids = {k: F.transform(k, lambda i: F.when(i == 0, F.lit(FILL_LONG)).otherwise(i)) for k in ("up", "down")}
    known = {f"n_{k}": F.size(F.filter(k, lambda i: i > 0)) for k in ("up", "down")}
    wanted = prior.where(F.col("reach_id") % 10 != network.GHOST).join(sizes, "reach_id", "left_semi").withColumns(known).withColumns(ids)
    columns = [c for c in observed.columns if c != "reach_id"]
    met = wanted.join(observed.withColumn("_seen", F.lit(True)), "reach_id", "left")
    fixed = {"reach_q": BAD, "reach_q_b": REACH_UNSEEN, "dschg_q_b": DISCHARGE_UNSEEN, "dschg_gq_b": DISCHARGE_UNSEEN, "xovr_cal_q": NO_CROSSOVER}
    return _filled(met, columns, fixed).withColumn("partial_f", F.when(F.col("obs_frac_n") < 0.5, 1).otherwise(0))


def named_discharge(rows: DataFrame, key: str, models: list[str]) -> DataFrame:
    """key and a column for each model and kind: dschg_<model> without gauges, dschg_g<model> with. rows: key, constrained, model, q."""
    names = [f"dschg_{g}{m}" for g in ("", "g") for m in models]
    name = F.concat(F.lit("dschg_"), F.when(F.col("constrained"), "g").otherwise(""), F.col("model"))
    return rows.withColumn("_name", name).groupBy(key).pivot("_name", names).agg(F.first("q"))


def check_fields(rows: DataFrame, fields: dict[str, dict]) -> DataFrame:
    """field, problem and n for each rule of a field that rows break: missing (null or NaN where that isn't allowed), infinite, low, high, bits.

    fields: by column valid_min, valid_max, fill (neither low nor high), flag_masks (the bits there may be) and nullable. One pass over the rows counts all rules.
    """
    tests: list[tuple[str, str, Column]] = []
    for name, f in fields.items():
        v = F.col(name)
        real = isinstance(rows.schema[name].dataType, (DoubleType, FloatType))
        here = v.isNotNull() & (v != f["fill"]) if "fill" in f else v.isNotNull()
        if not f.get("nullable", False):
            tests.append((name, "missing", v.isNull() | F.isnan(v) if real else v.isNull()))
        if real:
            tests.append((name, "infinite", F.abs(v) == float("inf")))
        if "valid_min" in f:
            tests.append((name, "low", here & (v < f["valid_min"])))
        if "valid_max" in f:
            tests.append((name, "high", here & (v > f["valid_max"]) & (~F.isnan(v) if real else F.lit(True))))
        if "flag_masks" in f:
            allowed = 0
            for m in f["flag_masks"]:
                allowed |= m
            tests.append((name, "bits", here & (v.bitwiseAND(F.lit(~allowed).cast("long")) != 0)))
    counts = rows.agg(*(F.count_if(F.coalesce(t, F.lit(False))).alias(f"_{k}") for k, (_, _, t) in enumerate(tests)))
    told = F.explode(F.array(*(F.struct(F.lit(a).alias("field"), F.lit(b).alias("problem"), F.col(f"_{k}").alias("n")) for k, (a, b, _) in enumerate(tests))))
    return counts.select(told.alias("t")).select("t.*").where("n > 0")


def correlates(rows: DataFrame, target: str, columns: list[str], top: int = 10) -> DataFrame:
    """name, value and place of the top highest and lowest correlations with target, in one pass over the rows."""
    found = rows.agg(*(F.corr(target, k).alias(k) for k in columns))
    long = found.select(F.explode(F.array(*(F.struct(F.lit(k).alias("name"), F.col(k).alias("value")) for k in columns))).alias("k")).select("k.*").where("value is not null")
    high = long.orderBy(F.desc("value"), "name").limit(top).withColumn("place", F.lit("top"))
    return high.unionByName(long.orderBy("value", "name").limit(top).withColumn("place", F.lit("bottom")))


def pass_product(tiles: list[DataFrame], order: list[str]) -> DataFrame:
    """One product of a pass from those of its tiles, in order of the ids (by ranges, without one task that sorts all)."""
    out = tiles[0]
    for t in tiles[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.orderBy(*order)


def every(rows: DataFrame, k: int, line: str) -> DataFrame:
    """Every k-th line of a raster."""
    return rows.where(F.col(line) % k == 0)
