"""Quality bits and summary flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the node, reach and discharge flags, and the bits from which a summary is degraded or bad.
NODE_BITS = {
    "sig0_suspect": 0, "class_suspect": 1, "geoloc_suspect": 2, "water_frac_suspect": 3, "blocked": 4, "bright_land": 7, "few_sig0": 9, "few_area": 10, "few_wse": 11, "far_range": 13, "near_range": 14,
    "class_degraded": 18, "geoloc_degraded": 19, "lake": 22, "outlier": 23, "wse_bad": 24, "no_sig0": 25, "no_area": 26, "no_wse": 27, "no_pixels": 28,
}
REACH_BITS = {"few_area": 10, "few_wse": 11, "partial": 15, "lake": 22, "min_fit": 25, "no_area": 26, "no_wse": 27, "no_pixels": 28}
DISCHARGE_BITS = {
    "reach_suspect": 0, "big_slope_u": 1, "metroman": 3, "bam": 4, "hivdi": 5, "momma": 6, "sads": 7, "sic4dvar": 8, "incomplete": 11, "reach_degraded": 18, "reach_bad": 22, "none": 23, "negative_slope": 24,
}
DEGRADED, BAD = 1 << 18, 1 << 22
# Fewest pixels, water fraction, share of the blocking width, range limits (m) and valid heights (m) of the node bits.
FEW_PIXELS, MOST_FRACTION, BLOCKED_SHARE, NEAR, FAR, LOWEST, HIGHEST = 10, 3.0, 0.9, 10_000.0, 60_000.0, -500.0, 8000.0
#: Bits of the nodes that say nothing about their reach, or are decided anew for it.
NOT_INHERITED = ("sig0_suspect", "blocked", "few_sig0", "few_area", "few_wse", "outlier", "wse_bad", "no_sig0", "no_area", "no_wse", "no_pixels")


def mask_of(names: tuple[str, ...], bits: dict[str, int] = NODE_BITS) -> int:
    return sum(1 << bits[n] for n in names)


def flag(conditions: dict[str, Column], bits: dict[str, int] = NODE_BITS) -> Column:
    """The sum of the bits whose condition holds; null counts as false."""
    parts = [F.when(c, F.lit(1 << bits[n])).otherwise(0).cast("long") for n, c in conditions.items()]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def has(flags: Column, name: str, bits: dict[str, int] = NODE_BITS) -> Column:
    return flags.bitwiseAND(F.lit(1 << bits[name]).cast("long")) > 0


def summary(flags: Column) -> Column:
    """0 good, 1 suspect, 2 degraded, 3 bad."""
    return F.when(flags == 0, 0).when(flags < DEGRADED, 1).when(flags < BAD, 2).otherwise(3).cast("int")


def blocked(least: Column, most: Column, width: Column) -> Column:
    """Pixels lie beyond the blocking width, whose sign tells the side; a null width blocks nothing."""
    test = width * BLOCKED_SHARE
    return F.coalesce(((test < 0) & (least < test)) | ((test > 0) & (most > test)), F.lit(False))


def node_flag(n: dict[str, Column], wse: Column, xtrack: Column, water_frac: Column, is_blocked: Column) -> Column:
    """The flag of a node from its counts of pixels.

    n has pixels, sig0, area and wse (pixels used for each), area_good and wse_good (those that are not degraded), enough_area and
    enough_wse (whether these were enough), sig0_suspect, area_suspect, wse_suspect, area_degraded, wse_degraded and bright.
    """
    return flag(
        {
            "sig0_suspect": n["sig0_suspect"] > 0, "class_suspect": n["area_suspect"] > 0, "geoloc_suspect": n["wse_suspect"] > 0, "water_frac_suspect": water_frac > MOST_FRACTION,
            "blocked": is_blocked, "bright_land": n["bright"] > 0, "few_sig0": n["sig0"] < FEW_PIXELS, "few_area": n["area"] < FEW_PIXELS, "few_wse": n["wse"] < FEW_PIXELS,
            "far_range": F.abs(xtrack) > FAR, "near_range": F.abs(xtrack) < NEAR, "class_degraded": ~n["enough_area"] & (n["area_degraded"] > 0), "geoloc_degraded": ~n["enough_wse"] & (n["wse_degraded"] > 0),
            "wse_bad": (wse < LOWEST) | (wse > HIGHEST), "no_sig0": n["sig0"] == 0, "no_area": n["area"] == 0, "no_wse": n["wse"] == 0, "no_pixels": n["pixels"] == 0,
        }
    )


def reach_flag(flags: Column, good: Column, valid: Column, observed: Column, min_fit: int, least_observed: float = 0.5) -> Column:
    """An aggregate: the flag of a reach from its nodes' flags, which of them are good, which have a valid height, and the observed share.

    Bits of good nodes are inherited but for NOT_INHERITED. Few pixels count if half of the valid nodes have few, missing ones if all good nodes miss them.
    """
    either = F.coalesce(F.bit_or(F.when(good, flags)), F.lit(0).cast("long")).bitwiseAND(F.lit(~mask_of(NOT_INHERITED)).cast("long"))
    every = F.coalesce(F.bit_and(F.when(good, flags)), F.lit(0).cast("long"))
    half = lambda name: F.coalesce(F.avg(F.when(valid, has(flags, name).cast("double"))) >= 0.5, F.lit(False))
    own = flag(
        {
            "few_area": half("few_area"), "few_wse": half("few_wse"), "partial": observed < least_observed, "min_fit": F.count_if(good) < min_fit,
            "no_area": has(every, "no_area"), "no_wse": has(every, "no_wse"), "no_pixels": has(every, "no_pixels"),
        },
        REACH_BITS,
    )
    return either.bitwiseOR(own)


def crossover(suspect: Column, degraded: Column, used: Column) -> Column:
    """0 good, 1 where suspect pixels were used, 2 where degraded ones or none were."""
    return F.when((degraded > 0) | (used == 0), 2).when(suspect > 0, 1).otherwise(0).cast("int")
