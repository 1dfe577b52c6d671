"""Removal of noise among the detections of an exposure. Smaller ``mag`` is brighter."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .skyjoin import neighbour_pairs

EXPOSURE = ("field_id",)


def dedupe_nearby(df: DataFrame, radius: float, key: str = "det_id", bright: str = "mag", within: tuple[str, ...] = EXPOSURE) -> DataFrame:
    """Drop a point with a brighter neighbour in its exposure, or an equally bright one with a smaller id."""
    return df.join(beaten_nearby(df, radius, key, bright, within), key, "left_anti")


def beaten_nearby(df: DataFrame, radius: float, key: str, bright: str, within: tuple[str, ...] = EXPOSURE) -> DataFrame:
    """The keys of points with a brighter neighbour in their exposure, or an equally bright one with a smaller id; one may come more than once."""
    pairs = neighbour_pairs(df, radius, key, within, (bright,))
    beaten = (F.col(f"o_{bright}") < F.col(bright)) | ((F.col(f"o_{bright}") == F.col(bright)) & (F.col(f"o_{key}") < F.col(key)))
    return pairs.filter(beaten).select(key)


def drop_stationary(df: DataFrame, radius: float, key: str = "det_id", within: tuple[str, ...] = EXPOSURE) -> DataFrame:
    """Drop every point with another one of its exposure (or other ``within`` columns) in the radius."""
    return df.join(neighbour_pairs(df, radius, key, within).select(key), key, "left_anti")


def density_filter(df: DataFrame, density: float, radius: float, relative: bool = False, key: str = "det_id", bright: str = "mag", within: tuple[str, ...] = EXPOSURE) -> DataFrame:
    """Drop points in whose disc there are more than ``density`` points a square degree (the point itself counts).

    With ``relative`` a point stays if it is brighter than the (int(density * area) + 2)-th brightest of its
    disc, where the disc has so many.
    """
    area = math.pi * radius * radius
    best = int(density * area) + 1
    pairs = neighbour_pairs(df, radius, key, within, (bright,))
    # the (best + 1)-th brightest is fainter than a point if at most ``best`` of the disc, itself included, are not
    ahead = F.count(F.when(F.col(f"o_{bright}") <= F.col(bright), 1))
    around = pairs.groupBy(key).agg((F.count("*") + 1).alias("n"), (F.count(f"o_{bright}") + 1).alias("known"), (ahead + 1).alias("ahead"), F.min(bright).alias("own"))
    bad = F.col("n") / area > density
    if relative:
        bad = bad & ~(F.col("own").isNotNull() & (F.col("known") > best) & (F.col("ahead") <= best))
    return df.join(around.filter(bad).select(key), key, "left_anti")


def field_density_filter(df: DataFrame, density: float, progressive: bool = False, key: str = "det_id", bright: str = "mag") -> DataFrame:
    """Drop the points of exposures over ``density`` points a square degree of their bounds, or keep the best int(density * area) + 1.

    Exposures of fewer than 5 points pass; points of no exposure go. Bounds are windows over an exposure, so points are read, shuffled and sorted once.
    """
    w = W.partitionBy("field_id")
    extent = lambda c: F.max(c).over(w) - F.min(c).over(w)
    middle = (F.min("dec_deg").over(w) + F.max("dec_deg").over(w)) / 2
    area = F.greatest(F.lit(1e-50), extent("dec_deg") * extent("ra_deg") * F.cos(F.radians(middle)))
    bounded = df.filter(F.col("field_id").isNotNull()).withColumns({"_n": F.count("*").over(w), "_area": area})
    fine = (F.col("_n") < 5) | (F.col("_n") / F.col("_area") < density)
    if progressive:
        bounded = bounded.withColumn("_rank", F.row_number().over(w.orderBy(bright, key)))
        fine = fine | (F.col("_rank") <= F.floor(density * F.col("_area")) + 1)
    return bounded.filter(fine).select(*df.columns)


def drop_linear(df: DataFrame, radius: float, angle: float, support: int, key: str = "det_id", within: tuple[str, ...] = EXPOSURE) -> DataFrame:
    """Drop points on streaks: those with at least ``support`` neighbours within ``angle`` degrees of one direction modulo 180.

    Neighbours under 5e-5 degrees have no direction. The window over a point's neighbours by angle is a range
    frame; angles near 0 are repeated past 180.
    """
    pairs = neighbour_pairs(df, radius, key, within).filter(F.col("distance") >= 5e-5)
    east = (F.pmod(F.col("o_ra_deg") - F.col("ra_deg") + 180.0, F.lit(360.0)) - 180.0) * F.cos(F.radians((F.col("dec_deg") + F.col("o_dec_deg")) / 2))
    direction = F.pmod(F.degrees(F.atan2(F.col("o_dec_deg") - F.col("dec_deg"), east)), F.lit(180.0))
    angles = pairs.select(key, F.explode(F.array(direction, direction + 180.0)).alias("_angle")).filter(F.col("_angle") < 180.0 + angle + 1e-9)
    support_of = F.expr(f"count(*) OVER (PARTITION BY {key} ORDER BY _angle RANGE BETWEEN CURRENT ROW AND {float(angle)}D FOLLOWING)")
    bad = angles.withColumn("_support", support_of).filter(F.col("_support") >= support).select(key).distinct()
    return df.join(bad, key, "left_anti")


def fom_codes(df: DataFrame, fom: str = "fom", radius: float = 0.00027, dense: float | None = None, dense_radius: float = 0.01, key: str = "det_id") -> DataFrame:
    """Add ``code``: 2 for duplicates of a better source, I for sources in discs that are too dense, else null. Larger ``fom`` is better."""
    ranked = df.withColumn("_bad", -F.col(fom))
    worse = beaten_nearby(ranked, radius, key, "_bad").distinct()
    marked = df.join(worse.withColumn("code", F.lit("2")), key, "left")
    if dense is None:
        return marked
    calm = density_filter(ranked.join(worse, key, "left_anti"), dense, dense_radius, True, key, "_bad").select(key, F.lit(True).alias("_calm"))
    return marked.join(calm, key, "left").withColumn("code", F.coalesce("code", F.when(F.col("_calm").isNull(), "I"))).drop("_calm")


def bad_cells(df: DataFrame, most: int, edge_cells: list[int], cell: str = "cell") -> DataFrame:
    """Add ``code`` O to detections of detector cells with more than ``most`` (half of it for edge cells) in an exposure."""
    counts = df.groupBy("field_id", cell).agg(F.count("*").alias("_n"))
    limit = F.when(F.col(cell).isin(edge_cells), F.lit(most / 2)).otherwise(F.lit(float(most)))
    bad = counts.filter(F.col("_n") > limit).select("field_id", cell, F.lit("O").alias("code"))
    return df.join(bad, ["field_id", cell], "left")


def split_clean_noise(df: DataFrame, clean: DataFrame, key: str = "det_id") -> DataFrame:
    """All rows with ``is_clean``: whether they are among the clean ones."""
    return df.join(clean.select(key).distinct().withColumn("_c", F.lit(True)), key, "left").withColumn("is_clean", F.coalesce("_c", F.lit(False))).drop("_c")


# Row-wise filters at ingest: each gives a removal code or null.

BAD_FLAGS = 0x1


def silly_code(flags: Column, mag: Column, mag_sigma: Column, moment: Column, bad: int = BAD_FLAGS, low: float = 0.0, high: float = 30.0) -> Column:
    """S for bad flags, NaN or non-positive errors, magnitudes out of range or zero moments."""
    silly = (flags.bitwiseAND(bad) != 0) | F.isnan(mag_sigma) | (mag_sigma <= 0) | F.isnan(mag) | (mag < low) | (mag > high) | (moment == 0)
    return F.when(F.coalesce(silly, F.lit(True)), "S")


def bright_code(distance_px: Column, bright_mag: Column, limit_px: float, limit_mag: float) -> Column:
    """B near a bright source."""
    return F.when((distance_px < limit_px) & (bright_mag < limit_mag), "B")


def low_s2n_code(mag_sigma: Column, limit: float) -> Column:
    """L under the limit of S/N, which is 2.5 / ln 10 over the magnitude's sigma."""
    return F.when(F.try_divide(F.lit(2.5 / math.log(10)), mag_sigma) < limit, "L")


def dipole_code(flags: Column, s2n: Column, positive_s2n: Column, negative_s2n: Column, bit: int, factor: float = 5.0) -> Column:
    """D for flagged sources between stronger positive and negative ones."""
    return F.when((flags.bitwiseAND(bit) != 0) & (positive_s2n > factor * s2n) & (negative_s2n > factor * s2n), "D")


def clean_ingest(df: DataFrame, codes: list[Column], keep: bool = True, status: str = "status") -> DataFrame:
    """The first code to fire becomes the status (others are found); without ``keep`` coded rows go."""
    coded = df.withColumn("_code", F.coalesce(*codes, F.lit(None).cast("string")))
    return (coded.withColumn(status, F.coalesce("_code", F.lit("F"))) if keep else coded.filter("_code is null").withColumn(status, F.lit("F"))).drop("_code")


def time_filter(df: DataFrame, low: float, high: float, column: str = "epoch_mjd") -> DataFrame:
    """Rows in a band; a negative bound is open."""
    return _band(df, column, low, high)


def brightness_filter(df: DataFrame, low: float, high: float, column: str = "mag") -> DataFrame:
    return _band(df, column, low, high)


def _band(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    ok = F.col(column).isNotNull()
    if low >= 0:
        ok = ok & (F.col(column) >= low)
    if high >= 0:
        ok = ok & (F.col(column) <= high)
    return df.filter(ok)


def box_filter(df: DataFrame, ra0: float, ra1: float, dec0: float, dec1: float) -> DataFrame:
    """Rows in a box; ``ra0`` over ``ra1`` goes through 0."""
    ra = F.col("ra_deg")
    inside = ra.between(ra0, ra1) if ra0 <= ra1 else (ra >= ra0) | (ra <= ra1)
    return df.filter(inside & F.col("dec_deg").between(dec0, dec1))


def region_filter(df: DataFrame, ra: float, dec: float, radius: float) -> DataFrame:
    """Rows in a circle."""
    from ..functions.sky import separation

    return df.filter(separation(F.lit(float(ra)), F.lit(float(dec)), F.col("ra_deg"), F.col("dec_deg")) <= radius)
