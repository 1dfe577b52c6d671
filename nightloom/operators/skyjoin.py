"""Spatial joins by cells of unit vectors: no wrap in RA, no poles."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sky import separation


def cell_size(radius_deg: float) -> float:
    """An edge at least as long as the chord of the radius."""
    return max(2 * math.sin(math.radians(min(radius_deg, 180.0)) / 2) * (1 + 1e-9), 1e-9)


def cells(ra: Column, dec: Column, size: float | Column) -> list[Column]:
    x, y, z = F.cos(F.radians(dec)) * F.cos(F.radians(ra)), F.cos(F.radians(dec)) * F.sin(F.radians(ra)), F.sin(F.radians(dec))
    return [F.floor(v / size).cast("bigint") for v in (x, y, z)]


def with_cell(df: DataFrame, ra: str, dec: str, size: float | Column) -> DataFrame:
    return df.withColumns(dict(zip(("_cx", "_cy", "_cz"), cells(F.col(ra), F.col(dec), size), strict=True)))


def spans(x: Column, reach: float | Column, size: float | Column) -> Column:
    """The cells of ``size`` that ``x`` give or take ``reach`` touches: one or two where cells are at least twice as wide as the reach."""
    return F.sequence(F.floor((x - reach) / size).cast("bigint"), F.floor((x + reach) / size).cast("bigint"))


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, a side of a join whose rows are repeated: sorted and merged, never sent whole to the driver and all executors.

    Spark takes repeated rows for as few as there were before, so it would broadcast sides that are many times its limit.
    """
    return df.hint("merge")


#: Width of a cell in reaches: wider ones repeat fewer rows (four or five at 3, not the 27 of cells one reach wide) and let more pairs meet.
CELL_REACHES = 3


def with_cells_in_reach(df: DataFrame, ra: str, dec: str, reach: float | Column, size: float | Column) -> DataFrame:
    """One row per cell that lies within ``reach`` (a chord) of the position."""
    x, y, z = F.cos(F.radians(dec)) * F.cos(F.radians(ra)), F.cos(F.radians(dec)) * F.sin(F.radians(ra)), F.sin(F.radians(dec))
    for name, v in (("_cx", x), ("_cy", y), ("_cz", z)):
        df = df.withColumn(name, F.explode(spans(v, reach, size)))
    return df


#: The narrowest cells whose three numbers fit into one of 63 bits.
LEAST_PACKED = 2.0**-19


def packed(df: DataFrame, size: float) -> DataFrame:
    """``df`` with one number ``_cell`` in place of a cell's three, if cells of ``size`` leave room for it: exact, and less to shuffle and to sort."""
    if size < LEAST_PACKED:
        return df
    x, y, z = (F.col(c) + F.lit(1 << 20) for c in ("_cx", "_cy", "_cz"))
    return df.withColumn("_cell", x * F.lit(1 << 42) + y * F.lit(1 << 21) + z).drop("_cx", "_cy", "_cz")


def sky_join(left: DataFrame, right: DataFrame, radius_deg: float, left_pos: tuple[str, str], right_pos: tuple[str, str], on: tuple[str, ...] = (), how: str = "inner", extra: Column | None = None, deal: int = 1) -> DataFrame:
    """Pairs within ``radius_deg`` of each other (and equal in ``on``), with ``distance`` in degrees.

    ``right`` is the smaller side: it is repeated for the cells in reach of each of its positions; columns of the two sides must differ
    but for ``on``. The join is an equi-join on cells; the exact distance is tested after it. Null positions match nothing. Where most positions lie in a few cells, ``left`` rows
    of a cell are dealt over ``deal`` keys by a hash of theirs, and ``right`` ones go to each, so a crowded cell is the work of so many tasks.
    """
    reach = cell_size(radius_deg)
    size = CELL_REACHES * reach
    a, b = packed(with_cell(left, *left_pos, size), size), packed(with_cells_in_reach(right, *right_pos, reach, size), size)
    cell = [c for c in ("_cell", "_cx", "_cy", "_cz") if c in a.columns]
    if deal > 1:
        a = a.withColumn("_part", F.pmod(F.xxhash64(*left.columns), F.lit(deal)).cast("int"))
        b = b.withColumn("_part", F.explode(F.array(*[F.lit(k) for k in range(deal)])))
    joined = a.join(shuffled(b), [*on, *cell, *(["_part"] if deal > 1 else [])]).withColumn("distance", separation(F.col(left_pos[0]), F.col(left_pos[1]), F.col(right_pos[0]), F.col(right_pos[1])))
    found = joined.filter(F.col("distance") <= radius_deg).drop(*cell, "_part")
    return found if extra is None else found.filter(extra)


#: Arrays that the keys of one place are dealt over by their hash, so that none holds all of a crowded place.
CHUNKS = 16


def keys_at(df: DataFrame, key: str, place: tuple[str, ...], name: str) -> DataFrame:
    """``place`` and an array ``name`` of the keys of the rows there, up to ``CHUNKS`` rows a place; null keys stay, null places go."""
    there = df.select(key, *place).dropna(subset=list(place)).withColumn("_chunk", F.pmod(F.xxhash64(key), F.lit(CHUNKS)))
    kept = there.groupBy(*place, "_chunk").agg(F.collect_list(F.struct(F.col(key).alias("k"))).alias("_k"))
    return kept.select(*place, F.transform("_k", lambda x: x["k"]).alias(name))


def for_each_key(pairs: DataFrame, df: DataFrame, key: str, place: tuple[str, ...], deal: int = 1, found: DataFrame | None = None) -> DataFrame:
    """``pairs`` of places, once for each row of ``df`` at the pair's ``place``, with its ``key``.

    A table of pairs of rows that share places is the pairs of those places times the rows at each. So places are compared, and what is shuffled is the keys in arrays, once and only those of places that
    ``pairs`` has; its rows come into being one after the other as they are read. ``pairs`` rows of a place are dealt over ``deal`` keys, to each of which the arrays go. Tasks are many and fixed in
    number: the few bytes that arrive say nothing of the rows that come of them, by which Spark would put all into a task or two.
    ``found`` has the places of ``pairs`` where those have been given for other keys already.
    """
    keys = keys_at(df.join(shuffled((pairs if found is None else found).select(*place).distinct()), list(place), "left_semi"), key, place, "_keys")
    # places meet on their hash and are compared after it: partitions by a hash are taken as they are, those by numbers with fractions would be dealt anew
    at, tasks = F.xxhash64(*place), 3 * df.sparkSession.sparkContext.defaultParallelism
    pairs = pairs.withColumns({"_at": at, "_deal": F.pmod(F.xxhash64(*pairs.columns), F.lit(deal)).cast("int")})
    keys = keys.withColumns({"_at": at, "_deal": F.explode(F.array(*[F.lit(k) for k in range(deal)]))}).withColumnsRenamed({c: f"_{c}" for c in place})
    met = pairs.repartition(tasks, "_at", "_deal").join(shuffled(keys.repartition(tasks, "_at", "_deal")), ["_at", "_deal"])
    same = reduce(lambda x, y: x & y, [F.col(c).between(F.col(f"_{c}"), F.col(f"_{c}")) for c in place])
    return met.filter(same).withColumn(key, F.explode("_keys")).select(*[c for c in pairs.columns if c not in ("_at", "_deal")], key)


def neighbour_pairs(df: DataFrame, radius_deg: float, key: str, within: tuple[str, ...], columns: tuple[str, ...] = (), ra: str = "ra_deg", dec: str = "dec_deg") -> DataFrame:
    """Ordered pairs of different rows within a radius and equal in ``within``; the other row's columns are prefixed with ``o_``."""
    names = [key, ra, dec, *columns]
    other = df.select(*within, *[F.col(c).alias(f"o_{c}") for c in names])
    near = sky_join(df.select(*within, *names), other, radius_deg, (ra, dec), (f"o_{ra}", f"o_{dec}"), within)
    return near.filter(F.col(key) != F.col(f"o_{key}")).select(*within, *names, *[f"o_{c}" for c in names], "distance")


LEAST_LEVEL, LARGEST_LEVEL = -30, 1


def leveled_sky_join(left: DataFrame, right: DataFrame, radius: str, left_pos: tuple[str, str], right_pos: tuple[str, str], on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs within the ``radius`` (degrees) of each row of ``right``, with ``distance``; columns of the two sides must differ but for ``on``.

    Cells come in levels, each twice as wide as the one below. A row of ``right`` is joined at the level of its own radius and repeated for the few cells in reach there; ``left`` rows have
    one cell at each level that occurs, at most 32. So a wide search does not widen the cells of narrow ones. Null positions and radii match nothing.
    """
    chord = 2 * F.sin(F.radians(F.greatest(F.lit(0.0), F.least(F.col(radius), F.lit(180.0)))) / 2) * (1 + 1e-9)
    level = F.greatest(F.lit(LEAST_LEVEL), F.ceil(F.log2(F.greatest(chord, F.lit(2.0**LEAST_LEVEL))))).cast("int")
    b = right.filter(F.col(radius).isNotNull() & (F.col(radius) >= 0)).withColumn("_level", level)
    levels = sorted(r["_level"] for r in b.select("_level").distinct().collect() if r["_level"] is not None)  # at most 32
    size = F.pow(F.lit(2.0), F.col("_level") + 1)
    a = with_cell(left.withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))), *left_pos, size)
    b = with_cells_in_reach(b, *right_pos, chord, size)
    joined = a.join(shuffled(b), [*on, "_level", "_cx", "_cy", "_cz"]).withColumn("distance", separation(F.col(left_pos[0]), F.col(left_pos[1]), F.col(right_pos[0]), F.col(right_pos[1])))
    return joined.filter(F.col("distance") <= F.col(radius)).drop("_level", "_cx", "_cy", "_cz")
