"""Instances and archives: export, extracts, and the low-significance layout by night and RA slice."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import cut_lineage
from ..operators.skyjoin import sky_join

SLICES = 3600


def instance_tables(detections: DataFrame, attrib: DataFrame, members: DataFrame, orbits: DataFrame, where: Column | None = None) -> dict[str, DataFrame]:
    """The four tables of an export, its detections under a condition and the rest to match."""
    d = detections if where is None else detections.filter(where)
    a = attrib if where is None else attrib.join(d.select("det_id"), "det_id", "left_semi").select("tracklet_id", "det_id")
    m = members if where is None else members.join(a.select("tracklet_id"), "tracklet_id", "left_semi").select("derivedobject_id", "tracklet_id")
    return {"detections": d, "tracklet_attrib": a, "derivedobject_attrib": m, "orbits": orbits}


def export_instance(tables: dict[str, DataFrame], path: str, kind: str = "parquet") -> None:
    """Write tables below a folder, as ``parquet`` or ``csv``."""
    for name, df in tables.items():
        writer = df.write.option("header", True) if kind == "csv" else df.write
        getattr(writer, kind)(f"{path}/{name}")


def extract_objects(ids: DataFrame, members: DataFrame, attrib: DataFrame, detections: DataFrame, fields: DataFrame) -> dict[str, DataFrame]:
    """Objects' tracklets, detections and fields, by semi joins."""
    m = members.join(ids.select("derivedobject_id"), "derivedobject_id", "left_semi")
    a = attrib.join(m.select("tracklet_id"), "tracklet_id", "left_semi")
    d = detections.join(a.select("det_id"), "det_id", "left_semi")
    return {"derivedobject_attrib": m, "tracklet_attrib": a, "detections": d, "fields": fields.join(d.select("field_id"), "field_id", "left_semi")}


def with_slice(df: DataFrame) -> DataFrame:
    return df.withColumn("ra_slice", F.floor(F.col("ra_deg") / 360.0 * SLICES).cast("int"))


def write_lsd(df: DataFrame, path: str) -> None:
    """Add detections to an archive: a folder per night, each file a range of RA slices in order of RA, and an index of the files.

    Nights prune folders, slices the files' row groups; a folder per slice would leave a handful of rows in each file. Each call writes a batch of its own and then
    its part of the index, so readers, who go by the index, see a batch when it is whole.
    """
    batch = uuid.uuid4().hex
    folder = f"{path}/detections/batch={batch}"
    with_slice(df).repartitionByRange("nn", "ra_slice").sortWithinPartitions("nn", "ra_slice", "ra_deg").write.partitionBy("nn").parquet(folder)
    try:
        written = df.sparkSession.read.parquet(folder)
    except AnalysisException:  # no rows, no files
        return
    tiles = written.groupBy("nn", "ra_slice", F.col("_metadata.file_path").alias("file")).agg(F.min("dec_deg").alias("min_dec"), F.max("dec_deg").alias("max_dec"), F.count("*").alias("n"))
    tiles.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{path}/index")


def lsd_index(df: DataFrame) -> DataFrame:
    """Per night and slice: bounds of Dec and the number of rows."""
    return with_slice(df).groupBy("nn", "ra_slice").agg(F.min("dec_deg").alias("min_dec"), F.max("dec_deg").alias("max_dec"), F.count("*").alias("n"))


def tiles_near(spark: SparkSession, path: str, positions: DataFrame, radius: float) -> tuple[DataFrame, DataFrame]:
    """The positions, one row per slice in reach (all slices near a pole), and the index rows (nn, ra_slice, file, batch) of tiles that can hold what is near them."""
    reach = radius / F.greatest(F.lit(1e-6), F.cos(F.radians(F.least(F.lit(90.0), F.abs("p_dec") + radius))))
    span = F.least(F.lit(SLICES // 2), F.ceil(reach / 360.0 * SLICES)).cast("int")
    centre = F.floor(F.col("p_ra") / 360.0 * SLICES).cast("int")
    near = positions.withColumnRenamed("p_nn", "nn").withColumn("ra_slice", F.explode(F.array_distinct(F.transform(F.sequence(centre - span, centre + span), lambda s: F.pmod(s, F.lit(SLICES))))))
    wanted = near.groupBy("nn", "ra_slice").agg((F.min("p_dec") - radius).alias("low"), (F.max("p_dec") + radius).alias("high"))
    index = spark.read.parquet(f"{path}/index")
    return near, index.join(wanted, ["nn", "ra_slice"]).filter("max_dec >= low and min_dec <= high").select("nn", "ra_slice", "file", "batch")


def slice_ranges(slices: list[int], most: int = 32) -> list[tuple[int, int]]:
    """Sorted numbers as ranges; the smallest gaps are closed until there are at most so many."""
    cuts = sorted(range(1, len(slices)), key=lambda k: slices[k - 1] - slices[k])[: most - 1]
    bounds = [0, *sorted(k for k in cuts if slices[k] - slices[k - 1] > 1), len(slices)]
    return [(slices[a], slices[z - 1]) for a, z in zip(bounds, bounds[1:], strict=False)]


def read_tiles(spark: SparkSession, path: str, tiles: DataFrame, radius_box: tuple[float, float] = (-90.0, 90.0), most_files: int = 10_000) -> DataFrame:
    """The archive's rows in the files, slices and Dec range that ``tiles`` name: an index-driven scan.

    Up to ``most_files`` files are named to the reader, which opens no others; beyond that it is told the nights (a folder each) and batches. Row groups are skipped by
    slice ranges (there are 3600 slices) and by Dec. What it returns may hold more than was asked for, never less.
    """
    few = [r["file"] for r in tiles.select("file").distinct().limit(most_files + 1).collect()]
    if not few:
        return spark.read.parquet(f"{path}/detections").filter(F.lit(False)).drop("batch")
    if len(few) <= most_files:
        rows = spark.read.option("basePath", f"{path}/detections").parquet(*few)
    else:
        nights = [r["nn"] for r in tiles.select("nn").distinct().collect()]  # one number a night
        rows = spark.read.parquet(f"{path}/detections").filter(F.col("nn").isin(nights)).join(tiles.select("batch").distinct(), "batch", "left_semi")
    inside = F.lit(False)
    for low, high in slice_ranges(sorted(r["ra_slice"] for r in tiles.select("ra_slice").distinct().collect())):
        inside = inside | F.col("ra_slice").between(low, high)
    return rows.filter(inside & F.col("dec_deg").between(*radius_box)).drop("batch")


def read_lsd(spark: SparkSession, path: str, positions: DataFrame, radius: float) -> DataFrame:
    """(position_id, detection): archived detections near positions (position_id, p_nn, p_ra, p_dec).

    The index tells which files, slices and Dec range the positions need (:func:`read_tiles`), so what is read falls with the positions. The join after it is on night and sky cell: a position's slices
    only say what to read.
    """
    _, tiles = tiles_near(spark, path, positions, radius)
    tiles = cut_lineage(tiles)
    low, high = positions.agg(F.min("p_dec"), F.max("p_dec")).first()
    archive = read_tiles(spark, path, tiles, ((low if low is not None else 0.0) - radius, (high if high is not None else 0.0) + radius))
    return sky_join(archive, positions.withColumnRenamed("p_nn", "nn"), radius, ("ra_deg", "dec_deg"), ("p_ra", "p_dec"), ("nn",)).drop("ra_slice").dropDuplicates(["position_id", "det_id"])


def sync_missing(source: DataFrame, target: DataFrame, key: str = "field_id") -> DataFrame:
    """Rows that a downstream instance lacks, newest night first."""
    return source.join(target.select(key), key, "left_anti").orderBy(F.col("nn").desc(), key)
