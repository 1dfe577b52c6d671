"""Text formats: detections, orbits, tagged exchange lines, 80-column observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import UNIX_MJD, ut_to_mjd


def _typed(parts: Column, layout: list[tuple[str, str]]) -> list[Column]:
    return [F.try_element_at(parts, F.lit(k + 1)).try_cast(kind).alias(name) for k, (name, kind) in enumerate(layout)]


DETECTION = [("det_id", "bigint"), ("epoch_mjd", "double"), ("ra_deg", "double"), ("dec_deg", "double"), ("mag", "double"), ("obscode", "string"), ("object_name", "string"), ("length_deg", "double"), ("orient_deg", "double")]
ORBIT = [("q", "double"), ("e", "double"), ("i", "double"), ("node", "double"), ("arg_peri", "double"), ("time_peri", "double"), ("h_v", "double"), ("epoch", "double"), ("name", "string")]


def parse_detections(lines: DataFrame, column: str = "value") -> DataFrame:
    """Whitespace lines (id mjd ra dec mag obscode object [length angle]) as columns; lines that don't fit keep their text in ``_corrupt``. Blank and # lines go."""
    rows = lines.filter(~F.col(column).rlike(r"^\s*(#|$)"))
    parts = F.split(F.trim(column), r"\s+")
    typed = rows.select(*_typed(parts, DETECTION), F.col(column).alias("_line"))
    bad = F.col("det_id").isNull() | F.col("epoch_mjd").isNull() | F.col("ra_deg").isNull() | F.col("dec_deg").isNull()
    return typed.withColumn("_corrupt", F.when(bad, F.col("_line"))).drop("_line")


def read_detections_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_detections(spark.read.text(path))


def format_detections(df: DataFrame) -> DataFrame:
    """The same lines from columns; a null object is NS."""
    return df.select(F.concat_ws(" ", F.col("det_id").cast("string"), F.format_string("%.6f", "epoch_mjd"), F.format_string("%.6f", "ra_deg"), F.format_string("%.6f", "dec_deg"), F.format_string("%.4f", "mag"), "obscode", F.coalesce("object_name", F.lit("NS"))).alias("value"))


def write_detections_text(df: DataFrame, path: str) -> None:
    format_detections(df).write.text(path)


def parse_orbits(lines: DataFrame, column: str = "value") -> DataFrame:
    """Whitespace lines (q e i node argperi tperi H epoch name)."""
    rows = lines.filter(~F.col(column).rlike(r"^\s*([#!]|$)"))
    return rows.select(*_typed(F.split(F.trim(column), r"\s+"), ORBIT)).filter("q is not null")


def read_orbits_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_orbits(spark.read.text(path))


def parse_exchange(lines: DataFrame, column: str = "value") -> dict[str, DataFrame]:
    """Tagged lines routed to typed tables: DETECTION, ORBIT, TRACKLET and TRACK pointers."""
    parts = F.split(F.trim(column), r"\s+")
    tagged = lines.select(parts.alias("p")).withColumn("tag", F.upper(F.get("p", F.lit(0)))).withColumn("p", F.slice("p", 2, F.greatest(F.lit(0), F.size("p") - 1)))
    of = lambda tag: tagged.filter(F.col("tag") == tag)
    pointer = [("owner_id", "bigint"), ("member_id", "bigint")]
    return {"detections": of("DETECTION").select(*_typed(F.col("p"), DETECTION)), "orbits": of("ORBIT").select(*_typed(F.col("p"), ORBIT)), "tracklets": of("TRACKLET").select(*_typed(F.col("p"), pointer)), "tracks": of("TRACK").select(*_typed(F.col("p"), pointer))}


def read_exchange(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return parse_exchange(spark.read.text(path))


def _two(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


#: Characters of the longest name that an 80-column line holds with its first column blank.
MOST_NAME = 11


def format_obs80(df: DataFrame) -> DataFrame:
    """80-column observation lines from object_name, epoch_mjd, ra_deg, dec_deg, mag, filter_id, obscode.

    A name has columns 6 to 12. One of 8 to 11 characters ends there and begins in the number's columns, of which the first stays blank, as comets' designations do; a longer one fits nowhere and is
    an error: cut names would make one object of several.
    """
    day = F.floor("epoch_mjd")
    date = F.date_format(F.date_add(F.to_date(F.lit("1970-01-01")), (day - UNIX_MJD).cast("int")), "yyyy MM dd")
    fraction = F.substring(F.format_string("%.6f", F.floor((F.col("epoch_mjd") - day) * 1e6) / 1e6), 2, 7)
    # a right ascension that is 24 hours, or rounds to them, stays so in the line, as it does in the reference's
    ms = F.round(F.when(F.col("ra_deg") < 0, F.col("ra_deg") + 360.0).otherwise(F.col("ra_deg")) / 15 * 3600000).cast("bigint")
    ra = F.concat(_two(F.floor(ms / 3600000)), F.lit(" "), _two(F.floor(ms / 60000) % 60), F.lit(" "), F.format_string("%06.3f", (ms % 60000) / 1000.0))
    cs = F.round(F.abs("dec_deg") * 360000).cast("bigint")
    dec = F.concat(F.when(F.col("dec_deg") < 0, "-").otherwise("+"), _two(F.floor(cs / 360000)), F.lit(" "), _two(F.floor(cs / 6000) % 60), F.lit(" "), F.format_string("%05.2f", (cs % 6000) / 100.0))
    given = F.coalesce("object_name", F.lit(""))
    wide = F.when(F.length(given) <= MOST_NAME, F.lpad(given, 12, " ")).otherwise(F.raise_error(F.concat(F.lit(f"longer than {MOST_NAME} characters: "), given)))
    name = F.when(F.length(given) <= 7, F.rpad(F.concat(F.lit("     "), given), 12, " ")).otherwise(wide)
    line = F.concat(name, F.lit("  C"), date, fraction, ra, dec, F.lit("         "), F.format_string("%5.2f", "mag"), F.rpad("filter_id", 1, " "), F.lit("      "), F.rpad("obscode", 3, " "))
    return df.select(line.alias("value"))


def parse_obs80(lines: DataFrame, column: str = "value") -> DataFrame:
    """Columns from 80-column observation lines. Where the first column is blank there is no number, and a long name may begin before column 6."""
    cut = lambda a, n: F.trim(F.substring(column, a, n))
    num = lambda a, n, kind="double": cut(a, n).try_cast(kind)
    epoch = ut_to_mjd(num(16, 4, "int"), num(21, 2, "int"), num(24, 2, "int"), F.lit(0), F.lit(0), F.lit(0)) + F.concat(F.lit("0"), cut(26, 7)).try_cast("double")
    ra = (num(33, 2) + num(36, 2) / 60 + num(39, 6) / 3600) * 15
    dec = F.when(F.substring(column, 45, 1) == "-", -1.0).otherwise(1.0) * (num(46, 2) + num(49, 2) / 60 + num(52, 5) / 3600)
    name = F.when(F.substring(column, 1, 1) == " ", cut(1, 12)).otherwise(cut(6, 7))
    return lines.select(name.alias("object_name"), epoch.alias("epoch_mjd"), ra.alias("ra_deg"), dec.alias("dec_deg"), num(66, 5).alias("mag"), cut(71, 1).alias("filter_id"), cut(78, 3).alias("obscode"))


def read_obs80(spark: SparkSession, path: str) -> DataFrame:
    return parse_obs80(spark.read.text(path).filter(F.length("value") >= 80))


def write_obs80(df: DataFrame, path: str) -> None:
    format_obs80(df).write.text(path)
