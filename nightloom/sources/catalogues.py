"""Public orbit catalogues and survey cadence files as tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the packed date format: century, and the digit of a month or day.
CENTURIES = "IJKL"
PACKED_DIGITS = "123456789ABCDEFGHIJKLMNOPQRSTUV"
PACKED_DATE = r"^([IJKL])(\d\d)([1-9A-C])([1-9A-V])(\d*)$"
CATALOGUE = ("name", "h_v", "g", "packed", "mean_anomaly", "arg_peri", "node", "i", "e", "daily_motion", "a")


def unpack_date(packed: Column) -> Column:
    """The MJD of a packed date such as K107N (2010 July 23), with its fraction of a day if any; null where it isn't one."""
    digit = lambda k: F.lpad(F.instr(F.lit(PACKED_DIGITS), F.substring(packed, k, 1)).cast("string"), 2, "0")
    century = (17 + F.instr(F.lit(CENTURIES), F.substring(packed, 1, 1))).cast("string")
    day = F.concat(century, F.substring(packed, 2, 2), F.lit("-"), digit(4), F.lit("-"), digit(5)).try_cast("date")
    fraction = F.concat(F.lit("0."), F.substring(packed, 6, 20), F.lit("0")).try_cast("double")
    return F.when(packed.rlike(PACKED_DATE), F.datediff(day, F.to_date(F.lit("1858-11-17"))) + fraction)


def pack_date(mjd: Column) -> Column:
    """A date's packed form, without a fraction."""
    day = F.date_add(F.to_date(F.lit("1858-11-17")), F.floor(mjd).cast("int"))
    digit = lambda x: F.substring(F.lit(PACKED_DIGITS), x, 1)
    return F.concat(F.substring(F.lit(CENTURIES), F.floor(F.year(day) / 100).cast("int") - 17, 1), F.lpad((F.year(day) % 100).cast("string"), 2, "0"), digit(F.month(day)), digit(F.dayofmonth(day)))


def parse_catalogue(lines: DataFrame, column: str = "value") -> DataFrame:
    """Orbits (name, q, e, i, node, arg_peri, time_peri, h_v, epoch) from catalogue lines: name, H, G, packed epoch, mean anomaly, argument of perihelion, node,
    inclination, e, daily motion, semi-major axis, and more that is not read.

    The catalogue gives a and the mean anomaly; q is a (1 - e), and perihelion is passed where the anomaly is 0, next to the epoch. A line is data if its fourth word is a packed
    date, so headers and rules fall away wherever files are split; lines whose numbers don't read are left out, and impossible dates (a 31st of February) are null.
    """
    words = F.split(F.trim(column), r"\s+")
    word = lambda name: F.get(words, F.lit(CATALOGUE.index(name)))
    number = lambda name: word(name).try_cast("double")
    rows = lines.filter(F.coalesce(word("packed").rlike(PACKED_DATE), F.lit(False)) & number("e").isNotNull() & number("a").isNotNull() & number("mean_anomaly").isNotNull() & (number("daily_motion") != 0))
    rows = rows.select(word("name").alias("name"), unpack_date(word("packed")).alias("epoch"), *[number(c).alias(c) for c in CATALOGUE if c not in ("name", "packed")])
    ahead = F.when(F.col("mean_anomaly") > 180, F.col("mean_anomaly") - 360).otherwise(F.col("mean_anomaly"))
    return rows.select("name", (F.col("a") * (1 - F.col("e"))).alias("q"), "e", "i", "node", "arg_peri", (F.col("epoch") - F.try_divide(ahead, "daily_motion")).alias("time_peri"), "h_v", "epoch")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return parse_catalogue(spark.read.text(path))


# Columns of a cadence file that are read, by their places.
CADENCE = {"visit": 0, "filter_id": 4, "mjd": 9, "exposure_s": 10, "ra": 28, "dec": 29}


def parse_cadence(lines: DataFrame, obscode: str, limiting_mag: float, shift_days: float = 4383.0, column: str = "value") -> DataFrame:
    """Fields (epoch_mjd, ra_deg, dec_deg, exposure_s, filter_id, obscode, limiting_mag) from the lines of a survey simulation's cadence files.

    An exposure that serves several programmes has a line for each, told by its start; the one with the smallest visit number counts. Positions are in radians, and dates are shifted to the
    survey's years. Header lines don't read as numbers and fall away.
    """
    words = F.split(F.trim(column), r"\s+")
    word = lambda name: F.get(words, F.lit(CADENCE[name]))
    number = lambda name: word(name).try_cast("double")
    rows = lines.select(number("visit").alias("visit"), number("mjd").alias("mjd"), word("filter_id").alias("filter_id"), number("exposure_s").alias("exposure_s"), number("ra").alias("ra"), number("dec").alias("dec"))
    rows = rows.filter("mjd is not null and ra is not null and dec is not null")
    one = rows.groupBy("mjd").agg(F.min(F.struct("visit", "filter_id", "exposure_s", "ra", "dec")).alias("x")).select("mjd", "x.*")
    degrees = 180.0 / math.pi
    return one.select(
        (F.col("mjd") + shift_days).alias("epoch_mjd"), (F.col("ra") * degrees).alias("ra_deg"), (F.col("dec") * degrees).alias("dec_deg"), F.col("exposure_s").cast("int").alias("exposure_s"), "filter_id",
        F.lit(obscode).alias("obscode"), F.lit(float(limiting_mag)).alias("limiting_mag"),
    )


def read_cadence(spark: SparkSession, path: str, obscode: str, limiting_mag: float, shift_days: float = 4383.0) -> DataFrame:
    return parse_cadence(spark.read.text(path), obscode, limiting_mag, shift_days)
