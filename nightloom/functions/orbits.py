"""Orbits: classes, checks, distances; names of objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import BASE62, JUPITER_AU
from ..operators.numbering import numbered


def classify_orbit(q: Column, e: Column, i: Column, moid_1: Column | None = None, moid_2: Column | None = None) -> Column:
    """Dynamical class of an orbit; ``UNK`` where no rule fits."""
    a = F.try_divide(q, 1 - e)
    near = F.lit(False)
    for m in (moid_1, moid_2):
        if m is not None:
            near = near | F.coalesce(m < 0.05, F.lit(False))
    t = F.try_divide(F.lit(JUPITER_AU), a) + 2 * F.sqrt((1 - e * e) * a / JUPITER_AU) * F.cos(F.radians(i))
    bound = (
        F.when(near, "PHO").when(q < 1.30, "NEO").when((q > 1.30) & (q <= 1.67), "MC").when((a > 1.67) & (a <= 5.0), "MB").when((a > 5.0) & (a <= 5.5), "TRO")
        .when((a > 5.0) & (a <= 35.0), "CEN").when((a > 35.0) & (a <= 50.0), "TNO").when(a > 50.0, "SDO")
        .when((t > 2.0) & (t < 3.0), "SPC").when((t < 2.0) & (a <= 34.2), "HFC").when((t < 2.0) & (a > 34.2), "LPC").otherwise("UNK")
    )
    return F.when((e > 0) & (e < 1), bound).when(e > 1, "HYP").otherwise("UNK")


def classify_orbits(orbits: DataFrame) -> DataFrame:
    """Add ``dyn_class`` to a table of q, e, i, moid_1, moid_2."""
    return orbits.withColumn("dyn_class", classify_orbit(F.col("q"), F.col("e"), F.col("i"), F.col("moid_1"), F.col("moid_2")))


def valid_orbit(q: Column, e: Column, i: Column, node: Column, arg_peri: Column) -> Column:
    """Whether an orbit is one that the survey can handle."""
    bad = (q <= 0) | (e < 0) | (i > 180) | (i < 0) | (node < 0) | (node > 360) | (arg_peri < 0) | (arg_peri > 360) | ((e > 10) & (e / q > 1e7))
    return ~bad


def d_criterion(a: dict[str, Column], b: dict[str, Column]) -> tuple[Column, Column]:
    """3- and 4-element D-criterion (Southworth and Hawkins 1963) of two orbits with q, e, i, node, arg_peri."""
    clamp = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))
    i1, i2, n1, n2 = F.radians(a["i"]), F.radians(b["i"]), F.radians(a["node"]), F.radians(b["node"])
    mutual = F.acos(clamp(F.cos(i1) * F.cos(i2) + F.sin(i1) * F.sin(i2) * F.cos(n1 - n2)))
    turn = F.radians(a["arg_peri"] - b["arg_peri"]) + 2 * F.asin(clamp(F.cos((i1 + i2) / 2) * F.try_divide(F.sin((n1 - n2) / 2), F.cos(mutual / 2))))
    three = F.pow(a["q"] - b["q"], 2) + F.pow(a["e"] - b["e"], 2) + F.pow(2 * F.sin(mutual / 2), 2)
    return F.sqrt(three), F.sqrt(three + F.pow((a["e"] + b["e"]) * F.sin(turn / 2), 2))


def to_base62(number: Column, width: int) -> Column:
    """A number in base 62, filled with zeros to ``width`` places."""
    digit = lambda k: F.substring(F.lit(BASE62), (F.floor(number / F.lit(62**k)) % 62 + 1).cast("int"), F.lit(1))
    return F.concat(*[digit(k) for k in range(width - 1, -1, -1)])


def from_base62(text: Column) -> Column:
    """The number that a base-62 text stands for."""
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0).cast("bigint"), lambda acc, c: acc * 62 + F.instr(F.lit(BASE62), c) - 1)


def assign_names(df: DataFrame, template: str, order: list[str], first: int = 0, column: str = "name") -> DataFrame:
    """Name rows by their place in ``order``: the template's zeros are replaced with the number in base 62.

    Places come from per-range counts (:func:`nightloom.operators.numbering.numbered`), so no task sees all rows.
    """
    prefix = template.rstrip("0")
    width = len(template) - len(prefix)
    number = F.lit(first - 1) + F.col("_number")
    return numbered(df, order, "_number").withColumn(column, F.concat(F.lit(prefix), to_base62(number, width))).select(*df.columns, column)


def object_family(name: Column) -> Column:
    """The family of a synthetic object: the first two characters of its name."""
    return F.substring(name, 1, 2)


def normalize_survey_mode(mode: Column) -> Column:
    """``3PI`` for any mode of the all-sky survey, ``MD`` and ``OSS`` likewise, others in upper case without their suffix."""
    upper = F.upper(F.trim(mode))
    return F.when(upper.startswith("3PI"), "3PI").when(upper.rlike(r"^(MD|M\d)"), "MD").when(upper.rlike("OSS|ESS"), "OSS").otherwise(F.regexp_extract(upper, r"^([A-Z0-9]*)", 1))
