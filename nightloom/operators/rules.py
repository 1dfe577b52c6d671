"""Alert rules: named predicates over objects or tracklets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import JUPITER_AU

RULES: dict[str, Column] = {}


def register_rule(name: str, predicate: Column, rules: dict[str, Column] | None = None) -> None:
    (RULES if rules is None else rules)[name] = predicate


def orbit_rules() -> dict[str, Column]:
    """Rules on q, e, i and moid_1 of an object's orbit."""
    q, e, i = F.col("q"), F.col("e"), F.col("i")
    a = F.when(e < 1, F.try_divide(q, 1 - e))
    tisserand = F.try_divide(F.lit(JUPITER_AU), a) + 2 * F.sqrt((1 - e * e) * a / JUPITER_AU) * F.cos(F.radians(i))
    return {
        "centaurs": (a > 5.2) & (a < 29) & (q > 5.2) & (q < 29),
        "comets": tisserand < 3,
        "distant_planets": a > 60,
        "encke_family": a.between(2.0, 2.5) & (e > 0.8) & (i > 4.0),
        "hildas": a.between(3.7, 4.2) & (e <= 0.3) & (i <= 20),
        "hyperbolics": e > 1,
        "impactors": F.col("moid_1") < 0.005,
        "phaethon_family": a.between(0.9, 1.8) & (e > 0.7) & (i > 14),
        "sednas": q > 50,
        "thule_family": a.between(4.25, 4.35),
    }


def evaluate_rules(df: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """(key, rule) for every rule that fires, in one pass over the table."""
    fired = F.filter(F.array(*[F.when(p, F.lit(name)) for name, p in rules.items()]), lambda x: x.isNotNull())
    return df.select(key, F.explode(fired).alias("rule"))


def high_digest_objects(members: DataFrame, submissions: DataFrame, limit: float = 20, key: str = "desig") -> DataFrame:
    """Objects with a submission of a digest over the limit."""
    return members.join(submissions.filter(F.col("digest") > limit).select(key).distinct(), key, "left_semi")


def named_known(objects: DataFrame, names: list[str], column: str = "object_name") -> DataFrame:
    """Objects with one of some names, whatever the case."""
    return objects.filter(F.upper(column).isin([n.upper() for n in names]))


def unlinked_fast_movers(tracklets: DataFrame, speed: float = 0.99) -> DataFrame:
    return tracklets.filter((F.col("status") == "U") & (F.col("vel_tot") > speed))


def unusual_light_curves(objects: DataFrame, members: DataFrame, dets: DataFrame, least: int = 3, spread: float = 0.5) -> DataFrame:
    """Objects of a > 3 and H < 13 with enough good detections whose V magnitudes spread enough. ``dets`` has tracklet_id, v_mag, good."""
    o = objects.filter((F.try_divide("q", 1 - F.col("e")) > 3) & (F.col("e") < 1) & (F.col("h_v") < 13)).select("derivedobject_id")
    j = o.join(members, "derivedobject_id").join(dets.filter("good"), "tracklet_id")
    return j.groupBy("derivedobject_id").agg(F.count("*").alias("n"), (F.max("v_mag") - F.min("v_mag")).alias("spread")).filter((F.col("n") >= least) & (F.col("spread") >= spread))


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Rows through an external function, a batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)
