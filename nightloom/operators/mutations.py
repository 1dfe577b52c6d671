"""Changes to survey tables, as new tables: attribution, merging, events, queues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import QUEUE_CHAIN
from ..functions.orbits import assign_names
from .efficiency import classify_groups


def attribute(objects: DataFrame, members: DataFrame, tracklets: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, tracklets) after ``pairs`` (derivedobject_id, tracklet_id) are added: memberships once, tracklets in status A."""
    new = members.unionByName(pairs.join(objects.select("derivedobject_id"), "derivedobject_id", "left_semi")).distinct()
    marked = tracklets.join(pairs.select("tracklet_id").distinct().withColumn("_a", F.lit(True)), "tracklet_id", "left")
    return new, marked.withColumn("status", F.when(F.col("_a"), "A").otherwise(F.col("status"))).drop("_a")


def refresh_classes(members: DataFrame, attrib: DataFrame, detections: DataFrame) -> DataFrame:
    """Classification of each object from all its detections' names."""
    return classify_groups(members.join(attrib, "tracklet_id").join(detections.select("det_id", "object_name"), "det_id"), "derivedobject_id")


def merge_objects(objects: DataFrame, members: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(objects, members) after children merged into parents (child_id, parent_id): memberships remapped and once, children in status M."""
    map_ = pairs.select(F.col("child_id").alias("derivedobject_id"), "parent_id")
    moved = members.join(map_, "derivedobject_id", "left").select(F.coalesce("parent_id", "derivedobject_id").alias("derivedobject_id"), "tracklet_id").distinct()
    marked = objects.join(map_.select("derivedobject_id").distinct().withColumn("_m", F.lit(True)), "derivedobject_id", "left")
    return marked.withColumn("status", F.when(F.col("_m"), "M").otherwise(F.col("status"))).drop("_m"), moved


def derive_objects(links: DataFrame, template: str = "L0000000") -> DataFrame:
    """(name, link, place, tracklet_id): new objects from links like ``t1=t2=t3``, named in the order of their text."""
    named = assign_names(links.select("link").distinct(), template, ["link"])
    return named.select("name", "link", F.posexplode(F.split("link", "=")).alias("place", "t")).select("name", "link", "place", F.col("t").cast("bigint").alias("tracklet_id"))


def remove_objects(objects: DataFrame, ids: DataFrame, status: str = "K") -> tuple[DataFrame, DataFrame]:
    """(objects, events): removed objects get the status and an R event each."""
    gone = ids.select("derivedobject_id").distinct().withColumn("_r", F.lit(True))
    marked = objects.join(gone, "derivedobject_id", "left")
    events = marked.filter("_r").select("derivedobject_id", F.lit("R").alias("event_type"), F.col("status").alias("old_status"))
    return marked.withColumn("status", F.when(F.col("_r"), status).otherwise(F.col("status"))).drop("_r"), events


def restore_objects(objects: DataFrame, events: DataFrame) -> DataFrame:
    """Objects with the status they had before their removal."""
    old = events.filter("event_type = 'R'").select("derivedobject_id", "old_status")
    return objects.join(old, "derivedobject_id", "left").withColumn("status", F.coalesce("old_status", "status")).drop("old_status")


def record_events(history: DataFrame, kind: str, df: DataFrame) -> DataFrame:
    """The history with new events of one kind; their other columns are its payload, missing ones null."""
    return history.unionByName(df.withColumn("event_type", F.lit(kind)), allowMissingColumns=True)


def queue_submit(queue: DataFrame, new: DataFrame) -> DataFrame:
    """The queue with one row per object: new rows replace old ones."""
    return queue.join(new.select("derivedobject_id"), "derivedobject_id", "left_anti").unionByName(new)


def queue_select(queue: DataFrame, status: str) -> DataFrame:
    return queue.filter(F.col("status") == status).orderBy("queue_id")


def queue_advance(queue: DataFrame) -> DataFrame:
    """Every row one step along the chain; those at its end stay."""
    step = F.col("status")
    for a, b in zip(QUEUE_CHAIN, QUEUE_CHAIN[1:], strict=False):
        step = F.when(F.col("status") == a, b).otherwise(step)
    return queue.withColumn("status", step)


def queue_flush(queue: DataFrame) -> DataFrame:
    """The queue without finished rows."""
    return queue.filter(F.col("status") != QUEUE_CHAIN[-1])


def upsert_known(known: DataFrame, names: DataFrame, key: str = "known_name") -> DataFrame:
    """Known objects with names that weren't there added."""
    return known.unionByName(names.select(key).distinct().join(known.select(key), key, "left_anti"), allowMissingColumns=True)


def export_delta(current: DataFrame, last: DataFrame, key: str = "derivedobject_id", member: str = "det_id") -> DataFrame:
    """(key, member, removed): what joined or left each object since its last revision."""
    a, b = current.select(key, member).distinct(), last.select(key, member).distinct()
    return a.join(b, [key, member], "left_anti").withColumn("removed", F.lit(False)).unionByName(b.join(a, [key, member], "left_anti").withColumn("removed", F.lit(True)))
