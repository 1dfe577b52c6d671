"""Selections of detections, fields, tracklets, objects, orbits and events. Arguments left out select everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.photometry import predict_s2n
from ..functions.sky import in_field, in_square_field
from .numbering import numbered


def _only(df: DataFrame, column: str, values) -> DataFrame:
    """Rows with one of some values: a value, a list, or a table of a column of that name."""
    if values is None:
        return df
    if isinstance(values, DataFrame):
        return df.join(values.select(column).distinct(), column, "left_semi")
    return df.filter(F.col(column).isin(values) if isinstance(values, list | tuple) else F.col(column) == values)


def select_detections(detections: DataFrame, det_id=None, field_id=None, object_name=None, status: str | None = "F", min_s2n: float | None = None, nn: int | None = None, fields: DataFrame | None = None, attributes: DataFrame | None = None, dirty: float | None = None) -> DataFrame:
    """Detections by id, field, object, status (found by default), S/N and night; ``dirty`` keeps those of a PSF quality over it."""
    d = _only(_only(_only(_only(detections, "det_id", det_id), "field_id", field_id), "object_name", object_name), "status", status)
    if min_s2n is not None:
        d = d.filter(F.col("s2n") >= min_s2n)
    if nn is not None:
        d = d.join(fields.filter(F.col("nn") == nn).select("field_id"), "field_id", "left_semi")
    if dirty is not None:
        d = d.join(attributes.filter(F.col("psf_quality") > dirty).select("det_id"), "det_id", "left_semi")
    return d


def detections_by_tracklet_status(detections: DataFrame, attrib: DataFrame, tracklets: DataFrame, status: str, field_id=None, nn=None) -> DataFrame:
    """Detections in tracklets of a status, of a field or a night, each once."""
    t = _only(_only(_only(tracklets, "status", status), "field_id", field_id), "nn", nn)
    return detections.join(attrib.join(t.select("tracklet_id"), "tracklet_id", "left_semi").select("det_id"), "det_id", "left_semi")


def detections_of_object(detections: DataFrame, attrib: DataFrame, members: DataFrame, derivedobject_id=None) -> DataFrame:
    """(derivedobject_id, detection) rows of objects."""
    return _only(members, "derivedobject_id", derivedobject_id).join(attrib, "tracklet_id").join(detections, "det_id").select("derivedobject_id", "tracklet_id", *detections.columns)


def select_fields(fields: DataFrame, nn=None, ocnum=None, mjd: tuple[float, float] | None = None, status=None, parents_only: bool = False, field_id=None) -> DataFrame:
    """Fields by night, lunation, time, status; parents only if wanted. In order of time."""
    f = _only(_only(_only(_only(fields, "nn", nn), "ocnum", ocnum), "status", status), "field_id", field_id)
    if mjd is not None:
        f = f.filter((F.col("epoch_mjd") >= mjd[0]) & (F.col("epoch_mjd") < mjd[1]))
    if parents_only:
        f = f.filter("parent_id is null")
    return f.orderBy("epoch_mjd", "field_id")


def next_field(fields: DataFrame, mode: str, chain: tuple[str, ...] = ("I", "N", "D", "T", "U", "A"), nn: int | None = None) -> DataFrame:
    """One field: the ``oldest`` unfinished, the ``first`` in the order of the status chain of a night, or the ``last`` processed."""
    rank = F.lit(None).cast("int")
    for k, s in reversed(list(enumerate(chain))):
        rank = F.when(F.col("status") == s, k).otherwise(rank)
    f = _only(fields, "nn", nn).withColumn("_rank", rank)
    if mode == "oldest":
        f = f.filter("_rank is not null").orderBy("epoch_mjd", "field_id")
    elif mode == "first":
        f = f.filter("_rank is not null").orderBy("_rank", "epoch_mjd", "field_id")
    elif mode == "last":
        f = f.filter("_rank is null").orderBy(F.col("epoch_mjd").desc(), F.col("field_id").desc())
    else:
        raise ValueError(f"no mode {mode}")
    return f.drop("_rank").limit(1)


def select_tracklets(tracklets: DataFrame, attrib: DataFrame | None = None, members: DataFrame | None = None, field_id=None, status=None, det_id=None, derivedobject_id=None, mjd: tuple[float, float] | None = None) -> DataFrame:
    t = _only(_only(tracklets, "field_id", field_id), "status", status)
    if det_id is not None:
        t = t.join(_only(attrib, "det_id", det_id).select("tracklet_id"), "tracklet_id", "left_semi")
    if derivedobject_id is not None:
        t = t.join(_only(members, "derivedobject_id", derivedobject_id).select("tracklet_id"), "tracklet_id", "left_semi")
    if mjd is not None:
        t = t.filter((F.col("ext_epoch") >= mjd[0]) & (F.col("ext_epoch") < mjd[1]))
    return t


def tracklets_in_field(tracklets: DataFrame, attrib: DataFrame, detections: DataFrame, field_id, speed: tuple[float, float], any_in_field: bool = False) -> DataFrame:
    """Tracklet ids of a field in a band of speed: by their last field, or one row for each detection in it."""
    t = tracklets.filter(F.col("vel_tot").between(*speed))
    if not any_in_field:
        return _only(t, "field_id", field_id).select("tracklet_id")
    return attrib.join(_only(detections, "field_id", field_id).select("det_id"), "det_id").join(t.select("tracklet_id"), "tracklet_id").select("tracklet_id")


def select_detracklets(tracklets: DataFrame, attrib: DataFrame, detections: DataFrame, field_id=None, tracklet_id=None, probability: float | None = None, speed: tuple[float, float] | None = None) -> DataFrame:
    """Tracklet and detection rows together."""
    t = _only(_only(tracklets, "field_id", field_id), "tracklet_id", tracklet_id)
    if probability is not None:
        t = t.filter(F.col("probability") >= probability)
    if speed is not None:
        t = t.filter(F.col("vel_tot").between(*speed))
    d = detections.select("det_id", "epoch_mjd", "ra_deg", "dec_deg", "mag")
    return t.select("tracklet_id", "classification", "probability", "vel_tot").join(attrib, "tracklet_id").join(d, "det_id")


def select_objects(objects: DataFrame, members: DataFrame | None = None, orbits: DataFrame | None = None, derivedobject_id=None, object_name=None, tracklet_id=None, updated_since: int | None = None, orbit: Column | None = None) -> DataFrame:
    """Derived objects; with a predicate on the orbit they come in order of perihelion distance."""
    o = _only(_only(objects, "derivedobject_id", derivedobject_id), "object_name", object_name)
    if tracklet_id is not None:
        o = o.join(_only(members, "tracklet_id", tracklet_id).select("derivedobject_id"), "derivedobject_id", "left_semi")
    if updated_since is not None:
        o = o.filter(F.col("updated_nn") >= updated_since)
    if orbit is not None:
        o = o.join(orbits.filter(orbit).select("orbit_id", "q"), "orbit_id").orderBy("q", "derivedobject_id")
    return o


def select_orbits(objects: DataFrame, orbits: DataFrame, queue: DataFrame, mode: str, since: int = 0) -> DataFrame:
    """(derivedobject_id, orbit): ``unmerged``, ``updated`` since a night, ``queue`` (in status I), ``data`` (unmerged, not in it), or ``moid`` (could come within q - 3 sigma < 1.3)."""
    o = objects.filter("status <> 'M'")
    queued = queue.filter("status = 'I'").select("derivedobject_id")
    if mode == "updated":
        o = o.filter(F.col("updated_nn") >= since)
    elif mode == "queue":
        o = o.join(queued, "derivedobject_id", "left_semi")
    elif mode == "data":
        o = o.join(queued, "derivedobject_id", "left_anti")
    elif mode not in ("unmerged", "moid"):
        raise ValueError(f"no mode {mode}")
    out = o.select("derivedobject_id", "orbit_id").join(orbits, "orbit_id")
    return out.filter(F.col("q") - 3 * F.coalesce("q_sigma", F.lit(0.0)) < 1.3) if mode == "moid" else out


def select_population(ssm: DataFrame, ids: tuple[int, int] | None = None, object_name=None, predicate: Column | None = None) -> DataFrame:
    s = _only(ssm, "object_name", object_name)
    if ids is not None:
        s = s.filter(F.col("ssm_id").between(*ids))
    return s if predicate is None else s.filter(predicate)


def select_history(history: DataFrame, subtypes: dict[str, DataFrame], event_id=None, derivedobject_id=None, field_id=None) -> DataFrame:
    """Events with the payload of their type's table (event_id, ...), one left join per type."""
    h = _only(_only(_only(history, "event_id", event_id), "derivedobject_id", derivedobject_id), "field_id", field_id)
    out = None
    for kind, table in subtypes.items():
        part = h.filter(F.col("event_type") == kind).join(table, "event_id", "left")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    rest = h.filter(~F.col("event_type").isin(list(subtypes)))
    return rest if out is None else out.unionByName(rest, allowMissingColumns=True)


def visible_predictions(predictions: DataFrame, limit: float) -> DataFrame:
    """Objects that are brighter than a limit at any coarse epoch."""
    return predictions.groupBy("object_id").agg(F.min("mag").alias("brightest")).filter(F.col("brightest") < limit)


def detectable(predictions: DataFrame, fields: DataFrame, least_s2n: float | None, square: bool = False) -> DataFrame:
    """Predictions in their field's shape that reach the S/N, or without one the field's limiting magnitude."""
    f = fields.select("field_id", F.col("ra_deg").alias("f_ra"), F.col("dec_deg").alias("f_dec"), "fov_deg", "limiting_mag")
    shape = in_square_field if square else in_field
    j = predictions.join(f, "field_id").filter(shape(F.col("f_ra"), F.col("f_dec"), F.col("fov_deg"), F.col("ra_deg"), F.col("dec_deg")))
    ok = F.col("mag") <= F.col("limiting_mag") if least_s2n is None else predict_s2n("simple", F.col("mag")) >= least_s2n
    return j.filter(ok).select("object_id", "field_id")


def select_extended(detections: DataFrame, attributes: DataFrame, least_px: float) -> DataFrame:
    """Detections whose major axis is over so many pixels (moments xx, xy, yy)."""
    from ..functions.photometry import morphology_axes

    major, _, _ = morphology_axes(F.col("xx"), F.col("xy"), F.col("yy"))
    return detections.join(attributes.withColumn("major_px", major).filter(F.col("major_px") > least_px).select("det_id", "major_px"), "det_id")


def observed_nights(fields: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Nights with fields, newest first."""
    f = fields.select("nn").distinct()
    if low is not None:
        f = f.filter(F.col("nn") >= low)
    if high is not None:
        f = f.filter(F.col("nn") <= high)
    return f.orderBy(F.col("nn").desc())


def latest_per_pointing(fields: DataFrame, by_night: bool = False) -> DataFrame:
    """The last exposure of each pointing (and night)."""
    keys = ["p", "nn"] if by_night else ["p"]
    return fields.groupBy(*keys).agg(F.max(F.struct("epoch_mjd", "field_id")).alias("m")).select(*keys, F.col("m.field_id").alias("field_id"), F.col("m.epoch_mjd").alias("epoch_mjd"))


def last_event(history: DataFrame) -> DataFrame:
    """Each event with the id of the object's previous attribution or derivation."""
    w = W.partitionBy("derivedobject_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, -1)
    chained = F.when(F.col("event_type").isin("D", "A"), F.col("event_id"))
    return history.select("event_id", "derivedobject_id", F.last(chained, ignorenulls=True).over(w).alias("last_event_id"))


def consecutive_separations(dets: DataFrame, key: str) -> DataFrame:
    """Distance and time from each detection to the one before it in its group."""
    from ..functions.sky import separation

    w = W.partitionBy(key).orderBy("epoch_mjd", "det_id")
    prev = {c: F.lag(c).over(w) for c in ("ra_deg", "dec_deg", "epoch_mjd")}
    return dets.select(key, "det_id", separation(prev["ra_deg"], prev["dec_deg"], F.col("ra_deg"), F.col("dec_deg")).alias("distance"), (F.col("epoch_mjd") - prev["epoch_mjd"]).alias("dt"))


def sample_every(df: DataFrame, n: int, offset: int, order: str) -> DataFrame:
    """Every n-th row in an order that is unique, from ``offset`` on, numbered by ranges (no task sees all rows)."""
    return numbered(df, [order], "_k").filter(F.pmod(F.col("_k") - 1 - offset, F.lit(n)) == 0).drop("_k")


def interleave(df: DataFrame, n: int, order: str) -> DataFrame:
    """Rows with ``part``: 0 to n - 1 in turn."""
    return numbered(df, [order], "_k").withColumn("part", F.pmod(F.col("_k") - 1, F.lit(n)).cast("int")).drop("_k")


def designation_counts(observations: DataFrame) -> DataFrame:
    return observations.groupBy("desig").agg(F.count("*").alias("n"))


def observations_by_q(detections: DataFrame, objects: DataFrame) -> DataFrame:
    """Observations of objects with their perihelion distance, by it."""
    return detections.select("det_id", "object_name", "mag").join(objects.select("object_name", "q"), "object_name").orderBy("q", "det_id")


def audit_reuse(members: DataFrame, objects: DataFrame, attrib: DataFrame | None = None) -> DataFrame:
    """Tracklets (or, with ``attrib``, detections) in more than one unmerged object, with the classes of those."""
    live = objects.filter("status <> 'M'").select("derivedobject_id", "classification")
    m = members.join(live, "derivedobject_id")
    key = "tracklet_id" if attrib is None else "det_id"
    if attrib is not None:
        m = m.join(attrib, "tracklet_id").select("derivedobject_id", "classification", "det_id").distinct()
    return m.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct("classification").alias("classes"), F.min("derivedobject_id").alias("first_object")).filter("n > 1")


def audit_references(tables: dict[str, DataFrame], rules: list[tuple[str, str, str]]) -> DataFrame:
    """(rule, n): rows of a table whose key is missing in its parent, per rule (child, column, parent)."""
    out = None
    for child, column, parent in rules:
        lost = tables[child].join(tables[parent].select(column).distinct(), column, "left_anti").agg(F.count("*").alias("n")).select(F.lit(f"{child}.{column}").alias("rule"), "n")
        out = lost if out is None else out.unionByName(lost)
    return out
