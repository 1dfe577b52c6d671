"""Joins of detections, fields, tracks and orbits that lie near each other."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sky import angle_diff, in_ellipse, separation
from .skyjoin import cell_size, for_each_key, keys_at, leveled_sky_join, shuffled, sky_join, spans, with_cell, with_cells_in_reach

GAUSS_YEAR = 365.256898

#: Keys that a crowded cell's rows are dealt over where the other side comes back to the same places.
DEALT = 24


def detection_proximity(data: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, det_id): data within each query's own distance, time and brightness thresholds (negative brightness: off).

    ``queries`` has query_id, q_ra, q_dec, q_mjd, q_mag, max_dist, max_dt, max_dmag. Each query is joined on cells of its own distance's size, so a wide one
    makes no other wider, and on buckets of time, a quarter of the longest ``max_dt``: a place that is seen every night is not read whole for each query.
    """
    longest = queries.filter("max_dt >= 0").agg(F.max("max_dt")).first()[0]
    bucket = max(float(longest or 0.0) / 4, 1e-3)
    d = data.select("det_id", "epoch_mjd", "ra_deg", "dec_deg", "mag").withColumn("_t", F.floor(F.col("epoch_mjd") / bucket))
    k = queries.filter("max_dt >= 0").withColumn("_t", F.explode(spans(F.col("q_mjd"), F.col("max_dt") + 1e-6, bucket)))
    near = leveled_sky_join(d, k, "max_dist", ("ra_deg", "dec_deg"), ("q_ra", "q_dec"), ("_t",))
    ok = (F.abs(F.col("epoch_mjd") - F.col("q_mjd")) <= F.col("max_dt")) & ((F.col("max_dmag") < 0) | (F.abs(F.col("mag") - F.col("q_mag")) <= F.col("max_dmag")))
    return near.filter(ok).select("query_id", "det_id")


def segments(tracks: DataFrame, key: str, *kept: Column) -> DataFrame:
    """Pieces of piecewise-linear tracks (key, epoch_mjd, ra_deg, dec_deg): each knot with the next one; ``last`` where none follows. ``kept`` are further columns, per knot or over the key."""
    w = W.partitionBy(key).orderBy("epoch_mjd", "ra_deg", "dec_deg")
    return tracks.select(key, *kept, F.col("epoch_mjd").alias("t0"), F.col("ra_deg").alias("ra0"), F.col("dec_deg").alias("dec0"), F.lead("epoch_mjd").over(w).alias("t1"), F.lead("ra_deg").over(w).alias("ra1"), F.lead("dec_deg").over(w).alias("dec1"), F.lead("epoch_mjd", 2).over(w).isNull().alias("last")).filter("t1 is not null")


def field_proximity(fields: DataFrame, tracks: DataFrame, pad: float = 0.0, key: str = "object_id", radius: Column | None = None, bucket_days: float = 1.0, by_place: bool = False) -> DataFrame:
    """(field_id, key, distance): tracks interpolated to a field's epoch within its radius and the padding (:func:`met_fields`)."""
    return met_fields(fields, segments(tracks, key), pad, key, radius, bucket_days, by_place=by_place).select("field_id", key, "distance")


def met_fields(fields: DataFrame, pieces: DataFrame, pad: float, key: str, radius: Column | None = None, bucket_days: float = 1.0, own_pad: Column | None = None, by_place: bool = False) -> DataFrame:
    """``pieces`` (:func:`segments`, with any columns beside) and the fields they meet: tracks interpolated to a field's epoch within its radius and the padding, or ``own_pad`` of the piece's columns, which
    is no larger.

    With ``by_place`` fields of one epoch and place are compared once, and so are equal pieces of several tracks; their pairs are given for each field and each track (:func:`skyjoin.for_each_key`). Without
    it each is compared, which is less work where few share anything.

    Segments are cut into pieces of at most a bucket of time and about the search radius of motion. Pieces and fields meet on the bucket
    and the sky cell, cells being as wide as the radius, the padding and half a piece's motion, so a field sees only what is near it then. Pieces end before
    the next one starts, a track's last one at its last knot: a field meets one piece of a track at most, and pairs need no comparing with each other.
    """
    every = fields.select("field_id", "epoch_mjd", F.col("ra_deg").alias("f_ra"), F.col("dec_deg").alias("f_dec"), (radius if radius is not None else F.col("fov_deg") / 2).alias("f_radius"))
    view, path = ("epoch_mjd", "f_ra", "f_dec", "f_radius"), tuple(c for c in pieces.columns if c != key)
    f = (every.select(*view).distinct() if by_place else every).withColumn("_b", F.floor(F.col("epoch_mjd") / bucket_days))
    reach = max(float(f.agg(F.max("f_radius")).first()[0] or 0.0) + pad, 1e-3)
    motion = F.abs(angle_diff(F.col("ra1"), F.col("ra0"))) + F.abs(F.col("dec1") - F.col("dec0"))
    n = F.greatest(F.lit(1), F.ceil((F.col("t1") - F.col("t0")) / bucket_days), F.ceil(motion / reach)).cast("int")
    s = (pieces.select(*path).distinct() if by_place else pieces).withColumn("_n", n).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    cut = lambda k: F.col("t0") + (F.col("t1") - F.col("t0")) * k / F.col("_n")
    s = s.withColumn("_from", cut(F.col("_k"))).withColumn("_to", F.when(F.col("_k") == F.col("_n") - 1, F.col("t1")).otherwise(cut(F.col("_k") + 1))).withColumn("_end", F.col("last") & (F.col("_k") == F.col("_n") - 1))
    half = (F.col("_k") + 0.5) / F.col("_n")
    s = s.withColumn("m_ra", F.pmod(F.col("ra0") + half * angle_diff(F.col("ra1"), F.col("ra0")), F.lit(360.0))).withColumn("m_dec", F.col("dec0") + half * (F.col("dec1") - F.col("dec0")))
    first = F.floor(F.col("_from") / bucket_days)
    s = s.withColumn("_b", F.explode(F.sequence(first, F.when(F.col("_end"), F.floor(F.col("_to") / bucket_days)).otherwise(F.greatest(first, F.ceil(F.col("_to") / bucket_days) - 1))))).drop("_n", "_k")
    inside = (F.col("epoch_mjd") >= F.col("_from")) & ((F.col("epoch_mjd") < F.col("_to")) | (F.col("_end") & (F.col("epoch_mjd") == F.col("_to"))))
    j = sky_join(s, f, reach * 1.5, ("m_ra", "m_dec"), ("f_ra", "f_dec"), ("_b",)).filter(inside)
    part = F.when(F.col("t1") > F.col("t0"), (F.col("epoch_mjd") - F.col("t0")) / (F.col("t1") - F.col("t0"))).otherwise(0.0)
    ra = F.pmod(F.col("ra0") + part * angle_diff(F.col("ra1"), F.col("ra0")), F.lit(360.0))
    dec = F.col("dec0") + part * (F.col("dec1") - F.col("dec0"))
    near = j.withColumn("distance", separation(F.col("f_ra"), F.col("f_dec"), ra, dec)).filter(F.col("distance") <= F.col("f_radius") + (pad if own_pad is None else own_pad))
    if not by_place:
        return near
    near = near.select(*view, *path, "distance")
    return for_each_key(for_each_key(near, every, "field_id", view), pieces, key, path, deal=2, found=near)


def orbit_proximity(data: DataFrame, queries: DataFrame, q: float = 0.1, e: float = 0.05, i: float = 5.0, node: float = 10.0, arg_peri: float = 10.0, time_peri: float = 0.1) -> DataFrame:
    """(query_id, orbit_id): orbits near each query in all of q, e, i, node, argument and time of perihelion.

    Angles wrap. The time of perihelion may differ by a fraction of the query's period, once more per passage between. The argument of
    perihelion does not count for queries of e <= 0.05. A threshold under 1e-20 is off. The join is on
    cells of q, e, i and node, twice as wide as the thresholds that are on; the queries are repeated for those in reach.
    """
    on = lambda x: x >= 1e-20
    names = ("q", "e", "i", "node", "arg_peri", "time_peri")
    d, k = data.select("orbit_id", *names), queries.select("query_id", *[F.col(c).alias(f"k_{c}") for c in names])
    cells = []
    for c, w, around in (("q", q, 0.0), ("e", e, 0.0), ("i", i, 360.0), ("node", node, 360.0)):
        if on(w):
            n = max(1, math.floor(around / (2 * w)))  # cells around the circle
            width = around / n if around else 2 * w
            turn = lambda x: F.pmod(x, F.lit(n)) if around else x  # noqa: B023, E731
            d = d.withColumn(f"_{c}", turn(F.floor(F.col(c) / width)))
            k = k.withColumn(f"_{c}", F.explode(F.array_distinct(F.transform(spans(F.col(f"k_{c}"), w * (1 + 1e-9) + 1e-9, width), turn))))
            cells.append(f"_{c}")
    j = d.join(shuffled(k), cells) if cells else d.crossJoin(k)
    ok = F.lit(True)
    for c, w in (("q", q), ("e", e)):
        if on(w):
            ok = ok & (F.abs(F.col(c) - F.col(f"k_{c}")) < w)
    for c, w in (("i", i), ("node", node), ("arg_peri", arg_peri)):
        if on(w):
            close = F.abs(angle_diff(F.col(c), F.col(f"k_{c}"))) < w
            ok = ok & ((F.col("k_e") <= 0.05) | close if c == "arg_peri" else close)
    if on(time_peri):
        period = GAUSS_YEAR * F.pow(F.try_divide("k_q", 1 - F.col("k_e")), 1.5)
        passed = F.try_divide(F.abs(F.col("time_peri") - F.col("k_time_peri")), period)
        ok = ok & (passed - F.floor(passed) < time_peri * (F.floor(passed) + 1))
    return j.filter(ok).select("query_id", "orbit_id")


def orbit_field_candidates(fields: DataFrame, tracks: DataFrame, small_pad: float, large_pad: float, limit: float, key: str = "object_id") -> DataFrame:
    """Objects that may be in a field: those of small uncertainty within a padded radius, others within a wider one.

    Whether a track's worst uncertainty is small travels with its pieces, so what has been found is not joined again.
    """
    worst = F.max("uncertainty").over(W.partitionBy(key))
    pieces = segments(tracks.filter(F.col(key).isNotNull()), key, F.coalesce((worst <= limit).cast("int"), F.lit(-1)).alias("_small"))
    pad = F.when(F.col("_small") == 1, small_pad).otherwise(large_pad)
    wide = met_fields(fields.filter("field_id is not null"), pieces, max(small_pad, large_pad), key, F.col("fov_deg") / 2, own_pad=pad, by_place=True)
    return wide.select("field_id", key, F.when(F.col("_small") >= 0, F.col("_small") == 1).alias("certain"))


def attribute_candidates(predictions: DataFrame, dets: DataFrame, used: DataFrame | None, sigma: float, most_deg: float, pad_deg: float = 0.0) -> DataFrame:
    """(object_id, tracklet_id): end detections of unattributed tracklets in the clamped N-sigma ellipse of a prediction in their field.

    ``dets`` has tracklet_id, field_id, d_ra, d_dec; for precovery ``used`` lists (object_id, field_id) to skip.
    """
    p = predictions if used is None else predictions.join(used, ["object_id", "field_id"], "left_anti")
    clamp = lambda c: F.least(F.lit(most_deg), F.col(c) * sigma / 3600.0)
    near = sky_join(dets, p.select("object_id", "field_id", "ra_deg", "dec_deg", clamp("smaa_arcsec").alias("a"), clamp("smia_arcsec").alias("b"), "bearing_deg"), most_deg + pad_deg, ("d_ra", "d_dec"), ("ra_deg", "dec_deg"), ("field_id",))
    inside = in_ellipse(F.col("ra_deg"), F.col("dec_deg"), F.col("a"), F.col("b"), F.col("bearing_deg"), F.col("d_ra"), F.col("d_dec"), pad_deg)
    return near.filter(inside).select("object_id", "tracklet_id", "distance")


def objects_in_view(predictions: DataFrame, pointings: DataFrame, radius: float, faintest: float) -> DataFrame:
    """(pointing_id, object_id, distance): predictions brighter than a limit near pointings (p_ra, p_dec).

    Surveys come back to a place night after night, so places are compared once and their pairs given for each prediction and each pointing there (:func:`skyjoin.for_each_key`); cells and places that many
    have are dealt over many tasks.
    """
    bright = predictions.filter(F.col("mag") < faintest).select("object_id", "ra_deg", "dec_deg")
    near = sky_join(bright.select("ra_deg", "dec_deg").distinct(), pointings.select("p_ra", "p_dec").distinct(), radius, ("ra_deg", "dec_deg"), ("p_ra", "p_dec"), deal=DEALT)
    seen = for_each_key(near, bright, "object_id", ("ra_deg", "dec_deg")).select("object_id", "p_ra", "p_dec", "distance")
    return for_each_key(seen, pointings, "pointing_id", ("p_ra", "p_dec"), deal=DEALT, found=near).select("pointing_id", "object_id", "distance")


def find_object(predictions: DataFrame, dets: DataFrame, radius: float) -> DataFrame:
    """Detections within a radius of an object's prediction for their field."""
    p = predictions.select("object_id", "field_id", F.col("ra_deg").alias("p_ra"), F.col("dec_deg").alias("p_dec"))
    return sky_join(dets.select("det_id", "field_id", "ra_deg", "dec_deg"), p, radius, ("ra_deg", "dec_deg"), ("p_ra", "p_dec"), ("field_id",)).select("object_id", "det_id", "distance")


def compare_detections(sim: DataFrame, real: DataFrame, radius: float) -> DataFrame:
    """Each simulated detection with the nearest real one of its exposure within the radius, or null (ties: the smaller id).

    Places are compared, not detections: simulated ones that share a place share its answer, and of real ones at one place only the smallest id can be it. So objects that take the same
    paths do not meet each other's copies.
    """
    place = ["field_id", "s_ra", "s_dec"]
    s = sim.select(F.col("det_id").alias("sim_id"), "field_id", "mag", F.col("ra_deg").alias("s_ra"), F.col("dec_deg").alias("s_dec"))
    r = real.groupBy("field_id", "ra_deg", "dec_deg").agg(F.min("det_id").alias("det_id"))
    near = sky_join(r, s.select(*place).distinct(), radius, ("ra_deg", "dec_deg"), ("s_ra", "s_dec"), ("field_id",))
    best = near.groupBy(*place).agg(F.min(F.struct("distance", "det_id")).alias("b")).select(*place, F.col("b.det_id").alias("real_id"), F.col("b.distance").alias("distance"))
    return s.join(best, place, "left").select("sim_id", "field_id", "mag", "real_id", "distance")


def compare_tracklets(matches: DataFrame, sim_attrib: DataFrame, real_attrib: DataFrame) -> DataFrame:
    """Pairs of a simulated and a real tracklet with the number of detections that match."""
    j = matches.filter("real_id is not null").join(sim_attrib.select(F.col("det_id").alias("sim_id"), F.col("tracklet_id").alias("sim_tracklet")), "sim_id").join(real_attrib.select(F.col("det_id").alias("real_id"), F.col("tracklet_id").alias("real_tracklet")), "real_id")
    return j.groupBy("sim_tracklet", "real_tracklet").agg(F.count("*").alias("matched"))


def compare_predictions(a: DataFrame, b: DataFrame, mapping: DataFrame) -> DataFrame:
    """Signed differences and separation of two prediction tables at the same fields, for mapped objects (a_id, b_id)."""
    names = ("field_id", "ra_deg", "dec_deg", "epoch_mjd", "mag")
    x = a.select(F.col("object_id").alias("a_id"), *[F.col(c).alias(f"a_{c}") if c != "field_id" else F.col(c) for c in names])
    y = b.select(F.col("object_id").alias("b_id"), *[F.col(c).alias(f"b_{c}") if c != "field_id" else F.col(c) for c in names])
    j = x.join(mapping, "a_id").join(y, ["b_id", "field_id"])
    return j.select("a_id", "b_id", "field_id", angle_diff(F.col("a_ra_deg"), F.col("b_ra_deg")).alias("dra"), (F.col("a_dec_deg") - F.col("b_dec_deg")).alias("ddec"), (F.col("a_epoch_mjd") - F.col("b_epoch_mjd")).alias("dt"), (F.col("a_mag") - F.col("b_mag")).alias("dmag"), separation(F.col("a_ra_deg"), F.col("a_dec_deg"), F.col("b_ra_deg"), F.col("b_dec_deg")).alias("distance"))


def fields_in_cone(targets: DataFrame, fields: DataFrame, max_speed: float, max_days: float) -> DataFrame:
    """(target_id, field_id, dt, gap): earlier fields that motion at ``max_speed`` could have left for a target, ``gap`` degrees apart.

    The radius of the search grows with the time looked back, so that is cut into steps, each half as long ago as the one before, down to the time in which nothing moves by more than the fields are wide. A step
    has buckets of time and sky cells of its own size: a target meets what was near it then, however many years of fields there are. ``gap`` is the distance less both radii.
    """
    wide = (fields.agg(F.max("fov_deg")).first()[0] or 0.0) / 2 + (targets.agg(F.max("t_radius")).first()[0] or 0.0)
    steps = max(0, min(20, math.ceil(math.log2(max(1.0, max_speed * max_days / max(wide, 1e-6))))))
    bounds = [(max_days / 2 ** (k + 1) if k < steps else 0.0, max_days / 2**k) for k in range(steps + 1)]
    step = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(low).alias("low"), F.lit(high).alias("high"), F.lit(cell_size(min(180.0, max_speed * high + wide))).alias("chord")) for k, (low, high) in enumerate(bounds)]))
    f = fields.select("field_id", "epoch_mjd", "ra_deg", "dec_deg", (F.col("fov_deg") / 2).alias("f_radius"), step.alias("_s")).withColumn("_bucket", F.floor(F.col("epoch_mjd") / F.col("_s.high")))
    f = with_cell(f, "ra_deg", "dec_deg", 2 * F.col("_s.chord")).withColumn("_k", F.col("_s.k")).drop("_s")
    t = targets.select("*", step.alias("_s")).withColumn("_bucket", F.explode(F.sequence(F.floor((F.col("t_mjd") - F.col("_s.high")) / F.col("_s.high")), F.floor((F.col("t_mjd") - F.col("_s.low")) / F.col("_s.high")))))
    t = with_cells_in_reach(t, "t_ra", "t_dec", F.col("_s.chord"), 2 * F.col("_s.chord"))
    t = t.select("*", F.col("_s.k").alias("_k"), F.col("_s.low").alias("_low"), F.col("_s.high").alias("_high")).drop("_s")
    met = f.join(shuffled(t), ["_k", "_bucket", "_cx", "_cy", "_cz"]).withColumn("dt", F.col("t_mjd") - F.col("epoch_mjd")).filter((F.col("dt") > F.col("_low")) & (F.col("dt") <= F.col("_high")))
    apart = separation(F.col("t_ra"), F.col("t_dec"), F.col("ra_deg"), F.col("dec_deg")) - F.col("f_radius") - F.col("t_radius")
    return met.withColumn("gap", F.greatest(F.lit(0.0), apart)).filter(F.col("gap") <= max_speed * F.col("dt")).select("target_id", "field_id", "dt", "gap")


def linkable_detracklets(targets: DataFrame, fields: DataFrame, tracklets: DataFrame, max_speed: float, max_days: float, slack: float = 1.3) -> DataFrame:
    """(target_id, tracklet_id): unattributed tracklets of earlier fields that could have moved into a target field.

    ``targets`` has target_id, t_mjd, t_ra, t_dec, t_radius. Of the fields that have such tracklets and lie within reach (:func:`fields_in_cone`) those tracklets count whose own speed
    times the slack covers the gap.

    Targets and fields of one epoch and place are compared once, and so are a field's tracklets of one speed. The tracklets of each pair travel in arrays to the target's place, where each of its targets gets
    them: what is shuffled grows with the tracklets that places have in reach, not with the pairs.
    """
    free = tracklets.filter("status = 'U'").select("tracklet_id", "field_id", "vel_tot")
    view, aim = ("epoch_mjd", "ra_deg", "dec_deg", "fov_deg"), ("t_mjd", "t_ra", "t_dec", "t_radius")
    seen = free.join(fields.select("field_id", *view), "field_id").select("tracklet_id", "vel_tot", *view).dropna(subset=["vel_tot", *view])
    moves = seen.select(*view, "vel_tot").distinct()
    places = moves.select(*view).distinct().withColumn("field_id", F.struct(*view))
    cone = fields_in_cone(targets.select(*aim).distinct().withColumn("target_id", F.struct(*aim)), places, max_speed, max_days)
    near = cone.select("target_id.*", "field_id.*", "dt", "gap").join(shuffled(moves), list(view)).filter(F.col("vel_tot") * slack * F.col("dt") >= F.col("gap")).select(*aim, *view, "vel_tot")
    keys = keys_at(seen, "tracklet_id", (*view, "vel_tot"), "_tracklets")
    held = near.join(shuffled(keys), [*view, "vel_tot"]).select(*aim, "_tracklets")
    return for_each_key(held, targets, "target_id", aim, deal=2, found=near).select("target_id", F.explode("_tracklets").alias("tracklet_id"))


def lsd_tracklets(predictions: DataFrame, dets: DataFrame, used: DataFrame, radius: float, cutoff: float, least: int = 2, same: tuple[str, ...] = ()) -> DataFrame:
    """Groups of archive detections near an object's predictions in one night, without used ones and not all of high significance.

    Whatever lies nearest to a prediction counts. Injected detections carry the name of their object: with ``same``, columns of both sides that must agree
    (nulls never do), another object's detection at the same place is none of this one's.
    """
    free = dets.join(used.select("det_id"), "det_id", "left_anti")
    p = predictions.select("object_id", "field_id", *same, F.col("ra_deg").alias("p_ra"), F.col("dec_deg").alias("p_dec"))
    near = sky_join(free.select("det_id", "field_id", *same, "nn", "ra_deg", "dec_deg", "s2n"), p, radius, ("ra_deg", "dec_deg"), ("p_ra", "p_dec"), ("field_id", *same))
    best = near.groupBy("object_id", "nn", "field_id").agg(F.min(F.struct("distance", "det_id", "s2n")).alias("b"))
    return best.groupBy("object_id", "nn").agg(F.count("*").alias("n"), F.min("b.s2n").alias("least_s2n"), F.min("b.det_id").alias("first_det")).filter((F.col("n") >= least) & (F.col("least_s2n") < cutoff))


def search_radius(days: float, speed: float, pad: float) -> float:
    return math.fabs(days) * speed + pad
