"""Efficiency and quality reports: conditional sums over classification codes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..constants import EFF_BAD, EFF_CLEAN, EFF_MIXED, EFF_NONSYNTHETIC, EFF_UNFOUND


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")


def is_(code: str, column: str = "classification") -> Column:
    return F.col(column) == code


def class_counts() -> list[Column]:
    return [
        count_if(~is_(EFF_UNFOUND)).alias("found"), count_if(is_(EFF_UNFOUND)).alias("unfound"), count_if(F.col("classification").isin(EFF_CLEAN, EFF_UNFOUND)).alias("avail"),
        count_if(is_(EFF_CLEAN)).alias("clean"), count_if(is_(EFF_MIXED)).alias("mixed"), count_if(is_(EFF_BAD)).alias("bad"), count_if(is_(EFF_NONSYNTHETIC)).alias("nonsynthetic"),
    ]


def eff_detections(detections: DataFrame, fields: DataFrame, nn: int | None = None) -> DataFrame:
    """Per field: detections available, found, unfound, synthetic, nonsynthetic."""
    chosen = (fields if nn is None else fields.filter(F.col("nn") == nn)).select("field_id")
    synthetic = F.coalesce(F.col("object_name").startswith("S"), F.lit(False))
    return detections.join(chosen, "field_id", "left_semi").groupBy("field_id").agg(
        count_if(synthetic).alias("avail"), count_if(synthetic & is_("F", "status")).alias("found"), count_if(synthetic & is_("X", "status")).alias("unfound"),
        count_if(synthetic & is_("F", "status")).alias("synthetic"), count_if(~synthetic).alias("nonsynthetic"),
    )


def eff_tracklets_by_field(tracklets: DataFrame, attrib: DataFrame, detections: DataFrame, start: float) -> DataFrame:
    """Per field of a member detection: tracklets by class, over one night from ``start``."""
    night = tracklets.filter((F.col("ext_epoch") >= start) & (F.col("ext_epoch") < start + 1)).select("tracklet_id", "classification")
    joined = night.join(attrib, "tracklet_id", "left").join(detections.select("det_id", "field_id"), "det_id", "left")
    return joined.groupBy("field_id").agg(*class_counts())


def eff_tracklets_by_night(tracklets: DataFrame, fields: DataFrame, ocnum: int | None) -> DataFrame:
    """Per night of a lunation: tracklets by class."""
    chosen = fields if ocnum is None else fields.filter(F.col("ocnum") == ocnum)
    return tracklets.select("field_id", "classification").join(chosen.select("field_id", "nn"), "field_id").groupBy("nn").agg(*class_counts())


def eff_history(history: DataFrame, fields: DataFrame, kind: str, by: str = "nn") -> DataFrame:
    """Events of one type by field or night: available, found, unfound (unlinked or failed fits), clean, mixed, bad, nonsynthetic."""
    joined = history.filter(F.col("event_type") == kind).join(fields.select("field_id", "nn"), "field_id")
    unfound = is_(EFF_UNFOUND)
    return joined.groupBy(by).agg(
        *class_counts(), count_if(unfound & is_("F", "orbit_code")).alias("unlinked"), count_if(unfound & ~is_("F", "orbit_code")).alias("failod"), F.lit(0).cast("bigint").alias("failiod")
    )


def eff_derivations(history: DataFrame, keys: DataFrame, key: str, on: str) -> DataFrame:
    """Derivations by a key: the first clean derivation of an object is clean, further ones are duplicates; sides without events count 0."""
    derived = history.filter(F.col("event_type") == "D").join(keys, on)
    clean = derived.filter(is_(EFF_CLEAN)).groupBy(key, "derivedobject_id").agg(F.count("*").alias("n")).groupBy(key).agg(F.count("*").alias("clean"), F.sum(F.col("n") - 1).alias("duplicate"))
    rest = derived.groupBy(key).agg(
        count_if(is_(EFF_UNFOUND)).alias("unfound"), count_if(is_(EFF_MIXED)).alias("mixed"), count_if(is_(EFF_BAD)).alias("bad"), count_if(is_(EFF_NONSYNTHETIC)).alias("nonsynthetic")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return clean.join(rest, key, "full_outer").select(key, *[zero(c) for c in ("clean", "duplicate", "unfound", "mixed", "bad", "nonsynthetic")])


def derivation_residuals(objects: DataFrame, orbits: DataFrame) -> DataFrame:
    """Residuals of derived orbits in a long table by class."""
    return objects.join(orbits.select("orbit_id", "residual"), "orbit_id").select("classification", "derivedobject_id", "residual")


def attribution_distances(history: DataFrame) -> DataFrame:
    """Ephemeris distances of attributions in a long table by class."""
    return history.filter(F.col("event_type") == "A").select("classification", "event_id", "ephemeris_distance")


def available_linkages(tracklets: DataFrame, nights: int, first: int, last: int) -> DataFrame:
    """Population objects with clean tracklets on at least so many nights of a range."""
    clean = tracklets.filter(is_(EFF_CLEAN) & F.col("nn").between(first, last) & F.col("ssm_id").isNotNull())
    return clean.groupBy("ssm_id").agg(F.count_distinct("nn").alias("nights")).filter(F.col("nights") >= nights)


def available_link2(tracklets: DataFrame, fields: DataFrame) -> DataFrame:
    """Population objects seen in more than one lunation on more than two nights."""
    seen = tracklets.filter(F.col("ssm_id").isNotNull()).join(fields.select("field_id", "ocnum"), "field_id")
    return seen.groupBy("ssm_id").agg(F.count_distinct("ocnum").alias("lunations"), F.count_distinct("nn").alias("nights")).filter("lunations > 1 and nights > 2")


def survey_mode_counts(fields: DataFrame) -> DataFrame:
    return fields.groupBy("nn", "survey_mode").agg(F.count("*").alias("n"))


def status_summary(fields: DataFrame, tracklets: DataFrame) -> DataFrame:
    """Fields and tracklets by lunation, night and status, and by filter and survey mode, as grouping sets of one pass."""
    per_field = tracklets.groupBy("field_id").agg(F.count("*").alias("t"))
    joined = fields.join(per_field, "field_id", "left")
    a, b = ["ocnum", "nn", "status"], ["filter_id", "survey_mode"]
    keys = [F.col(c) for c in a + b]
    sets = joined.groupingSets([[F.col(c) for c in a], [F.col(c) for c in b]], *keys)
    return sets.agg(F.count("*").alias("n_fields"), F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("n_tracklets"), F.grouping("nn").cast("int").alias("by_mode")).select(*a, *b, "n_fields", "n_tracklets", "by_mode")


def chain_quality(history: DataFrame, kind: str, population: DataFrame | None = None) -> DataFrame:
    """Efficiency (clean among available) and accuracy (clean among found) of one kind of event."""
    h = history.filter(F.col("event_type") == kind)
    if population is not None:
        h = h.join(population.select(F.col("ssm_id").alias("derivedobject_id")), "derivedobject_id", "left_semi")
    sums = h.agg(*class_counts())
    return sums.select("avail", "found", "clean", F.when(F.col("avail") > 0, F.col("clean") / F.col("avail")).alias("efficiency"), F.when(F.col("found") > 0, F.col("clean") / F.col("found")).alias("accuracy"))


def iod_efficiency(history: DataFrame) -> DataFrame:
    """Share of clean and unfound derivations with an initial orbit."""
    h = history.filter((F.col("event_type") == "D") & F.col("classification").isin(EFF_CLEAN, EFF_UNFOUND))
    return h.agg(F.count("*").alias("n"), count_if(F.col("orbit_code").isin("I", "D")).alias("with_orbit")).withColumn("efficiency", F.when(F.col("n") > 0, F.col("with_orbit") / F.col("n")))


def histogram(df: DataFrame, column: str, bins: int, cap: float | None = None) -> DataFrame:
    """Counts per bin between minimum and maximum, empty bins with 0, with share and running count. Nulls are left out; values over ``cap`` count in its bin."""
    v = F.least(F.col(column), F.lit(float(cap))) if cap is not None else F.col(column)
    values = df.select(v.cast("double").alias("v")).filter("v is not null")
    low, high = values.agg(F.min("v"), F.max("v")).first()
    size = (high - low) / bins if low is not None else 0.0
    at = F.least(F.lit(bins - 1), F.floor((F.col("v") - low) / size)) if size else F.lit(0)
    counts = values.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins if low is not None else 0).select(F.col("id").cast("int").alias("bin"))
    filled = every.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    w = W.orderBy("bin")
    return filled.select("bin", (F.lit(low) + F.col("bin") * size).alias("start"), "n", F.sum("n").over(w).alias("cumulative"), (F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1)))).alias("share"))


def mean_std(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"))


def efficiency_bins(compared: DataFrame, width: float, radius: float) -> DataFrame:
    """Per magnitude bin: known detections and those found within the radius (``distance`` null: not found)."""
    return compared.groupBy(F.floor(F.col("mag") / width).cast("bigint").alias("bin")).agg(F.count("*").alias("known"), count_if(F.coalesce(F.col("distance") <= radius, F.lit(False))).alias("found"))


def efficiency_curve(bins: DataFrame, width: float) -> DataFrame:
    """Share found per bin start, where any are known."""
    return bins.filter("known > 0").select((F.col("bin") * width).alias("mag_start"), (F.col("found") / F.col("known")).alias("efficiency"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def added(rows: Column, term: Callable[[Column], Column]) -> Column:
    return F.aggregate(rows, F.lit(0.0), lambda total, r: total + term(r))


def logistic(m: Column, limit: Column, width: Column) -> Column:
    return 1 / (1 + F.exp(F.greatest(F.lit(-50.0), F.least(F.lit(50.0), (m - limit) / width))))


def fit_efficiency(curves: DataFrame, by: list[str], least: int = 4, steps: int = 200) -> DataFrame:
    """Fit eff0 / (1 + exp((m - L) / w)) to (mag_start, efficiency) of each group; groups under ``least`` bins are left out.

    Gauss-Newton with damping from the half-efficiency magnitude, for all groups at once: a group is an array of its few dozen bins, a step sums the nine moments of its derivatives and solves
    three equations, and the steps are a fold over the state. eff0 stays in (0, 1], w in [0.01, 5].
    """
    bins = curves.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col("mag_start").cast("double").alias("m"), F.col("efficiency").cast("double").alias("y")))).alias("p")).filter(F.size("p") >= least)
    cost = lambda e, limit, width: added(F.col("p"), lambda r: F.pow(r["y"] - e * logistic(r["m"], limit, width), 2))
    top = F.greatest(F.array_max(F.transform("p", lambda r: r["y"])), F.lit(1e-3))
    half = F.array_min(F.transform("p", lambda r: F.struct(F.abs(r["y"] - F.array_max(F.transform("p", lambda q: q["y"])) / 2).alias("d"), r["m"].alias("m"))))["m"]
    start = bins.withColumns({"top": top, "half": half}).withColumn("start", F.struct(F.col("top").alias("e"), F.col("half").alias("l"), F.lit(0.3).alias("w"), cost(F.col("top"), F.col("half"), F.lit(0.3)).alias("cost"), F.lit(1e-2).alias("damping"), F.lit(False).alias("done")))

    def derivatives(r: Column, x: Column) -> Column:
        return let(logistic(r["m"], x["l"], x["w"]), lambda s: F.struct(s.alias("a"), (x["e"] * s * (1 - s) / x["w"]).alias("b"), (x["e"] * s * (1 - s) * (r["m"] - x["l"]) / (x["w"] * x["w"])).alias("c"), (r["y"] - x["e"] * s).alias("r")))

    def solved(h: Column, x: Column) -> Column:
        """The step by Cramer's rule; eff0 or w stays where it is at a bound that it would cross."""
        aa, bb, cc = (h[k] + x["damping"] * (h[k] + 1e-12) for k in ("aa", "bb", "cc"))
        held_e = ((x["e"] >= 1) & (h["ar"] > 0)) | ((x["e"] <= 1e-6) & (h["ar"] < 0))
        held_w = ((x["w"] >= 5) & (h["cr"] > 0)) | ((x["w"] <= 0.01) & (h["cr"] < 0))
        free = lambda k, *held: F.when(reduce(or_, held), 0.0).otherwise(h[k])
        ab, ac, bc, u, v, w = free("ab", held_e), free("ac", held_e, held_w), free("bc", held_w), free("ar", held_e), h["br"], free("cr", held_w)
        det = aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac)
        one = u * (bb * cc - bc * bc) - ab * (v * cc - bc * w) + ac * (v * bc - bb * w)
        two = aa * (v * cc - bc * w) - u * (ab * cc - bc * ac) + ac * (ab * w - v * ac)
        three = aa * (bb * w - v * bc) - ab * (ab * w - v * ac) + u * (ab * bc - bb * ac)
        return let(det, lambda d: F.struct(*[F.coalesce(F.try_divide(x, d), F.lit(0.0)).alias(n) for x, n in ((one, "a"), (two, "b"), (three, "c"))]))

    def step(x: Column, _: Column) -> Column:
        moments = let(F.transform("p", lambda r: derivatives(r, x)), lambda rows: F.struct(*[added(rows, lambda r, k=k: r[k[0]] * r[k[1]]).alias(k) for k in ("aa", "ab", "ac", "bb", "bc", "cc", "ar", "br", "cr")]))
        bounded = lambda d: F.struct(F.greatest(F.lit(1e-6), F.least(F.lit(1.0), x["e"] + d["a"])).alias("e"), (x["l"] + d["b"]).alias("l"), F.greatest(F.lit(0.01), F.least(F.lit(5.0), x["w"] + d["c"])).alias("w"))
        tried = let(let(moments, lambda h: solved(h, x)), bounded)
        costed = let(tried, lambda n: F.struct(n["e"].alias("e"), n["l"].alias("l"), n["w"].alias("w"), cost(n["e"], n["l"], n["w"]).alias("cost")))
        taken = lambda n: F.struct(n["e"].alias("e"), n["l"].alias("l"), n["w"].alias("w"), n["cost"].alias("cost"), (x["damping"] / 3).alias("damping"), (x["cost"] - n["cost"] < 1e-14).alias("done"))
        stays = F.struct(x["e"].alias("e"), x["l"].alias("l"), x["w"].alias("w"), x["cost"].alias("cost"), (x["damping"] * 4).alias("damping"), (x["damping"] * 4 > 1e12).alias("done"))
        return F.when(x["done"], x).otherwise(let(costed, lambda n: F.when(n["cost"] < x["cost"], taken(n)).otherwise(stays)))

    fitted = start.withColumn("fit", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("start"), step))
    return fitted.select(*by, F.col("fit.e").alias("eff0"), F.col("fit.l").alias("limit"), F.col("fit.w").alias("width"))


def discoveries_by_lunation(submissions: DataFrame, groups: list[str]) -> DataFrame:
    """Per lunation, one column per survey group: designations first submitted in it."""
    from ..functions.timefn import lunation

    first = submissions.filter("is_discovery = 1").groupBy("desig").agg(F.min(F.struct("nn", "survey_group")).alias("f"))
    return first.select(lunation(F.col("f.nn").cast("double")).alias("ocnum"), F.col("f.survey_group").alias("g")).groupBy("ocnum").pivot("g", groups).agg(F.count(F.lit(1))).na.fill(0, groups)


def snr_magnitude_sample(detections: DataFrame, attrib: DataFrame, tracklets: DataFrame, fields: DataFrame, classification: str, nn: int) -> DataFrame:
    """(mag, s2n) of detections in tracklets of a class, in one night, with the filter."""
    t = tracklets.filter(F.col("classification") == classification).select("tracklet_id")
    f = fields.filter(F.col("nn") == nn).select("field_id", F.col("filter_id").alias("filter"))
    return detections.select("det_id", "field_id", "mag", "s2n").join(attrib, "det_id").join(t, "tracklet_id", "left_semi").join(f, "field_id").select("det_id", "mag", "s2n", "filter")


def recoverable_by_lunation(detections: DataFrame, fields: DataFrame) -> DataFrame:
    """Per lunation and family: objects seen on at least 1, 2, 3 nights, those new in it, and the running number of new ones."""
    seen = detections.filter("object_name is not null").join(fields.select("field_id", "ocnum"), "field_id").groupBy("object_name", "ocnum").agg(F.count_distinct("nn").alias("nights"))
    first = W.partitionBy("object_name").orderBy("ocnum")
    seen = seen.withColumn("new", (F.row_number().over(first) == 1).cast("int")).withColumn("family", F.substring("object_name", 1, 2))
    by = seen.groupBy("ocnum", "family").agg(F.count("*").alias("on1"), count_if(F.col("nights") >= 2).alias("on2"), count_if(F.col("nights") >= 3).alias("on3"), F.sum("new").alias("new"))
    return by.withColumn("cumulative", F.sum("new").over(W.partitionBy("family").orderBy("ocnum")))


def s2n_scale_factor(detections: DataFrame, fields: DataFrame, predicted: Column) -> DataFrame:
    """Per field: mean of observed over predicted S/N of found sources; 1 where there are none."""
    scale = detections.filter("status = 'F'").groupBy("field_id").agg(F.avg(F.col("s2n") / predicted).alias("scale"))
    return fields.select("field_id").join(scale, "field_id", "left").select("field_id", F.coalesce("scale", F.lit(1.0)).alias("scale"))


def classify_groups(df: DataFrame, key: str, name: str = "object_name", also: dict[str, Column] | None = None) -> DataFrame:
    """Class of each group of detections by their names: clean, mixed, bad or nonsynthetic; with the clean name, and with the aggregates ``also``.

    Whether there is one name or more is told by the least and the greatest, so rows pass one aggregate and no name is held apart.
    """
    synthetic = F.coalesce(F.col(name).startswith("S"), F.lit(False))
    own, also = F.when(synthetic, F.col(name)), also or {}
    counts = df.groupBy(key).agg(F.min(own).alias("first"), F.max(own).alias("last"), count_if(~synthetic).alias("n"), *[c.alias(k) for k, c in also.items()])
    code = F.when(F.col("first").isNull(), EFF_NONSYNTHETIC).when((F.col("first") == F.col("last")) & (F.col("n") == 0), EFF_CLEAN).when(F.col("n") == 0, EFF_MIXED).otherwise(EFF_BAD)
    return counts.select(key, code.alias("classification"), F.when(code == EFF_CLEAN, F.col("first")).alias("clean_name"), *also)


def arc_length(dets_of_objects: DataFrame, key: str) -> DataFrame:
    return dets_of_objects.groupBy(key).agg((F.max("epoch_mjd") - F.min("epoch_mjd")).alias("arc_days"), F.count("*").alias("n"))


def stable_objects(uncertainties: DataFrame, key: str, limit: float) -> DataFrame:
    """Objects whose predicted uncertainty stays under a limit at all times."""
    return uncertainties.groupBy(key).agg(F.max("uncertainty").alias("worst")).filter(F.col("worst") < limit)


def visible_tracklets(tracklets: DataFrame, attrib: DataFrame, detections: DataFrame, nights: list[int], limit: float) -> DataFrame:
    """Tracklets of some nights all of whose detections are brighter than a limit."""
    t = tracklets.filter(F.col("nn").isin(nights)).select("tracklet_id", "pk")
    return t.join(attrib, "tracklet_id").join(detections.select("det_id", "mag"), "det_id").groupBy("tracklet_id").agg(F.max("mag").alias("faintest")).filter(F.col("faintest") < limit)


def coverage_report(fields: DataFrame, least: int) -> DataFrame:
    """Per tuple of exposures with at least so many: first centre, exposures, deepest limiting magnitude."""
    by = fields.groupBy("nn", F.coalesce("parent_id", "field_id").alias("tuple_id")).agg(
        F.min_by("ra_deg", "epoch_mjd").alias("ra_deg"), F.min_by("dec_deg", "epoch_mjd").alias("dec_deg"), F.count("*").alias("exposures"), F.max("limiting_mag").alias("limiting_mag")
    )
    return by.filter(F.col("exposures") >= least)


def timing_summary(logs: DataFrame, line: str = "line") -> DataFrame:
    """Seconds per section and subsection of ``TIMING section/subsection seconds nn`` lines, with totals and percentages."""
    pattern = r"TIMING ([^/\s]+)(?:/(\S+))? ([0-9.]+) "
    parsed = logs.filter(F.col(line).rlike(pattern)).select(F.regexp_extract(line, pattern, 1).alias("section"), F.regexp_extract(line, pattern, 2).alias("part"), F.regexp_extract(line, pattern, 3).cast("double").alias("seconds"))
    summed = parsed.rollup("section", "part").agg(F.sum("seconds").alias("seconds"), F.grouping_id().cast("int").alias("level"))
    total = F.max(F.when(F.col("level") == 3, F.col("seconds"))).over(W.partitionBy(F.lit(1)))
    return summed.withColumn("percent", 100 * F.col("seconds") / total)


def sky_density(df: DataFrame, cell: float) -> DataFrame:
    return df.groupBy(F.floor(F.col("ra_deg") / cell).cast("bigint").alias("ra_cell"), F.floor(F.col("dec_deg") / cell).cast("bigint").alias("dec_cell")).agg(F.count("*").alias("n"))


def link_summary(links: DataFrame, available: DataFrame) -> DataFrame:
    """Tracks on more than two nights by class with percentages, and available objects that no clean track found."""
    tracks = classify_groups(links.filter(F.col("track_id").isNotNull()), "track_id", also={"nights": F.count_distinct("nn")}).filter("nights > 2")
    missed = available.join(tracks.filter("classification = 'C'").select(F.col("clean_name").alias("object_name")), "object_name", "left_anti").agg(F.count("*").alias("missed"))
    total = tracks.agg(F.count("*").alias("tracks"), count_if(is_(EFF_CLEAN)).alias("clean"), count_if(is_(EFF_MIXED)).alias("mixed"))
    return total.join(F.broadcast(missed)).withColumn("clean_percent", F.when(F.col("tracks") > 0, 100 * F.col("clean") / F.col("tracks")))


def linking_ledger(available: DataFrame, links: DataFrame, initial: DataFrame, final: DataFrame) -> DataFrame:
    """How far each available object came: unlinked, linked, initial orbit or final orbit."""
    mark = lambda df, c: df.select("object_name").distinct().withColumn(c, F.lit(True))
    j = available.select("object_name").distinct().join(mark(links, "l"), "object_name", "left").join(mark(initial, "i"), "object_name", "left").join(mark(final, "f"), "object_name", "left")
    return j.select("object_name", F.when(F.col("f"), "final").when(F.col("i"), "initial").when(F.col("l"), "linked").otherwise("unlinked").alias("stage"))


def efficiency_report(by_night: DataFrame, key: str = "nn") -> DataFrame:
    """A report by night with a totals row (null key) and percentages."""
    sums = [F.sum(c).alias(c) for c in ("avail", "found", "clean", "mixed", "bad", "nonsynthetic")]
    return by_night.rollup(key).agg(*sums).withColumn("percent", F.when(F.col("avail") > 0, 100 * F.col("clean") / F.col("avail")))
