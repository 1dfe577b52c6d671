"""Same-night tracklets: pairing, grouping, quality, probabilities."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.photometry import to_v
from ..functions.sky import angle_diff, bearing, separation
from .efficiency import count_if
from .graph import cut_lineage
from .skyjoin import LEAST_PACKED, cell_size, leveled_sky_join, packed, shuffled, sky_join, spans, with_cell, with_cells_in_reach


def pair_detections(dets: DataFrame, min_speed: float, max_speed: float, thresh: float, max_days: float, stack: str = "stack_id", trail: bool = False, trail_error: float = 0.0, exposure_days: float = 30 / 86400.0) -> DataFrame:
    """(stack, a, b, dt, va, vd): pairs whose later detection lies where the earlier one could have moved.

    Distance must be within [min_speed * dt - thresh, max_speed * dt + thresh] degrees, ``dt`` at most ``max_days``. With ``trail`` a
    trail longer than ``max_speed`` allows (column length_deg) narrows the speeds to its own. The join is on sky cells inside a stack of exposures; with trails each
    detection is joined on cells of its own reach, so a long trail widens no other's.
    """
    cols = ["epoch_mjd", "ra_deg", "dec_deg"] + (["length_deg"] if trail else [])
    a = dets.select(stack, F.col("det_id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in cols])
    b = dets.select(stack, F.col("det_id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in ("epoch_mjd", "ra_deg", "dec_deg")])
    reach = max_speed * max_days + thresh
    if trail:
        fast = F.col("a_length_deg") / exposure_days > max_speed
        a = a.withColumn("_reach", F.when(fast, (F.col("a_length_deg") + trail_error) / exposure_days * max_days + thresh).otherwise(reach))
        near = leveled_sky_join(b, a, "_reach", ("b_ra_deg", "b_dec_deg"), ("a_ra_deg", "a_dec_deg"), (stack,))
    else:
        near = sky_join(b, a, reach, ("b_ra_deg", "b_dec_deg"), ("a_ra_deg", "a_dec_deg"), (stack,))
    dt = F.col("b_epoch_mjd") - F.col("a_epoch_mjd")
    low, high = F.lit(float(min_speed)), F.lit(float(max_speed))
    if trail:
        speed = F.col("a_length_deg") / exposure_days
        low = F.when(speed > max_speed, F.greatest(F.lit(0.0), (F.col("a_length_deg") - trail_error) / exposure_days)).otherwise(low)
        high = F.when(speed > max_speed, (F.col("a_length_deg") + trail_error) / exposure_days).otherwise(high)
    ok = (dt > 1e-5) & (dt <= max_days) & (F.col("distance") >= low * dt - thresh) & (F.col("distance") <= high * dt + thresh)
    speed = lambda x: F.try_divide(x, dt)
    return near.filter(ok).select(stack, "a", "b", dt.alias("dt"), speed(angle_diff(F.col("b_ra_deg"), F.col("a_ra_deg"))).alias("va"), speed(F.col("b_dec_deg") - F.col("a_dec_deg")).alias("vd"), "distance")


#: Partners of a start beyond which they are joined on cells of velocity too. A line has some ten rows on cells, each shuffled and sorted; that costs as much as to test several hundred partners in place.
MANY_PARTNERS = 512


def with_partners(lines: DataFrame, pairs: DataFrame, stack: str, tolerance: Column, stretch: float, va: str, vd: str) -> DataFrame:
    """``lines`` (stack, a and a velocity in ``va`` and ``vd``) with the pairs of the same start whose velocity lies within ``tolerance``, an expression of the pair's ``dt``, and perhaps others.

    Starts of few partners meet them all. Those of many meet them on cells of velocity, which come in levels of twice the width: a pair has a cell at the level of its own tolerance, a
    line those in reach at each level there is. ``stretch`` is how much further ``va`` may be off; beyond 4 it is left out of the key.
    """
    busy = pairs.groupBy(stack, "a").agg(F.count("*").alias("_n")).filter(F.col("_n") > MANY_PARTNERS).select(stack, "a")
    few = lines.join(busy, [stack, "a"], "left_anti").join(pairs, [stack, "a"])
    many = pairs.join(busy, [stack, "a"], "left_semi").withColumn("_level", F.ceil(F.log2(tolerance)).cast("int"))
    levels = sorted(r["_level"] for r in many.select("_level").distinct().collect())  # powers of two between max_days and the shortest gap of time
    if not levels:
        return few
    half = F.pow(F.lit(2.0), F.col("_level")) * (1 + 1e-6)
    size = 2 * stretch * half
    cells = {"_cd": F.floor(F.col("vd") / size).cast("bigint"), "_ca": F.floor(F.col("va") / size).cast("bigint") if stretch <= 4 else F.lit(0).cast("bigint")}
    wide = lines.join(busy, [stack, "a"], "left_semi").withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels])))
    wide = wide.withColumn("_cd", F.explode(spans(F.col(vd), half, size)))
    wide = wide.withColumn("_ca", F.explode(spans(F.col(va), stretch * half, size))) if stretch <= 4 else wide.withColumn("_ca", F.lit(0).cast("bigint"))
    return few.unionByName(wide.join(shuffled(many.withColumns(cells)), [stack, "a", "_level", "_cd", "_ca"]).select(*few.columns))


#: Width of the cells of starts in reaches: a detection goes to some three of them.
START_REACHES = 4

#: Detections of a cell for each partner of a start there: a reach covers a fifth of a cell, and half of what is there is earlier.
CELL_PARTNERS = 8


def with_place(dets: DataFrame, reach: float, stack: str) -> tuple[DataFrame, float]:
    """``dets`` with the sky cell ``cell`` they lie in, and the size of cells."""
    size = max(START_REACHES * reach, LEAST_PACKED)
    placed = packed(with_cell(dets.select(stack, "det_id", "epoch_mjd", "ra_deg", "dec_deg").filter(F.col(stack).isNotNull()), "ra_deg", "dec_deg", size), size)
    return placed.withColumnRenamed("_cell", "cell").filter("cell is not null"), size


def is_crowded(placed: DataFrame, stack: str) -> bool:
    """Whether some cell of a stack has more than ``CELL_PARTNERS`` times ``MANY_PARTNERS`` detections: then partners are joined on cells of velocity too, which shuffles pairs."""
    return (placed.groupBy(stack, "cell").agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0) > CELL_PARTNERS * MANY_PARTNERS


def by_cell(df: DataFrame, stack: str) -> DataFrame:
    """``df`` dealt over many tasks by stack and cell, whatever is to meet alike."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism), stack, "_cell")


def starts_with_partners(placed: DataFrame, size: float, reach: float, min_speed: float, max_speed: float, thresh: float, max_days: float, stack: str, merge: bool) -> DataFrame:
    """(stack, _cell, a, copies, partners): each start with an array of the pairs (b, cell, dt, va, vd) that :func:`pair_detections` finds for it, ``cell`` being that of b.

    Detections travel to the cells of starts, once for each cell in reach, and everything that follows by start stays where it is: pairs are neither shuffled nor written. With ``merge`` those that share
    time and place are one, by their smallest id, and ``copies`` has all ids.
    """
    there = by_cell(packed(with_cells_in_reach(placed, "ra_deg", "dec_deg", reach, size), size), stack)
    if merge:
        there = there.groupBy(stack, "_cell", "cell", "epoch_mjd", "ra_deg", "dec_deg").agg(F.min("det_id").alias("det_id"), F.collect_list("det_id").alias("copies"))
    else:
        there = there.withColumn("copies", F.array("det_id"))
    names = ("det_id", "epoch_mjd", "ra_deg", "dec_deg", "cell")
    side = lambda x: [F.col(f"{x}.{c}").alias(f"{x}_{c}") for c in names]
    each = there.groupBy(stack, "_cell").agg(F.collect_list(F.struct(*names, "copies")).alias("_all")).select(stack, "_cell", "_all", F.explode("_all").alias("a")).filter("a.cell = _cell")
    near = each.select(stack, "_cell", *side("a"), F.col("a.copies").alias("copies"), F.explode("_all").alias("b")).select(stack, "_cell", *[f"a_{c}" for c in names], "copies", *side("b"))
    near = near.withColumn("dt", F.col("b_epoch_mjd") - F.col("a_epoch_mjd")).filter((F.col("dt") > 1e-5) & (F.col("dt") <= max_days))
    near = near.withColumn("distance", separation(F.col("b_ra_deg"), F.col("b_dec_deg"), F.col("a_ra_deg"), F.col("a_dec_deg")))
    ok = (F.col("distance") >= min_speed * F.col("dt") - thresh) & (F.col("distance") <= max_speed * F.col("dt") + thresh)
    va, vd = F.try_divide(angle_diff(F.col("b_ra_deg"), F.col("a_ra_deg")), "dt"), F.try_divide(F.col("b_dec_deg") - F.col("a_dec_deg"), "dt")
    pair = F.struct(F.col("b_det_id").alias("b"), F.col("b_cell").alias("cell"), "dt", va.alias("va"), vd.alias("vd"))
    return near.filter(ok).groupBy(stack, "_cell", F.col("a_det_id").alias("a")).agg(F.first("copies").alias("copies"), F.collect_list(pair).alias("partners"))


def largest_of_starts(paths: DataFrame, stack: str) -> DataFrame:
    """(tracklet_key, stack, det_ids, n) of starts' ``paths`` (stack, _cell, a, copies, paths): arrays of (b, cell) in time order, a set for each start. Groups inside another one of the stack go.

    What holds a group begins with its start or has its start among its later members. The first is settled by start; for the second, groups of three or more send what follows each member to that
    member's cell, where the groups that begin with it are. Other ids at a start's place (``copies``) have its groups too, but are no one's later member.
    """
    inside = lambda x, y: F.size(F.array_except(x, y)) == 0
    kept = paths.withColumn("_large", F.filter("paths", lambda x: F.size(x) > 1)).withColumn("_in_large", F.array_distinct(F.flatten("_large")))
    free = F.filter("paths", lambda x: F.when(F.size(x) == 1, ~F.array_contains("_in_large", x[0])).otherwise(~F.exists("_large", lambda y: (F.size(y) > F.size(x)) & inside(x, y))))
    kept = kept.select(stack, "_cell", "a", "copies", free.alias("paths"))
    tails = kept.select(stack, F.explode(F.filter("paths", lambda x: F.size(x) > 1)).alias("p")).select(stack, F.posexplode("p").alias("k", "m"), "p").filter(F.col("k") < F.size("p") - 1)
    tails = tails.select(stack, F.col("m.cell").alias("_cell"), F.col("m.b").alias("a"), F.expr("slice(p, k + 2, size(p))").alias("tail"))
    tails = by_cell(tails, stack).groupBy(stack, "_cell").agg(F.collect_set(F.struct("a", "tail")).alias("_tails"))
    kept = kept.join(shuffled(tails), [stack, "_cell"], "left").withColumn("_tails", F.transform(F.filter("_tails", lambda t: t["a"] == F.col("a")), lambda t: t["tail"]))
    own = F.when(F.size("_tails") > 0, F.filter("paths", lambda x: ~F.exists("_tails", lambda t: inside(x, t)))).otherwise(F.col("paths"))
    each = kept.select(stack, "a", "paths", own.alias("own"), F.explode("copies").alias("id")).select(stack, "id", F.explode(F.when(F.col("id") == F.col("a"), F.col("own")).otherwise(F.col("paths"))).alias("p"))
    groups = each.select(stack, F.array_sort(F.concat(F.array("id"), F.col("p.b"))).alias("det_ids"))
    return groups.withColumn("n", F.size("det_ids")).withColumn("tracklet_key", F.xxhash64("det_ids"))


def find_tracklets(dets: DataFrame, min_speed: float, max_speed: float, thresh: float, max_days: float, min_obs: int = 2, max_obs: int = 1000, greedy: bool = False, stack: str = "stack_id") -> DataFrame:
    """(tracklet_key, stack, det_ids, n): velocity-compatible groups per start detection, without subsets.

    For each start and end, the detections between them whose velocities from the start agree with the end's, one per time, nearest in
    velocity. Groups equal to or inside another one of the same start go; so do groups inside any other group of the stack. Starts with many partners meet them on cells
    of velocity (:func:`with_partners`); where no cell is crowded, starts meet their partners in place (:func:`starts_with_partners`).

    Detections that share time and place are one, by their smallest id, until groups are given for each start there: of equally near ones the smallest id counts.
    """
    reach = cell_size(max_speed * max_days + thresh)
    placed, size = with_place(dets, reach, stack)
    if not is_crowded(placed, stack):
        starts = starts_with_partners(placed, size, reach, min_speed, max_speed, thresh, max_days, stack, merge=True)
        ends = starts.select(stack, "_cell", "a", "copies", "partners", F.explode("partners").alias("e"))
        both = ends.select(stack, "_cell", "a", "copies", F.col("e.b").alias("end"), F.col("e.dt").alias("e_dt"), F.col("e.va").alias("e_va"), F.col("e.vd").alias("e_vd"), F.explode("partners").alias("s"))
        both = both.select(stack, "_cell", "a", "copies", "end", "e_dt", "e_va", "e_vd", "s.*").filter(F.col("dt") <= F.col("e_dt") + 1e-10)
        dist = F.pow((F.col("e_va") - F.col("va")) * F.cos(F.radians("e_vd")), 2) + F.pow(F.col("e_vd") - F.col("vd"), 2)
        fits = both.withColumn("_d", dist).filter(F.col("_d") <= F.pow(F.try_divide(F.lit(thresh), "e_dt"), 2) + F.pow(F.try_divide(F.lit(thresh), "dt"), 2))
        nearest = fits.groupBy(stack, "_cell", "a", "end", F.round("dt", 9).alias("_t")).agg(F.min(F.struct("_d", "b", "cell")).alias("m"), F.first("copies").alias("copies"))
        groups = nearest.groupBy(stack, "_cell", "a", "end").agg(F.first("copies").alias("copies"), F.array_sort(F.collect_list(F.struct("_t", "m.b", "m.cell"))).alias("p"))
        groups = groups.withColumn("p", F.transform("p", lambda x: F.struct(x["b"].alias("b"), x["cell"].alias("cell")))).filter((F.size("p") + 1).between(min_obs, max_obs))
        paths = groups.groupBy(stack, "_cell", "a").agg(F.first("copies").alias("copies"), F.collect_set("p").alias("paths"))
        if greedy:
            longest = F.array_max(F.transform("paths", F.size))
            paths = paths.withColumn("_m", longest).withColumn("paths", F.filter("paths", lambda x: F.size(x) == F.col("_m"))).drop("_m")
        return largest_of_starts(paths, stack)
    pairs = cut_lineage(pair_detections(dets, min_speed, max_speed, thresh, max_days, stack).select(stack, "a", "b", "dt", "va", "vd"))
    end = pairs.select(stack, "a", F.col("b").alias("end"), F.col("dt").alias("e_dt"), F.col("va").alias("e_va"), F.col("vd").alias("e_vd"))
    steepest = max_speed + thresh / 1e-5  # what a pair's vd can reach: distances are measured with an error, over 1e-5 days at least
    stretch = 1 / max(1e-3, math.cos(math.radians(min(steepest, 89.9))))
    both = with_partners(end, pairs, stack, math.sqrt(2) * thresh / F.col("dt"), stretch, "e_va", "e_vd").filter(F.col("dt") <= F.col("e_dt") + 1e-10)
    dist = F.pow((F.col("e_va") - F.col("va")) * F.cos(F.radians("e_vd")), 2) + F.pow(F.col("e_vd") - F.col("vd"), 2)
    fits = both.withColumn("_d", dist).filter(F.col("_d") <= F.pow(F.try_divide(F.lit(thresh), "e_dt"), 2) + F.pow(F.try_divide(F.lit(thresh), "dt"), 2))
    nearest = fits.groupBy(stack, "a", "end", F.round("dt", 9).alias("_t")).agg(F.min(F.struct("_d", "b")).alias("m"))
    groups = nearest.groupBy(stack, "a", "end").agg(F.array_sort(F.concat(F.array("a"), F.collect_list("m.b"))).alias("det_ids"))
    groups = groups.withColumn("n", F.size("det_ids")).filter(F.col("n").between(min_obs, max_obs))
    if greedy:
        longest = groups.groupBy(stack, "a").agg(F.max("n").alias("_m"))
        groups = groups.join(longest, [stack, "a"]).filter("n = _m")
    unique = groups.select(stack, "det_ids", "n").dropDuplicates([stack, "det_ids"]).withColumn("tracklet_key", F.xxhash64("det_ids"))
    return drop_subsets(cut_lineage(unique), "tracklet_key", "det_ids")


def grow_tracklets(dets: DataFrame, min_speed: float, max_speed: float, thresh: float, max_days: float, min_obs: int = 2, steps: int = 8, stack: str = "stack_id", greedy: bool = False) -> DataFrame:
    """(tracklet_key, stack, det_ids, n): pairs extended by one later detection a step while they stay on a line.

    A group is a line of least squares kept as sums, so each step is one join and one test of the mean residual; at most
    ``steps`` detections after the first. Only groups that can't grow and lie in no other stay.

    Each extension is a hypothesis of its own, so n detections on a line give all their subsets of up to ``steps`` + 1: right for stacks of a few exposures. With ``greedy`` only pairs branch; a group of
    three or more goes on as the one that takes the earliest later detection that fits (ties: the smaller id), so there are no more groups than triples however many detections share a place.

    Where no cell is crowded, all steps of a start are taken in place (:func:`starts_with_partners`): at each a line stays as it is, or grows by one of the start's partners.
    """
    reach = cell_size(max_speed * max_days + thresh)
    placed, size = with_place(dets, reach, stack)
    if not is_crowded(placed, stack):
        starts = starts_with_partners(placed, size, reach, min_speed, max_speed, thresh, max_days, stack, merge=False)
        pair = F.struct(F.col("e.b").alias("b"), F.col("e.cell").alias("cell"))
        lines = starts.select(stack, "_cell", "a", "copies", "partners", F.explode("partners").alias("e"))
        lines = lines.select(stack, "_cell", "a", "copies", "partners", F.array(pair).alias("p"), F.col("e.va").alias("l_va"), F.col("e.vd").alias("l_vd"), F.col("e.dt").alias("l_dt"), F.lit(True).alias("live"))

        def fits(x: Column) -> Column:
            miss = F.sqrt(F.pow((x["va"] - F.col("l_va")) * x["dt"], 2) + F.pow((x["vd"] - F.col("l_vd")) * x["dt"], 2))
            return (x["dt"] > F.col("l_dt") + 1e-5) & (miss / 2 < thresh)

        grown = F.col("x").isNotNull()
        turn = lambda name: F.when(grown, (F.col(f"l_{name}") + F.col(f"x.{name}")) / 2).otherwise(F.col(f"l_{name}")).alias(f"l_{name}")
        for k in range(steps - 1):
            if greedy and k:
                first = F.array_min(F.transform(F.filter("partners", fits), lambda x: F.struct(x["dt"], x["b"], x["va"], x["vd"], x["cell"])))
                lines = lines.withColumn("x", F.when(F.col("live"), first))
            else:
                stay = F.array(F.lit(None).cast(dict(starts.dtypes)["partners"][6:-1]))
                lines = lines.withColumn("x", F.explode(F.when(F.col("live"), F.concat(stay, "partners")).otherwise(stay))).filter(F.col("x").isNull() | fits(F.col("x")))
            longer = F.when(grown, F.concat("p", F.array(F.struct(F.col("x.b").alias("b"), F.col("x.cell").alias("cell"))))).otherwise(F.col("p"))
            lines = lines.select(stack, "_cell", "a", "copies", "partners", longer.alias("p"), turn("va"), turn("vd"), F.coalesce("x.dt", "l_dt").alias("l_dt"), grown.alias("live"))
        paths = lines.groupBy(stack, "_cell", "a").agg(F.first("copies").alias("copies"), F.collect_set("p").alias("paths"))
        return largest_of_starts(paths, stack).filter(F.col("n") >= min_obs)
    pairs = cut_lineage(pair_detections(dets, min_speed, max_speed, thresh, max_days, stack).select(stack, "a", "b", "dt", "va", "vd"))
    level = pairs.select(stack, F.array("a", "b").alias("det_ids"), "a", F.col("va").alias("l_va"), F.col("vd").alias("l_vd"), F.col("dt").alias("l_dt"))
    found = level.select(stack, "det_ids")
    off = F.sqrt(F.pow((F.col("va") - F.col("l_va")) * F.col("dt"), 2) + F.pow((F.col("vd") - F.col("l_vd")) * F.col("dt"), 2))
    state = lambda: [F.concat("det_ids", F.array("b")).alias("det_ids"), "a", ((F.col("l_va") + F.col("va")) / 2).alias("l_va"), ((F.col("l_vd") + F.col("vd")) / 2).alias("l_vd"), F.col("dt").alias("l_dt")]
    for k in range(steps - 1):
        near = with_partners(level, pairs, stack, 2 * thresh / F.col("dt"), 1.0, "l_va", "l_vd")
        grown = near.filter((F.col("dt") > F.col("l_dt") + 1e-5) & (off / 2 < thresh))
        if greedy and k:
            grown = grown.groupBy(stack, "det_ids").agg(F.min(F.struct("dt", "b", "va", "vd", "a", "l_va", "l_vd")).alias("m")).select(stack, "det_ids", "m.*")
            next_level = cut_lineage(grown.select(stack, F.col("det_ids").alias("was"), *state()))
            found = found.unionByName(level.join(next_level.select(stack, F.col("was").alias("det_ids")), [stack, "det_ids"], "left_anti").select(stack, "det_ids"))
            level = next_level.drop("was")
        else:
            level = cut_lineage(grown.select(stack, *state()))
            if not greedy:
                found = found.unionByName(level.select(stack, "det_ids"))
        if level.isEmpty():
            break
    if greedy:
        found = found.unionByName(level.select(stack, "det_ids"))
    groups = found.withColumn("det_ids", F.array_sort("det_ids")).dropDuplicates([stack, "det_ids"]).withColumn("n", F.size("det_ids")).withColumn("tracklet_key", F.xxhash64("det_ids"))
    return drop_subsets(cut_lineage(groups), "tracklet_key", "det_ids").filter(F.col("n") >= min_obs)


def drop_subsets(groups: DataFrame, key: str, members: str) -> DataFrame:
    """Drop groups whose members all lie in a larger group, or in an equal one with a smaller key.

    Whatever holds a group holds its rarest member, so only that one is joined to the groups that have it; a member that
    many groups share is no one's rarest but where groups have no other.
    """
    g = groups.select(F.col(key).alias("k"), F.col(members).alias("all"), F.explode(members).alias("m"))
    users = g.groupBy("m").agg(F.count("*").alias("users"))
    rare = g.join(users, "m").groupBy("k").agg(F.min(F.struct("users", "m")).alias("r"), F.first("all").alias("all"))
    a = rare.select("k", "all", F.col("r.m").alias("m"))
    b = g.select(F.col("k").alias("ok"), F.col("all").alias("o_all"), "m")
    larger = (F.size("o_all") > F.size("all")) | ((F.size("o_all") == F.size("all")) & (F.col("ok") < F.col("k")))
    inside = a.join(b, "m").filter((F.col("k") != F.col("ok")) & larger & (F.size(F.array_except("all", "o_all")) == 0)).select(F.col("k").alias(key)).distinct()
    return groups.join(inside, key, "left_anti")


def evaluate_tracklets(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Found, true and exactly matching groups by their sets of detections (``det_ids`` sorted)."""
    f = found.select("det_ids").distinct().withColumn("f", F.lit(1))
    t = truth.select("det_ids").distinct().withColumn("t", F.lit(1))
    return f.join(t, "det_ids", "full_outer").agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n_found"), F.coalesce(F.sum("t"), F.lit(0)).alias("n_true"), F.coalesce(F.sum(F.col("f") * F.col("t")), F.lit(0)).alias("n_match"))


def union_passes(*passes: DataFrame, key: str = "tracklet_key") -> DataFrame:
    """The tracklets of several passes, each set of detections once (the first pass wins)."""
    out = None
    for k, p in enumerate(passes):
        p = p.withColumn("pass", F.lit(k))
        out = p if out is None else out.unionByName(p)
    first = out.groupBy(key).agg(F.min("pass").alias("pass"))
    return out.join(first, [key, "pass"], "left_semi")


def stack_pass_options(stacks: DataFrame, slow: float, fast: float, pair_speed: float, plane_deg: float) -> DataFrame:
    """Search options per stack (n_fields, galactic_lat): pairs and fields near the galactic plane get lower speeds; ``min_obs`` is all but one of more than 3."""
    speed = F.when(F.abs("galactic_lat") < plane_deg, F.least(F.lit(slow), F.lit(pair_speed))).when(F.col("n_fields") <= 2, pair_speed).otherwise(slow)
    return stacks.withColumns({"max_speed_slow": speed, "max_speed_fast": F.when(F.col("n_fields") > 2, fast).otherwise(pair_speed), "min_obs": F.when(F.col("n_fields") > 3, F.col("n_fields") - 1).otherwise(F.col("n_fields"))})


def summarize_tracklets(members: DataFrame, key: str = "tracklet_id") -> DataFrame:
    """Motion, central epoch and position, mean V magnitude and last field of each group of detections."""
    v = to_v(F.col("mag"), F.col("filter_id"))
    m = members.groupBy(key).agg(
        F.min(F.struct("epoch_mjd", "ra_deg", "dec_deg")).alias("a"), F.max(F.struct("epoch_mjd", "ra_deg", "dec_deg", "field_id")).alias("z"), F.avg(v).alias("v_mag"), F.count("*").alias("n_dets"), F.avg("epoch_mjd").alias("ext_epoch")
    )
    dt = F.col("z.epoch_mjd") - F.col("a.epoch_mjd")
    dra, ddec = angle_diff(F.col("z.ra_deg"), F.col("a.ra_deg")), F.col("z.dec_deg") - F.col("a.dec_deg")
    moved = separation(F.col("a.ra_deg"), F.col("a.dec_deg"), F.col("z.ra_deg"), F.col("z.dec_deg"))
    return m.select(
        key, "n_dets", "ext_epoch", "v_mag", F.col("z.field_id").alias("field_id"), F.when(dt > 0, dra / dt).alias("vel_ra"), F.when(dt > 0, ddec / dt).alias("vel_dec"), F.when(dt > 0, moved / dt).alias("vel_tot"),
        bearing(F.col("a.ra_deg"), F.col("a.dec_deg"), F.col("z.ra_deg"), F.col("z.dec_deg")).alias("pos_ang"), F.pmod(F.col("a.ra_deg") + dra / 2, F.lit(360.0)).alias("ext_ra"), (F.col("a.dec_deg") + ddec / 2).alias("ext_dec"),
    )


def gcr(members: DataFrame, key: str = "tracklet_id") -> DataFrame:
    """Root mean square distance (arcseconds) of each group's detections from motion along its best great circle; 0 for pairs.

    The circle's pole is the smallest principal axis of the unit vectors; along it motion is fitted linearly in time. All of it is sums over windows of one key. In a frame around the group's
    mean direction only the third axis is long, so the 3 x 3 problem is that of 2 x 2 moments less what the third axis takes of them, whose axes have a closed form; a few rounds settle the smallest
    value, which is tiny beside the third axis. Small differences are taken of angles, not of unit vectors, so nothing cancels.
    """
    w = W.partitionBy(key)
    ra, dec = F.radians("ra_deg"), F.radians("dec_deg")
    m = members.select(key, F.col("epoch_mjd").alias("t"), ra.alias("r"), dec.alias("d"))
    m = m.withColumns({"n": F.count("*").over(w), "mx": F.avg(F.cos("d") * F.cos("r")).over(w), "my": F.avg(F.cos("d") * F.sin("r")).over(w), "mz": F.avg(F.sin("d")).over(w), "tau": F.col("t") - F.avg("t").over(w)})
    m = m.withColumns({"r0": F.atan2("my", "mx"), "d0": F.atan2(F.col("mz"), F.hypot("mx", "my"))}).withColumn("dr", F.col("r") - F.col("r0"))
    m = m.select(
        key, "n", "tau", (F.cos("d") * F.sin("dr")).alias("u"), (F.sin(F.col("d") - F.col("d0")) + 2 * F.cos("d") * F.sin("d0") * F.pow(F.sin(F.col("dr") / 2), 2)).alias("v"),
        (F.cos(F.col("d") - F.col("d0")) - 2 * F.cos("d") * F.cos("d0") * F.pow(F.sin(F.col("dr") / 2), 2)).alias("w"),
    )
    m = m.withColumns({f"s{a}{b}": F.sum(F.col(a) * F.col(b)).over(w) for a, b in ("uu", "uv", "vv", "uw", "vw", "ww")}).withColumn("least", F.lit(0.0))
    for _ in range(3):
        rest = F.col("sww") - F.col("least")
        m = m.withColumns({"p": F.col("suu") - F.col("suw") * F.col("suw") / rest, "q": F.col("suv") - F.col("suw") * F.col("svw") / rest, "s": F.col("svv") - F.col("svw") * F.col("svw") / rest})
        m = m.withColumn("least", F.greatest(F.lit(0.0), (F.col("p") + F.col("s")) / 2 - F.hypot((F.col("p") - F.col("s")) / 2, F.col("q"))))
    axis = F.atan2(2 * F.col("q"), F.col("p") - F.col("s")) / 2
    m = m.withColumns({"a1": -F.sin(axis), "a2": F.cos(axis)}).withColumn("a3", -(F.col("suw") * F.col("a1") + F.col("svw") * F.col("a2")) / (F.col("sww") - F.col("least")))
    size = F.sqrt(1 + F.col("a3") * F.col("a3"))
    m = m.withColumns({"a1": F.col("a1") / size, "a2": F.col("a2") / size, "a3": F.col("a3") / size}).withColumn("off", F.col("u") * F.col("a1") + F.col("v") * F.col("a2") + F.col("w") * F.col("a3"))
    m = m.withColumn("along", F.atan2(F.col("u") * F.col("a2") - F.col("v") * F.col("a1"), F.col("w") - F.col("a3") * F.col("off")))
    m = m.withColumns({"mean": F.avg("along").over(w), "slope": F.coalesce(F.try_divide(F.sum(F.col("tau") * F.col("along")).over(w), F.sum(F.col("tau") * F.col("tau")).over(w)), F.lit(0.0))})
    left = F.pow(F.col("along") - F.col("mean") - F.col("slope") * F.col("tau"), 2) + F.pow(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("off")))), 2)
    return m.groupBy(key).agg(F.when(F.first("n") > 2, F.degrees(F.sqrt(F.avg(left))) * 3600).otherwise(0.0).alias("gcr_arcsec"))


def accept_tracklets(members: DataFrame, summary: DataFrame, most_spread: float, least_speed: float, most_speed: float, slow_gcr: float, fast_gcr: float, fast: float, key: str = "tracklet_id") -> DataFrame:
    """Tracklets within limits of magnitude spread per filter, speed, and great-circle residual (column gcr_arcsec)."""
    spread = members.groupBy(key, "filter_id").agg((F.max("mag") - F.min("mag")).alias("s")).groupBy(key).agg(F.max("s").alias("spread"))
    limit = F.when(F.col("vel_tot") > fast, fast_gcr).otherwise(slow_gcr)
    return summary.join(spread, key).filter((F.col("spread") <= most_spread) & F.col("vel_tot").between(least_speed, most_speed) & (F.col("gcr_arcsec") <= limit)).drop("spread")


def triage_stacks(tracklets: DataFrame, stack: str, most: int, tight_gcr: float) -> DataFrame:
    """Per stack: its tracklets, and what to do: abandon above 5 * ``most``, tighten above ``most``, else accept; with those left after it."""
    return tracklets.groupBy(stack).agg(F.count("*").alias("n"), count_if(F.col("gcr_arcsec") <= tight_gcr).alias("tight")).withColumn("action", F.when(F.col("n") > 5 * most, "abandon").when(F.col("n") > most, "tighten").otherwise("accept")).withColumn("kept", F.when(F.col("action") == "abandon", 0).when(F.col("action") == "tighten", F.col("tight")).otherwise(F.col("n"))).drop("tight")


def unfound_tracklets(dets: DataFrame, found: DataFrame, min_obs: int, stack: str = "stack_id") -> DataFrame:
    """Synthetic objects with enough detections in a stack and no clean tracklet there."""
    there = dets.filter(F.col("object_name").startswith("S")).groupBy(stack, "object_name").agg(F.count("*").alias("n_dets")).filter(F.col("n_dets") >= min_obs)
    return there.join(found.filter("classification = 'C'").select(stack, F.col("clean_name").alias("object_name")), [stack, "object_name"], "left_anti")


def score_tracklets(members: DataFrame, elongation: Column, key: str = "tracklet_id") -> DataFrame:
    """Quality scores of tracklets: faintest S/N, spread of magnitudes over their errors (reduced chi-square), alignment of trails
    with motion, and speed for the elongation. ``members`` has mag, mag_sigma, s2n, orient_deg, pos_ang, vel_tot."""
    w = F.try_divide(F.lit(1.0), F.pow("mag_sigma", 2))
    m = members.withColumn("_w", w).groupBy(key).agg(
        F.min("s2n").alias("least_s2n"), F.count("*").alias("n"), (F.sum(F.col("_w") * F.pow("mag", 2)) - F.try_divide(F.pow(F.sum(F.col("_w") * F.col("mag")), 2), F.sum("_w"))).alias("_chi"),
        F.max(F.abs(angle_diff(2 * F.col("orient_deg"), 2 * F.col("pos_ang"))) / 2).alias("misaligned"), F.max("vel_tot").alias("vel_tot"), F.max(elongation).alias("elongation"),
    )
    return m.withColumn("chi2", F.when(F.col("n") > 1, F.greatest(F.lit(0.0), F.col("_chi")) / (F.col("n") - 1))).drop("_chi")


def quality_gate(scores: DataFrame, s2n: float, chi2: float, misaligned: float) -> DataFrame:
    """Tracklets of fast passes that are good enough."""
    return scores.filter((F.col("least_s2n") >= s2n) & (F.coalesce("chi2", F.lit(0.0)) <= chi2) & (F.col("misaligned") <= misaligned))


def tracklet_probability(members: DataFrame, key: str = "tracklet_id") -> DataFrame:
    """The product of the three best real * (1 - star) of a tracklet's detections; 0 where two or more carry a B, R or V flag."""
    each = F.col("p_real") * (1 - F.col("p_star"))
    flagged = count_if(F.coalesce(F.col("flag").isin("B", "R", "V"), F.lit(False)))
    best = F.row_number().over(W.partitionBy(key).orderBy(F.col("_p").desc_nulls_last()))
    m = members.withColumn("_p", each).withColumn("_best", best).groupBy(key).agg(F.product(F.when(F.col("_best") <= 3, F.col("_p"))).alias("p"), flagged.alias("flagged"))
    return m.select(key, F.when(F.col("flagged") >= 2, 0.0).otherwise(F.coalesce("p", F.lit(1.0))).alias("probability"))


def killable_tracklets(tracklets: DataFrame, attrib: DataFrame, members: DataFrame, queue: DataFrame, queue_status: str = "P") -> DataFrame:
    """Unattributed tracklets that share a detection with one of a queued object in the given status."""
    held = members.join(queue.filter(F.col("status") == queue_status).select("derivedobject_id"), "derivedobject_id", "left_semi").select("tracklet_id").join(attrib, "tracklet_id").select("det_id").distinct()
    free = tracklets.filter("status = 'U'").select("tracklet_id")
    return attrib.join(free, "tracklet_id", "left_semi").join(held, "det_id", "left_semi").select("tracklet_id").distinct()


def kill_tracklets(tracklets: DataFrame, killable: DataFrame) -> DataFrame:
    marked = tracklets.join(killable.withColumn("_k", F.lit(True)), "tracklet_id", "left")
    return marked.withColumn("status", F.when(F.col("_k"), "K").otherwise(F.col("status"))).drop("_k")


def magnitude_series(members: DataFrame, key: str) -> DataFrame:
    """Time-ordered magnitudes of each object with their place and the range so far seen in it."""
    w = W.partitionBy(key)
    return members.select(key, "epoch_mjd", "mag", F.row_number().over(w.orderBy("epoch_mjd", "det_id")).alias("k"), (F.max("mag").over(w) - F.min("mag").over(w)).alias("mag_range"))


def quadratic_motion(days: float, acceleration: float) -> float:
    return math.fabs(acceleration) * days * days / 2
