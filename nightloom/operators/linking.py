"""Linking tracklets of different nights, and arbitration between links."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sky import angle_diff, separation
from .graph import connected_components, cut_lineage, forget
from .numbering import numbered
from .skyjoin import leveled_sky_join, shuffled, spans


def model_pairs(tracklets: DataFrame, max_ra_accel: float, max_dec_accel: float, pred_thresh: float, max_days: float, max_speed: float) -> DataFrame:
    """Pairs of tracklets of different nights that one motion of bounded acceleration can join: the first one's state and the acceleration.

    The join is in position and velocity. Both tracklets of a pair, carried by their own motion to the middle between their nights, must lie where the other is, and their
    velocities differ by what the acceleration allows; so a bucket is a pair of nights, a cell in RA and Dec and one in the two rates, each a few tolerances wide. How fast other tracklets
    are does not matter: a false one of any speed only has buckets of its own.
    """
    frac = F.col("t") - F.floor("t")
    low, high = tracklets.agg(F.min(frac), F.max(frac)).first()
    middle, spread = ((low or 0.0) + (high or 0.0)) / 2, ((high or 0.0) - (low or 0.0)) / 2
    t = tracklets.withColumn("night", F.floor("t"))
    nights = t.select("night").distinct()  # a row a night: a gap that ends where there is none needs no row
    gaps = F.explode(F.sequence(F.lit(1), F.lit(int(max_days) + 1))).alias("gap")
    longest = F.least(F.col("gap") + 2 * spread, F.lit(float(max_days)))
    tolerance = [4 * pred_thresh + acc * longest * spread + 1e-9 for acc in (max_ra_accel, max_dec_accel)]
    drift = [acc * longest + 1e-9 for acc in (max_ra_accel, max_dec_accel)]
    around = F.greatest(F.lit(1), F.floor(360.0 / (4 * tolerance[0])))  # cells around the sky
    wide = 360.0 / around

    def side(name: str, sign: int) -> DataFrame:
        """One row per gap of nights, with where the tracklet is half-way there."""
        at = F.col(f"{name}_night") + middle + sign * F.col("gap") / 2 - F.col(f"{name}_t")
        d = t.select(*[F.col(c).alias(f"{name}_{c}") for c in ("tracklet_id", "t", "ra", "dec", "va", "vd", "night")]).select("*", gaps)
        return d.withColumns({f"{name}_x": F.pmod(F.col(f"{name}_ra") + F.col(f"{name}_va") * at, F.lit(360.0)), f"{name}_y": F.col(f"{name}_dec") + F.col(f"{name}_vd") * at})

    a = side("a", 1).withColumns({"b_night": F.col("a_night") + F.col("gap"), "_ra": F.pmod(F.floor(F.col("a_x") / wide), around), "_dec": F.floor(F.col("a_y") / (4 * tolerance[1])), "_va": F.floor(F.col("a_va") / (4 * drift[0])), "_vd": F.floor(F.col("a_vd") / (4 * drift[1]))})
    a = a.join(F.broadcast(nights.select(F.col("night").alias("b_night"))), "b_night", "left_semi")
    b = side("b", -1).withColumn("a_night", F.col("b_night") - F.col("gap")).join(F.broadcast(nights.select(F.col("night").alias("a_night"))), "a_night", "left_semi").drop("a_night")
    b = b.withColumn("_ra", F.explode(F.array_distinct(F.transform(spans(F.col("b_x"), tolerance[0], wide), lambda c: F.pmod(c, around)))))
    for name, value, reach in (("_dec", "b_y", tolerance[1]), ("_va", "b_va", drift[0]), ("_vd", "b_vd", drift[1])):
        b = b.withColumn(name, F.explode(spans(F.col(value), reach, 4 * reach)))
    # the cells' hash stands for them: what meets by chance fails the tests below, and the rows that travel are half as wide
    cell, kept = F.xxhash64("b_night", "gap", "_ra", "_dec", "_va", "_vd").alias("_cell"), ("tracklet_id", "t", "ra", "dec", "va", "vd")
    near = a.select(cell, *[f"a_{c}" for c in kept]).join(shuffled(b.select(cell, *[f"b_{c}" for c in kept])), "_cell").filter("b_t > a_t and floor(b_t) > floor(a_t)")
    dt = F.col("b_t") - F.col("a_t")
    near = near.filter((dt <= max_days) & (separation(F.col("a_ra"), F.col("a_dec"), F.col("b_ra"), F.col("b_dec")) <= max_speed * max_days))
    ra_acc, dec_acc = F.try_divide(F.col("b_va") - F.col("a_va"), dt), F.try_divide(F.col("b_vd") - F.col("a_vd"), dt)
    miss_ra = angle_diff(F.col("b_ra"), F.col("a_ra")) - (F.col("a_va") + F.col("b_va")) / 2 * dt
    miss_dec = F.col("b_dec") - F.col("a_dec") - (F.col("a_vd") + F.col("b_vd")) / 2 * dt
    return near.filter((F.abs(ra_acc) <= max_ra_accel) & (F.abs(dec_acc) <= max_dec_accel) & (F.abs(miss_ra) <= pred_thresh * 4) & (F.abs(miss_dec) <= pred_thresh * 4)).select(
        F.xxhash64("a_tracklet_id", "b_tracklet_id").alias("pair"), "a_t", "a_ra", "a_dec", "a_va", "a_vd", "b_t", "b_ra", "b_dec", ra_acc.alias("ra_acc"), dec_acc.alias("dec_acc"), F.col("a_tracklet_id").alias("ta"), F.col("b_tracklet_id").alias("tb"),
        F.lit(middle).alias("middle"), (spread * F.hypot(F.abs("a_va") + max_ra_accel * dt, F.abs("a_vd") + max_dec_accel * dt)).alias("strays"),
    )


def quadratic_misfit(n: Column, x: list[Column], y: list[Column]) -> Column:
    """The sum of squares that a quadratic in x leaves of y, from the sums of x, x^2, x^3, x^4 and of y, xy, x^2 y, y^2 over n points.

    1, x less its mean, and x^2 less what those two have of it are orthogonal, so each takes its part off the squares.
    """
    m = x[0] / n
    c2, c3 = x[1] - n * m * m, x[2] - 3 * m * x[1] + 2 * n * m * m * m
    c4 = x[3] - 4 * m * x[2] + 6 * m * m * x[1] - 3 * n * m * m * m * m
    lean, level = F.try_divide(c3, c2), c2 / n
    first, square = y[1] - m * y[0], y[2] - 2 * m * y[1] + m * m * y[0]
    second, size = square - lean * first - level * y[0], c4 - lean * c3 - level * c2
    taken = F.when(n > 1, F.coalesce(F.try_divide(first * first, c2), F.lit(0.0))).otherwise(0.0) + F.when(n > 2, F.coalesce(F.try_divide(second * second, size), F.lit(0.0))).otherwise(0.0)
    return F.greatest(F.lit(0.0), y[3] - y[0] * y[0] / n - taken)


def link_tracklets(tracklets: DataFrame, max_ra_accel: float, max_dec_accel: float, pred_thresh: float, fit_thresh: float, min_support: int = 3, max_days: float = 20.0, max_speed: float = 1.0) -> DataFrame:
    """(track_key, tracklet_ids, n, residual): tracklets of several nights on one quadratic motion.

    ``tracklets`` has tracklet_id, t, ra, dec, va, vd (middle epoch, position, degrees a day). Two model tracklets of different nights with
    a bounded acceleration between them (:func:`model_pairs`) predict positions; tracklets within ``pred_thresh`` (degrees) support the
    pair, one per night, the pair's own first, then the nearest. Tracks of ``min_support`` or more whose quadratic fit leaves less than ``fit_thresh`` stay, without subsets.

    A night's supporters are looked for around the prediction for its middle, within the threshold and what the pair's own motion strays from there in a night, on cells of that size. Nights of the pair's
    own tracklets are only searched where the later one lies off its prediction: the others are known without a join. The fit is one of sums over a track's tracklets, a handful, so all of it is joins and
    aggregates.
    """
    pair = cut_lineage(model_pairs(tracklets, max_ra_accel, max_dec_accel, pred_thresh, max_days, max_speed))
    at = lambda p, v, acc, x: F.col(p) + F.col(v) * x + F.col(acc) * x * x / 2

    def against(df: DataFrame, ts: str, t: str, ra: str, dec: str) -> DataFrame:
        """(pair, night, ts, ...): tracklets of ``df`` with how far they lie from their pair's motion at their own time, where that is within the threshold."""
        y = F.col(t) - F.col("a_t")
        p_ra, p_dec = F.pmod(at("a_ra", "a_va", "ra_acc", y), F.lit(360.0)), at("a_dec", "a_vd", "dec_acc", y)
        off = separation(F.col(ra), F.col(dec), p_ra, p_dec).alias("_d")
        return df.select("pair", "night", F.col(ts).alias("ts"), F.col(dec).alias("dec"), off, y.alias("x"), angle_diff(F.col(ra), p_ra).alias("off_ra"), (F.col(dec) - p_dec).alias("off_dec")).filter(F.col("_d") <= pred_thresh)

    later = F.col("b_t") - F.col("a_t")
    missed = separation(F.col("b_ra"), F.col("b_dec"), F.pmod(at("a_ra", "a_va", "ra_acc", later), F.lit(360.0)), at("a_dec", "a_vd", "dec_acc", later)) > pred_thresh
    first, last = F.floor("a_t") + 1, F.floor("b_t") - F.when(missed, 0).otherwise(1)
    nights = F.broadcast(tracklets.select(F.floor("t").alias("night")).distinct())
    span = pair.withColumn("night", F.explode(F.when(first <= last, F.sequence(first, last)))).join(nights, "night", "left_semi")
    x = F.col("night") + F.col("middle") - F.col("a_t")
    guess = span.select("pair", "night", "a_t", "a_ra", "a_dec", "a_va", "a_vd", "ra_acc", "dec_acc", F.pmod(at("a_ra", "a_va", "ra_acc", x), F.lit(360.0)).alias("p_ra"), at("a_dec", "a_vd", "dec_acc", x).alias("p_dec"), (F.col("strays") + pred_thresh).alias("reach"))
    t = tracklets.select(F.col("tracklet_id").alias("ts"), "t", "ra", "dec", F.floor("t").alias("night"))
    support = against(leveled_sky_join(t, guess, "reach", ("ra", "dec"), ("p_ra", "p_dec"), ("night",)), "ts", "t", "ra", "dec")
    for side, tracklet in (("a", "ta"), ("b", "tb")):
        support = support.unionByName(against(pair.withColumn("night", F.floor(f"{side}_t")), tracklet, f"{side}_t", f"{side}_ra", f"{side}_dec"))
    best = support.repartition("pair").groupBy("pair", "night").agg(F.min(F.struct("_d", "ts", "x", "off_ra", "off_dec", "dec")).alias("m"))
    # deviations from the pair's own quadratic leave the same after a fit as positions do
    m = best.select("pair", "m.*")
    sums = {f"x{k}": F.sum(F.pow("x", k)) for k in (1, 2, 3, 4)}
    for name in ("ra", "dec"):
        off = F.col(f"off_{name}")
        sums |= {f"{name}0": F.sum(off), f"{name}1": F.sum(F.col("x") * off), f"{name}2": F.sum(F.col("x") * F.col("x") * off), f"{name}3": F.sum(off * off)}
    many = m.groupBy("pair").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("ts")).alias("tracklet_ids"), F.avg("dec").alias("dec"), *[v.alias(k) for k, v in sums.items()]).filter(F.col("n") >= min_support)
    misfit = lambda name: quadratic_misfit(F.col("n"), [F.col(f"x{k}") for k in (1, 2, 3, 4)], [F.col(f"{name}{k}") for k in range(4)]) / F.col("n")
    fitted = many.withColumn("residual", F.sqrt(misfit("ra") * F.pow(F.cos(F.radians("dec")), 2) + misfit("dec"))).filter(F.col("residual") < fit_thresh)
    tracks = fitted.groupBy("tracklet_ids").agg(F.min(F.struct(F.col("pair").alias("track_key"), "residual")).alias("m"), F.max("n").alias("n")).select("m.track_key", "tracklet_ids", "n", "m.residual")
    from .tracklets import drop_subsets

    return drop_subsets(tracks, "track_key", "tracklet_ids").select("track_key", "tracklet_ids", "n", "residual")


def rank_tracks(tracks: DataFrame, key: str, size: str = "n", residual: str = "residual", within: list[str] | None = None) -> DataFrame:
    """Trust order: most detections first, then the lowest residual, then the key; over all tracks it is numbered by ranges."""
    order = [F.col(size).desc(), F.col(residual), F.col(key)]
    if within:
        return tracks.withColumn("trust", F.row_number().over(W.partitionBy(*within).orderBy(*order)))
    return numbered(tracks, order, "trust")


def best_candidate(candidates: DataFrame, key: str, tie: str, residual: str = "residual", cutoff: float | None = None) -> DataFrame:
    """The candidate of the lowest residual per key, under a cutoff."""
    c = candidates if cutoff is None else candidates.filter(F.col(residual) < cutoff)
    return c.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(residual, tie))).filter("_r = 1").drop("_r")


def resolve_leading_conflicts(links: DataFrame, members: str = "tracklet_ids", residual: str = "residual", key: str = "link_id") -> DataFrame:
    """Of links with the same members but the last keep the lowest residual; links without an orbit (null residual) pass."""
    found = links.filter(F.col(residual).isNotNull())
    lead = F.slice(F.col(members), 1, F.greatest(F.lit(1), F.size(members) - 1))
    best = found.withColumn("_r", F.row_number().over(W.partitionBy(lead).orderBy(residual, key))).filter("_r = 1").drop("_r")
    return best.unionByName(links.filter(F.col(residual).isNull()))


def _conflicts(members: DataFrame, owner: str, member: str) -> DataFrame:
    """(owner, component) of owners that hang together by shared members; others are their own component."""
    low = members.groupBy(member).agg(F.min(owner).alias("_low"))
    return connected_components(members.join(low, member).select(owner, "_low"), owner, "_low")


def arbitrate(objects: DataFrame, members: DataFrame, factor: float = 1.5, key: str = "object_id", member: str = "tracklet_id", merit: str = "fom") -> DataFrame:
    """Objects with ``accepted``: whoever shares a member must have more than ``factor`` times the merit of the best rival.

    Rivals are compared member by member: the best and the second best merit per member decide, so conflicts of
    any size need two aggregates and no pairs.
    """
    m = members.join(objects.select(key, merit), key)
    top = m.groupBy(member).agg(F.max(F.struct(F.col(merit).alias("f"), F.col(key).alias("k"))).alias("best"), F.count("*").alias("users"))
    second = m.join(top, member).filter(F.col(key) != F.col("best.k")).groupBy(member).agg(F.max(merit).alias("second"))
    ruled = m.join(top, member).join(second, member, "left")
    wins = (F.col("users") == 1) | ((F.col(key) == F.col("best.k")) & (F.col("best.f") > factor * F.col("second")))
    verdict = ruled.groupBy(key).agg(F.min(wins.cast("int")).alias("w"))
    return objects.join(verdict, key, "left").withColumn("accepted", F.coalesce(F.col("w") == 1, F.lit(True))).drop("w")


def merge_overlaps(tracks: DataFrame, members: DataFrame, least: float, key: str = "track_key", member: str = "det_id") -> DataFrame:
    """(key, merged_into): tracks whose overlap 2 n(A and B) / (n(A) + n(B)) reaches ``least`` merge into the most trusted of their group.

    ``tracks`` has the trust order in ``trust``. Members at the same time in both refuse the merge (``epoch_mjd`` of members).
    With such an overlap both share at least least / (2 - least) of either, so in one order of all members, the rarest first, some member among the first
    n - that + 1 of both is common. Only those are joined: members that many tracks share come last.
    """
    a = members.select(F.col(key).alias("a"), F.col(member).alias("m"), F.col("epoch_mjd").alias("t"))
    size = members.groupBy(key).agg(F.count("*").alias("n"))
    users = a.groupBy("m").agg(F.count("*").alias("users"))
    in_order = W.partitionBy("a").orderBy("users", "m")
    placed = a.join(users, "m").withColumn("k", F.row_number().over(in_order)).withColumn("n", F.count("*").over(W.partitionBy("a")))
    first = placed.filter(F.col("k") <= F.col("n") - F.ceil(F.col("n") * (least / (2 - least)) - 1e-9) + 1).select("a", "m")
    pairs = first.join(first.select(F.col("a").alias("b"), "m"), "m").filter("a < b").select("a", "b").distinct()
    shared = pairs.join(a.select("a", "m"), "a").join(a.select(F.col("a").alias("b"), "m"), ["b", "m"]).groupBy("a", "b").agg(F.count("*").alias("both"))
    over = shared.join(size.select(F.col(key).alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col(key).alias("b"), F.col("n").alias("nb")), "b").filter(2 * F.col("both") / (F.col("na") + F.col("nb")) >= least)
    other = a.select(F.col("a").alias("b"), F.col("m").alias("m2"), "t")
    clash = over.join(a, "a").join(other, ["b", "t"]).filter("m <> m2").select("a", "b").distinct()
    groups = connected_components(over.join(clash, ["a", "b"], "left_anti"), "a", "b")
    led = groups.join(tracks.select(F.col(key).alias("node"), "trust"), "node")
    head = led.groupBy("component").agg(F.min(F.struct("trust", "node")).alias("h"))
    return tracks.select(key).join(led.join(head, "component").select(F.col("node").alias(key), F.col("h.node").alias("merged_into")), key, "left").withColumn("merged_into", F.coalesce("merged_into", key))


ROUNDS = 8


def first_use_only(candidates: DataFrame, members: DataFrame, key: str = "tracklet_id", member: str = "det_id", order: str = "rank", rounds: int = ROUNDS) -> DataFrame:
    """(key, accepted): a tracklet is accepted only if no earlier accepted one (by ``order``, nulls last, then the key) used any of its detections.

    In rounds, as joins: who ranks first on all its detections is accepted, its rivals are struck, and both leave. Most are settled after one or two. A chain in which each waits for the one before
    would take a round per link, so what ``rounds`` leave over is streamed: each component's tracklets in their order, through sorted batches, with only the detections in hand that a later tracklet still has.
    Tracklets without detections are accepted.
    """
    kind = dict(candidates.dtypes)[key]
    place = F.struct(F.col(order).isNull().alias("last"), F.col(order).alias("o"), F.col(key).alias("k"))
    live = cut_lineage(members.select(key, F.col(member).alias("m")).distinct().join(candidates.select(key, place.alias("place")), key).select(F.col(key).alias("k"), "place", "m"))
    settled = []
    for _ in range(rounds):
        if live.isEmpty():
            break
        first = live.groupBy("m").agg(F.min("place").alias("first"))
        won = live.join(first, "m").groupBy("k").agg(F.min((F.col("place") == F.col("first")).cast("int")).alias("w")).filter("w = 1").select("k")
        taken = live.join(won, "k", "left_semi").select("m").distinct()
        done = live.join(taken, "m", "left_semi").select("k").distinct().join(won.withColumn("accepted", F.lit(True)), "k", "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))
        settled.append(cut_lineage(done))
        old, live = live, cut_lineage(live.join(settled[-1], "k", "left_anti"))
        forget(old)
    if not live.isEmpty():
        settled.append(stream_first_use(live, kind))
    out = candidates.select(F.col(key).alias("k"))
    known = reduce(DataFrame.unionByName, settled) if settled else None
    out = out.withColumn("accepted", F.lit(True)) if known is None else out.join(known, "k", "left").withColumn("accepted", F.coalesce("accepted", F.lit(True)))
    return out.select(F.col("k").alias(key), "accepted")


def stream_first_use(live: DataFrame, kind: str) -> DataFrame:
    """(k, accepted) of (k, place, m): each component's rows pass one task in order of place, in batches; a detection is forgotten with the last tracklet that has it."""
    last = live.groupBy("m").agg(F.max("place").alias("end"))
    low = live.groupBy("m").agg(F.min("k").alias("low"))
    groups = connected_components(live.join(low, "m").select("k", "low"), "k", "low").select(F.col("node").alias("k"), "component")
    codes = live.select("m").distinct().withColumn("c", F.xxhash64("m", F.lit("a"))).withColumn("d", F.xxhash64("m", F.lit("b")))  # two hashes name a member whatever its type
    rows = live.join(last, "m").join(codes, "m").groupBy("k").agg(F.min("place").alias("place"), F.collect_list(F.struct("c", "d", (F.col("place") == F.col("end")).alias("last"))).alias("uses"))
    rows = rows.join(groups, "k").select("component", "place", "k", "uses")

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        used: set = set()
        now = None
        for pdf in batches:
            ok = []
            for component, uses in zip(pdf["component"], pdf["uses"], strict=True):
                if component != now:
                    now, used = component, set()
                mine = [(u["c"], u["d"]) for u in uses]
                free = used.isdisjoint(mine)
                ok.append(free)
                if free:
                    used.update(mine)
                used.difference_update(x for x, u in zip(mine, uses, strict=True) if u["last"])
            yield pd.DataFrame({"k": pdf["k"], "accepted": ok})

    ordered = rows.repartition("component").sortWithinPartitions("component", "place").select("component", "k", "uses")
    return ordered.mapInPandas(take, f"k {kind}, accepted boolean")


def identifiable_pairs(objects: DataFrame, queue: DataFrame) -> DataFrame:
    """(child_id, parent_id): queued objects and other unmerged ones of the same population object."""
    live = objects.filter("status <> 'M' and ssm_id is not null")
    child = live.join(queue.filter("status = 'I'").select("derivedobject_id"), "derivedobject_id", "left_semi").select(F.col("derivedobject_id").alias("child_id"), "ssm_id")
    parent = live.select(F.col("derivedobject_id").alias("parent_id"), "ssm_id")
    return child.join(parent, "ssm_id").filter("child_id <> parent_id").select("child_id", "parent_id")


def provisional_attributions(tracklets: DataFrame, objects: DataFrame, field_ids: DataFrame | None = None, queue: DataFrame | None = None) -> DataFrame:
    """Unattributed tracklets whose population object has a live derived object; for precovery it must be queued in status I."""
    t = tracklets.filter("status = 'U' and ssm_id is not null")
    if field_ids is not None:
        t = t.join(field_ids, "field_id", "left_semi")
    o = objects.filter("status <> 'M'").select("derivedobject_id", "ssm_id")
    if queue is not None:
        o = o.join(queue.filter("status = 'I'").select("derivedobject_id"), "derivedobject_id", "left_semi")
    return t.join(o, "ssm_id").select("tracklet_id", "derivedobject_id")


def lost_attributions(tracklets: DataFrame, objects: DataFrame, nights: tuple[int, int]) -> DataFrame:
    """Provisional attributions of some nights that were not made."""
    return provisional_attributions(tracklets.filter(F.col("nn").between(*nights)), objects)


def lost_precoveries(tracklets: DataFrame, objects: DataFrame, queue: DataFrame, nights: tuple[int, int]) -> DataFrame:
    return provisional_attributions(tracklets.filter(F.col("nn").between(*nights)), objects, queue=queue)


def lost_linkages(tracklets: DataFrame, history: DataFrame, nights: int) -> DataFrame:
    """Population objects on at least so many nights, unattributed, without an event at their last field."""
    seen = tracklets.filter("status = 'U' and ssm_id is not null").groupBy("ssm_id").agg(F.count_distinct("nn").alias("nights"), F.max("field_id").alias("field_id")).filter(F.col("nights") >= nights)
    return seen.join(history.select(F.col("derivedobject_id").alias("ssm_id"), "field_id"), ["ssm_id", "field_id"], "left_anti")


def decorate_known(assignments: DataFrame, tracklets: DataFrame, status: str | None = None) -> DataFrame:
    """Tracklets with the designations assigned to them: ``assignments`` has known_name and tracklet_ids joined by commas."""
    each = assignments.withColumn("tracklet_id", F.explode(F.split("tracklet_ids", ","))).select("known_name", F.col("tracklet_id").cast("bigint").alias("tracklet_id"))
    names = each.groupBy("tracklet_id").agg(F.array_join(F.array_sort(F.collect_set("known_name")), ",").alias("known_names"))
    joined = tracklets.join(names, "tracklet_id", "left")
    return joined if status is None else joined.withColumn("status", F.when(F.col("known_names").isNotNull(), status).otherwise(F.col("status")))


def merge_residuals(old: DataFrame, new: DataFrame) -> DataFrame:
    """Residuals by (det_id, tracklet_id), new rows in place of old ones."""
    return old.join(new.select("det_id", "tracklet_id"), ["det_id", "tracklet_id"], "left_anti").unionByName(new)
