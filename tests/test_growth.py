"""Joins whose work or memory once grew faster than their tables, by what they join and how."""

import math
import random

from pyspark.sql import functions as F

from nightloom.operators import cleaning, efficiency, linking, proximity, tracklets
from nightloom.sources import archive

MOTION = "tracklet_id long, t double, ra double, dec double, va double, vd double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def recorded(monkeypatch, module, name):
    """The frames that ``module``'s function of that name is called with, and what it gives."""
    calls, real = [], getattr(module, name)

    def call(*args, **kwargs):
        made = real(*args, **kwargs)
        calls.append((args, made))
        return made

    monkeypatch.setattr(module, name, call)
    return calls


def test_links_search_only_nights_between(spark, monkeypatch):
    """A pair's own tracklets are known: of a track of three nights only the middle one of its longest pair is searched."""
    calls = recorded(monkeypatch, linking, "leveled_sky_join")
    rows = [(10 * k + n, 55000.4 + n, (40 * k + 0.1 * n) % 360, 5.0 + 0.05 * n, 0.1, 0.05) for k in range(6) for n in (0, 3, 6)]
    found = linking.link_tracklets(spark.createDataFrame(rows, MOTION), 0.01, 0.01, 0.02, 0.002, 3, 10.0, 0.4)
    assert sorted(r.tracklet_ids for r in found.collect()) == [[10 * k, 10 * k + 3, 10 * k + 6] for k in range(6)]
    (_, guess, *_), _ = calls[0]
    assert guess.count() == 6


def test_links_search_a_night_whose_own_tracklet_is_off(spark):
    """The later tracklet of a pair lies off its prediction, and another one of its night on it: that one supports the pair."""
    rows = [(1, 55000.4, 10.0, 5.0, 0.1, 0.0), (2, 55003.4, 10.3, 5.0, 0.1, 0.0), (3, 55006.4, 10.6, 5.05, 0.1, 0.0), (4, 55006.4, 10.6, 5.0, 0.1, 0.0)]
    found = linking.link_tracklets(spark.createDataFrame(rows, MOTION), 0.01, 0.01, 0.02, 0.002, 3, 10.0, 0.4)
    assert [r.tracklet_ids for r in found.collect()] == [[1, 2, 4]]


def test_proximity_meets_what_was_near_then(spark, monkeypatch):
    """One place seen in 100 nights: a query meets the nights around it, not all of them."""
    calls = recorded(monkeypatch, proximity, "leveled_sky_join")
    data = spark.createDataFrame([(n, 55000.0 + n, 10.0, 5.0, 20.0) for n in range(100)], "det_id long, epoch_mjd double, ra_deg double, dec_deg double, mag double")
    asked = [(1, 10.0, 5.0, 55050.0, 20.0, 0.5, 3.0, -1.0), (2, 10.0, 5.0, 55099.0, 20.0, 0.5, 0.0, -1.0), (3, 10.0, 5.0, 55020.0, 20.0, 0.5, -1.0, -1.0), (4, 10.0, 5.0, 55000.5, 20.0, 0.5, 0.5, 0.1)]
    queries = spark.createDataFrame(asked, "query_id long, q_ra double, q_dec double, q_mjd double, q_mag double, max_dist double, max_dt double, max_dmag double")
    got = {(r.query_id, r.det_id) for r in proximity.detection_proximity(data, queries).collect()}
    assert got == {(1, n) for n in range(47, 54)} | {(2, 99), (4, 0), (4, 1)}
    assert calls[0][1].count() < 20


def test_field_candidates_broadcast_no_track(spark):
    """Objects' uncertainties and fields are not sent to the driver; the worst of an object's uncertainties counts."""
    fields = spark.createDataFrame([(1, 55001.0, 10.0, 0.0, 2.0), (2, 55001.0, 11.25, 0.0, 2.0)], "field_id long, epoch_mjd double, ra_deg double, dec_deg double, fov_deg double")
    tracks = [(k, 55000.0 + 2 * n, 10.0, 0.0, u) for k, us in ((7, (0.0, 5.0)), (8, (0.0, 1.0)), (None, (0.0, 0.0))) for n, u in enumerate(us)]
    found = proximity.orbit_field_candidates(fields, spark.createDataFrame(tracks, "object_id long, epoch_mjd double, ra_deg double, dec_deg double, uncertainty double"), 0.1, 0.4, 2.0)
    assert "Broadcast" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, 7, False), (1, 8, True), (2, 7, False)]


def test_orbits_are_brute_force(spark):
    """Orbits are joined on cells of four elements, merged; angles wrap, and thresholds may be off."""
    r = random.Random(3)
    names = ("q", "e", "i", "node", "arg_peri", "time_peri")
    orbits = [(k, r.uniform(0.5, 1.5), r.choice((0.01, 0.03, r.uniform(0, 0.3))), r.uniform(0, 20), r.choice((r.uniform(340, 360), r.uniform(0, 20))), r.uniform(0, 30), 54000 + r.uniform(0, 50)) for k in range(400)]
    data = spark.createDataFrame(orbits, "orbit_id long, " + ", ".join(f"{n} double" for n in names))
    queries = data.filter("orbit_id % 4 = 0").withColumnRenamed("orbit_id", "query_id")
    apart = lambda x, y: min(abs(x - y), 360 - abs(x - y))

    def near(k, d, q, e, i, node):
        x = abs(d[6] - k[6]) / (365.256898 * (k[1] / (1 - k[2])) ** 1.5)
        return (not q or abs(d[1] - k[1]) < q) and (not e or abs(d[2] - k[2]) < e) and apart(d[3], k[3]) < i and apart(d[4], k[4]) < node and (k[2] <= 0.05 or apart(d[5], k[5]) < 10) and x - math.floor(x) < 0.1 * (math.floor(x) + 1)

    for q, e, i, node in ((0.1, 0.05, 5.0, 10.0), (0.0, 0.0, 3.0, 170.0), (0.3, 0.0, 200.0, 7.0)):
        found = proximity.orbit_proximity(data, queries, q, e, i, node)
        assert "Broadcast" not in plan(found)
        assert {tuple(x) for x in found.collect()} == {(k[0], d[0]) for k in orbits if k[0] % 4 == 0 for d in orbits if near(k, d, q, e, i, node)}


def test_nearest_detections_meet_by_place(spark, monkeypatch):
    """Forty objects on one path: their place is compared once, not each of them with each other's copy."""
    calls = recorded(monkeypatch, proximity, "sky_join")
    kinds = "det_id long, field_id long, ra_deg double, dec_deg double, mag double"
    sim = [(k, 1, 10.0, 5.0, 20.0 + k % 3) for k in range(40)] + [(100, 1, 10.0, 5.002, 20.0), (101, 1, 10.0, 6.0, 20.0), (102, 2, 10.0, 5.0, 20.0), (103, 1, None, 5.0, 20.0)]
    real = [(1000 - k, 1, 10.0, 5.001, 20.0) for k in range(40)] + [(7, 1, 10.0, 5.0035, 20.0), (8, 1, None, None, 20.0)]
    found = proximity.compare_detections(spark.createDataFrame(sim, kinds), spark.createDataFrame(real, kinds), 0.003)
    got = {r.sim_id: (r.field_id, r.mag, r.real_id, None if r.distance is None else round(r.distance, 9)) for r in found.collect()}
    assert got == {k: (1, 20.0 + k % 3, 961, 0.001) for k in range(40)} | {100: (1, 20.0, 961, 0.001), 101: (1, 20.0, None, None), 102: (2, 20.0, None, None), 103: (1, 20.0, None, None)}
    assert calls[0][1].count() == 3


def test_partners_of_a_crowded_place_meet_in_place(spark):
    """A hundred partners of a start are tested where they are: no line is repeated for cells of velocity."""
    pairs = spark.createDataFrame([(1, 1, 2 + k, 0.01, k / 100, 0.0) for k in range(100)], "stack_id long, a long, b long, dt double, va double, vd double")
    lines = pairs.selectExpr("stack_id", "a", "b as end", "va as l_va", "vd as l_vd")
    both = tracklets.with_partners(lines, pairs, "stack_id", 0.0003 / F.col("dt"), 1.0, "l_va", "l_vd")
    assert "Union" not in plan(both) and both.count() == 10_000


def test_archive_positions_are_not_repeated_by_slice(spark, monkeypatch, tmp_path):
    """A position in reach of three slices is joined once for each sky cell; a detection in two batches is found once."""
    calls = recorded(monkeypatch, archive, "sky_join")
    rows = spark.createDataFrame([(k, 55000 + k % 2, (359.95 + k * 0.05) % 360, 60.0) for k in range(8)], "det_id long, nn long, ra_deg double, dec_deg double")
    for _ in range(2):
        archive.write_lsd(rows, str(tmp_path / "lsd"))
    positions = rows.selectExpr("det_id as position_id", "nn as p_nn", "ra_deg as p_ra", "dec_deg as p_dec")
    found = archive.read_lsd(spark, str(tmp_path / "lsd"), positions, 0.06)
    assert sorted((r.position_id, r.det_id) for r in found.select("position_id", "det_id").collect()) == [(a, b) for a in range(8) for b in range(8) if a in (b, b - 2, b + 2)]
    (_, asked, *_), _ = calls[0]
    assert asked.count() == 8


def test_codes_join_on_one_packed_cell(spark):
    """Codes join on the exposure and one number a cell, at any place and radius; each detection keeps one row."""
    r = random.Random(5)
    places = [(0.0, 90.0), (0.0, -90.0), (359.9999, 0.0), (180.0, 45.0), (90.0, 0.0)]
    dets = [(k, k % 3, (ra + r.uniform(-0.002, 0.002)) % 360, max(-90.0, min(90.0, dec + r.uniform(-0.002, 0.002))), float(r.randint(1, 5))) for k, (ra, dec) in enumerate(places * 30)]
    df = spark.createDataFrame(dets, "det_id long, field_id long, ra_deg double, dec_deg double, fom double")

    def apart(a, b):
        x, y = math.radians(b[3] - a[3]), math.radians(b[2] - a[2])
        return math.degrees(2 * math.asin(math.sqrt(math.sin(x / 2) ** 2 + math.cos(math.radians(a[3])) * math.cos(math.radians(b[3])) * math.sin(y / 2) ** 2)))

    for radius in (0.0007, 0.000001):  # the second is too narrow to pack
        found = cleaning.fom_codes(df, radius=radius)
        text = plan(found)
        assert ("_cell" in text) == (radius > 1e-5)
        want = {a[0]: "2" if any(b[1] == a[1] and b[0] != a[0] and apart(a, b) <= radius and (-b[4], b[0]) < (-a[4], a[0]) for b in dets) else None for a in dets}
        got = [(x.det_id, x.code) for x in found.select("det_id", "code").collect()]
        assert len(got) == len(dets) and dict(got) == want


def test_field_density_reads_points_once(spark):
    """Bounds are no second side of a join: points pass once, in one shuffle and one order of exposures, and points of no exposure go."""
    r = random.Random(11)
    rows = [(k, f, r.uniform(10, 10 + wide), r.uniform(0, wide), r.uniform(18, 22)) for f, n, wide in ((1, 4, 0.1), (2, 30, 1.0), (3, 8, 3.0), (None, 9, 9.0)) for k in range((f or 0) * 100, (f or 0) * 100 + n)]
    df = spark.createDataFrame(rows, "det_id long, field_id long, ra_deg double, dec_deg double, mag double")
    for best in (False, True):
        found = cleaning.field_density_filter(df, 3.0, best)
        assert "Join" not in plan(found)
        want = set()
        for f in (1, 2, 3):
            own = sorted((x for x in rows if x[1] == f), key=lambda x: (x[4], x[0]))
            (a, b), (c, d) = [(min(x[k] for x in own), max(x[k] for x in own)) for k in (2, 3)]
            area = (d - c) * (b - a) * math.cos(math.radians((c + d) / 2))
            want |= {x[0] for k, x in enumerate(own) if len(own) < 5 or len(own) / area < 3.0 or (best and k <= math.floor(3.0 * area))}
        assert {x.det_id for x in found.collect()} == want


def test_groups_are_classified_in_one_aggregate(spark):
    """Names are not told apart by an aggregate of their own; nulls and names of no synthetic object count as such."""
    names = {1: ["S0_1", "S0_1"], 2: ["S0_1", "S0_2"], 3: ["S0_1", None], 4: ["x", None], 5: ["S0_1", "S0_2", "x"]}
    found = efficiency.classify_groups(spark.createDataFrame([(k, n) for k, ns in names.items() for n in ns], "k long, object_name string"), "k")
    assert "distinct" not in plan(found) and plan(found).count("Exchange") == 1
    assert sorted(map(tuple, found.collect())) == [(1, "C", "S0_1"), (2, "M", None), (3, "B", None), (4, "N", None), (5, "B", None)]


def test_link_summary_reads_links_once(spark):
    """Classes and nights are one aggregate over the links; links of no track are none."""
    rows = [(k, n, name) for k, name in ((1, "S0_1"), (2, "S0_2"), (None, "S0_3")) for n in range(4 - (k == 2) * 2)]
    found = efficiency.link_summary(spark.createDataFrame(rows, "track_id long, nn long, object_name string"), spark.createDataFrame([("S0_1",), ("S0_2",), ("S0_3",)], "object_name string"))
    (x,) = found.collect()
    assert (x.tracks, x.clean, x.mixed, x.missed, x.clean_percent) == (1, 1, 0, 2, 100.0)
    assert plan(found).count("SortMergeJoin") <= 1


def test_views_of_a_place_are_compared_once(spark, monkeypatch):
    """Forty pointings at one place and thirty objects at another meet as one pair of places; all their rows come out, null keys too."""
    calls = recorded(monkeypatch, proximity, "sky_join")
    predictions = spark.createDataFrame([(k, 10.0, 0.0, 19.0) for k in range(30)] + [(99, -0.0, 5.0, 19.0), (None, 10.0, 0.0, 19.0), (98, None, 0.0, 19.0), (97, 10.0, 0.0, 21.0)], "object_id long, ra_deg double, dec_deg double, mag double")
    pointings = spark.createDataFrame([(k, 10.5, 0.0) for k in range(40)] + [(50, 0.0, 5.0), (None, 0.0, 5.0), (51, None, None)], "pointing_id long, p_ra double, p_dec double")
    found = proximity.objects_in_view(predictions, pointings, 1.5, 20.0)
    want = [(p, o, 0.5) for p in range(40) for o in [*range(30), None]] + [(50, 99, 0.0), (None, 99, 0.0)]
    order = lambda rows: sorted(rows, key=str)
    assert order((x[0], x[1], round(x[2], 9)) for x in found.collect()) == order(want)
    assert calls[0][1].count() == 2


def test_tracklets_are_found_where_their_starts_are(spark, monkeypatch):
    """Pairs are neither written nor shuffled: only detections travel, and what may hold another start's group. The groups are those of the way by cells of velocity, for objects that share places, too."""
    r = random.Random(7)
    rows = []
    for k in range(60):
        ra, dec, va, vd = r.choice((0.0, 359.995, 10.0)), r.choice((0.0, 30.0, 89.0)), r.choice((-0.1, 0.0, 0.1)), r.choice((0.0, 0.1))
        for e in range(4):
            t = 55000 + e / 80
            rows += [(len(rows) + c, k % 2, t, (ra + va * e / 80) % 360, dec + vd * e / 80 + (0.0002 if k % 7 == 3 and e == 2 else 0.0)) for c in range(2 if k % 5 == 0 else 1)]
    df = spark.createDataFrame(rows, "det_id long, stack_id long, epoch_mjd double, ra_deg double, dec_deg double")
    ways = (
        lambda: tracklets.find_tracklets(df, 0.0, 0.3, 0.0003, 0.05, 2),
        lambda: tracklets.find_tracklets(df, 0.0, 0.3, 0.0003, 0.05, 3, 3, greedy=True),
        lambda: tracklets.grow_tracklets(df.filter("det_id % 3 > 0"), 0.0, 0.3, 0.0003, 0.05, 2, 4),
        lambda: tracklets.grow_tracklets(df, 0.0, 0.3, 0.0003, 0.05, 2, 4, greedy=True),
    )
    groups = lambda found: sorted((x.stack_id, x.det_ids, x.n, x.tracklet_key) for x in found.collect())
    written = recorded(monkeypatch, tracklets, "cut_lineage")
    got = []
    for way in ways:
        found = way()
        assert plan(found).count("Exchange hash") == 3, plan(found)
        got.append(groups(found))
    assert not written
    monkeypatch.setattr(tracklets, "MANY_PARTNERS", 0)
    assert got == [groups(way()) for way in ways] and all(got) and written


def test_fields_of_a_place_meet_equal_tracks_once(spark, monkeypatch):
    """Thirty fields of one epoch and place and twenty objects on one track are one pair; every field and object comes out, with its own verdict."""
    calls = recorded(monkeypatch, proximity, "sky_join")
    fields = spark.createDataFrame([(k, 55001.0, 10.0, 0.0, 2.0) for k in range(30)] + [(90, 55001.0, None, 0.0, 2.0), (91, 55001.0, 11.25, 0.0, 2.0)], "field_id long, epoch_mjd double, ra_deg double, dec_deg double, fov_deg double")
    tracks = spark.createDataFrame([(k, 55000.0 + 2 * n, 10.0, 0.0, None if k == 19 else float(k % 2 * 5)) for k in range(20) for n in (0, 1)], "object_id long, epoch_mjd double, ra_deg double, dec_deg double, uncertainty double")
    found = proximity.field_proximity(fields, tracks, 0.1, by_place=True)
    assert sorted(map(tuple, found.collect())) == [(f, o, 0.0) for f in range(30) for o in range(20)]
    assert calls[-1][1].count() == 2  # the second one is too far off
    assert sorted(map(tuple, proximity.field_proximity(fields, tracks, 0.1).collect())) == sorted(map(tuple, found.collect()))
    certain = proximity.orbit_field_candidates(fields, tracks, 0.1, 0.4, 2.0)
    verdict = lambda o: None if o == 19 else o % 2 == 0
    want = [(f, o, verdict(o)) for f in range(30) for o in range(20)] + [(91, o, verdict(o)) for o in range(20) if o % 2]
    assert sorted(map(tuple, certain.collect()), key=str) == sorted(want, key=str)


def test_targets_of_a_place_meet_tracklets_once(spark, monkeypatch):
    """Twenty targets of one place and the tracklets of ten fields of another meet as one pair of places; each target gets each tracklet that is fast enough."""
    calls = recorded(monkeypatch, proximity, "fields_in_cone")
    kinds = "field_id long, epoch_mjd double, ra_deg double, dec_deg double, fov_deg double"
    fields = spark.createDataFrame([(k, 55000.0, 10.0, 0.0, 1.0) for k in range(10)] + [(50, 55000.0, 12.5, 0.0, 1.0), (51, 55000.0, None, 0.0, 1.0)], kinds)
    targets = spark.createDataFrame([(k, 55002.0, 12.0, 0.0, 0.5) for k in range(20)], "target_id long, t_mjd double, t_ra double, t_dec double, t_radius double")
    tracklets = spark.createDataFrame([(k, k % 10, 0.5 if k % 3 else 0.1, "U" if k % 5 else "K") for k in range(60)] + [(100, 50, 0.0, "U"), (101, 51, 1.0, "U"), (102, 1, None, "U")], "tracklet_id long, field_id long, vel_tot double, status string")
    found = proximity.linkable_detracklets(targets, fields, tracklets, 0.6, 4.0)
    want = [(t, k) for t in range(20) for k in [*(k for k in range(60) if k % 3 and k % 5), 100]]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert calls[0][1].count() == 2
