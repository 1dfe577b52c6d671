"""Spatial and sequence operators against brute force and hand-made cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from nightloom.operators import cleaning, linking, skyjoin, tracklets, tuples
from nightloom.operators.graph import connected_components
from nightloom.sources import archive, text


def sep(a, b):
    (r1, d1), (r2, d2) = [tuple(map(math.radians, x)) for x in (a, b)]
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
    return math.degrees(2 * math.asin(min(1, math.sqrt(h))))


def points(n, seed):
    r = random.Random(seed)
    out = [(r.uniform(0, 360), math.degrees(math.asin(r.uniform(-1, 1)))) for _ in range(n)]
    return out + [(359.9, 0.0), (0.1, 0.0), (10.0, 90.0), (200.0, 89.5), (0.0, -90.0), (5.0, 5.0), (5.0, 5.0)]


@pytest.mark.parametrize("radius", [0.3, 5.0, 40.0])
def test_sky_join_is_brute_force(spark, radius):
    a, b = points(150, 1), points(120, 2)
    left = spark.createDataFrame([(k, *p) for k, p in enumerate(a)], "i int, ra double, dec double")
    right = spark.createDataFrame([(k, *p) for k, p in enumerate(b)], "j int, ra2 double, dec2 double")
    got = {(r.i, r.j) for r in skyjoin.sky_join(left, right, radius, ("ra", "dec"), ("ra2", "dec2")).select("i", "j").collect()}
    assert got == {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if sep(p, q) <= radius}


def test_sky_join_of_nothing(spark):
    left = spark.createDataFrame([], "i int, ra double, dec double")
    right = spark.createDataFrame([(1, 2.0, 3.0), (2, None, None)], "j int, ra2 double, dec2 double")
    assert skyjoin.sky_join(left, right, 1.0, ("ra", "dec"), ("ra2", "dec2")).count() == 0


def dets(spark, rows):
    return spark.createDataFrame(rows, "det_id bigint, field_id bigint, ra_deg double, dec_deg double, mag double")


def test_dedupe_and_stationary(spark):
    df = dets(spark, [(1, 1, 359.9999, 0.0, 20.0), (2, 1, 0.0001, 0.0, 19.0), (3, 2, 0.0, 0.0, 20.0), (4, 1, 10.0, 10.0, 20.0), (5, 1, 10.0, 10.0, 20.0)])
    ids = lambda d: sorted(r.det_id for r in d.collect())
    assert ids(cleaning.dedupe_nearby(df, 0.001)) == [2, 3, 4]
    assert ids(cleaning.drop_stationary(df, 0.001)) == [3]


def test_streak(spark):
    line = [(k, 1, 10.0 + k * 0.01, 5.0 + k * 0.01, 20.0) for k in range(6)]
    noise = [(100 + k, 1, 10.0 + x, 5.0 + y, 20.0) for k, (x, y) in enumerate([(0.03, -0.04), (-0.02, 0.05)])]
    got = sorted(r.det_id for r in cleaning.drop_linear(dets(spark, line + noise), 0.1, 2.0, 3).collect())
    assert got == [100, 101]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3), (200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200}


def test_tracklets_of_planted_movers(spark):
    rows = []
    for o in range(12):
        for e in range(4):
            t = e * 0.0125
            rows.append((o * 10 + e, 1, 55000.3 + t, 10.0 + o * 0.1 + 0.1 * t, 5.0 + 0.2 * t))
    df = spark.createDataFrame(rows, "det_id bigint, stack_id bigint, epoch_mjd double, ra_deg double, dec_deg double")
    found = tracklets.find_tracklets(df, 0.0, 0.5, 0.0003, 0.05, 3)
    truth = df.groupBy(F.floor(F.col("det_id") / 10)).agg(F.array_sort(F.collect_list("det_id")).alias("det_ids"))
    assert tuple(tracklets.evaluate_tracklets(found, truth).first()) == (12, 12, 12)
    assert tracklets.grow_tracklets(df, 0.0, 0.5, 0.0003, 0.05, 3, 4).count() == 12


def test_crowded_stack(spark):
    """Two hundred detections in one place: velocity cells give what a comparison of all partners gives, and greedy growth stays small."""
    r = random.Random(13)
    rows = [(e * 1000 + k, 1, 55000.3 + e * 0.0125, 10.0 + r.gauss(0, 0.0006), 5.0 + r.gauss(0, 0.0006)) for e in range(4) for k in range(50)]
    df = spark.createDataFrame(rows, "det_id bigint, stack_id bigint, epoch_mjd double, ra_deg double, dec_deg double")
    want, most = None, tracklets.MANY_PARTNERS
    try:
        for partners in (10**9, 20):
            tracklets.MANY_PARTNERS = partners
            found = sorted((x.det_ids for x in tracklets.find_tracklets(df, 0.0, 0.3, 0.0003, 0.05, 3).collect()))
            grown = sorted((x.det_ids for x in tracklets.grow_tracklets(df, 0.0, 0.05, 0.0003, 0.05, 3, 4, greedy=True).collect()))
            want = want or (found, grown)
            assert (found, grown) == want
    finally:
        tracklets.MANY_PARTNERS = most
    assert 200 < len(want[0]) < 20000 and 200 < len(want[1]) < 50000


def test_long_trails_pair_within_their_own_reach(spark):
    rows = [(1, 1, 55000.0, 10.0, 0.0, 0.0), (2, 1, 55000.01, 10.002, 0.0, 0.0), (3, 1, 55000.0, 50.0, 0.0, 0.01), (4, 1, 55000.01, 50.0 + 0.01 * 2880 * 0.01, 0.0, 0.01), (5, 1, 55000.01, 50.0 + 0.002, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "det_id bigint, stack_id bigint, epoch_mjd double, ra_deg double, dec_deg double, length_deg double")
    got = sorted((x.a, x.b) for x in tracklets.pair_detections(df, 0.0, 0.3, 0.0003, 0.05, trail=True, trail_error=0.001).collect())
    assert got == [(1, 2), (3, 4)]


def test_gcr(spark):
    rows = [(1, 55000.0 + k / 100, 10.0 + k * 0.01, 20.0 + k * 0.005) for k in range(4)] + [(2, 55000.0, 1.0, 1.0), (2, 55000.1, 1.1, 1.0), (3, 55000.0, 1.0, 1.0), (3, 55000.01, 1.01, 1.01), (3, 55000.02, 1.02, 1.0)]
    df = spark.createDataFrame(rows, "tracklet_id bigint, epoch_mjd double, ra_deg double, dec_deg double")
    got = {r.tracklet_id: r.gcr_arcsec for r in tracklets.gcr(df).collect()}
    assert got[1] < 1 and got[2] == 0 and got[3] > 10


def test_subsets(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [1, 2]), (3, [2, 3, 4]), (4, [1, 2, 3]), (5, [9])], "k int, m array<int>")
    assert sorted(r.k for r in tracklets.drop_subsets(df, "k", "m").collect()) == [1, 3, 5]


def fields(spark, rows):
    return spark.createDataFrame([(55000, *r) for r in rows], "nn int, field_id bigint, ra_deg double, dec_deg double, epoch_mjd double, filter_id string")


def test_tuples(spark):
    m = 1 / 1440
    rows = [(1, 10.0, 0.0, 55000.0, "r"), (2, 10.0, 0.0, 55000.0 + 15 * m, "r"), (3, 50.0, 0.0, 55000.0 + 16 * m, "r"), (4, 10.0, 0.0, 55000.0 + 20 * m, "g"), (5, 80.0, 0.0, 55000.0 + 30 * m, "r"), (6, 80.0, 0.0, 55000.0 + 31 * m, "r")]
    got = {r.field_id: (r.kind, r.tuple_id) for r in tuples.assemble_tuples(fields(spark, rows), 2, 4, 10, 30).collect()}
    assert got == {1: ("TTI", 2), 2: ("TTI", 2), 3: ("ORPHAN", None), 4: ("ORPHAN", None), 5: ("DEEP", 6), 6: ("DEEP", 6)}


def test_arbitration(spark):
    objects = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 8.0), (4, 7.0), (5, 1.0)], "object_id int, fom double")
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 2), (5, 3)], "object_id int, tracklet_id int")
    got = {r.object_id: r.accepted for r in linking.arbitrate(objects, members).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: True}


def first_uses(c, m):
    used, out = set(), {}
    of = {}
    for k, d in m:
        of.setdefault(k, set()).add(d)
    for k, rank in sorted(c, key=lambda x: (x[1] is None, x[1] or 0, x[0])):
        out[k] = not (of.get(k, set()) & used)
        if out[k]:
            used |= of.get(k, set())
    return out


@pytest.mark.parametrize("rounds", [0, 1, 8])
def test_first_use_is_greedy(spark, rounds):
    r = random.Random(9)
    c = [(k, r.choice([None, 1, 2, 3, 50, r.randint(0, 99)])) for k in range(300)] + [(1000 + k, 1000 + k) for k in range(60)]
    m = [(k, r.randint(0, 250)) for k in range(290) for _ in range(r.randint(0, 4))] + [(1000 + k, 5000 + k + d) for k in range(60) for d in (0, 1)] + [(7777, 5), (7777, 5020)]
    cd, md = spark.createDataFrame(c, "tracklet_id bigint, rank int"), spark.createDataFrame(m + m[:20], "tracklet_id bigint, det_id bigint")
    assert {x.tracklet_id: x.accepted for x in linking.first_use_only(cd, md, rounds=rounds).collect()} == first_uses(c, m)


def test_first_use_of_a_long_chain(spark):
    """Each waits for the one before: the rounds settle its ends, the rest is streamed."""
    n = 100_000
    c = spark.range(n).select(F.col("id").alias("tracklet_id"), F.col("id").alias("rank"))
    m = spark.range(n).select(F.col("id").alias("tracklet_id"), F.explode(F.array("id", F.expr("id + 1"))).alias("det_id"))
    got = linking.first_use_only(c, m, rounds=2)
    assert tuple(got.agg(F.count("*"), F.sum(F.col("accepted").cast("int")), F.sum((F.col("accepted") == (F.col("tracklet_id") % 2 == 0)).cast("int"))).first()) == (n, n // 2, n)


def test_fields_in_cone_are_brute_force(spark):
    from nightloom.operators import proximity

    r = random.Random(10)
    fields = [(k, 55000 + r.uniform(0, 40), *p, r.choice([1.0, 3.0])) for k, p in enumerate(points(250, 7))]
    near = [(1000 + k, 55000 + r.uniform(0, 40), 40 + r.uniform(-8, 8), 85 + r.uniform(-5, 5), 3.0) for k in range(150)]
    fields += near
    targets = [(k, f[1] + r.choice([0.0, 0.01, 1.0, 4.0]), f[2], f[3], 1.5) for k, f in enumerate(fields[::7])]
    fd = spark.createDataFrame(fields, "field_id int, epoch_mjd double, ra_deg double, dec_deg double, fov_deg double")
    td = spark.createDataFrame(targets, "target_id int, t_mjd double, t_ra double, t_dec double, t_radius double")
    for speed, days in ((0.5, 8.0), (30.0, 20.0), (0.0, 5.0)):
        got = sorted((x.target_id, x.field_id) for x in proximity.fields_in_cone(td, fd, speed, days).collect())
        want = sorted((t[0], f[0]) for t in targets for f in fields if 0 < t[1] - f[1] <= days and max(0, sep(t[2:4], f[2:4]) - f[4] / 2 - t[4]) <= speed * (t[1] - f[1]))
        assert got == want and len(want) > 10


def test_lines(spark, tmp_path):
    lines = spark.createDataFrame([("# note",), ("1 54593.3 10.5 -3.25 20.1 F51 S1 0.01 90",), ("x y",), ("",)], "value string")
    rows = text.parse_detections(lines).orderBy("det_id").collect()
    assert [r._corrupt for r in rows] == ["x y", None] and rows[1].ra_deg == 10.5 and rows[1].orient_deg == 90.0
    obs = spark.createDataFrame([("S12345", 54593.312345, 359.999, -0.5, 20.25, "r", "F51")], "object_name string, epoch_mjd double, ra_deg double, dec_deg double, mag double, filter_id string, obscode string")
    line = text.format_obs80(obs)
    assert len(line.first().value) == 80
    back = text.parse_obs80(line).first()
    assert (back.object_name, back.filter_id, back.obscode, back.mag) == ("S12345", "r", "F51", 20.25)
    assert back.epoch_mjd == pytest.approx(54593.312345, abs=2e-6) and back.ra_deg == pytest.approx(359.999, abs=1e-5) and back.dec_deg == pytest.approx(-0.5, abs=1e-5)
    text.write_obs80(obs, str(tmp_path / "o"))
    assert text.read_obs80(spark, str(tmp_path / "o")).count() == 1


def motion(spark, rows):
    return spark.createDataFrame(rows, "tracklet_id bigint, t double, ra double, dec double, va double, vd double")


def test_model_pairs_are_brute_force(spark):
    """All pairs of bounded acceleration, across RA 0 and whatever the time of night; a very fast tracklet changes nothing for the others."""
    r = random.Random(11)
    rows = []
    for o in range(60):
        ra, dec, va, vd = r.choice([0.0, 359.9, 120.0]) + r.uniform(-1, 1), r.uniform(-3, 3), r.uniform(-0.4, 0.4), r.uniform(-0.3, 0.3)
        for night in (0, 1, 4, 9):
            x = night + r.uniform(0.2, 0.5)
            rows.append((len(rows), 55000 + x, (ra + va * x + r.uniform(-0.02, 0.02)) % 360, dec + vd * x, va + r.uniform(-0.02, 0.02), vd + r.uniform(-0.01, 0.01)))
    fast = [(1000, 55002.3, 10.0, 0.0, 50.0, 3.0)]
    diff = lambda a, b: 180 - (180 - (a - b)) % 360
    for extra in ([], fast):
        got = {(x.ta, x.tb) for x in linking.model_pairs(motion(spark, rows + extra), 0.01, 0.02, 0.02, 8.0, 0.5).collect()}
        want = set()
        for a in rows + extra:
            for b in rows + extra:
                dt = b[1] - a[1]
                if math.floor(b[1]) > math.floor(a[1]) and dt <= 8 and sep(a[2:4], b[2:4]) <= 4.0:
                    if abs(b[4] - a[4]) <= 0.01 * dt and abs(b[5] - a[5]) <= 0.02 * dt and abs(diff(b[2], a[2]) - (a[4] + b[4]) / 2 * dt) <= 0.08 and abs(b[3] - a[3] - (a[5] + b[5]) / 2 * dt) <= 0.08:
                        want.add((a[0], b[0]))
        assert len(want) > 50 and got == want


def test_quadratic_misfit(spark):
    import numpy as np

    r = random.Random(12)
    rows = [(k, r.uniform(0, 20), r.uniform(-0.02, 0.02)) for k in range(30) for _ in range(1 + k % 9)]
    df = spark.createDataFrame(rows, "k int, x double, y double").groupBy("k").agg(F.count("*").alias("n"), *[F.sum(F.pow("x", p)).alias(f"x{p}") for p in (1, 2, 3, 4)], F.sum("y").alias("y0"), F.sum(F.expr("x * y")).alias("y1"), F.sum(F.expr("x * x * y")).alias("y2"), F.sum(F.expr("y * y")).alias("y3"))
    got = {x.k: x.v for x in df.select("k", linking.quadratic_misfit(F.col("n"), [F.col(f"x{p}") for p in (1, 2, 3, 4)], [F.col(f"y{p}") for p in range(4)]).alias("v")).collect()}
    for k in range(30):
        x, y = (np.array([row[c] for row in rows if row[0] == k]) for c in (1, 2))
        assert got[k] == pytest.approx(float(np.sum((y - np.polyval(np.polyfit(x, y, min(2, len(x) - 1)), x)) ** 2)), abs=1e-12)


def test_leveled_join_is_brute_force(spark):
    """Each query within its own radius, from arcseconds to half the sky."""
    a, b = points(200, 3), points(90, 4)
    radius = [(0.001, 0.3, 5.0, 40.0, 170.0, 0.0)[k % 6] for k in range(len(b))]
    left = spark.createDataFrame([(k, *p) for k, p in enumerate(a)] + [(-1, None, 1.0)], "i int, ra double, dec double")
    right = spark.createDataFrame([(k, *p, x) for (k, p), x in zip(enumerate(b), radius, strict=True)] + [(-1, 1.0, 1.0, None), (-2, 1.0, 1.0, -3.0), (-3, None, 1.0, 3.0)], "j int, ra2 double, dec2 double, r double")
    got = sorted((x.i, x.j) for x in skyjoin.leveled_sky_join(left, right, "r", ("ra", "dec"), ("ra2", "dec2")).select("i", "j").collect())
    assert got == sorted((i, j) for i, p in enumerate(a) for (j, q), x in zip(enumerate(b), radius, strict=True) if sep(p, q) <= x)


def test_archive(spark, tmp_path):
    r = random.Random(5)
    rows = [(k, 55000 + k % 2, r.uniform(0, 360), r.uniform(-90, 90)) for k in range(300)] + [(1000, 55000, 359.99, 1.0), (1001, 55000, 0.01, 1.0)]
    df = spark.createDataFrame(rows, "det_id int, nn int, ra_deg double, dec_deg double")
    archive.write_lsd(df, str(tmp_path / "lsd"))
    pos = [(1, 55000, 0.0, 1.0), (2, 55001, rows[1][2], rows[1][3]), (3, 55000, 12.0, 89.0)]
    p = spark.createDataFrame(pos, "position_id int, p_nn int, p_ra double, p_dec double")
    got = {(x.position_id, x.det_id) for x in archive.read_lsd(spark, str(tmp_path / "lsd"), p, 3.0).collect()}
    assert got == {(i, d) for i, nn, ra, dec in pos for d, n, r2, d2 in rows if n == nn and sep((ra, dec), (r2, d2)) <= 3.0}


def test_archive_reads_only_what_positions_need(spark, tmp_path):
    """The reader opens the files that the index names: fewer positions, fewer files; batches without an index are not there."""
    r = random.Random(6)
    path = str(tmp_path / "lsd")
    for part in range(2):
        rows = [(part * 2000 + k, 55000 + k % 10, r.uniform(0, 360), r.uniform(-80, 80)) for k in range(2000)]
        archive.write_lsd(spark.createDataFrame(rows, "det_id int, nn int, ra_deg double, dec_deg double").repartition(4), path)
        every = rows if part == 0 else every + rows
    archive.with_slice(spark.createDataFrame([(9999, 55000, 10.0, 0.0)], "det_id int, nn int, ra_deg double, dec_deg double")).write.partitionBy("nn").parquet(f"{path}/detections/batch=unfinished")
    opened = []
    for n in (1, 5, 60):
        pos = [(k, 55000 + k % 10, every[k][2], every[k][3]) for k in range(n)] + [(900, 55000, 10.0, 0.0), (901, 12345, 10.0, 0.0)]
        p = spark.createDataFrame(pos, "position_id int, p_nn int, p_ra double, p_dec double")
        want = {(i, d) for i, nn, ra, dec in pos for d, m, r2, d2 in every if m == nn and sep((ra, dec), (r2, d2)) <= 0.3}
        assert {(x.position_id, x.det_id) for x in archive.read_lsd(spark, path, p, 0.3).collect()} == want
        tiles = archive.tiles_near(spark, path, p, 0.3)[1]
        rows = archive.read_tiles(spark, path, tiles)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in plan and "ra_slice" in plan.split("PushedFilters")[1]
        opened.append(len(rows.inputFiles()))
        many = archive.read_tiles(spark, path, tiles, most_files=0)
        assert {x.det_id for x in rows.collect()} <= {x.det_id for x in many.collect()}
        assert "nn" in many._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]
    there = len(spark.read.parquet(f"{path}/detections").inputFiles())
    assert opened[0] < opened[1] < opened[2] <= there and opened[0] <= 3


def test_slice_ranges():
    assert archive.slice_ranges([3]) == [(3, 3)]
    assert archive.slice_ranges([1, 2, 3, 7, 8, 20]) == [(1, 3), (7, 8), (20, 20)]
    assert archive.slice_ranges([1, 2, 3, 7, 8, 20], 2) == [(1, 8), (20, 20)]
    assert archive.slice_ranges([1, 5], 1) == [(1, 5)]


def test_components_leave_one_checkpoint(spark, tmp_path):
    """Each round's edges go when the next ones are written."""
    from nightloom.operators import graph

    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    sc.setCheckpointDir(str(tmp_path / "cp"))
    try:
        got = connected_components(spark.range(3000).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")))
        assert got.select("component").distinct().count() == 1
        folder = sc.getCheckpointDir()
        assert len([x for x in graph.children(spark, folder) if x.startswith("rdd-")]) == 1
        one = graph.cut_lineage(spark.range(10))
        assert len(graph.children(spark, folder)) == 2
        graph.forget(one, None, spark.range(3))
        assert len(graph.children(spark, folder)) == 1 and graph.children(spark, str(tmp_path / "none")) == []
    finally:
        if before:
            sc._jsc.setCheckpointDir(before)


def test_gcr_as_by_numpy(spark):
    import numpy as np

    r = random.Random(14)
    rows = []
    for k in range(120):
        ra, dec, va, vd = r.uniform(0, 360), math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-3, 3), r.uniform(-3, 3)
        noise = r.choice([0.0, 1e-5, 1e-3])
        for e in range(1 + k % 7):
            t = 55000 + r.uniform(0, 0.1)
            rows.append((k, t, (ra + va * (t - 55000) / max(0.01, math.cos(math.radians(dec))) + r.gauss(0, noise)) % 360, max(-90.0, min(90.0, dec + vd * (t - 55000) + r.gauss(0, noise)))))
    rows += [(500, 55000.0, 10.0, 10.0)] * 3 + [(501, 55000.0 + k, 30.0 * k, 5.0 * k) for k in range(6)]
    df = spark.createDataFrame(rows, "tracklet_id bigint, epoch_mjd double, ra_deg double, dec_deg double")
    got = {x.tracklet_id: x.gcr_arcsec for x in tracklets.gcr(df).collect()}
    for k in sorted({x[0] for x in rows} - {500}):
        t, ra, dec = (np.array([x[c] for x in rows if x[0] == k]) for c in (1, 2, 3))
        want = 0.0
        if len(t) > 2:
            ra, dec = np.radians(ra), np.radians(dec)
            x = np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], axis=1)
            pole = np.linalg.svd(x)[2][2]
            u = x.mean(0) - pole * (x.mean(0) @ pole)
            u /= np.linalg.norm(u)
            along, across = np.arctan2(x @ np.cross(pole, u), x @ u), np.arcsin(x @ pole)
            off = along - np.polyval(np.polyfit(t - t.mean(), along, 1), t - t.mean())
            want = float(np.degrees(np.sqrt(np.mean(off**2 + across**2))) * 3600)
        assert got[k] == pytest.approx(want, rel=1e-8, abs=1e-7), (k, len(t))
    assert got[500] == pytest.approx(0.0, abs=1e-9)


def test_noise_belongs_to_the_row(spark):
    from nightloom.functions import photometry

    df = spark.range(20000).select(F.col("id").alias("det_id"), (F.col("id") / 100.0).alias("ra_deg"), F.lit(0.0).alias("dec_deg"), F.lit(20.0).alias("mag"), F.lit(5.0).alias("s2n"))
    a, b = (photometry.perturb_positions(df.repartition(n), 7) for n in (3, 5))
    assert a.exceptAll(b).count() == 0
    assert photometry.perturb_positions(df, 8).join(a.select("det_id", F.col("mag").alias("m")), "det_id").filter("mag = m").count() == 0
    s = photometry.perturb_positions(df, 7).select(((F.col("ra_deg") - F.col("det_id") / 100.0) / F.col("ra_sigma_deg")).alias("x"), (F.col("dec_deg") / F.col("dec_sigma_deg")).alias("y"), ((F.col("mag") - 20) / F.col("mag_sigma")).alias("z"))
    row = s.agg(*[f(c) for c in "xyz" for f in (F.avg, F.stddev, F.kurtosis)], F.corr("x", "y"), F.corr("x", "z"), F.max(F.abs("x"))).first()
    for k in range(3):
        assert abs(row[3 * k]) < 0.03 and abs(row[3 * k + 1] - 1) < 0.02 and abs(row[3 * k + 2]) < 0.15
    assert abs(row[9]) < 0.03 and abs(row[10]) < 0.03 and 3 < row[11] < 6


def test_catalogue_lines(spark):
    from nightloom.sources import catalogues

    lines = ["Some header text with more than eleven words in it that say nothing of orbits", "-----", "00001    3.34  0.12 K107N 113.41048   72.58976   80.39321   10.58682  0.0791382  0.21432817   2.7653485  0 MPO110568", "", "X 1 2 I001125 200 1 2 3 0.5 0.5 2.0", "Y 1 2 K10DN 1 1 1 1 .1 1 1", "Z 1 2 K1029 x 1 1 1 0.1 1 1", "short K107N", "W 1 2 K102V 10 1 2 3 0.5 0.5 2.0"]
    rows = {r.name: r for r in catalogues.parse_catalogue(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert sorted(rows) == ["00001", "W", "X"] and rows["W"].epoch is None
    ceres = rows["00001"]
    assert ceres.epoch == 55400.0 and ceres.q == pytest.approx(2.7653485 * (1 - 0.0791382)) and ceres.time_peri == pytest.approx(55400 - 113.41048 / 0.21432817) and ceres.h_v == 3.34
    assert rows["X"].epoch == -21504 + 0.25 and rows["X"].time_peri == pytest.approx(-21504 + 0.25 + 160 / 0.5)  # 1800 January 1, and a quarter
    days = spark.range(-20000, 100000, 77).select(F.col("id").cast("double").alias("m"))
    assert days.filter(F.col("m") != catalogues.unpack_date(catalogues.pack_date(F.col("m")))).count() == 0


def test_cadence_lines(spark):
    from nightloom.sources import catalogues

    line = lambda visit, mjd, filt, ra: "\t".join({0: str(visit), 4: filt, 9: str(mjd), 10: "30", 28: str(ra), 29: "-0.5"}.get(k, "0") for k in range(49))
    lines = ["obsHistID\tsessionID", line(7, 49353.1, "z", 1.0), line(5, 49353.1, "r", 1.5), line(6, 49353.2, "g", 0.0), "not a line"]
    rows = catalogues.parse_cadence(spark.createDataFrame([(x,) for x in lines], "value string"), "I11", 24.0).orderBy("epoch_mjd").collect()
    assert [(r.epoch_mjd, r.filter_id, r.exposure_s, r.obscode) for r in rows] == [(49353.1 + 4383, "r", 30, "I11"), (49353.2 + 4383, "g", 30, "I11")]
    assert rows[0].ra_deg == pytest.approx(math.degrees(1.5)) and rows[0].dec_deg == pytest.approx(math.degrees(-0.5))
