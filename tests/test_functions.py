"""Scalar functions against values worked out by hand or from published formulas."""

import math

import pytest
from pyspark.sql import functions as F

from nightloom.functions import orbits, photometry, sky, timefn


def value(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()
    return row[0] if len(columns) == 1 else tuple(row)


def test_night_and_lunation(spark):
    assert value(spark, timefn.night_number(F.lit(54593.4), -10.0)) == 54592
    assert value(spark, timefn.night_start(F.lit(54592), -10.0)) == pytest.approx(54592.5 + 10 / 24)
    assert value(spark, timefn.lunation(F.lit(51564.0)), timefn.lunation(F.lit(51563.9))) == (0, -1)
    assert value(spark, timefn.jd_to_mjd(F.lit(2451545.0))) == 51544.5


def test_calendar(spark):
    got = value(spark, timefn.ut_to_mjd(F.lit(2000), F.lit(1), F.lit(1), F.lit(12), F.lit(0), F.lit(0)))
    assert got == pytest.approx(51544.5)
    assert value(spark, timefn.mjd_to_utc(F.lit(51544.5)), timefn.mjd_to_local(F.lit(51544.5), -10.0, " ")) == ("2000-01-01T12:00:00.0Z", "2000-01-01 02:00:00.0")


@pytest.mark.parametrize("ra, dec, want", [(10.0, 20.0, (10.0, 20.0)), (-5.0, 0.0, (355.0, 0.0)), (10.0, 95.0, (190.0, 85.0)), (200.0, -100.0, (20.0, -80.0)), (370.0, 90.0, (10.0, 90.0))])
def test_normalize(spark, ra, dec, want):
    assert value(spark, *sky.normalize_radec(F.lit(ra), F.lit(dec))) == pytest.approx(want)


@pytest.mark.parametrize("a, b, want", [(10.0, 350.0, 20.0), (350.0, 10.0, -20.0), (180.0, 0.0, 180.0), (0.0, 180.0, 180.0), (5.0, 5.0, 0.0)])
def test_angle_diff(spark, a, b, want):
    assert value(spark, sky.angle_diff(F.lit(a), F.lit(b))) == pytest.approx(want)


def test_separation_and_bearing(spark):
    assert value(spark, sky.separation(F.lit(359.9), F.lit(0.0), F.lit(0.1), F.lit(0.0))) == pytest.approx(0.2)
    assert value(spark, sky.separation(F.lit(0.0), F.lit(90.0), F.lit(123.0), F.lit(89.0))) == pytest.approx(1.0)
    assert value(spark, sky.bearing(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) == pytest.approx(90.0)


def test_fields_at_a_pole(spark):
    assert value(spark, sky.in_field(F.lit(0.0), F.lit(90.0), F.lit(3.0), F.lit(77.0), F.lit(89.0))) is True
    assert value(spark, sky.in_square_field(F.lit(0.0), F.lit(90.0), F.lit(3.0), F.lit(180.0), F.lit(-90.0))) is False
    assert value(spark, sky.xy_index(F.lit(10.0), F.lit(0.0), F.lit(3.0), 20, F.lit(10.0), F.lit(0.0))) == 210


def test_text_forms(spark):
    assert value(spark, sky.hms(F.lit(15.0)), sky.dms(F.lit(-0.5)), sky.hms(F.lit(400.0))) == ("01:00:00.000", "-00:30:00.00", None)


def test_sun(spark):
    # the March equinox of 2000 fell on day 51623.32
    ra, dec = value(spark, *sky.sun_position(F.lit(51623.32)))
    assert min(ra, 360 - ra) < 0.02 and abs(dec) < 0.02


def test_photometry(spark):
    assert value(spark, photometry.to_v(F.lit(20.0), F.lit("r")), photometry.from_v(F.lit(20.0), F.lit("?"))) == (pytest.approx(20.23), 20.0)
    flux, sigma = value(spark, *photometry.mag_to_flux(F.lit(25.1), F.lit(10.0), F.lit("r")))
    assert (flux, sigma) == pytest.approx((1.0, 0.1))
    assert value(spark, *photometry.flux_to_mag(F.lit(1.0), F.lit(0.1), F.lit("r"))) == pytest.approx((25.1, 0.1085736, 10.0), rel=1e-5)
    assert value(spark, *photometry.mag_to_flux(F.lit(20.0), F.lit(0.0), F.lit("r"))) == (None, None)
    assert value(spark, photometry.photo_error(F.lit(10.0))) == pytest.approx(-2.5 * math.log10(0.9))


@pytest.mark.parametrize("q, e, i, moid, want", [(1.0, 0.5, 5.0, 0.04, "PHO"), (1.0, 0.5, 5.0, 0.2, "NEO"), (1.5, 0.3, 5.0, None, "MC"), (2.0, 0.2, 5.0, None, "MB"), (5.1, 0.02, 5.0, None, "TRO"), (10.0, 0.1, 5.0, None, "CEN"), (40.0, 0.1, 5.0, None, "TNO"), (45.0, 0.5, 5.0, None, "SDO"), (2.0, 1.1, 5.0, None, "HYP"), (2.0, 1.0, 5.0, None, "UNK")])
def test_classes(spark, q, e, i, moid, want):
    got = value(spark, orbits.classify_orbit(F.lit(q), F.lit(e), F.lit(i), F.lit(moid).cast("double"), F.lit(None).cast("double")))
    assert got == want


def test_d_criterion(spark):
    a = {k: F.lit(v) for k, v in {"q": 1.0, "e": 0.1, "i": 10.0, "node": 20.0, "arg_peri": 30.0}.items()}
    assert value(spark, *orbits.d_criterion(a, a)) == pytest.approx((0.0, 0.0), abs=1e-7)
    b = a | {"q": F.lit(1.3)}
    assert value(spark, *orbits.d_criterion(a, b)) == pytest.approx((0.3, 0.3), abs=1e-7)


def test_names(spark):
    df = spark.range(200).toDF("k")
    rows = {r["k"]: r["name"] for r in orbits.assign_names(df, "L000", ["k"]).collect()}
    assert rows[0] == "L000" and rows[61] == "L00Z" and rows[62] == "L010" and rows[199] == "L03d"
    assert value(spark, orbits.from_base62(F.lit("10"))) == 62


def test_noise_is_as_large_as_its_errors(spark):
    df = spark.range(4000).select(F.lit(10.0).alias("ra_deg"), F.lit(0.0).alias("dec_deg"), F.lit(20.0).alias("mag"), F.lit(10.0).alias("s2n"))
    got = photometry.perturb_positions(df, 3).agg(F.stddev("dec_deg"), F.avg("dec_deg"), F.first("dec_sigma_deg")).first()
    assert got[0] == pytest.approx(got[2], rel=0.1) and abs(got[1]) < got[2] / 10


def test_efficiency_fit(spark):
    """Curves made from the model come back; with noise the gradient vanishes, but for eff0 and w at their bounds; few bins are left out."""
    import numpy as np

    from nightloom.operators.efficiency import fit_efficiency

    r = np.random.default_rng(4)
    rows, made = [], {}
    for g in range(12):
        e, limit, w = r.uniform(0.5, 1.0), r.uniform(20, 23), r.uniform(0.1, 0.8)
        m = np.arange(18, 25, 0.5)
        y = e / (1 + np.exp((m - limit) / w)) + (0 if g < 6 else r.normal(0, 0.03, len(m)))
        made[g] = (e, limit, w, m, y)
        rows += [(g, float(a), float(b)) for a, b in zip(m, y, strict=True)]
    rows += [(99, 20.0, 0.5), (99, 21.0, 0.4), (99, 22.0, 0.1)]
    got = {x.g: (x.eff0, x.limit, x.width) for x in fit_efficiency(spark.createDataFrame(rows, "g int, mag_start double, efficiency double").repartition(3), ["g"]).collect()}
    assert sorted(got) == list(range(12))
    for g, (e, limit, w, m, y) in made.items():
        a, b, c = got[g]
        if g < 6:
            assert (a, b, c) == pytest.approx((e, limit, w), abs=1e-5)
        s = 1 / (1 + np.exp((m - b) / c))
        left = y - a * s
        slopes = [left @ s, left @ (a * s * (1 - s) / c), left @ (a * s * (1 - s) * (m - b) / c**2)]
        assert abs(slopes[1]) < 1e-5 and (abs(slopes[0]) < 1e-5 or a == 1.0 and slopes[0] > 0) and abs(slopes[2]) < 1e-5
