"""Positions on the sky. All angles are degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

rad = F.radians


def normalize_radec(ra: Column, dec: Column) -> tuple[Column, Column]:
    """RA in [0, 360) and Dec in [-90, 90], going over the pole where Dec says so."""
    folded = F.pmod(dec + 180.0, F.lit(360.0)) - 180.0
    over = F.abs(folded) > 90.0
    new_dec = F.when(folded > 90.0, 180.0 - folded).when(folded < -90.0, -180.0 - folded).otherwise(folded)
    return F.pmod(ra + F.when(over, 180.0).otherwise(0.0), F.lit(360.0)), new_dec


def angle_diff(a: Column, b: Column) -> Column:
    """a - b in (-180, 180]."""
    return 180.0 - F.pmod(180.0 - (a - b), F.lit(360.0))


def separation(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance (haversine, stable at small angles)."""
    h = F.pow(F.sin(rad(dec2 - dec1) / 2), 2) + F.cos(rad(dec1)) * F.cos(rad(dec2)) * F.pow(F.sin(rad(ra2 - ra1) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), h))))


def bearing(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Direction from the first position to the second, east of north, in [0, 360)."""
    d = rad(ra2 - ra1)
    y = F.sin(d) * F.cos(rad(dec2))
    x = F.cos(rad(dec1)) * F.sin(rad(dec2)) - F.sin(rad(dec1)) * F.cos(rad(dec2)) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0))


def tangent_plane(ra0: Column, dec0: Column, ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    """(xi, eta, depth) of the projection at (ra0, dec0), in radians; only where depth > 0 it means something."""
    d = rad(ra - ra0)
    depth = F.sin(rad(dec0)) * F.sin(rad(dec)) + F.cos(rad(dec0)) * F.cos(rad(dec)) * F.cos(d)
    xi = F.try_divide(F.cos(rad(dec)) * F.sin(d), depth)
    eta = F.try_divide(F.cos(rad(dec0)) * F.sin(rad(dec)) - F.sin(rad(dec0)) * F.cos(rad(dec)) * F.cos(d), depth)
    return xi, eta, depth


def in_field(ra0: Column, dec0: Column, fov: Column, ra: Column, dec: Column) -> Column:
    """Whether a point is in a circular field of diameter ``fov``."""
    return separation(ra0, dec0, ra, dec) < fov / 2


def in_square_field(ra0: Column, dec0: Column, fov: Column, ra: Column, dec: Column) -> Column:
    """Whether a point is in a square field of side ``fov`` on the tangent plane."""
    xi, eta, depth = tangent_plane(ra0, dec0, ra, dec)
    half = rad(fov) / 2
    return (depth > 0) & (F.abs(xi) < half) & (F.abs(eta) < half)


def in_ellipse(ra0: Column, dec0: Column, major: Column, minor: Column, orient: Column, ra: Column, dec: Column, pad: float = 0.0) -> Column:
    """Whether a point is in an error ellipse: semi-axes ``major`` and ``minor`` with padding, the major one pointing ``orient`` east of north."""
    x = angle_diff(ra, ra0) * F.cos(rad(dec0))
    y = dec - dec0
    along = x * F.sin(rad(orient)) + y * F.cos(rad(orient))
    across = x * F.cos(rad(orient)) - y * F.sin(rad(orient))
    return F.pow(F.try_divide(along, major + pad), 2) + F.pow(F.try_divide(across, minor + pad), 2) <= 1.0


def xy_index(ra0: Column, dec0: Column, fov: Column, size: int, ra: Column, dec: Column, rotation: Column | None = None) -> Column:
    """Cell of a ``size`` by ``size`` grid on the field's tangent plane, clamped to it; the centre cell if the point can't be projected."""
    xi, eta, depth = tangent_plane(ra0, dec0, ra, dec)
    if rotation is not None:
        c, s = F.cos(rad(-rotation)), F.sin(rad(-rotation))
        xi, eta = xi * c - eta * s, xi * s + eta * c
    cell = lambda v: F.greatest(F.lit(0), F.least(F.lit(size - 1), F.floor((v + rad(fov) / 2) / rad(fov) * size))).cast("int")
    return F.when(depth > 0, cell(eta) * size + cell(xi)).otherwise(F.lit(size * size // 2))


def ecliptic_latitude(mjd: Column, ra: Column, dec: Column) -> Column:
    """Ecliptic latitude with the mean obliquity of date."""
    tilt = rad(23.439291 - 0.0130042 * (mjd - 51544.5) / 36525.0)
    return F.degrees(F.asin(F.sin(rad(dec)) * F.cos(tilt) - F.cos(rad(dec)) * F.sin(tilt) * F.sin(rad(ra))))


def galactic_latitude(ra: Column, dec: Column) -> Column:
    """Galactic latitude from the J2000 pole (192.85948, 27.12825)."""
    return F.degrees(F.asin(F.sin(rad(dec)) * F.sin(rad(F.lit(27.12825))) + F.cos(rad(dec)) * F.cos(rad(F.lit(27.12825))) * F.cos(rad(ra - 192.85948))))


def sun_position(mjd: Column) -> tuple[Column, Column]:
    """RA and Dec of the Sun from the Astronomical Almanac's low-precision series (about 0.01 degree)."""
    n = mjd - 51544.5
    g = rad(357.528 + 0.9856003 * n)
    longitude = rad(280.460 + 0.9856474 * n + 1.915 * F.sin(g) + 0.020 * F.sin(2 * g))
    tilt = rad(23.439 - 0.0000004 * n)
    return F.pmod(F.degrees(F.atan2(F.cos(tilt) * F.sin(longitude), F.cos(longitude))), F.lit(360.0)), F.degrees(F.asin(F.sin(tilt) * F.sin(longitude)))


def solar_elongation(mjd: Column, ra: Column, dec: Column) -> Column:
    sun_ra, sun_dec = sun_position(mjd)
    return separation(ra, dec, sun_ra, sun_dec)


def hms(ra: Column) -> Column:
    """RA as HH:MM:SS.SSS; null outside [0, 360]."""
    h = ra / 15.0
    m = (h - F.floor(h)) * 60.0
    s = (m - F.floor(m)) * 60.0
    return F.when(ra.between(0, 360), F.format_string("%02d:%02d:%06.3f", F.floor(h).cast("int"), F.floor(m).cast("int"), s))


def dms(dec: Column) -> Column:
    """Dec as +DD:MM:SS.SS; null outside [-90, 90]."""
    d = F.abs(dec)
    m = (d - F.floor(d)) * 60.0
    s = (m - F.floor(m)) * 60.0
    return F.when(dec.between(-90, 90), F.format_string("%s%02d:%02d:%05.2f", F.when(dec < 0, "-").otherwise("+"), F.floor(d).cast("int"), F.floor(m).cast("int"), s))
