"""Magnitudes, fluxes, signal to noise and measurement errors."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import TO_V, ZERO_POINTS


def _of_filter(filt: Column, values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[filt]


def to_v(mag: Column, filt: Column, offsets: dict[str, float] | None = None) -> Column:
    """V magnitude; an unknown filter has no offset."""
    return mag + F.coalesce(_of_filter(filt, offsets or TO_V), F.lit(0.0))


def from_v(v: Column, filt: Column, offsets: dict[str, float] | None = None) -> Column:
    return v - F.coalesce(_of_filter(filt, offsets or TO_V), F.lit(0.0))


def mag_to_flux(mag: Column, s2n: Column, filt: Column) -> tuple[Column, Column]:
    """Flux and its sigma from a magnitude and S/N; null for unknown filters or S/N of 0 or less."""
    flux = F.when(s2n > 0, F.pow(F.lit(10.0), (mag - _of_filter(filt, ZERO_POINTS)) / -2.5))
    return flux, F.try_divide(flux, s2n)


def flux_to_mag(flux: Column, sigma: Column, filt: Column) -> tuple[Column, Column, Column]:
    """Magnitude, its sigma and S/N; null for unknown filters or values of 0 or less."""
    ok = (flux > 0) & (sigma > 0)
    return (
        F.when(ok, -2.5 * F.log10(flux) + _of_filter(filt, ZERO_POINTS)),
        F.when(ok & _of_filter(filt, ZERO_POINTS).isNotNull(), F.abs(2.5 * sigma / (flux * math.log(10)))),
        F.when(ok & _of_filter(filt, ZERO_POINTS).isNotNull(), flux / sigma),
    )


def magsig_to_flux(mag: Column, mag_sigma: Column, filt: Column) -> tuple[Column, Column, Column]:
    """Flux, its sigma and S/N from a magnitude and its sigma; null for unknown filters or a sigma of 0 or less."""
    flux = F.when(mag_sigma > 0, F.pow(F.lit(10.0), (mag - _of_filter(filt, ZERO_POINTS)) / -2.5))
    sigma = F.abs(mag_sigma * flux * math.log(10) / 2.5)
    return flux, sigma, F.try_divide(flux, sigma)


def predict_s2n(model: str, mag: Column, *, exposure_s: Column | float = 30.0, fwhm: Column | float = 0.6, zero: Column | float = 46.2, area: float = 2.0, diff_mag: Column | float = 0.0, sky: Column | float = 0.0, read_noise: Column | float = 5.55, scale: Column | float = 1.0) -> Column:
    """Predicted S/N of a source.

    ``model`` ``simple``, ``filter`` and ``exposure`` scale a zero-point sum with exposure time and seeing (the filter's own values
    come as columns; ``exposure`` has a magnitude offset); ``counts`` and ``scaled`` weigh the source's counts against sky and read noise, ``scaled``
    with a factor per exposure. Read noise is a column, never drawn at random.
    """
    as_col = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    exposure_s, fwhm, zero, diff_mag, sky, read_noise, scale = map(as_col, (exposure_s, fwhm, zero, diff_mag, sky, read_noise, scale))
    if model in ("simple", "filter", "exposure"):
        shift = diff_mag if model == "exposure" else F.lit(0.0)
        return area * 1.00017 * F.pow(F.lit(10.0), -0.2 * (2 * mag - zero + shift)) * F.sqrt(exposure_s / math.pi / F.pow(fwhm, 2))
    if model in ("counts", "scaled"):
        variance = F.pow(fwhm, 2) / 5.5452
        flux = F.pow(F.lit(10.0), 0.4 * (zero - mag)) * (1 - F.exp(-1 / (2 * variance)))
        s2n = flux / F.sqrt(flux + 2 * math.pi * (sky + F.pow(read_noise, 2) + 0.289))
        return F.when(fwhm > 0, s2n * scale if model == "scaled" else s2n)
    raise ValueError(f"no S/N model {model}")


def astro_error(s2n: Column, fwhm: float = 0.6) -> Column:
    """Astrometric error in arcseconds from S/N."""
    return F.when(s2n <= 1.5, 1.5).otherwise(0.070 * (fwhm / 0.6) * (5.0 / s2n))


def photo_error(s2n: Column) -> Column:
    """Photometric error in magnitudes from S/N."""
    return -2.5 * F.log10(1 - 1.0 / F.greatest(s2n, F.lit(1.5)))


def astro_error_px(s2n: Column, bias: Column, pixel_scale: Column) -> Column:
    """Astrometric error in arcseconds: a baseline and a share of a pixel, in quadrature."""
    return F.sqrt(F.pow(bias, 2) + F.pow(F.abs(pixel_scale) * 0.269230 * F.try_divide(F.lit(5.0), s2n), 2))


def gaussian_pair(key: Column, seed: int, draw: int) -> tuple[Column, Column]:
    """Two independent standard normal numbers that depend on the key, the seed and the number of the draw alone (Box and Muller on two halves of a digest)."""
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), F.lit(str(draw)), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    share = lambda at: F.conv(F.substring(digest, at, 13), 16, 10).cast("bigint") / F.lit(2.0**52)
    radius, turn = F.sqrt(-2 * F.log(1 - share(1))), 2 * math.pi * share(14)
    return radius * F.cos(turn), radius * F.sin(turn)


def perturb_positions(df: DataFrame, seed: int, ra: str = "ra_deg", dec: str = "dec_deg", mag: str = "mag", s2n: str = "s2n", key: str = "det_id") -> DataFrame:
    """Gaussian noise on positions and magnitudes after their errors, which are added as columns.

    Noise belongs to the row's ``key`` and the seed (:func:`gaussian_pair`): however the rows are partitioned, and on every rerun, a detection gets the same. A table without
    the key has nothing to tell its rows apart but their places, which number them then.
    """
    error, photo = astro_error(F.col(s2n)) / 3600.0, photo_error(F.col(s2n))
    name = F.col(key) if key in df.columns else F.monotonically_increasing_id()
    (east, north), (bright, _) = gaussian_pair(name, seed, 0), gaussian_pair(name, seed, 1)
    return df.withColumns(
        {
            ra: F.col(ra) + error * east / F.cos(F.radians(dec)), dec: F.col(dec) + error * north, mag: F.col(mag) + photo * bright,
            "ra_sigma_deg": error, "dec_sigma_deg": error, "mag_sigma": photo,
        }
    )


def apply_astrometry_policy(sigma: Column, floor: float, maximum: float, force: float | None = None) -> Column:
    """The forced sigma, or the floor added in quadrature and capped."""
    return F.lit(float(force)) if force is not None else F.least(F.lit(float(maximum)), F.sqrt(floor * floor + sigma * sigma))


EXTENDED_FIT = 0x20000000


def resolve_trail_columns(df: DataFrame, pixel_scale: float, flag: int = EXTENDED_FIT) -> DataFrame:
    """Positions and magnitudes of the extended fit where ``flags`` has the bit, else of the point-source fit; lengths in degrees."""
    ext = F.col("flags").bitwiseAND(flag) != 0
    pick = lambda a, b: F.when(ext, F.col(a)).otherwise(b)
    return df.withColumns(
        {
            "ra_deg": F.pmod(pick("ext_ra", F.col("psf_ra")), F.lit(360.0)), "dec_deg": pick("ext_dec", F.col("psf_dec")), "mag": pick("ext_mag", F.col("psf_mag")),
            "orient_deg": F.when(ext, F.pmod(F.degrees("ext_theta") + 90.0, F.lit(360.0))).otherwise(0.0),
            "length_deg": F.when(ext, F.col("ext_major_px") * pixel_scale / 3600.0).otherwise(0.0),
        }
    )


def normalize_trail_length(length: Column, exposure_s: Column, standard_s: float = 30.0) -> Column:
    """A trail's length as it would be after a standard exposure."""
    return F.when(exposure_s > 0, length * standard_s / exposure_s)


def morphology_axes(xx: Column, xy: Column, yy: Column) -> tuple[Column, Column, Column]:
    """Major and minor axis and angle (degrees) from second moments."""
    middle, half = (xx + yy) / 2, F.sqrt(F.pow((xx - yy) / 2, 2) + F.pow(xy, 2))
    return F.sqrt(middle + half), F.sqrt(F.greatest(F.lit(0.0), middle - half)), F.degrees(F.atan2(2 * xy, xx - yy) / 2)
