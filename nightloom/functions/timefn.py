"""Times: night numbers, lunations, calendars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import LUNATION_DAYS, LUNATION_ZERO_JD, MJD_JD

#: The Unix epoch as a modified Julian date.
UNIX_MJD = 40587


def night_number(mjd: Column, offset_hours: float) -> Column:
    """The integer MJD at the trailing edge of local noon."""
    return F.floor(mjd - 0.5 + offset_hours / 24.0)


def night_start(nn: Column, offset_hours: float) -> Column:
    """The MJD at which a night number begins."""
    return nn + 0.5 - offset_hours / 24.0


def lunation(mjd: Column) -> Column:
    """The lunation number, which changes at 0h UT."""
    midnight = F.floor(mjd + (MJD_JD - 0.5)) + 0.5
    return F.floor((midnight - LUNATION_ZERO_JD) / LUNATION_DAYS + 1e-11)


def lunation_start(number: Column) -> Column:
    """The MJD at which a lunation begins."""
    return F.floor(LUNATION_ZERO_JD + LUNATION_DAYS * number) - MJD_JD


def jd_to_mjd(jd: Column) -> Column:
    return jd - MJD_JD


def mjd_to_jd(mjd: Column) -> Column:
    return mjd + MJD_JD


def ut_to_mjd(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """A calendar date and time (UTC) as MJD."""
    days = F.datediff(F.make_date(year, month, day), F.to_date(F.lit("1970-01-01")))
    return days + UNIX_MJD + ((hour * 60 + minute) * 60 + second) / 86400.0


def _text(mjd: Column, separator: str, suffix: str) -> Column:
    seconds = F.floor(mjd * 86400.0 + 0.5).cast("bigint") - UNIX_MJD * 86400
    day = F.floor(seconds / 86400).cast("int")
    rest = F.pmod(seconds, F.lit(86400))
    date = F.date_format(F.date_add(F.to_date(F.lit("1970-01-01")), day), "yyyy-MM-dd")
    return F.concat(date, F.lit(separator), F.format_string("%02d:%02d:%02d.0", F.floor(rest / 3600).cast("int"), (F.floor(rest / 60) % 60).cast("int"), (rest % 60).cast("int")), F.lit(suffix))


def mjd_to_utc(mjd: Column, separator: str = "T") -> Column:
    """UTC text, to the nearest second."""
    return _text(mjd, separator, "Z")


def mjd_to_local(mjd: Column, offset_hours: float, separator: str = "T") -> Column:
    """Local time as text, to the nearest second."""
    return _text(mjd + offset_hours / 24.0, separator, "")
