"""Column functions that stay in the JVM: points, numbers, references, codes, distances and directions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeforge.constants import EARTH_KM, TLD_OVERRIDES

_POINT = r"(?i)^POINT\(([-0-9.eE]+)\s+([-0-9.eE]+)\)$"
SECTORS = ("north", "northeast", "east", "southeast", "south", "southwest", "west", "northwest")


def parse_point(c: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of 'Point(lng lat)' in any case; nulls for anything else, malformed numbers too."""
    lat, lng = _part(c, 2), _part(c, 1)
    return F.when(lng.isNotNull(), lat), F.when(lat.isNotNull(), lng)


def _part(c: Column, k: int) -> Column:
    return F.nullif(F.regexp_extract(c, _POINT, k), F.lit("")).try_cast("double")


def parse_int(c: Column) -> Column:
    """Whole part of a decimal text, towards zero; null for bad text, infinity and overflow."""
    return F.nullif(c, F.lit("")).try_cast("double").try_cast("bigint")


def parse_float(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("double")


def reference(c: Column) -> Column:
    """A reference to an entity ('Q…'), or null."""
    return F.when(c.startswith("Q"), c)


def first_reference(c: Column) -> Column:
    """The first element of a list that is a reference, as a number."""
    return F.get(F.filter(c, lambda x: x.rlike(r"^Q[0-9]+$")), F.lit(0)).substr(2, 20).try_cast("bigint")


def with_prefix(codes: Column, iso2: Column) -> Column:
    """The codes of a list that start with '<ISO2>-'."""
    return F.filter(codes, lambda x: x.startswith(F.concat(iso2, F.lit("-"))))


def flag(c: Column) -> Column:
    """The flag of a two-letter code: its letters as regional indicators."""
    up = F.upper(c)
    sign = lambda k: F.decode(F.unhex(F.concat(F.lit("F09F87"), F.hex(F.ascii(up.substr(k, 1)) + F.lit(0xA6 - 65)))), "UTF-8")
    return F.when(c.rlike(r"^[A-Za-z]{2}\z"), F.concat(sign(1), sign(2)))


def country_tld(c: Column) -> Column:
    out = F.concat(F.lit("."), F.lower(c))
    for code, tld in TLD_OVERRIDES.items():
        out = F.when(F.upper(c) == code, tld).otherwise(out)
    return F.when(F.length(c) == 2, out)


def distance_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lng2) - F.radians(lng1)) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(h))


def sector(lat: Column, lng: Column, lat0: Column, lng0: Column) -> Column:
    """Which eighth of the compass a point is in, seen from (lat0, lng0)."""
    a, b, d = F.radians(lat0), F.radians(lat), F.radians(lng - lng0)
    y = F.sin(d) * F.cos(b)
    x = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)
    k = (F.floor((F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0)) + 22.5) / 45) % 8).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in SECTORS]), k + 1)


def cell(c: Column, size: float = 1.0) -> Column:
    """The grid cell of a coordinate."""
    return F.floor(c / F.lit(size)).cast("int")
