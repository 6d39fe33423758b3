"""Pixel algebra, physics and statistics as Column expressions. Missing values are null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, Settings

EPS = 1e-6
# Radiation constants in W um4 m-2 sr-1 and um K.
C1, C2 = 1.191042e8, 1.4387752e4


def known(c: Column) -> Column:
    """NaN and infinities become null, so that aggregates skip them."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def ratio(a: Column, b: Column) -> Column:
    """(a - b) / (a + b): NDVI of nir and red, NDWI of green and nir, NHI of swir2 and swir1, redness of red and blue."""
    return (a - b) / (a + b + EPS)


def brightness(r: Column, g: Column, b: Column) -> Column:
    return (r + g + b) / 3


def nodata_if_zero(value: Column, *bands: Column) -> Column:
    """Null where every band is zero or missing."""
    empty = F.lit(True)
    for b in bands:
        empty = empty & (F.coalesce(b, F.lit(0.0)) == 0)
    return F.when(~empty, value)


def bits_clear(qa: Column, mask: int = DEFAULT.qa_reject) -> Column:
    return qa.bitwiseAND(F.lit(mask)) == 0


def bit_field(flags: Column, first: int, width: int) -> Column:
    """The number in width bits of a flag word, from bit `first` on; null for null."""
    return F.shiftrightunsigned(flags.cast("long"), first).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def clear_class(scl: Column) -> Column:
    """Scene classes other than shadow, clouds, cirrus and snow."""
    return ~scl.isin(3, 8, 9, 10, 11)


def landsat_celsius(dn: Column) -> Column:
    return dn * 0.00341802 + 149.0 - 273.15


def clip(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def quantised(z: Column, base: float = 150.0, step: float = 0.01) -> Column:
    """Surface heights as unsigned 16-bit steps; 0 is no data."""
    return F.coalesce(clip(F.rint((z - base) / step), 1, 65535), F.lit(0.0)).cast("int")


def hillshade(gx: Column, gy: Column, azimuth: float = 315.0, altitude: float = 45.0) -> Column:
    """Light on a surface of these gradients, 0 to 1."""
    from math import cos, radians, sin

    az, alt = radians(azimuth), radians(altitude)
    slope, aspect = F.atan(F.hypot(gx, gy)), F.atan2(-gx, gy)
    light = F.lit(sin(alt)) * F.cos(slope) + F.lit(cos(alt)) * F.sin(slope) * F.cos(F.lit(az) - aspect)
    return clip(light, 0, 1)


def radiance(kelvin: Column, um: float = DEFAULT.wavelength_um) -> Column:
    return F.lit(C1) / (F.lit(um**5) * (F.exp(F.lit(C2 / um) / kelvin) - 1))


def kelvin(radiance: Column, um: float = DEFAULT.wavelength_um) -> Column:
    """Null for radiances that no temperature has."""
    return F.when(radiance > 0, F.lit(C2 / um) / F.ln(F.lit(C1 / um**5) / radiance + 1))


def hotspot_celsius(observed: Column, background: Column, area: float, footprint: Column | float, um: float = DEFAULT.wavelength_um) -> Column:
    """Temperature that a spot of area m2 needs to lift a footprint's mean radiance to the observed one."""
    share = F.least(F.lit(area) / (F.lit(footprint) if isinstance(footprint, (int, float)) else footprint) ** 2, F.lit(1.0))
    spot = (radiance(observed + 273.15, um) - (1 - share) * radiance(background + 273.15, um)) / share
    return kelvin(spot, um) - 273.15


def detectable_celsius(background: Column, sigma: Column, footprint: Column | float, s: Settings = DEFAULT) -> Column:
    """Coolest spot of the settings' size that stands out by their number of sigmas."""
    return hotspot_celsius(background + s.anomaly_sigma * sigma, background, s.hotspot_side_m**2, footprint, s.wavelength_um)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """Probability of k or more hits in n tries: terms by recurrence, from the most likely end."""

    def step(acc: Column, j: Column) -> Column:
        term = F.when(j == 0, F.pow(F.lit(1 - p), n)).otherwise(acc.term * (n - j + 1) / j * (p / (1 - p)))
        return F.struct(term.alias("term"), (acc.total + F.when(j >= k, term).otherwise(0.0)).alias("total"))

    zero = F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("total"))
    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint")), zero, step, lambda a: a.total)


def rounded(c: Column, digits: int = 4) -> Column:
    """Rounded with a nudge, so that other engines' last bits don't matter."""
    return F.round(c + 3.1415926e-8, digits) + 0.0


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)
