"""Coordinates: transverse Mercator of UTM zones and web Mercator as Column expressions."""

from __future__ import annotations

from math import atan, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid and the projection's scale and false easting.
A, FLATTENING = 6378137.0, 1 / 298.257222101
SCALE, EASTING = 0.9996, 500000.0
_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Kruger's series to the third order.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def to_utm(lon: Column, lat: Column, meridian: float = 9.0) -> tuple[Column, Column]:
    """Degrees -> easting and northing in metres (zone 32 by default)."""
    e = 2 * sqrt(_N) / (1 + _N)
    phi, lam = F.radians(lat), F.radians(lon - meridian)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.lit(EASTING) + SCALE * _RECTIFYING * x, SCALE * _RECTIFYING * y


def from_utm(x: Column, y: Column, meridian: float = 9.0) -> tuple[Column, Column]:
    """Easting and northing -> degrees."""
    xi, eta = y / (SCALE * _RECTIFYING), (x - EASTING) / (SCALE * _RECTIFYING)
    xi2, eta2 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi2 = xi2 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta2 = eta2 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi2) / F.cosh(eta2))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.lit(meridian) + F.degrees(F.atan2(F.sinh(eta2), F.cos(xi2))), F.degrees(lat)


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees -> web Mercator metres."""
    return F.radians(lon) * A, F.ln(F.tan(F.radians(lat) / 2 + F.lit(atan(1.0)))) * A
