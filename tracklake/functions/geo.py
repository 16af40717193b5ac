"""Geohash and UTM as column expressions (Karney/Krueger series to third order, WGS84)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
_CELLS = 1 << 30


def geohash(lat: Column, lon: Column) -> Column:
    """Twelve-character geohash: 30 bits per axis, longitude first, five bits per character."""

    def scaled(value: Column, half: float) -> Column:
        cell = F.floor((value + half) / (2 * half) * _CELLS).cast("bigint")
        return F.least(F.greatest(cell, F.lit(0)), F.lit(_CELLS - 1))

    x, y = scaled(lon, 180.0), scaled(lat, 90.0)

    def bit(axis: Column, place: int, weight: int) -> Column:
        return F.shiftleft(F.shiftright(axis, place).bitwiseAND(F.lit(1)), weight)

    chars = []
    for index in range(12):
        code = F.lit(0).cast("bigint")
        for k in range(5):
            position = index * 5 + k
            axis = x if position % 2 == 0 else y
            code = code + bit(axis, 29 - position // 2, 4 - k)
        chars.append(F.substring(F.lit(_ALPHABET), code.cast("int") + 1, F.lit(1)))
    return F.concat(*chars)


_A = 6378137.0
_F = 1 / 298.257223563
_N = _F / (2 - _F)
_K0 = 0.9996
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_C = 2 * math.sqrt(_N) / (1 + _N)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
)


@dataclass(frozen=True)
class Zone:
    """A UTM zone, chosen once per run and then a literal in every plan."""

    number: int
    northern: bool

    @property
    def meridian(self) -> float:
        return 6.0 * self.number - 183.0

    @property
    def false_northing(self) -> float:
        return 0.0 if self.northern else 1e7

    @property
    def epsg(self) -> str:
        return str((32600 if self.northern else 32700) + self.number)


def zone_of(lat: float, lon: float) -> Zone:
    """Zone of one position, with the usual Norway and Svalbard exceptions."""
    number = min(int((lon + 180.0) // 6) + 1, 60)
    if 56 <= lat < 64 and 3 <= lon < 12:
        number = 32
    elif 72 <= lat < 84 and 0 <= lon < 42:
        number = 31 if lon < 9 else 33 if lon < 21 else 35 if lon < 33 else 37
    return Zone(number, lat >= 0)


def to_utm(lat: Column, lon: Column, zone: Zone) -> tuple[Column, Column]:
    """(easting, northing) in metres."""
    phi, dlon = F.radians(lat), F.radians(lon - zone.meridian)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(_C) * F.atanh(F.lit(_C) * s))
    xi = F.atan2(t, F.cos(dlon))
    eta = F.atanh(F.sin(dlon) / F.sqrt(F.lit(1.0) + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    scale = _K0 * _RADIUS
    return F.lit(500000.0) + F.lit(scale) * east, F.lit(zone.false_northing) + F.lit(scale) * north


def from_utm(easting: Column, northing: Column, zone: Zone) -> tuple[Column, Column]:
    """(lat, lon) in degrees."""
    scale = _K0 * _RADIUS
    xi = (northing - zone.false_northing) / scale
    eta = (easting - 500000.0) / scale
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi0 = xi0 - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta0 = eta0 - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    lam = F.lit(zone.meridian) + F.degrees(F.atan2(F.sinh(eta0), F.cos(xi0)))
    return F.degrees(phi), lam
