"""Map projections as column arithmetic on the GRS80 ellipsoid.

WGS84 and NAD83 are treated as one datum. Formulas: Snyder, *Map Projections: A
Working Manual* (USGS PP 1395) for the conic; Karney, *Transverse Mercator with
an accuracy of a few nanometers* (2011) and *On auxiliary latitudes* (2022) for
the series in the third flattening. All are closed expressions, so a projection
stays inside one generated stage: no Python worker, no iteration, no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from bioobs.functions.text import ColumnOrName, _col

# GRS80
A = 6378137.0
FLATTENING = 1 / 298.257222101
E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)
N3 = FLATTENING / (2 - FLATTENING)


def _powers(*coefficients: float) -> float:
    """c1*n + c2*n^2 + … with n the third flattening."""
    return sum(c * N3 ** (i + 1) for i, c in enumerate(coefficients))


def _sine_series(angle, terms: list[float], m=F):
    total = angle
    for j, t in enumerate(terms, start=1):
        total = total + t * m.sin(angle * (2 * j))
    return total


# ----------------------------------------------------------- equal-area conic


def _q(sin_lat: float) -> float:
    s = sin_lat
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E * s) / (1 + E * s)) / (2 * E))


Q_POLE = _q(1.0)

# geographic latitude from authalic latitude, to n^6
_FROM_AUTHALIC = [
    _powers(4 / 3, 4 / 45, -16 / 35, -2582 / 14175, 60136 / 467775, 28112932 / 212837625),
    _powers(0, 46 / 45, 152 / 945, -11966 / 14175, -21016 / 51975, 251310128 / 638512875),
    _powers(0, 0, 3044 / 2835, 3802 / 14175, -94388 / 66825, -8797648 / 10945935),
    _powers(0, 0, 0, 6059 / 4725, 41072 / 93555, -1472637812 / 638512875),
    _powers(0, 0, 0, 0, 768272 / 467775, 455935736 / 638512875),
    _powers(0, 0, 0, 0, 0, 4210684958 / 1915538625),
]


@dataclass(frozen=True)
class EqualAreaConic:
    """Albers projection with two standard parallels, degrees and metres."""

    lat_0: float
    lon_0: float
    lat_1: float
    lat_2: float
    x_0: float = 0.0
    y_0: float = 0.0

    def _m(self, lat: float) -> float:
        s = math.sin(math.radians(lat))
        return math.cos(math.radians(lat)) / math.sqrt(1 - E2 * s * s)

    @property
    def n(self) -> float:
        q1, q2 = (_q(math.sin(math.radians(v))) for v in (self.lat_1, self.lat_2))
        return (self._m(self.lat_1) ** 2 - self._m(self.lat_2) ** 2) / (q2 - q1)

    @property
    def c(self) -> float:
        return self._m(self.lat_1) ** 2 + self.n * _q(math.sin(math.radians(self.lat_1)))

    @property
    def rho_0(self) -> float:
        return A * math.sqrt(self.c - self.n * _q(math.sin(math.radians(self.lat_0)))) / self.n

    def forward(self, lon: ColumnOrName, lat: ColumnOrName) -> tuple[Column, Column]:
        """Degrees to metres."""
        s = F.sin(F.radians(_col(lat)))
        q = (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - E * s) / (1 + E * s)) / (2 * E))
        rho = F.sqrt(F.lit(self.c) - self.n * q) * (A / self.n)
        theta = F.radians(_col(lon) - self.lon_0) * self.n
        return self.x_0 + rho * F.sin(theta), (self.y_0 + self.rho_0) - rho * F.cos(theta)

    def inverse(self, x: ColumnOrName, y: ColumnOrName) -> tuple[Column, Column]:
        """Metres to degrees."""
        dx = _col(x) - self.x_0
        dy = (self.y_0 + self.rho_0) - _col(y)
        q = (self.c - (dx * dx + dy * dy) * (self.n / A) ** 2) / self.n
        authalic = F.asin(q / Q_POLE)
        lon = F.degrees(F.atan2(dx, dy) / self.n) + self.lon_0
        return lon, F.degrees(_sine_series(authalic, _FROM_AUTHALIC))

    def lon_lat_envelope(self, x_min, y_min, x_max, y_max) -> tuple[float, float, float, float]:
        """Degrees that surely contain a rectangle given in metres.

        Latitude depends on the distance to the cone's apex alone and longitude
        on the angle there alone, so the extremes sit at known places.
        """
        top = self.y_0 + self.rho_0
        xs = (x_min - self.x_0, x_max - self.x_0)
        ys = (top - y_min, top - y_max)
        if ys[1] <= 0:  # the rectangle reaches past the apex
            return -180.0, -90.0, 180.0, 90.0
        near_x = 0.0 if xs[0] <= 0 <= xs[1] else min(map(abs, xs))
        rho = (math.hypot(near_x, ys[1]), math.hypot(max(map(abs, xs)), ys[0]))
        lats = []
        for r in rho:
            q = (self.c - (r * self.n / A) ** 2) / self.n
            b = math.asin(max(-1.0, min(1.0, q / Q_POLE)))
            lats.append(
                math.degrees(
                    b + sum(t * math.sin(2 * j * b) for j, t in enumerate(_FROM_AUTHALIC, 1))
                )
            )
        lons = [self.lon_0 + math.degrees(math.atan2(x, y) / self.n) for x in xs for y in ys]
        pad = 1e-7
        return min(lons) - pad, min(lats) - pad, max(lons) + pad, max(lats) + pad


# fixed values: the projected systems the jobs use, by EPSG code
BC_ALBERS = EqualAreaConic(lat_0=45.0, lon_0=-126.0, lat_1=50.0, lat_2=58.5, x_0=1_000_000.0)


# -------------------------------------------------------- transverse Mercator

_RECTIFYING_RADIUS = A / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64 + N3**6 / 256)

# conformal to rectifying and back, to n^4
_ALPHA = [
    _powers(1 / 2, -2 / 3, 5 / 16, 41 / 180),
    _powers(0, 13 / 48, -3 / 5, 557 / 1440),
    _powers(0, 0, 61 / 240, -103 / 140),
    _powers(0, 0, 0, 49561 / 161280),
]
_BETA = [
    _powers(1 / 2, -2 / 3, 37 / 96, -1 / 360),
    _powers(0, 1 / 48, 1 / 15, -437 / 1440),
    _powers(0, 0, 17 / 480, -37 / 840),
    _powers(0, 0, 0, 4397 / 161280),
]
# geographic latitude from conformal latitude, to n^6
_FROM_CONFORMAL = [
    _powers(2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675),
    _powers(0, 7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945),
    _powers(0, 0, 56 / 15, -136 / 35, -1262 / 105, 73814 / 2835),
    _powers(0, 0, 0, 4279 / 630, -332 / 35, -399572 / 14175),
    _powers(0, 0, 0, 0, 4174 / 315, -144838 / 6237),
    _powers(0, 0, 0, 0, 0, 601676 / 22275),
]


@dataclass(frozen=True)
class TransverseMercator:
    """A UTM-style zone, degrees and metres."""

    lon_0: float
    scale: float = 0.9996
    x_0: float = 500_000.0
    y_0: float = 0.0

    def forward(self, lon: ColumnOrName, lat: ColumnOrName) -> tuple[Column, Column]:
        phi = F.radians(_col(lat))
        lam = F.radians(_col(lon) - self.lon_0)
        s = F.sin(phi)
        t = F.sinh(F.atanh(s) - E * F.atanh(E * s))
        xi = F.atan2(t, F.cos(lam))
        eta = F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
        north, east = xi, eta
        for j, a in enumerate(_ALPHA, start=1):
            north = north + a * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j))
            east = east + a * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j))
        k = self.scale * _RECTIFYING_RADIUS
        return self.x_0 + k * east, self.y_0 + k * north

    def inverse(self, x: ColumnOrName, y: ColumnOrName) -> tuple[Column, Column]:
        return self._inverse(_col(x), _col(y), F)

    def _inverse(self, x, y, m):
        """The same formulas on columns (``m`` is ``F``) or numbers (``math``)."""
        k = self.scale * _RECTIFYING_RADIUS
        north, east = (y - self.y_0) / k, (x - self.x_0) / k
        xi, eta = north, east
        for j, b in enumerate(_BETA, start=1):
            xi = xi - b * m.sin(north * (2 * j)) * m.cosh(east * (2 * j))
            eta = eta - b * m.cos(north * (2 * j)) * m.sinh(east * (2 * j))
        conformal = m.asin(m.sin(xi) / m.cosh(eta))
        lon = m.degrees(m.atan2(m.sinh(eta), m.cos(xi))) + self.lon_0
        return lon, m.degrees(_sine_series(conformal, _FROM_CONFORMAL, m))

    def lon_lat_envelope(self, x_min, y_min, x_max, y_max) -> tuple[float, float, float, float]:
        """Degrees that surely contain a box within 2,000 km of the central meridian.

        Away from that meridian longitudes spread towards the poles and latitudes
        fall towards the equator, so the extremes lie at corners or where the box
        meets the meridian or the equator. Any other box gives the whole globe.
        """
        if max(abs(x_min - self.x_0), abs(x_max - self.x_0)) > 2e6 or max(abs(y_min - self.y_0), abs(y_max - self.y_0)) > 9e6:
            return -360.0, -90.0, 360.0, 90.0
        xs = (x_min, x_max, min(max(self.x_0, x_min), x_max))
        ys = (y_min, y_max, min(max(self.y_0, y_min), y_max))
        lons, lats = zip(*(self._inverse(x, y, math) for x in xs for y in ys))
        return min(lons) - 1e-6, min(lats) - 1e-6, max(lons) + 1e-6, max(lats) + 1e-6


UTM_10N = TransverseMercator(lon_0=-123.0)

PROJECTIONS = {3005: BC_ALBERS, 32610: UTM_10N}


def reproject(x: ColumnOrName, y: ColumnOrName, source: int, target: int) -> tuple[Column, Column]:
    """Columns in another coordinate system, named by EPSG codes (4326 is degrees)."""
    for srid in (source, target):
        if srid != 4326 and srid not in PROJECTIONS:
            raise ValueError(f"no projection for EPSG:{srid}")
    if source == target:
        return _col(x), _col(y)
    lon, lat = (_col(x), _col(y)) if source == 4326 else PROJECTIONS[source].inverse(x, y)
    return (lon, lat) if target == 4326 else PROJECTIONS[target].forward(lon, lat)
