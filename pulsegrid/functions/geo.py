"""Grid cells and the inverse map projection, as column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offset of the simulated network, UTM zone 30 north on the WGS84 ellipsoid.
NET_OFFSET_X = -436207.35
NET_OFFSET_Y = -4465685.32
FALSE_EASTING = 500000.0
CENTRAL_MERIDIAN = -3.0
SCALE_FACTOR = 0.9996
SEMI_MAJOR_AXIS = 6378137.0
FLATTENING = 1 / 298.257223563

# Krueger series to third order in the third flattening n (Karney 2011).
_n = FLATTENING / (2 - FLATTENING)
RADIUS = SEMI_MAJOR_AXIS / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
BETA = (
    _n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96,
    _n**2 / 48 + _n**3 / 15,
    17 * _n**3 / 480,
)
DELTA = (
    2 * _n - 2 * _n**2 / 3 - 2 * _n**3,
    7 * _n**2 / 3 - 8 * _n**3 / 5,
    56 * _n**3 / 15,
)


def grid_cell(degrees: Column, precision: int = 3) -> Column:
    """Snap a coordinate to the grid."""
    return F.round(degrees, precision)


def local_xy_to_wgs84(x: Column, y: Column, digits: int = 6) -> tuple[Column, Column]:
    """Latitude and longitude of a local network position."""
    xi = (y - NET_OFFSET_Y) / (SCALE_FACTOR * RADIUS)
    eta = (x - NET_OFFSET_X - FALSE_EASTING) / (SCALE_FACTOR * RADIUS)
    xi_p, eta_p = xi, eta
    for j, beta in enumerate(BETA, start=1):
        xi_p = xi_p - beta * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_p = eta_p - beta * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    lat = chi
    for j, delta in enumerate(DELTA, start=1):
        lat = lat + delta * F.sin(2 * j * chi)
    lon = F.atan2(F.sinh(eta_p), F.cos(xi_p))
    to_degrees = 180 / math.pi
    return (
        F.round(lat * to_degrees, digits),
        F.round(lon * to_degrees + CENTRAL_MERIDIAN, digits),
    )
