"""Longitude/latitude <-> UTM metres as column expressions.

Kruger's series in the third flattening, to order six (coefficients as published by
Karney, "Transverse Mercator with an accuracy of a few nanometers", 2011).
"""

import math

from pyspark.sql import functions as F

from fieldlens.constants import (
    CENTRAL_MERIDIAN, FALSE_EASTING, FLATTENING, SCALE_FACTOR, SEMI_MAJOR_AXIS,
)

N = FLATTENING / (2 - FLATTENING)
ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))
RADIUS = SEMI_MAJOR_AXIS / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)

# --- fixed values: series coefficients by power of n ------------------------
FORWARD_SERIES = (
    {1: 1 / 2, 2: -2 / 3, 3: 5 / 16, 4: 41 / 180, 5: -127 / 288, 6: 7891 / 37800},
    {2: 13 / 48, 3: -3 / 5, 4: 557 / 1440, 5: 281 / 630, 6: -1983433 / 1935360},
    {3: 61 / 240, 4: -103 / 140, 5: 15061 / 26880, 6: 167603 / 181440},
    {4: 49561 / 161280, 5: -179 / 168, 6: 6601661 / 7257600},
    {5: 34729 / 80640, 6: -3418889 / 1995840},
    {6: 212378941 / 319334400},
)
INVERSE_SERIES = (
    {1: 1 / 2, 2: -2 / 3, 3: 37 / 96, 4: -1 / 360, 5: -81 / 512, 6: 96199 / 604800},
    {2: 1 / 48, 3: 1 / 15, 4: -437 / 1440, 5: 46 / 105, 6: -1118711 / 3870720},
    {3: 17 / 480, 4: -37 / 840, 5: -209 / 4480, 6: 5569 / 90720},
    {4: 4397 / 161280, 5: -11 / 504, 6: -830251 / 7257600},
    {5: 4583 / 161280, 6: -108847 / 3991680},
    {6: 20648693 / 638668800},
)
LATITUDE_SERIES = (
    {1: 2, 2: -2 / 3, 3: -2, 4: 116 / 45, 5: 26 / 45, 6: -2854 / 675},
    {2: 7 / 3, 3: -8 / 5, 4: -227 / 45, 5: 2704 / 315, 6: 2323 / 945},
    {3: 56 / 15, 4: -136 / 35, 5: -1262 / 105, 6: 73814 / 2835},
    {4: 4279 / 630, 5: -332 / 35, 6: -399572 / 14175},
    {5: 4174 / 315, 6: -144838 / 6237},
    {6: 601676 / 22275},
)
# --- end of fixed values ----------------------------------------------------


def coefficients(series):
    return tuple(sum(c * N**power for power, c in row.items()) for row in series)


ALPHA = coefficients(FORWARD_SERIES)
BETA = coefficients(INVERSE_SERIES)
DELTA = coefficients(LATITUDE_SERIES)


def project_utm(lon, lat):
    """(easting, northing) columns of a longitude and latitude in degrees."""
    lam = F.radians(F.col(lon) if isinstance(lon, str) else lon) - F.lit(math.radians(CENTRAL_MERIDIAN))
    phi = F.radians(F.col(lat) if isinstance(lat, str) else lat)
    sin_phi = F.sin(phi)
    # tangent of the conformal latitude
    conformal = F.sinh(F.atanh(sin_phi) - F.lit(ECCENTRICITY) * F.atanh(F.lit(ECCENTRICITY) * sin_phi))
    xi0 = F.atan2(conformal, F.cos(lam))
    eta0 = F.asinh(F.sin(lam) / F.sqrt(conformal * conformal + F.cos(lam) * F.cos(lam)))
    xi, eta = xi0, eta0
    for j, a in enumerate(ALPHA, start=1):
        xi = xi + F.lit(a) * F.sin(F.lit(2.0 * j) * xi0) * F.cosh(F.lit(2.0 * j) * eta0)
        eta = eta + F.lit(a) * F.cos(F.lit(2.0 * j) * xi0) * F.sinh(F.lit(2.0 * j) * eta0)
    scale = F.lit(SCALE_FACTOR * RADIUS)
    return scale * eta + F.lit(FALSE_EASTING), scale * xi


def unproject_utm(x, y):
    """(longitude, latitude) columns in degrees of an easting and northing."""
    scale = F.lit(SCALE_FACTOR * RADIUS)
    xi = (F.col(y) if isinstance(y, str) else y) / scale
    eta = ((F.col(x) if isinstance(x, str) else x) - F.lit(FALSE_EASTING)) / scale
    xi0, eta0 = xi, eta
    for j, b in enumerate(BETA, start=1):
        xi0 = xi0 - F.lit(b) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
        eta0 = eta0 - F.lit(b) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    phi = chi
    for j, d in enumerate(DELTA, start=1):
        phi = phi + F.lit(d) * F.sin(F.lit(2.0 * j) * chi)
    lam = F.atan2(F.sinh(eta0), F.cos(xi0)) + F.lit(math.radians(CENTRAL_MERIDIAN))
    return F.degrees(lam), F.degrees(phi)
