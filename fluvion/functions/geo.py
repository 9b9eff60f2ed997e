"""Column expressions on coordinates and heights."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 semi-major axis (m) and flattening; the mean radius (m) of step distances on a sphere.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
STEP_RADIUS = 6378000.0
# Fixed value: the orbit's height (m).
ORBIT = 970e3
ECC2 = FLATTENING * (2 - FLATTENING)


def wrap(angle: Column) -> Column:
    """Degrees in [-180, 180)."""
    return angle - 360 * F.floor((angle + 180) / 360)


def west(lon: Column) -> Column:
    return F.when(lon >= 180, lon - 360).otherwise(lon)


def _q(sin: Column, e: float = ECC2**0.5) -> Column:
    return (1 - e * e) * (sin / (1 - e * e * sin * sin) - F.log((1 - e * sin) / (1 + e * sin)) / (2 * e))


def laea(lon: Column, lat: Column, lon0: Column, lat0: Column) -> tuple[Column, Column]:
    """Ellipsoidal Lambert azimuthal equal-area coordinates (m) about a centre (Snyder 1987, pages 187 to 190)."""
    phi, phi0, lam = F.radians(lat), F.radians(lat0), F.radians(wrap(lon - lon0))
    qp = _q(F.lit(1.0))
    beta, beta0 = F.asin(_q(F.sin(phi)) / qp), F.asin(_q(F.sin(phi0)) / qp)
    rq = SEMI_MAJOR * F.sqrt(qp / 2)
    m0 = F.cos(phi0) / F.sqrt(1 - ECC2 * F.sin(phi0) * F.sin(phi0))
    d = SEMI_MAJOR * m0 / (rq * F.cos(beta0))
    b = rq * F.sqrt(2 / (1 + F.sin(beta0) * F.sin(beta) + F.cos(beta0) * F.cos(beta) * F.cos(lam)))
    return b * d * F.cos(beta) * F.sin(lam), (b / d) * (F.cos(beta0) * F.sin(beta) - F.sin(beta0) * F.cos(beta) * F.cos(lam))


def step_distance(lon: Column, lat: Column, next_lon: Column, next_lat: Column, mean_lat: Column) -> Column:
    """Metres to the next point on a sphere; 0 where there is none."""
    dx, dy = F.radians(next_lon - lon) * F.cos(F.radians(mean_lat)), F.radians(next_lat - lat)
    return F.coalesce(STEP_RADIUS * F.sqrt(dx * dx + dy * dy), F.lit(0.0))


def corrected_height(height: Column, geoid: Column, *tides: Column) -> Column:
    """Height less geoid and tides where the geoid is plausible, else as it is."""
    total = geoid
    for tide in tides:
        total = total + tide
    return F.when((geoid > -200) & (geoid < 200), height - total).otherwise(height)


def uncorrected_height(height: Column, geoid: Column, *tides: Column) -> Column:
    """Undoes corrected_height."""
    total = geoid
    for tide in tides:
        total = total + tide
    return F.when((geoid > -200) & (geoid < 200), height + total).otherwise(height)


def dark_fraction(area: Column, detected: Column) -> Column:
    """The share of an area that is dark, at most 1; null without an area."""
    return F.when(area > 0, F.least(1 - detected / area, F.lit(1.0)))


def unless_fill(value: Column, fill: float, replacement: Column) -> Column:
    return F.when(value == fill, replacement).otherwise(value)


def pixel_area(stored: Column, azimuth: Column, range_step: Column, look_angle: Column, ground_step: Column) -> Column:
    """The area of a pixel: as stored, else from its azimuth spacing and the slant step on the ground, else from the ground spacing; null if all lack.

    The incidence angle is the look angle (radians) enlarged by the orbit's height over the radius of the sphere.
    """
    slant = azimuth * range_step / F.sin(look_angle * (1 + ORBIT / STEP_RADIUS))
    return F.coalesce(stored, slant, azimuth * ground_step)


def flattened(re: Column, im: Column, wavelength: float, range_a: Column, range_b: Column) -> tuple[Column, Column]:
    """An interferogram turned back by the phase of the difference of its two ranges."""
    phase = -2 * math.pi / wavelength * (range_a - range_b)
    return re * F.cos(phase) - im * F.sin(phase), re * F.sin(phase) + im * F.cos(phase)


def great_circle(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> tuple[Column, Column]:
    """Metres along a great circle of the mean sphere, by the haversine, and the heading at the start in degrees from north, 0 to 360."""
    a, b, d = F.radians(lat_a), F.radians(lat_b), F.radians(lon_b - lon_a)
    h = F.pow(F.sin((b - a) / 2), 2.0) + F.cos(a) * F.cos(b) * F.pow(F.sin(d / 2), 2.0)
    heading = F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d))
    return 2 * STEP_RADIUS * F.asin(F.sqrt(F.least(h, F.lit(1.0)))), F.pmod(F.degrees(heading), F.lit(360.0))


def raster_index(x: Column, first: float, step: float, size: int) -> Column:
    """The cell of an axis nearest to x, clamped to the axis."""
    return F.greatest(F.least(F.rint((x - first) / step).cast("long"), F.lit(size - 1)), F.lit(0))


def height_std(phase_std: Column, sensitivity: Column, worst: float = 1e5) -> Column:
    s = F.abs(phase_std * sensitivity)
    return F.when((s > 0) & ~F.isnan(s) & (s < float("inf")), s).otherwise(worst)


def root_sum_squares(*parts: Column) -> Column:
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return F.sqrt(total)


def inundated_area(area: Column, water_frac: Column, klass: Column, fractional: tuple[int, ...]) -> Column:
    return F.when(klass.isin(*fractional), area * water_frac).otherwise(area)


def any_bit(flags: Column, mask: int) -> Column:
    return flags.bitwiseAND(F.lit(mask).cast("long")) > 0


def degrees_text(angle: Column, positive: str, negative: str) -> Column:
    """Degrees, minutes and seconds with the hemisphere."""
    a = F.abs(angle)
    d = F.floor(a)
    m = F.floor((a - d) * 60)
    s = ((a - d) * 60 - m) * 60
    return F.format_string("%d %d %.2f%s", d, m, s, F.when(angle < 0, negative).otherwise(positive))


def quantize(value: Column, offset: float, scale: float, fill: int, kind: str = "int") -> Column:
    return F.when(value.isNull() | F.isnan(value), F.lit(fill)).otherwise(F.round((value - offset) / scale)).cast(kind)


def utm_inverse(east: Column, north: Column, zone: int) -> tuple[Column, Column]:
    """Longitude and latitude of UTM coordinates of the northern half, by the series in the third flattening (to n^3)."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    xi, eta = north / (0.9996 * radius), (east - 500000.0) / (0.9996 * radius)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    x, e = xi, eta
    for k, b in enumerate(beta, 1):
        x, e = x - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta), e - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    chi = F.asin(F.sin(x) / F.cosh(e))
    phi = chi
    for k, d in enumerate(delta, 1):
        phi = phi + d * F.sin(2 * k * chi)
    return F.degrees(F.atan2(F.sinh(e), F.cos(x))) + (6 * zone - 183), F.degrees(phi)
