"""Location and movement helpers."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._util import as_col

__all__ = [
    "direction_angle", "compass_label", "midpoint", "side_value",
    "haversine_km", "ellipsoid_km", "plane_km", "trip_fare_parts", "arrived", "between_lines",
]

# Eight compass labels in angle order starting at East
# (image y axis points down, so a positive dy is South), and the label
# for an object that did not move.
COMPASS = ["E", "SE", "S", "SW", "W", "NW", "N", "NE"]
STOP = "Stop"
UNKNOWN = "unknow"
EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE = 111.0
# Equatorial radius (km) and flattening of WGS 84.
WGS84_A, WGS84_F = 6378.137, 1 / 298.257223563
# Fare rule (base + per km + per minute).
FARE_BASE, FARE_PER_KM, FARE_PER_MIN = 70.0, 25.0, 2.0


def direction_angle(x0, y0, x1, y1) -> Column:
    """Heading in degrees in [0, 360); null when the point did not move."""
    x0, y0, x1, y1 = map(as_col, (x0, y0, x1, y1))
    raw = F.degrees(F.atan2(y1 - y0, x1 - x0)) + F.lit(360.0)
    return F.when((x1 == x0) & (y1 == y0), F.lit(None).cast("double")).otherwise(F.pmod(raw, F.lit(360.0)))


def compass_label(angle: Column | str) -> Column:
    """Eight-way label, 45-degree sectors centred on each direction."""
    a = as_col(angle)
    c = F.when(a.isNull(), F.lit(STOP)).when((a >= 337.5) | (a < 22.5), F.lit(COMPASS[0]))
    for i, name in enumerate(COMPASS[1:], start=1):
        lo = 22.5 + 45.0 * (i - 1)
        c = c.when((a >= lo) & (a < lo + 45.0), F.lit(name))
    return c.otherwise(F.lit(UNKNOWN))


def midpoint(a: Column | str, b: Column | str) -> Column:
    """Middle of two coordinates (box centre)."""
    return (as_col(a) + as_col(b)) / 2.0


def side_value(lx1, ly1, lx2, ly2, px, py) -> Column:
    """Signed area of (line, point): which side of the line the point is on."""
    lx1, ly1, lx2, ly2, px, py = map(as_col, (lx1, ly1, lx2, ly2, px, py))
    return (lx2 - lx1) * (py - ly1) - (ly2 - ly1) * (px - lx1)


def between_lines(px, py, z: str = "z") -> Column:
    """Point between the two lines of zone struct ``z``.

    ``z`` must carry a1x..a2y (line 1), b1x..b2y (line 2) and the signs
    ``sa``/``sb`` of the other line's midpoint (0 marks a degenerate zone,
    which never matches).  A point on a line counts as inside."""
    g = lambda n: F.col(f"{z}.{n}")
    va = side_value(g("a1x"), g("a1y"), g("a2x"), g("a2y"), px, py)
    vb = side_value(g("b1x"), g("b1y"), g("b2x"), g("b2y"), px, py)
    ok_a = (F.signum(va) == g("sa")) | (va == 0)
    ok_b = (F.signum(vb) == g("sb")) | (vb == 0)
    return (g("sa") != 0) & (g("sb") != 0) & ok_a & ok_b


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """O1: great-circle distance (mean Earth radius); within ~0.5 % of the
    ellipsoid distance."""
    lat1, lon1, lat2, lon2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


# Longitude steps of the ellipsoid distance: each takes two to three digits.
# Near-antipodal points, where the steps don't settle, take halvings instead.
GEODESIC_STEPS, AZIMUTH_HALVINGS = 12, 60


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _arc(sin1, cos1, sin2, cos2, lam) -> Column:
    """Struct of the great circle between reduced latitudes at longitude
    difference ``lam``: arc ``s`` with sine ``ss`` and cosine ``cs``, squared
    cosine ``ca2`` and sine ``sa`` of the azimuth at the equator, cosine ``cm`` of
    twice the arc from the equator to the middle."""
    def parts(v):
        ss, cs = v["ss"], v["cs"]
        sa = F.when(ss == 0, 0.0).otherwise(cos1 * cos2 * F.sin(lam) / ss)
        return _let(sa, lambda a: _let(1 - a * a, lambda c2: F.struct(
            F.atan2(ss, cs).alias("s"), ss.alias("ss"), cs.alias("cs"), a.alias("sa"), c2.alias("ca2"),
            F.when(c2 < 1e-15, 0.0).otherwise(cs - 2 * sin1 * sin2 / c2).alias("cm"))))
    x, y = cos2 * F.sin(lam), cos1 * sin2 - sin1 * cos2 * F.cos(lam)
    return _let(F.struct(F.sqrt(x * x + y * y).alias("ss"), (sin1 * sin2 + cos1 * cos2 * F.cos(lam)).alias("cs")), parts)


def _longitude_excess(g: Column) -> Column:
    """Spherical less geodetic longitude difference along the arc ``g``."""
    c = WGS84_F / 16 * g["ca2"] * (4 + WGS84_F * (4 - 3 * g["ca2"]))
    return _let(c, lambda c: (1 - c) * WGS84_F * g["sa"] * (
        g["s"] + c * g["ss"] * (g["cm"] + c * g["cs"] * (2 * g["cm"] * g["cm"] - 1))))


def _arc_km(g: Column) -> Column:
    """Length on the ellipsoid of the arc ``g``."""
    b = WGS84_A * (1 - WGS84_F)
    u2 = g["ca2"] * ((WGS84_A / b) ** 2 - 1)

    def length(k):
        big_a, big_b = (1 + k * k / 4) / (1 - k), k * (1 - 3 * k * k / 8)
        m2 = g["cm"] * g["cm"]
        ds = big_b * g["ss"] * (g["cm"] + big_b / 4 * (
            g["cs"] * (2 * m2 - 1) - big_b / 6 * g["cm"] * (4 * g["ss"] * g["ss"] - 3) * (4 * m2 - 3)))
        return b * big_a * (g["s"] - ds)
    root = F.sqrt(1 + u2)
    return _let((root - 1) / (root + 1), length)


def _arc_of_azimuth(sin1, cos1, sin2, cos2, az) -> Column:
    """Struct as of ``_arc`` with the longitude difference ``lam``, for the great
    circle that leaves latitude 1 at azimuth ``az`` and goes on to latitude 2
    (latitude 1 is south and the farther one from the equator)."""
    sa = F.sin(az) * cos1
    # cos2 * cos(azimuth at 2), without loss where the latitudes are opposite
    c2 = F.sqrt(F.greatest(F.lit(0.0), F.cos(az) * F.cos(az) * cos1 * cos1 + (sin1 - sin2) * (sin1 + sin2)))
    s1, s2 = F.atan2(sin1, F.cos(az) * cos1), F.atan2(sin2, c2)
    w1, w2 = F.atan2(sa * sin1, F.cos(az) * cos1), F.atan2(sa * sin2, c2)
    return _let(F.struct(sa.alias("sa"), (s2 - s1).alias("s"), (s1 + s2).alias("m"), (w2 - w1).alias("lam")),
                lambda v: F.struct(v["s"].alias("s"), F.sin(v["s"]).alias("ss"), F.cos(v["s"]).alias("cs"), v["sa"].alias("sa"),
                                   (1 - v["sa"] * v["sa"]).alias("ca2"), F.cos(v["m"]).alias("cm"), v["lam"].alias("lam")))


def ellipsoid_km(lat1, lon1, lat2, lon2) -> Column:
    """O1: length of the shortest line on the WGS 84 ellipsoid, to under 1 mm.

    The longitude difference on the auxiliary sphere is refined a fixed number of
    times (Vincenty 1975); where that doesn't settle (points almost opposite to
    each other) the azimuth at the first point is found by halving, since the
    longitude reached grows with it (Karney 2013).  All in Column functions.  Null,
    not finite or beyond the poles gives null."""
    p1, l1, p2, l2 = (as_col(c).cast("double") for c in (lat1, lon1, lat2, lon2))
    diff = F.abs(F.pmod(l2 - l1 + 180.0, F.lit(360.0)) - 180.0)

    def reduced(lat):
        return F.atan2((1 - WGS84_F) * F.sin(F.radians(lat)), F.cos(F.radians(lat)))

    start = F.struct(F.sin(reduced(p1)).alias("a"), F.cos(reduced(p1)).alias("ca"), F.sin(reduced(p2)).alias("b"),
                     F.cos(reduced(p2)).alias("cb"), F.radians(diff).alias("l"))

    def solve(v):
        args = v["a"], v["ca"], v["b"], v["cb"]

        def step(acc, _):
            nxt = _let(_arc(*args, acc["lam"]), lambda g: v["l"] + _longitude_excess(g))
            return F.struct(nxt.alias("lam"), F.abs(nxt - acc["lam"]).alias("move"))
        near = F.aggregate(F.sequence(F.lit(1), F.lit(GEODESIC_STEPS)),
                           F.struct(v["l"].alias("lam"), F.lit(0.0).alias("move")), step)
        return _let(near, lambda near: F.when((near["move"] < 1e-12) & (near["lam"] <= math.pi),
                                              _let(_arc(*args, near["lam"]), _arc_km)).otherwise(opposite(v)))

    def opposite(v):
        # the farther latitude first, south of the equator
        swap = F.abs(v["a"]) < F.abs(v["b"])
        sign = F.when(F.when(swap, v["b"]).otherwise(v["a"]) > 0, -1.0).otherwise(1.0)
        turned = F.struct(F.least(sign * F.when(swap, v["b"]).otherwise(v["a"]), F.lit(-1e-15)).alias("a"),
                          F.when(swap, v["cb"]).otherwise(v["ca"]).alias("ca"),
                          (sign * F.when(swap, v["a"]).otherwise(v["b"])).alias("b"),
                          F.when(swap, v["ca"]).otherwise(v["cb"]).alias("cb"), v["l"].alias("l"))

        def halve(t):
            args = t["a"], t["ca"], t["b"], t["cb"]

            def step(acc, _):
                mid = (acc["lo"] + acc["hi"]) / 2
                short = _let(_arc_of_azimuth(*args, mid), lambda g: g["lam"] - _longitude_excess(g)) < t["l"]
                return F.struct(F.when(short, mid).otherwise(acc["lo"]).alias("lo"),
                                F.when(short, acc["hi"]).otherwise(mid).alias("hi"))
            found = F.aggregate(F.sequence(F.lit(1), F.lit(AZIMUTH_HALVINGS)),
                                F.struct(F.lit(0.0).alias("lo"), F.lit(math.pi).alias("hi")), step)
            return _let(_arc_of_azimuth(*args, found["hi"]), _arc_km)
        return _let(turned, halve)

    finite = F.abs(p1) + F.abs(p2) + F.abs(l1) + F.abs(l2) < F.lit(float("inf"))
    ok = finite & (F.abs(p1) <= 90) & (F.abs(p2) <= 90)
    return F.when(ok, F.when((p1 == p2) & (diff == 0), 0.0).otherwise(_let(start, solve)))


def plane_km(lat1, lon1, lat2, lon2) -> Column:
    """O2: degrees times 111 km, root of squares."""
    dlat = (as_col(lat2) - as_col(lat1)) * KM_PER_DEGREE
    dlon = (as_col(lon2) - as_col(lon1)) * KM_PER_DEGREE
    return F.sqrt(dlat * dlat + dlon * dlon)


def trip_fare_parts(km: Column | str, minutes: Column | str) -> dict[str, Column]:
    """Base, distance and time fare, parts rounded to 2; the amount is
    the rounded sum of the unrounded parts."""
    raw_dist = as_col(km) * FARE_PER_KM
    raw_time = as_col(minutes) * FARE_PER_MIN
    return {"base_fare": F.lit(FARE_BASE), "distance_fare": F.bround(raw_dist, 2),
            "time_fare": F.bround(raw_time, 2),
            "amount": F.bround(F.lit(FARE_BASE) + raw_dist + raw_time, 2)}


def arrived(lat, lon, dest_lat, dest_lon, step_lat, step_lon) -> Column:
    """Both remaining offsets are below one step."""
    return ((F.abs(as_col(dest_lat) - as_col(lat)) < F.abs(as_col(step_lat)))
            & (F.abs(as_col(dest_lon) - as_col(lon)) < F.abs(as_col(step_lon))))
