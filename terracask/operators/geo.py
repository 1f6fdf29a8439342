"""Geodesy as column expressions: transverse Mercator by Krüger's series, grids, footprints."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: WGS 84, UTM scale and false origin: fixed values.
A, INVERSE_F = 6378137.0, 298.257223563
K0, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500000.0, 10000000.0
_F = 1 / INVERSE_F
_N = _F / (2 - _F)
_E = math.sqrt(_F * (2 - _F))
RECTIFYING = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
#: Series coefficients of the third flattening up to its sixth power (Karney 2011), fixed values.
_FORWARD = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
_INVERSE = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)
ALPHA, BETA = (tuple(sum(c * _N ** (j + 1 + i) for i, c in enumerate(row)) for j, row in enumerate(table)) for table in (_FORWARD, _INVERSE))
NEWTON_STEPS = 4


def zone_meridian(epsg: int) -> tuple[float, bool]:
    """Central meridian in degrees and whether south, of a WGS 84 UTM system (326xx, 327xx)."""
    if epsg // 100 not in (326, 327) or not 1 <= epsg % 100 <= 60:
        raise ValueError(f"EPSG:{epsg} is no WGS 84 UTM zone")
    return epsg % 100 * 6.0 - 183.0, epsg // 100 == 327


def _conformal(tau: Column) -> Column:
    root = F.sqrt(1 + tau * tau)
    sigma = F.sinh(_E * F.atanh(_E * tau / root))
    return tau * F.sqrt(1 + sigma * sigma) - sigma * root


def to_utm(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    """Easting and northing of longitude and latitude in degrees."""
    meridian, south = zone_meridian(epsg)
    lam, tau = F.radians(lon - meridian), _conformal(F.tan(F.radians(lat)))
    xi = F.atan2(tau, F.cos(lam))
    eta = F.asinh(F.sin(lam) / F.sqrt(tau * tau + F.cos(lam) * F.cos(lam)))
    x, y = eta, xi
    for j, a in enumerate(ALPHA, 1):
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return FALSE_EASTING + K0 * RECTIFYING * x, (FALSE_NORTHING if south else 0.0) + K0 * RECTIFYING * y


def with_lonlat(df: DataFrame, easting: str, northing: str, epsg: int, lon: str, lat: str) -> DataFrame:
    """Adds longitude and latitude in degrees; Newton's steps are columns of their own, so
    that expressions don't multiply."""
    meridian, south = zone_meridian(epsg)
    out = df.withColumns(
        {"__xi": (F.col(northing) - (FALSE_NORTHING if south else 0.0)) / (K0 * RECTIFYING), "__eta": (F.col(easting) - FALSE_EASTING) / (K0 * RECTIFYING)}
    )
    xi, eta = F.col("__xi"), F.col("__eta")
    y, x = xi, eta
    for j, b in enumerate(BETA, 1):
        y = y - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        x = x - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    out = out.withColumns({"__y": y, "__x": x})
    target = F.sin("__y") / F.sqrt(F.sinh("__x") * F.sinh("__x") + F.cos("__y") * F.cos("__y"))
    out = out.withColumn("__target", target).withColumn("__tau", F.col("__target"))
    for _ in range(NEWTON_STEPS):
        tau, ahead = F.col("__tau"), _conformal(F.col("__tau"))
        step = (F.col("__target") - ahead) / F.sqrt(1 + ahead * ahead) * (1 + (1 - _E**2) * tau * tau) / ((1 - _E**2) * F.sqrt(1 + tau * tau))
        out = out.withColumn("__tau", tau + step)
    out = out.withColumns({lon: meridian + F.degrees(F.atan2(F.sinh("__x"), F.cos("__y"))), lat: F.degrees(F.atan("__tau"))})
    return out.drop("__xi", "__eta", "__y", "__x", "__target", "__tau")


def grid_of_bounds(bounds: DataFrame, epsg: int, resolution: float, key: str = "aoi_id", points: int = 21) -> DataFrame:
    """The grid of each lon/lat box: its projected edges, densified, snapped outward."""
    ends = [("min_lon", "min_lat", "max_lon", "min_lat"), ("max_lon", "min_lat", "max_lon", "max_lat"), ("max_lon", "max_lat", "min_lon", "max_lat"), ("min_lon", "max_lat", "min_lon", "min_lat")]
    cells = [
        F.struct((F.col(a) + (F.col(c) - F.col(a)) * (i / (points + 1))).alias("lon"), (F.col(b) + (F.col(d) - F.col(b)) * (i / (points + 1))).alias("lat"))
        for a, b, c, d in ends
        for i in range(points + 1)
    ]
    edge = bounds.select(key, F.inline(F.array(*cells)))
    x, y = to_utm(F.col("lon"), F.col("lat"), epsg)
    box = edge.select(key, x.alias("x"), y.alias("y")).groupBy(key).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    snapped = box.select(
        key,
        (F.floor(F.col("x0") / resolution) * resolution).alias("left"),
        (F.ceil(F.col("y1") / resolution) * resolution).alias("top"),
        (F.ceil(F.col("x1") / resolution) * resolution).alias("right"),
        (F.floor(F.col("y0") / resolution) * resolution).alias("bottom"),
    )
    return snapped.select(
        key, "left", "top", F.lit(float(resolution)).alias("resolution"),
        ((F.col("right") - F.col("left")) / resolution).cast("int").alias("width"), ((F.col("top") - F.col("bottom")) / resolution).cast("int").alias("height"), F.lit(epsg).alias("epsg"),
    )


def cells_inside(grids: DataFrame, bounds: DataFrame, epsg: int, key: str = "aoi_id") -> DataFrame:
    """Cells (key, row, col) whose centres lie in the projected quadrilateral of the box.

    A row's cells are found from four half-planes; rows are spread out before columns.
    """
    corners = {}
    for name, (lon, lat) in {"a": ("min_lon", "min_lat"), "b": ("max_lon", "min_lat"), "c": ("max_lon", "max_lat"), "d": ("min_lon", "max_lat")}.items():
        corners[f"{name}x"], corners[f"{name}y"] = to_utm(F.col(lon), F.col(lat), epsg)
    quads = bounds.select(key, *(v.alias(k) for k, v in corners.items()))
    rows = grids.join(quads, key).withColumn("row", F.explode(F.sequence(F.lit(0), F.col("height") - 1)))
    cells = rows.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
    px, py = F.col("left") + (F.col("col") + 0.5) * F.col("resolution"), F.col("top") - (F.col("row") + 0.5) * F.col("resolution")
    inside = F.lit(True)
    for p, q in ("ab", "bc", "cd", "da"):
        inside = inside & ((F.col(f"{q}x") - F.col(f"{p}x")) * (py - F.col(f"{p}y")) - (F.col(f"{q}y") - F.col(f"{p}y")) * (px - F.col(f"{p}x")) >= 0)
    return cells.where(inside).select(key, "row", "col")


def lonlat_of(points: Column, epsg: int) -> Column:
    """Longitudes and latitudes (``lon``, ``lat``) of an array of (``e``, ``n``). Each step is a pass over
    the array, so that expressions don't multiply however many points there are."""
    meridian, south = zone_meridian(epsg)

    def step(array: Column, cells) -> Column:
        return F.transform(array, lambda p: F.struct(*(v.alias(k) for k, v in cells(p).items())))

    def projected(p: Column) -> dict[str, Column]:
        return {"xi": (p["n"] - (FALSE_NORTHING if south else 0.0)) / (K0 * RECTIFYING), "eta": (p["e"] - FALSE_EASTING) / (K0 * RECTIFYING)}

    def unbent(p: Column) -> dict[str, Column]:
        x, y = p["eta"], p["xi"]
        for j, b in enumerate(BETA, 1):
            y = y - b * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
            x = x - b * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
        return {"x": x, "y": y}

    def started(p: Column) -> dict[str, Column]:
        target = F.sin(p["y"]) / F.sqrt(F.sinh(p["x"]) * F.sinh(p["x"]) + F.cos(p["y"]) * F.cos(p["y"]))
        return {"x": p["x"], "y": p["y"], "target": target, "tau": target}

    def looked_ahead(p: Column) -> dict[str, Column]:
        return {k: p[k] for k in ("x", "y", "target", "tau")} | {"ahead": _conformal(p["tau"])}

    def moved(p: Column) -> dict[str, Column]:
        tau, ahead = p["tau"], p["ahead"]
        by = (p["target"] - ahead) / F.sqrt(1 + ahead * ahead) * (1 + (1 - _E**2) * tau * tau) / ((1 - _E**2) * F.sqrt(1 + tau * tau))
        return {k: p[k] for k in ("x", "y", "target")} | {"tau": tau + by}

    out = step(step(step(points, projected), unbent), started)
    for _ in range(NEWTON_STEPS):
        out = step(step(out, looked_ahead), moved)
    return step(out, lambda p: {"lon": meridian + F.degrees(F.atan2(F.sinh(p["x"]), F.cos(p["y"]))), "lat": F.degrees(F.atan(p["tau"]))})


def map_probability(value: Column) -> Column:
    """A probability as map features state it, to 7 places."""
    return F.round(value, 7)


def patch_polygons(df: DataFrame, epsg: int, size: int = 32) -> DataFrame:
    """Adds ``polygon``: the closed ring of a patch's corners in degrees, to 8 places.

    Takes ``left``, ``top``, ``resolution``, ``row_off`` and ``col_off``.
    """

    def corner(rows: int, cols: int) -> Column:
        e = F.col("left") + (F.col("col_off") + cols) * F.col("resolution")
        return F.struct(e.cast("double").alias("e"), (F.col("top") - (F.col("row_off") + rows) * F.col("resolution")).cast("double").alias("n"))

    corners = F.array(corner(0, 0), corner(0, size), corner(size, size), corner(size, 0), corner(0, 0))
    return df.withColumn("polygon", F.transform(lonlat_of(corners, epsg), lambda p: F.array(F.round(p["lon"], 8), F.round(p["lat"], 8))))


def geojson_feature(polygon: Column, properties: Column) -> Column:
    """A map feature; probabilities should come as ``map_probability``."""
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(polygon).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")))
