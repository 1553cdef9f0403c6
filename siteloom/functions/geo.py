"""Geometry as columns: tiles, boxes, crops, UTM by Krueger series."""

from __future__ import annotations

from math import atanh, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

from siteloom.config import DEFAULT, Config

_A, _F = 6378137.0, 1 / 298.257222101  # GRS 80
_N = _F / (2 - _F)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_E = 2 * sqrt(_N) / (1 + _N)
_K0 = 0.9996
assert atanh(_E) > 0


def tile_x(lon: Column, zoom: int) -> Column:
    return (lon + 180) / 360 * F.lit(float(2**zoom))


def tile_y(lat: Column, zoom: int) -> Column:
    return (1 - F.asinh(F.tan(F.radians(lat))) / F.pi()) / 2 * F.lit(float(2**zoom))


def tile_range(lat: Column, lon: Column, side_m: float, zoom: int, config: Config = DEFAULT) -> dict[str, Column]:
    """x0, x1, y0, y1 of the tiles that cover a square around a point."""
    dlat = F.lit(side_m / 2 / config.metres_per_degree)
    dlon = F.lit(side_m / 2) / (F.lit(config.metres_per_degree) * F.cos(F.radians(lat)))
    return {
        "x0": tile_x(lon - dlon, zoom).cast("int"), "x1": tile_x(lon + dlon, zoom).cast("int"),
        "y0": tile_y(lat + dlat, zoom).cast("int"), "y1": tile_y(lat - dlat, zoom).cast("int"),
    }


def placement(view: Column, tx: Column, ty: Column, px: int = DEFAULT.tile_px) -> tuple[Column, Column]:
    """Pixel (left, top) of a tile on its view's canvas; needs the columns x0, x1, y0, y1."""
    x0, x1, y0, y1 = (F.col(c) for c in ("x0", "x1", "y0", "y1"))
    left = F.when(view == "South", x1 - tx).when(view == "East", ty - y0).when(view == "West", y1 - ty).otherwise(tx - x0)
    top = F.when(view == "South", y1 - ty).when(view == "East", x1 - tx).when(view == "West", tx - x0).otherwise(ty - y0)
    return left * px, top * px


def canvas(view: Column, px: int = DEFAULT.tile_px, most: int = DEFAULT.max_px) -> tuple[Column, Column]:
    """Width and height of a view's canvas; oblique ones are foreshortened, all are fitted to the largest size."""
    cols, rows = (F.col("x1") - F.col("x0") + 1) * px, (F.col("y1") - F.col("y0") + 1) * px
    swapped = view.isin("East", "West")
    w, h = F.when(swapped, rows).otherwise(cols), F.when(swapped, cols).otherwise(rows)
    h = F.when(view == "Vert", h).otherwise(F.greatest(F.lit(1), (h * 0.75).cast("int")))
    scale = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(w, h))
    return F.greatest(F.lit(1), (w * scale).cast("int")), F.greatest(F.lit(1), (h * scale).cast("int"))


def box_centre(box: Column) -> Column:
    """struct(cx, cy) in 0..1 of a box (ymin, xmin, ymax, xmax) of at least four numbers; null if it is out of order or range."""
    b = F.transform(F.slice(box, 1, 4), lambda v: v.try_cast("double"))
    y0, x0, y1, x1 = (F.get(b, F.lit(i)) for i in range(4))
    ok = (F.size(box) >= 4) & (y0 >= 0) & (y0 <= y1) & (y1 <= 1000) & (x0 >= 0) & (x0 <= x1) & (x1 <= 1000)
    return F.when(ok, F.struct(((x0 + x1) / 2000).alias("cx"), ((y0 + y1) / 2000).alias("cy")))


def box_offset(box: Column, chip_m: float = DEFAULT.chip_m) -> Column:
    """Metres from the chip's middle to the box's centre."""
    c = box_centre(box)
    return F.lit(chip_m) * F.sqrt((c.cx - 0.5) * (c.cx - 0.5) + (c.cy - 0.5) * (c.cy - 0.5))


def valid_box(box: Column, least: int = DEFAULT.min_side) -> Column:
    """The box as whole numbers, or null; stricter than ``box_centre``."""
    b = F.transform(box, lambda v: v.try_cast("double").cast("int"))
    y0, x0, y1, x1 = (F.get(b, F.lit(i)) for i in range(4))
    ok = (F.size(box) == 4) & (y0 >= 0) & (y0 < y1) & (y1 <= 1000) & (x0 >= 0) & (x0 < x1) & (x1 <= 1000) & (y1 - y0 >= least) & (x1 - x0 >= least)
    return F.when(ok, b)


def crop_rect(box: Column, width: Column, height: Column, pad: float = DEFAULT.pad) -> dict[str, Column]:
    """Pixels of the padded and clamped box."""
    y0, x0, y1, x1 = (F.get(box, F.lit(i)) for i in range(4))
    py, px = ((y1 - y0) * pad).cast("int"), ((x1 - x0) * pad).cast("int")

    def scaled(v: Column, size: Column) -> Column:
        return (F.greatest(F.lit(0), F.least(F.lit(1000), v)) / 1000.0 * size).cast("int")

    left, top = scaled(x0 - px, width), scaled(y0 - py, height)
    return {"left": left, "top": top, "right": F.greatest(left + 1, scaled(x1 + px, width)), "bottom": F.greatest(top + 1, scaled(y1 + py, height))}


def grid_boxes(n: int = DEFAULT.grid) -> list[list[int]]:
    step = 1000 // n
    edges = [*(step * i for i in range(n)), 1000]
    return [[edges[r], edges[c], edges[r + 1], edges[c + 1]] for r in range(n) for c in range(n)]


ANCHORS = ([350, 350, 650, 650], [480, 380, 680, 620])


def utm_zone(lon: Column) -> Column:
    return F.floor((lon + 180) / 6).cast("int") + 1


def utm_forward(lat: Column, lon: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing of the northern hemisphere in metres."""
    phi, lam = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    t = F.sinh(F.atanh(F.sin(phi)) - _E * F.atanh(_E * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500_000 + _K0 * _R * east, _K0 * _R * north


def utm_inverse(east: Column, north: Column, zone: Column) -> tuple[Column, Column]:
    """Latitude and longitude."""
    xi, eta = north / (_K0 * _R), (east - 500_000) / (_K0 * _R)
    x, y = xi, eta
    for j, b in enumerate(_BETA, 1):
        x = x - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        y = y - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(y))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(phi), zone * 6 - 183 + F.degrees(F.atan2(F.sinh(y), F.cos(x)))


def chip_bounds(east: Column, north: Column, side_m: float = DEFAULT.chip_m) -> dict[str, Column]:
    return {"x_min": east - side_m / 2, "x_max": east + side_m / 2, "y_min": north - side_m / 2, "y_max": north + side_m / 2}


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371008.8 * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
