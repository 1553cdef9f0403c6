"""What the services answer, as columns; and the parameters that they are asked with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siteloom.operators.intake import nominatim_quality

_CENSUS = "result struct<addressMatches: array<struct<matchedAddress: string, coordinates: struct<x: double, y: double>>>>"
_NOMINATIM = "array<struct<lat: string, lon: string, display_name: string, type: string, class: string>>"
_STAC = "features array<struct<id: string, bbox: array<double>, properties: struct<datetime: string>, assets: struct<image: struct<href: string>>>>"
_SURVEYS = "surveys array<struct<captureDate: string>>"


def census_parameters(address: str, benchmark: str = "Public_AR_Current") -> dict[str, str]:
    return {"address": address, "benchmark": benchmark, "format": "json"}


def nominatim_parameters(address: str) -> dict[str, str | int]:
    """One hit is all that is used, so the service is asked for one."""
    return {"q": address, "format": "json", "limit": 1}


def coverage_parameters() -> dict[str, int]:
    return {"limit": 1}


def stac_parameters(lat: float, lon: float, collection: str = "naip") -> dict:
    return {"collections": [collection], "intersects": {"type": "Point", "coordinates": [lon, lat]}}


def _hit(source: str, lat: Column, lon: Column, matched: Column, quality: Column) -> Column:
    ok = lat.isNotNull() & lon.isNotNull()
    return F.struct(
        F.lit(source).alias("source"), F.when(ok, lat).alias("lat"), F.when(ok, lon).alias("lon"), F.when(ok, matched).alias("matched_address"), F.when(ok, quality).alias("quality"),
        F.when(~ok, "no match").alias("error"),
    )


def census(raw: Column) -> Column:
    """The first match of the Census geocoder."""
    first = F.get(F.from_json(raw, _CENSUS)["result"]["addressMatches"], F.lit(0))
    return _hit("census", first["coordinates"]["y"], first["coordinates"]["x"], first["matchedAddress"], F.lit("census_match"))


def nominatim(raw: Column) -> Column:
    """The first hit of Nominatim; its quality is its type, or its class."""
    first = F.get(F.from_json(raw, _NOMINATIM), F.lit(0))
    return _hit("nominatim", first["lat"].try_cast("double"), first["lon"].try_cast("double"), first["display_name"], nominatim_quality(first["type"], first["class"]))


def scenes(raw: Column) -> Column:
    """array of struct(item_ord, item_id, dt, href) of a catalogue's answer, in its order."""
    items = F.from_json(raw, _STAC)["features"]
    return F.transform(items, lambda x, i: F.struct(i.alias("item_ord"), x["id"].alias("item_id"), x["properties"]["datetime"].try_cast("timestamp").alias("dt"), x["assets"]["image"]["href"].alias("href")))


def capture_date(raw: Column) -> Column:
    """Of the first survey; anything unreadable has none."""
    return F.get(F.from_json(raw, _SURVEYS)["surveys"], F.lit(0))["captureDate"]
