"""Thresholds and constants of the engine."""

from __future__ import annotations

import os
from dataclasses import dataclass

VIEWS = ("Vert", "North", "East", "South", "West")
OBLIQUES = VIEWS[1:]
NAIP, TOP_DOWN = "NAIP top-down", "Nearmap top-down"
#: Requests of the cascade; those with _recheck are the second look at the reply before.
STAGES = (
    "naip", "naip_recheck", "vert", "vert_recheck", "full", "full_recheck", "escalate", "escalate_recheck",
    "wide", "wide_recheck", "wide_escalate", "wide_escalate_recheck", "zoom",
)


def flag(name: str, default: bool = False) -> bool:
    """An environment switch: 1, true or yes in any case."""
    value = os.environ.get(name)
    return default if value is None else value.strip().lower() in ("1", "true", "yes")


@dataclass(frozen=True)
class Config:
    high: float = 0.75
    medium: float = 0.6
    chip_m: float = 250.0
    tile_m: float = 100.0
    wide_m: float = 250.0
    zoom: int = 21
    oblique_zoom: int = 20
    tile_px: int = 256
    max_px: int = 2048
    grid: int = 3
    max_crops: int = 6
    forced_crops: int = 3
    crop_px: int = 1024
    pad: float = 0.15
    min_side: int = 100
    metres_per_degree: float = 111_320.0
    pause_s: float = 12.0
    geocode_pause_s: float = 1.1


DEFAULT = Config()
