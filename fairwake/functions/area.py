"""Bounding boxes and region labels of ship positions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    """Inclusive longitude and latitude bounds in degrees."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    def contains(self, lon: Column, lat: Column) -> Column:
        return lat.between(self.lat_min, self.lat_max) & lon.between(self.lon_min, self.lon_max)


# The area served, the smaller area served earlier, and the
# latitude bands of the named regions (upper edge inclusive, the first band
# also includes its lower edge). The box is a little wider than the regions.
AREA = Box(33.285, 39.032, -125.013, -117.455)
AREA_LEGACY = Box(33.3011, 34.5738, -121.0299, -117.4998)
REGION_LON = (-125.013, -117.460)
REGION_SOUTH_EDGE = 33.290
REGIONS = [("sc", 34.5739), ("cc", 35.557), ("sf", 39.032)]
NO_REGION = "other"


def region_label(lon: Column, lat: Column) -> Column:
    in_width = lon.between(*REGION_LON) & (lat >= REGION_SOUTH_EDGE)
    out = F
    for label, north_edge in REGIONS:
        out = out.when(in_width & (lat <= north_edge), F.lit(label))
    return out.otherwise(F.lit(NO_REGION))
