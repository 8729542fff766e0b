"""Location dimension: staged zones plus classification flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import zones as Z


def dim_location(stg_zones: DataFrame) -> DataFrame:
    b, z, s = F.col("borough"), F.col("zone_name"), F.col("service_zone")
    return stg_zones.select(
        "location_id", "borough", "zone_name", "service_zone",
        Z.is_airport(s, z).alias("is_airport"),
        Z.is_ewr(s).alias("is_ewr"),
        Z.is_yellow_zone(s).alias("is_yellow_zone"),
        Z.borough_group(b).alias("borough_group"),
        Z.manhattan_subregion(b, z).alias("manhattan_subregion"),
    )
