"""Classification of pickup/dropoff zones (dimension flags)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service-zone labels, borough groups and the ordered Manhattan
# sub-region name patterns (first match wins).
AIRPORT_SERVICE_ZONE = "Airports"
AIRPORT_NAME_PATTERN = "%airport%"
EWR_SERVICE_ZONE = "EWR"
YELLOW_SERVICE_ZONE = "Yellow Zone"
MANHATTAN = "Manhattan"
OUTER_BOROUGHS = ["Brooklyn", "Queens", "Bronx", "Staten Island"]
BOROUGH_GROUPS = ["Manhattan", "Outer Borough", "New Jersey", "Other"]
MANHATTAN_SUBREGIONS = [
    ("Midtown", ["%Midtown%", "%Times Sq%", "%Penn Station%", "%Garment%"]),
    ("Lower Manhattan", ["%Financial%", "%TriBeCa%", "%Battery Park%", "%Seaport%", "%World Trade%"]),
    ("Upper Manhattan", ["%Upper East%", "%Upper West%", "%Lenox Hill%", "%Yorkville%",
                         "%Lincoln Square%", "%Central Park%"]),
    ("Northern Manhattan", ["%Harlem%", "%Washington Heights%", "%Inwood%", "%Hamilton%",
                            "%Manhattanville%"]),
]
OTHER_MANHATTAN = "Other Manhattan"


def _flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false: never NULL."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def is_airport(service_zone: Column, zone_name: Column) -> Column:
    return _flag((service_zone == AIRPORT_SERVICE_ZONE) | zone_name.ilike(AIRPORT_NAME_PATTERN))


def is_ewr(service_zone: Column) -> Column:
    return _flag(service_zone == EWR_SERVICE_ZONE)


def is_yellow_zone(service_zone: Column) -> Column:
    return _flag(service_zone == YELLOW_SERVICE_ZONE)


def borough_group(borough: Column) -> Column:
    return (F.when(borough == MANHATTAN, F.lit("Manhattan"))
            .when(borough.isin(OUTER_BOROUGHS), F.lit("Outer Borough"))
            .when(borough == "EWR", F.lit("New Jersey"))
            .otherwise(F.lit("Other")))


def _ilike_any(value: Column, patterns) -> Column:
    cond = F.lit(False)
    for p in patterns:
        cond = cond | value.ilike(p)
    return cond


def manhattan_subregion(borough: Column, zone_name: Column) -> Column:
    in_manhattan = borough == MANHATTAN
    expr = None
    for label, patterns in MANHATTAN_SUBREGIONS:
        cond = in_manhattan & _ilike_any(zone_name, patterns)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(in_manhattan, F.lit(OTHER_MANHATTAN)).otherwise(F.lit(None).cast("string"))
