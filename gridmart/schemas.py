"""Feeds, table schemas and the fixed code lists of the grid model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Feed:
    """One hourly feed: an authority column, a second key column and their labels.

    ``lookback_days`` is how many days before the run day one run fetches again.
    """

    name: str
    route: str
    code: str
    code_label: str
    series: str
    series_label: str
    lookback_days: int

    @property
    def raw_columns(self) -> tuple[str, ...]:
        return (
            "period",
            self.code,
            self.code_label,
            self.series,
            self.series_label,
            "value",
            "value-units",
        )

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.raw_columns])

    @property
    def renames(self) -> dict[str, str]:
        return {c: c.replace("-", "_") for c in self.raw_columns if "-" in c}

    @property
    def required(self) -> tuple[str, ...]:
        return ("value", "period", self.code, self.series)

    @property
    def key(self) -> tuple[str, ...]:
        """Columns the content id is made of; equal keys mean equal ids."""
        return ("period", self.code, self.series, "value")

    @property
    def attributes(self) -> tuple[str, ...]:
        """Cleaned columns that are not part of the key."""
        return (self.code_label.replace("-", "_"), self.series_label.replace("-", "_"), "value_units")

    @property
    def staged_columns(self) -> tuple[str, ...]:
        return ("id", *(self.renames.get(c, c) for c in self.raw_columns))

    @property
    def staged_schema(self) -> T.StructType:
        """Stored layout: the staged columns plus the ``day`` partition."""
        special = {"period": T.TimestampType(), "value": T.IntegerType()}
        fields = [T.StructField(c, special.get(c, T.StringType())) for c in self.staged_columns]
        return T.StructType([*fields, T.StructField("day", T.DateType())])


REGION = Feed("region", "region_data", "respondent", "respondent-name", "type", "type-name", 0)
FUEL_TYPE = Feed("fuel_type", "fuel_type_data", "respondent", "respondent-name", "fueltype", "type-name", 1)
INTERCHANGE = Feed("interchange", "interchange_data", "fromba", "fromba-name", "toba", "toba-name", 2)

FEEDS: dict[str, Feed] = {f.name: f for f in (REGION, FUEL_TYPE, INTERCHANGE)}

UNIFIED_COLUMNS = ("period", "ba_code", "type_code", "related_ba", "value", "value_units")

FACT_SCHEMA = T.StructType(
    [
        T.StructField("time_id", T.IntegerType()),
        T.StructField("type_id", T.IntegerType()),
        T.StructField("ba_id", T.IntegerType()),
        T.StructField("related_ba_id", T.IntegerType()),
        T.StructField("value", T.LongType()),
        T.StructField("value_units", T.StringType()),
        T.StructField("period", T.TimestampType()),
        T.StructField("date_id", T.IntegerType()),
    ]
)

DIM_BA_SCHEMA = T.StructType(
    [
        T.StructField("ba_id", T.IntegerType()),
        T.StructField("ba_code", T.StringType()),
        T.StructField("ba_name", T.StringType()),
        T.StructField("time_zone", T.StringType()),
        T.StructField("region_country_code", T.StringType()),
        T.StructField("region_country_name", T.StringType()),
        T.StructField("is_generation_only", T.StringType()),
        T.StructField("has_demand_subregion", T.StringType()),
        T.StructField("is_us_ba", T.StringType()),
        T.StructField("is_active", T.StringType()),
        T.StructField("activation_date", T.DateType()),
        T.StructField("retirement_date", T.DateType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

DIM_TYPE_SCHEMA = T.StructType(
    [
        T.StructField("type_id", T.IntegerType()),
        T.StructField("type_code", T.StringType()),
        T.StructField("type_description", T.StringType()),
    ]
)

FACT_COLUMNS = (
    "date_id",
    "time_id",
    "type_id",
    "ba_id",
    "related_ba_id",
    "value",
    "value_units",
    "period",
)

# Seed headers as published; numbers stay text until the dimension casts them.
AUTHORITY_SEED_COLUMNS = (
    "BA Id",
    "BA Code",
    "BA Name",
    "Time Zone",
    "Region_Country Code",
    "Region_Country Name",
    "Generation Only BA",
    "Demand by BA Subregion",
    "US_BA",
    "Active BA",
    "Activation Date",
    "Retirement Date",
    "LATITUDE",
    "LONGITUDE",
)

TYPE_SEED_COLUMNS = ("Type ID", "Type", "Type Name")

# Codes that stand for whole regions, left out of the model.
AGGREGATE_CODES = (
    "CAL",
    "CAR",
    "CENT",
    "FLA",
    "MIDA",
    "MIDW",
    "NE",
    "NW",
    "NY",
    "SE",
    "SW",
    "TEN",
    "TEX",
    "US48",
)

# Region-feed series that the other two feeds carry in more detail.
REGION_SERIES_LEFT_OUT = ("TI", "NG")

# Placeholder for "no related authority", and the type given to flows.
NO_RELATED = "Unknown"
FLOW_TYPE = "FLOW"

# Observation types (id, code, description).
TYPES = (
    (1, "D", "Demand"),
    (2, "DF", "Demand Forecast"),
    (3, "FLOW", "Interchange"),
    (4, "SYS", "All energy sources"),
    (5, "BAT", "Battery storage"),
    (6, "WNB", "Wind with integrated battery storage"),
    (7, "SNB", "Solar with integrated battery storage"),
    (8, "PS", "Pumped storage"),
    (9, "OES", "Other energy storage"),
    (10, "UES", "Unknown energy storage"),
    (11, "WND", "Wind"),
    (12, "SUN", "Solar"),
    (13, "WAT", "Hydro and pumped storage"),
    (14, "GEO", "Geothermal"),
    (15, "OTH", "Other"),
    (16, "OIL", "Petroleum"),
    (17, "NG", "Natural gas"),
    (18, "COL", "Coal"),
    (19, "NUC", "Nuclear"),
    (-1, "UNK", "Unknown"),
)

# Type ids that count as net generation (both ends included).
GENERATION_TYPE_IDS = (4, 19)

# The sources shown in the generation mix.
MIX_TYPE_CODES = ("COL", "NG", "NUC", "SUN", "WND", "WAT", "GEO", "OIL", "OTH", "BAT")

# Calendar covered by the date dimension.
CALENDAR_START = "2019-01-01"
CALENDAR_END = "2030-12-31"

# Fixed value: rows per page of the source interface.
PAGE_ROWS = 5000
