"""The three staged feeds in one shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.schemas import AGGREGATE_CODES, FLOW_TYPE, NO_RELATED, REGION_SERIES_LEFT_OUT


def single_authority(code: Column) -> Column:
    """False for codes of whole regions; null for a null code, so it is filtered too."""
    return ~code.isin(*AGGREGATE_CODES)


def _shaped(rows: DataFrame, ba_code: str, type_code: Column, related_ba: Column) -> DataFrame:
    return rows.filter(single_authority(F.col(ba_code))).select(
        "period",
        F.col(ba_code).alias("ba_code"),
        type_code.alias("type_code"),
        related_ba.alias("related_ba"),
        "value",
        "value_units",
    )


def unify(fuel_type: DataFrame, interchange: DataFrame, region: DataFrame) -> DataFrame:
    """UNION ALL of generation, flows and demand.

    ``NG`` is net generation in the region feed but natural gas in the fuel feed, so it
    is filtered on the region side only, before the union. Only the reporting side of a
    flow is checked for aggregate codes.
    """
    generation = _shaped(fuel_type, "respondent", F.col("fueltype"), F.lit(NO_RELATED))
    flows = _shaped(interchange, "fromba", F.lit(FLOW_TYPE), F.col("toba"))
    demand = _shaped(
        region.filter(~F.col("type").isin(*REGION_SERIES_LEFT_OUT)),
        "respondent",
        F.col("type"),
        F.lit(NO_RELATED),
    )
    return generation.unionByName(flows).unionByName(demand)
