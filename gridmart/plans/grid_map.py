"""Frames behind the map: the network, one hour on it, and what is drawn from that."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.functions.labels import bubble_size, flow_direction, flow_text, hover_text
from gridmart.operators.joins import keep_all_small
from gridmart.plans.star import Star
from gridmart.schemas import FLOW_TYPE

NODE_COLUMNS = ("ba_id", "ba_name", "ba_code", "latitude", "longitude")


def grid_topology(star: Star, day: date) -> DataFrame:
    """Edges reported on a day."""
    day_id = star.dims.date.filter(F.col("full_date") == F.lit(day)).select("date_id")
    return (
        star.fact.filter((F.col("date_id") == day_id.scalar()) & (F.col("related_ba_id") != -1))
        .select("ba_id", "related_ba_id")
        .distinct()
    )


def grid_skeleton(star: Star, day: date) -> DataFrame:
    """Active authorities with the edges of one chosen day; lone authorities stay.

    At most one row per authority pair and the same for every hour shown, so ``cache()``
    it when several hours are drawn.
    """
    nodes = star.dims.ba.filter((F.col("is_active") == "Yes") & (F.col("ba_id") != -1)).select(
        "ba_id", "ba_code", "ba_name", "latitude", "longitude"
    )
    ends = star.dims.ba.select(
        F.col("ba_id").alias("related_ba_id"),
        F.col("latitude").alias("rel_lat"),
        F.col("longitude").alias("rel_lon"),
    )
    return (
        nodes.join(grid_topology(star, day), "ba_id", "left")
        .join(ends, "related_ba_id", "left")
        .select(
            "ba_id",
            "ba_code",
            "ba_name",
            "latitude",
            "longitude",
            "related_ba_id",
            "rel_lat",
            "rel_lon",
        )
    )


def hourly_telemetry(star: Star, day: date, hour: int) -> DataFrame:
    """Demand and flow rows of one hour."""
    day_id = star.dims.date.filter(F.col("full_date") == F.lit(day)).select("date_id")
    hour_id = star.dims.time_of_day.filter(F.col("hour_24") == hour).select("time_id")
    kinds = star.dims.type.filter(F.col("type_code").isin("D", FLOW_TYPE))
    return (
        star.fact.filter(
            (F.col("date_id") == day_id.scalar()) & (F.col("time_id") == hour_id.scalar())
        )
        .join(kinds.select("type_id", "type_code"), "type_id")
        .select("ba_id", "related_ba_id", "value", "type_code")
    )


def map_frame(skeleton: DataFrame, telemetry: DataFrame) -> DataFrame:
    """The network with an hour's flows and demand on it.

    One row per flow, plus one per edge or lone authority without a flow. Null related
    keys match each other. Demand is brought to one row per authority first (largest
    value, and ``demand_rows`` = how many there were): joining single demand rows would
    pair every flow of an authority with every demand row of it.
    """
    demand = (
        telemetry.filter(F.col("type_code") == "D")
        .groupBy("ba_id")
        .agg(F.max("value").alias("value_demand"), F.count(F.lit(1)).alias("demand_rows"))
    )
    flows = telemetry.filter(F.col("type_code") == FLOW_TYPE).select(
        "ba_id", "related_ba_id", F.col("value").alias("value_flow")
    )
    network = skeleton.join(demand, "ba_id", "left").withColumn(
        "demand_rows", F.coalesce("demand_rows", F.lit(0).cast("bigint"))
    )
    return keep_all_small(
        network, flows, ["ba_id", "related_ba_id"], null_safe=["related_ba_id"]
    ).select(*skeleton.columns, "value_flow", "value_demand", "demand_rows")


def node_summary(frame: DataFrame) -> DataFrame:
    """Demand, net interchange and hover text per authority with coordinates.

    The net interchange counts every flow once per demand row, as a row-by-row merge of
    the two would; with one demand row per authority and hour that is the plain sum.
    """
    return (
        frame.na.drop(subset=list(NODE_COLUMNS))
        .groupBy(*NODE_COLUMNS)
        .agg(
            F.max("value_demand").alias("value_demand"),
            F.coalesce(
                F.sum(F.col("value_flow") * F.greatest("demand_rows", F.lit(1))),
                F.lit(0).cast("bigint"),
            ).alias("value_flow"),
        )
        .withColumn(
            "custom_hover",
            hover_text(
                F.col("ba_name"), F.col("ba_code"), F.col("value_demand"), F.col("value_flow")
            ),
        )
    )


def edge_list(skeleton: DataFrame) -> DataFrame:
    """Line ends of every edge whose far end has coordinates."""
    return skeleton.filter(F.col("rel_lat").isNotNull()).select(
        "ba_id", "related_ba_id", "latitude", "longitude", "rel_lat", "rel_lon"
    )


def active_flows(frame: DataFrame) -> DataFrame:
    """Non-zero flows with line ends, direction and text."""
    return frame.filter(F.col("value_flow").isNotNull() & (F.col("value_flow") != 0)).select(
        "ba_id",
        "related_ba_id",
        "latitude",
        "longitude",
        "rel_lat",
        "rel_lon",
        "value_flow",
        flow_direction(F.col("value_flow")).alias("direction"),
        flow_text(F.col("ba_code"), F.col("related_ba_id"), F.col("value_flow")).alias("flow_text"),
    )


def node_bubbles(nodes: DataFrame) -> DataFrame:
    """Nodes with demand and their marker size, relative to the largest demand.

    There is a row per authority, so one window over all of them is small, and the frame
    under it is evaluated once.
    """
    shown = nodes.filter(F.col("value_demand").isNotNull())
    largest = F.max("value_demand").over(Window.partitionBy())
    return shown.withColumn("bubble_size", bubble_size(F.col("value_demand"), largest))
