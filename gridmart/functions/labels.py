"""Categories and display text, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.schemas import FLOW_TYPE, GENERATION_TYPE_IDS

SMALLEST_BUBBLE = 10
BUBBLE_RANGE = 35


def category(type_code: Column, type_id: Column) -> Column:
    """Reporting category of an observation type; null where it has none."""
    return (
        F.when(type_code == "D", "Demand")
        .when(type_code == "DF", "Demand Forecast")
        .when(type_code == FLOW_TYPE, "Total Interchange")
        .when(type_id.between(*GENERATION_TYPE_IDS), "Net Generation")
    )


def quantity_text(value: Column) -> Column:
    """``12,345 MW``, or a notice when there is nothing to show (null or zero)."""
    return F.when(value.isNull() | (value == 0), "data unavailable").otherwise(
        F.concat(F.format_number(value, 0), F.lit(" MW"))
    )


def hover_text(name: Column, code: Column, demand: Column, flow: Column) -> Column:
    return F.concat(
        F.lit("<b>"),
        name,
        F.lit(" ("),
        code,
        F.lit(")</b><br>Demand: "),
        quantity_text(demand),
        F.lit("<br>Net Interchange: "),
        quantity_text(flow),
    )


def flow_text(code: Column, related: Column, value: Column) -> Column:
    """Text of a flow; the far end may be an authority that the model does not know."""
    return F.concat(
        F.lit("Flow: "),
        code,
        F.lit(" ➔ "),
        F.coalesce(related.cast("string"), F.lit("unknown")),
        F.lit("<br>Value: "),
        F.format_number(value, 0),
        F.lit(" MW"),
    )


def flow_direction(value: Column) -> Column:
    """Negative interchange is a net inflow, positive a net outflow."""
    return F.when(value > 0, "outflow").when(value < 0, "inflow")


def bubble_size(value: Column, largest: Column) -> Column:
    """Marker size of a value relative to the largest one; a zero maximum counts as 1."""
    scale = F.when(largest == 0, 1).otherwise(largest)
    return SMALLEST_BUBBLE + (value / scale) * BUBBLE_RANGE
