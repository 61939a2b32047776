"""The stored tables of one warehouse, and the steps that fill them.

The staged feeds grow by appends, ``dim_ba`` and ``dim_type`` come from seeds, and
``fct_grid_operation`` is rebuilt or refreshed by day from the staged feeds.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridmart.operators.unify import unify
from gridmart.plans import quality
from gridmart.plans.dimensions import dim_ba, dim_date, dim_time_of_day, dim_type
from gridmart.plans.star import (
    Dimensions,
    Star,
    fact_table,
    grid_fact,
    in_calendar,
    refresh_fact,
    replace_days,
    write_fact,
)
from gridmart.schemas import (
    CALENDAR_END,
    CALENDAR_START,
    DIM_BA_SCHEMA,
    DIM_TYPE_SCHEMA,
    FACT_COLUMNS,
    FEEDS,
    Feed,
)
from gridmart.session import apply_settings
from gridmart.sources.control import ChangeLog, exclusive
from gridmart.sources.staging import append_new, staged_table
from gridmart.sources.tables import Table


@dataclass(frozen=True)
class Warehouse:
    """Tables in a folder (``root`` with a slash) or in a database of the catalog."""

    spark: SparkSession
    root: str

    def __post_init__(self) -> None:
        apply_settings(self.spark)

    def _target(self, name: str) -> str:
        return f"{self.root}/{name}" if "/" in self.root else f"{self.root}.{name}"

    def staged_table(self, feed: Feed) -> Table:
        return staged_table(self._target(feed.name), feed)

    @property
    def fact_table(self) -> Table:
        return fact_table(self._target("fct_grid_operation"))

    @property
    def _ba_table(self) -> Table:
        return Table(self._target("dim_ba"), DIM_BA_SCHEMA)

    @property
    def _type_table(self) -> Table:
        return Table(self._target("dim_type"), DIM_TYPE_SCHEMA)

    def append(self, raw: DataFrame, feed: Feed, rejected: Observation | None = None) -> None:
        append_new(self.spark, raw, self.staged_table(feed), feed, rejected)

    def staged(self, first: date | None = None, last: date | None = None) -> dict[str, DataFrame]:
        """Staged feeds; bounds prune their day partitions."""
        tables = {}
        for name, feed in FEEDS.items():
            rows = self.staged_table(feed).read(self.spark)
            if first is not None:
                rows = rows.filter(F.col("day") >= F.lit(first))
            if last is not None:
                rows = rows.filter(F.col("day") <= F.lit(last))
            tables[name] = rows.drop("day")
        return tables

    def unified(self, first: date | None = None, last: date | None = None) -> DataFrame:
        staged = self.staged(first, last)
        return unify(staged["fuel_type"], staged["interchange"], staged["region"])

    def load_seeds(self, authorities: DataFrame, types: DataFrame) -> None:
        self._ba_table.replace(dim_ba(authorities))
        self._type_table.replace(dim_type(types))

    def dimensions(self) -> Dimensions:
        return Dimensions(
            self._ba_table.read(self.spark),
            self._type_table.read(self.spark),
            dim_date(self.spark),
            dim_time_of_day(self.spark),
        )

    def fact_from_staged(self, first: date | None = None, last: date | None = None) -> DataFrame:
        return grid_fact(self.unified(first, last), self.dimensions())

    def _pending(self) -> dict[str, dict[str, set[date | None]]]:
        """Open change entries of each feed; its lease is held, so that they are those of finished runs."""
        pending = {}
        for name, feed in FEEDS.items():
            table = self.staged_table(feed)
            with exclusive(self.spark, table):
                pending[name] = ChangeLog(self.spark, table).pending()
        return pending

    def _caught_up(self, pending: dict[str, dict[str, set[date | None]]]) -> None:
        for name, entries in pending.items():
            ChangeLog(self.spark, self.staged_table(FEEDS[name])).clear(entries)

    def build_fact(self) -> None:
        """Rebuild the fact from all staged rows."""
        with exclusive(self.spark, self.fact_table):
            pending = self._pending()
            write_fact(self.fact_from_staged(), self.fact_table)
            self._caught_up(pending)

    def refresh_changed(self) -> list[date] | None:
        """Rebuild the days of the fact whose staged rows changed since it last caught up, and return them.

        The days come from the change logs of the feeds, late ones included. They are rebuilt from all their staged
        rows and only then crossed off, so that a run that fails is simply repeated. Where a feed
        is new, or the fact is, all of it is built and None returned.
        """
        with exclusive(self.spark, self.fact_table):
            pending = self._pending()
            days = set().union(*(own for entries in pending.values() for own in entries.values()))
            whole = None in days or self.fact_table.read_if_any(self.spark) is None
            if whole:
                write_fact(self.fact_from_staged(), self.fact_table)
            elif days:
                replace_days(self._fact_of(days), self.fact_table)
            self._caught_up(pending)
        return None if whole else sorted(days)

    def _fact_of(self, days: set[date]) -> DataFrame:
        """The fact's rows of some days; those off the calendar share a partition, so one of them brings all."""
        day = F.col("day")
        wanted = day.isin([d for d in days if in_calendar(d)])
        if not all(map(in_calendar, days)):
            wanted |= ~day.between(F.lit(CALENDAR_START).cast("date"), F.lit(CALENDAR_END).cast("date"))
        staged = {name: self.staged_table(feed).read(self.spark).filter(wanted).drop("day") for name, feed in FEEDS.items()}
        return grid_fact(unify(staged["fuel_type"], staged["interchange"], staged["region"]), self.dimensions())

    def refresh_fact(self, first: date, last: date) -> None:
        """Rebuild only the days ``first..last``; reads only those staged days."""
        with exclusive(self.spark, self.fact_table):
            refresh_fact(self.fact_from_staged(first, last), self.fact_table, first, last)

    def star(self, first: date | None = None, last: date | None = None) -> Star:
        """The fact and its dimensions; bounds prune the fact's day partitions."""
        fact = self.fact_table.read(self.spark).select(*FACT_COLUMNS)
        if first is not None:
            fact = fact.filter(F.col("date_id") >= int(f"{first:%Y%m%d}"))
        if last is not None:
            fact = fact.filter(F.col("date_id") <= int(f"{last:%Y%m%d}"))
        return Star(fact, self.dimensions())

    def check(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """All data checks, one row each; bounds limit the feeds and the fact to some days.

        Equal keys have equal days, so that checking days one by one finds every repeat.
        Fact rows without a day are in no range.
        """
        days = first, last
        return quality.report(self.staged(*days), self.unified(*days), self.star(*days))
