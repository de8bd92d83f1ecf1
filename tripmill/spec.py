"""Configuration: which services, which months, where tables live, which thresholds."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date
from typing import NamedTuple

from tripmill.functions.dates import month_day, month_number, month_runs

# The two licensed taxi services, their file prefixes and their
# service-specific time columns; the default months; the default thresholds.
TAXI_SERVICES = (
    ("yellow", "yellow_tripdata", "tpep_pickup_datetime", "tpep_dropoff_datetime"),
    ("green", "green_tripdata", "lpep_pickup_datetime", "lpep_dropoff_datetime"),
)
TAXI_YEAR = 2023
TAXI_MONTHS = (1, 2, 3, 4, 5)
MIN_TOTAL_AMOUNT = 0.0
MIN_PASSENGER_COUNT = 1

#: A month of the spec's own year, or a (year, month) pair.
Month = int | tuple[int, int]

_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.\-]+")


class TableName(NamedTuple):
    """A three-part table name; ``str()`` gives the quoted SQL form."""

    catalog: str
    schema: str
    table: str

    def __str__(self) -> str:
        return ".".join(f"`{part.replace('`', '``')}`" for part in self)

    def renamed(self, table: str) -> "TableName":
        return self._replace(table=table)


@dataclass(frozen=True)
class ServiceSpec:
    """One service: its folder name, its file prefix and its two time columns."""

    name: str
    file_prefix: str
    pickup_col: str
    dropoff_col: str

    def __post_init__(self) -> None:
        # Names end up in file paths and are read back out of them.
        for value in (self.name, self.file_prefix):
            if not _PLAIN_NAME.fullmatch(value):
                raise ValueError(f"use only letters, digits, '_', '-' and '.': {value!r}")


def taxi_services() -> tuple[ServiceSpec, ...]:
    return tuple(ServiceSpec(*row) for row in TAXI_SERVICES)


@dataclass(frozen=True)
class PipelineSpec:
    """Everything the layers need to know; immutable, so it can be shared by threads.

    ``exact_months``   keep only the listed months instead of the span they cover.
    ``lossless``       int/bigint mixed with float becomes double instead of float.
    ``on_bad_cast``    ``"fail"`` stops on a value that does not fit, ``"null"`` keeps
                       the row with NULL, ``"route"`` keeps the row out of silver and puts
                       it, as it was stored, with the reason into ``rejected_table``.
    ``monthly_layout`` partition silver and gold by a trailing ``pickup_month`` column.
                       Off by default because the published schemas are a contract.
    ``calendar``       (year, month) pairs, over as many years as there are; where given, they
                       stand in for ``year`` and ``months``.
    ``refreshable``    ``monthly_layout``, and bronze partitioned by a trailing
                       ``landed_month``, so that ``refresh`` can rewrite single months.
    ``by_service``     partition the unified gold table by service as well, which is then written
                       service by service, side by side; needs a layout by month.
    ``swap``           how a table of a plain format is replaced: ``"rename"`` or ``"view"``,
                       see ``publish``.
    """

    landing_root: str
    services: tuple[ServiceSpec, ...] = field(default_factory=taxi_services)
    year: int = TAXI_YEAR
    months: tuple[int, ...] = TAXI_MONTHS
    consumption_services: tuple[str, ...] = ("yellow",)
    catalog: str = "spark_catalog"
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    table_format: str = "parquet"
    min_total_amount: float = MIN_TOTAL_AMOUNT
    min_passenger_count: int = MIN_PASSENGER_COUNT
    exact_months: bool = False
    lossless: bool = False
    on_bad_cast: str = "fail"
    monthly_layout: bool = False
    calendar: tuple[tuple[int, int], ...] = ()
    refreshable: bool = False
    by_service: bool = False
    swap: str = "rename"

    def __post_init__(self) -> None:
        if not self.services:
            raise ValueError("a spec needs at least one service")
        listed = [month for _, month in self.periods]
        if not listed or not all(1 <= m <= 12 for m in listed):
            raise ValueError(f"months must be a non-empty list of 1..12: {listed}")
        if len(set(self.periods)) != len(self.periods):
            raise ValueError(f"a month listed twice would be read twice: {self.periods}")
        if self.on_bad_cast not in ("fail", "null", "route"):
            raise ValueError(f"on_bad_cast must be 'fail', 'null' or 'route': {self.on_bad_cast!r}")
        if self.swap not in ("rename", "view"):
            raise ValueError(f"swap must be 'rename' or 'view': {self.swap!r}")
        if self.by_service and not self.by_month:
            raise ValueError("by_service needs monthly_layout or refreshable")
        names = [s.name for s in self.services]
        if len(set(names)) != len(names):
            raise ValueError(f"service names must be unique: {names}")
        unknown = set(self.consumption_services) - set(names)
        if unknown:
            raise ValueError(f"consumption table asked for unknown services: {sorted(unknown)}")

    # -- services and files -------------------------------------------------

    def service(self, name: str) -> ServiceSpec:
        for candidate in self.services:
            if candidate.name == name:
                return candidate
        raise KeyError(f"unknown service {name!r}")

    @property
    def periods(self) -> tuple[tuple[int, int], ...]:
        """Every expected month as a (year, month) pair; those of a calendar in order."""
        if self.calendar:
            return tuple(sorted((int(y), int(m)) for y, m in self.calendar))
        return tuple((self.year, m) for m in self.months)

    def period(self, month: Month) -> tuple[int, int]:
        return (self.year, month) if isinstance(month, int) else (month[0], month[1])

    @property
    def by_month(self) -> bool:
        """Whether silver and gold are partitioned by pickup month."""
        return self.monthly_layout or self.refreshable

    def file_name(self, service: str, month: Month) -> str:
        year, month = self.period(month)
        return f"{self.service(service).file_prefix}_{year}-{month:02d}.parquet"

    def service_dir(self, service: str) -> str:
        return f"{self.landing_root.rstrip('/')}/{service}"

    def file_path(self, service: str, month: Month) -> str:
        return f"{self.service_dir(service)}/{self.file_name(service, month)}"

    # -- scope --------------------------------------------------------------

    @property
    def scope(self) -> tuple[date, date]:
        """First day of the earliest month, first day after the latest month."""
        numbers = [month_number(*period) for period in self.periods]
        return month_day(min(numbers)), month_day(max(numbers) + 1)

    @property
    def scope_ranges(self) -> list[tuple[date, date]]:
        """The half-open date ranges a pickup may fall in."""
        if not self.exact_months:
            return [self.scope]
        runs = month_runs(month_number(*period) for period in self.periods)
        return [(month_day(lo), month_day(hi + 1)) for lo, hi in runs]

    # -- tables -------------------------------------------------------------

    def table(self, schema: str, table: str) -> TableName:
        return TableName(self.catalog, schema, table)

    def bronze_table(self, service: str) -> TableName:
        return self.table(self.bronze_schema, f"{service}_tripdata")

    def silver_table(self, service: str) -> TableName:
        return self.table(self.silver_schema, f"{service}_trips")

    def rejected_table(self, service: str) -> TableName:
        return self.table(self.silver_schema, f"{service}_rejected")

    def consumption_table(self, service: str) -> TableName:
        return self.table(self.gold_schema, f"{service}_trips_consumption")

    @property
    def trips_table(self) -> TableName:
        return self.table(self.gold_schema, "taxi_trips")

    @property
    def tables(self) -> list[TableName]:
        """Every table of every layer."""
        names = [s.name for s in self.services]
        return [
            *[self.bronze_table(name) for name in names],
            *[self.silver_table(name) for name in names],
            *[self.rejected_table(name) for name in names if self.on_bad_cast == "route"],
            *[self.consumption_table(name) for name in self.consumption_services],
            self.trips_table,
        ]
