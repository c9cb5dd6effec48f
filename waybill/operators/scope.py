"""Which routes a report covers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.sources.tables import Tables


@dataclass(frozen=True)
class ReportScope:
    """Filters on the route table; a ``None`` field does not filter.

    ``exclude_partners`` is a frame with a ``partner_id`` column. Routes without a partner stay in.
    """

    route_type: str | None = "DELIVERY"
    route_status: str | None = "COMPLETED"
    start: date | str | None = None
    end: date | str | None = None
    countries: Sequence[str] | None = None
    centers: Sequence[str] | None = None
    vehicle_types: Sequence[str] | None = None
    partner_id: str | None = None
    exclude_partners: DataFrame | None = None

    def routes(self, tables: Tables) -> DataFrame:
        df = tables.routes_new
        if self.route_type is not None:
            df = df.filter(F.col("route_type") == self.route_type)
        if self.route_status is not None:
            df = df.filter(F.col("route_status") == self.route_status)
        df = between_dates(df, self.start, self.end)
        if self.centers is not None:
            df = df.filter(F.col("center_id").isin(list(self.centers)))
        if self.vehicle_types is not None:
            df = df.filter(F.col("vehicle_type_id").isin(list(self.vehicle_types)))
        if self.partner_id is not None:
            df = df.filter(F.col("partner_id") == self.partner_id)
        if self.countries is not None:
            hubs = tables.distribution_centers.filter(F.col("country").isin(list(self.countries)))
            df = df.join(hubs.select("center_id"), "center_id", "left_semi")
        if self.exclude_partners is not None:
            df = df.join(self.exclude_partners.select("partner_id"), "partner_id", "left_anti")
        return df


#: Every route, whatever its type, status or date.
ALL_ROUTES = ReportScope(route_type=None, route_status=None)


def between_dates(
    df: DataFrame, start: date | str | None, end: date | str | None, column: str = "route_date"
) -> DataFrame:
    """Both bounds included."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end).cast("date"))
    return df
