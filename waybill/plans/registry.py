"""Reports by name, with declared and checked parameters."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date
from typing import Any

from pyspark.sql import DataFrame

from waybill.operators.scope import ReportScope
from waybill.plans import consistency, effectiveness, kpi, local_time, productivity, punctuality
from waybill.sources.tables import Tables

_ISO_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


def _as_date(value: Any) -> date:
    if isinstance(value, date):
        return value
    if isinstance(value, str) and _ISO_DATE.fullmatch(value):
        return date.fromisoformat(value)
    raise ValueError(f"not a YYYY-MM-DD date: {value!r}")


def _as_text(value: Any) -> str:
    if isinstance(value, str) and value:
        return value
    raise ValueError(f"not a non-empty text: {value!r}")


_CHECKS: Mapping[str, Callable[[Any], Any]] = {"date": _as_date, "string": _as_text}


@dataclass(frozen=True)
class Metric:
    run: Callable[..., DataFrame]
    description: str
    params: Mapping[str, str] = field(default_factory=dict)


def _scoped(report: Callable[..., DataFrame], **options: Any) -> Callable[..., DataFrame]:
    def run(tables: Tables, start_date: date, end_date: date) -> DataFrame:
        return report(tables, ReportScope(start=start_date, end=end_date), **options)

    return run


def _oth_schedule(tables: Tables, start_date: date, end_date: date) -> DataFrame:
    scope = ReportScope(start=start_date, end=end_date)
    keys = [*punctuality.FLEET_KEYS, "planned_end_hour"]
    return punctuality.oth_by_fleet(tables, scope, keys)


def _carrier_consistency(
    tables: Tables, partner_id: str, start_date: date, end_date: date
) -> DataFrame:
    return consistency.consistency_profile(tables, partner_id, start_date, end_date)


_DATES = {"start_date": "date", "end_date": "date"}

METRICS: dict[str, Metric] = {
    "route_productivity": Metric(
        _scoped(productivity.productivity_by_country),
        "Stops efficiency and capacity use by country for completed delivery routes.",
        _DATES,
    ),
    "delivery_effectiveness": Metric(
        _scoped(effectiveness.effectiveness_by_partner),
        "Shipments, delivered shipments and success rate by country and partner.",
        _DATES,
    ),
    "oth_schedule": Metric(
        _oth_schedule,
        "On-time handling by country, partner, vehicle type and planned end hour.",
        _DATES,
    ),
    "timezone_corruption": Metric(
        _scoped(local_time.late_night_by_country),
        "Late deliveries by UTC and local hour, and truncated logged hours, by country.",
        _DATES,
    ),
    "carrier_consistency": Metric(
        _carrier_consistency,
        "Stale, inverted, untimed, overlapping and out-of-contract routes of one partner.",
        {"partner_id": "string", **_DATES},
    ),
    "network_kpis": Metric(
        _scoped(kpi.network_kpis), "One row of network-wide indicators.", _DATES
    ),
}


def run_metric(tables: Tables, name: str, **params: Any) -> DataFrame:
    """Run a named report. Unknown, missing or ill-typed parameters raise ``ValueError``."""
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}; known: {sorted(METRICS)}")
    metric = METRICS[name]
    unknown, missing = set(params) - set(metric.params), set(metric.params) - set(params)
    if unknown or missing:
        raise ValueError(f"{name}: unknown {sorted(unknown)}, missing {sorted(missing)}")
    checked = {}
    for key, kind in metric.params.items():
        try:
            checked[key] = _CHECKS[kind](params[key])
        except ValueError as bad:
            raise ValueError(f"{name}.{key}: {bad}") from None
    if "start_date" in checked and checked["start_date"] > checked["end_date"]:
        raise ValueError(f"{name}: start_date lies after end_date")
    return metric.run(tables, **checked)
