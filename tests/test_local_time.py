import pytest

from tests.frames import at, day, dicts, tables
from waybill.operators.scope import ReportScope
from waybill.plans.local_time import (
    hour_corruption_matrix,
    hour_corruption_overall,
    late_night_by_country,
    local_hour_profile,
)

SCOPE = ReportScope(start="2025-04-01", end="2025-05-31")


def route(number, kind, date, center):
    return {"route_id": number, "route_type": kind, "route_status": "COMPLETED",
            "route_date": day(date), "center_id": center}


def event(number, route_id, stamp, logged=None, kind="delivered"):
    return {"event_id": number, "route_id": route_id, "event_type": kind,
            "event_timestamp": at(stamp) if stamp else None, "event_hour_utc": logged}


@pytest.fixture(scope="module")
def network(spark):
    return tables(
        spark,
        distribution_centers=[
            {"center_id": "DC1", "country": "CO", "timezone_offset": -5},
            {"center_id": "DC2", "country": "MX", "timezone_offset": -6},
        ],
        routes_new=[
            route("R1", "DELIVERY", "2025-04-10", "DC1"),
            route("R2", "DELIVERY", "2025-04-11", "DC1"),
            route("R3", "DELIVERY", "2025-06-01", "DC2"),
            route("R4", "PICKUP", "2025-04-12", "DC2"),
        ],
        shipment_events_new=[
            event("E1", "R1", "2025-04-10 01:30:00"),
            event("E2", "R2", "2025-04-11 20:30:00", 0),
            event("E3", "R3", "2025-06-01 01:30:00"),
            event("E4", "R4", "2025-04-12 01:30:00"),
        ],
    )


def test_late_night(network):
    (co,) = dicts(late_night_by_country(network, SCOPE))
    assert co == {
        "country": "CO", "timezone_offset": -5, "total_deliveries": 2,
        "deliveries_utc_after_20": 1, "pct_utc_after_20": 50.0,
        "deliveries_local_after_20": 1, "pct_local_after_20": 50.0,
        "corrupt_records_count": 1, "corruption_pct": 50.0,
    }


def test_without_scope_every_route_counts(network):
    totals = {r["country"]: r["total_deliveries"]
              for r in dicts(late_night_by_country(network, None))}
    assert totals == {"CO": 2, "MX": 2}


def test_late_threshold_names_its_columns(network):
    (co,) = dicts(late_night_by_country(network, SCOPE, late_from=15))
    assert co["deliveries_utc_after_15"] == 1 and co["deliveries_local_after_15"] == 2


def test_local_hour_profile(network):
    got = [(r["country"], r["hour_local"], r["events"], r["in_hours"])
           for r in dicts(local_hour_profile(network, SCOPE))]
    assert got == [("CO", 15, 1, True), ("CO", 20, 1, False)]


def test_corruption(spark):
    stamped = tables(spark, shipment_events_new=[
        event("E1", None, "2025-04-10 21:00:00", 0),
        event("E2", None, "2025-04-10 22:00:00", 22),
        event("E3", None, "2025-04-10 19:00:00", 0),
        event("E4", None, "2025-04-10 23:00:00", 0),
    ])
    assert dicts(hour_corruption_overall(stamped)) == [
        {"total_rows": 4, "total_corrupt_rows": 2, "overall_corruption_pct": 50.0}
    ]
    late = dicts(hour_corruption_matrix(stamped, from_hour=20))
    assert [(r["true_hour_utc"], r["logged_hour_utc"], r["corruption_pct"]) for r in late] == [
        (21, 0, 100.0), (22, 22, 0.0), (23, 0, 100.0),
    ]
    assert hour_corruption_matrix(stamped).count() == 4


def test_empty_events(spark):
    (got,) = dicts(hour_corruption_overall(tables(spark)))
    assert got == {"total_rows": 0, "total_corrupt_rows": 0, "overall_corruption_pct": None}
