import pytest

from tests.frames import at, day, dicts, tables
from waybill.operators.scope import ReportScope
from waybill.plans.punctuality import (
    network_oth,
    oth_by_fleet,
    oth_by_hour,
    oth_top_gap,
    oth_underperforming,
)

SCOPE = ReportScope(start="2025-04-01", end="2025-05-31")


def route(number, kind, date, partner, vehicle, planned, actual, **more):
    def times(pair):
        return [at(f"{date} {t}:00") if t else None for t in pair]

    (p0, p1), (a0, a1) = times(planned), times(actual)
    return {
        "route_id": str(number), "route_type": kind, "route_status": "COMPLETED",
        "route_date": day(date), "partner_id": partner, "vehicle_type_id": vehicle,
        "center_id": "301", "planned_route_start_time": p0, "planned_route_end_time": p1,
        "actual_route_start_time": a0, "actual_route_end_time": a1, **more,
    }


PLAN = ("08:00", "12:00")


@pytest.fixture(scope="module")
def fleet(spark):
    return tables(
        spark,
        partners=[{"partner_id": "101", "partner_name": "Partner A"},
                  {"partner_id": "102", "partner_name": "Partner B"}],
        vehicle_types=[{"vehicle_type_id": "201", "vehicle_type_name": "Van"},
                       {"vehicle_type_id": "202", "vehicle_type_name": "Truck"}],
        distribution_centers=[{"center_id": "301", "country": "Brazil"}],
        routes_new=[
            route(1, "DELIVERY", "2025-04-10", "101", "201", PLAN, ("08:00", "11:00")),
            route(2, "DELIVERY", "2025-04-11", "101", "201", PLAN, ("09:00", "13:00")),
            route(3, "DELIVERY", "2025-04-12", "102", "202", PLAN, ("08:00", "11:00")),
            route(4, "DELIVERY", "2025-04-13", "102", "202", PLAN, ("08:00", "13:00")),
            route(5, "PICKUP", "2025-04-14", "101", "201", PLAN, ("08:00", "11:00")),
        ],
    )


def test_by_fleet(fleet):
    got = {
        (r["country"], r["partner_name"], r["vehicle_type_name"]):
        (r["total_routes"], r["oth_end_time_pct"], r["oth_duration_pct"], r["oth_metric_gap"])
        for r in dicts(oth_by_fleet(fleet, SCOPE))
    }
    assert got == {
        ("Brazil", "Partner A", "Van"): (2, 50.0, 100.0, 50.0),
        ("Brazil", "Partner B", "Truck"): (2, 50.0, 50.0, 0.0),
    }


def test_by_hour_and_network(fleet):
    (hour,) = dicts(oth_by_hour(fleet, SCOPE))
    assert (hour["planned_end_hour"], hour["total_routes"]) == (12, 4)
    (network,) = dicts(network_oth(fleet, SCOPE))
    assert (network["oth_end_time_pct"], network["oth_duration_pct"]) == (50.0, 75.0)


def test_underperforming_and_top_gap(fleet):
    assert oth_underperforming(fleet, SCOPE).count() == 2
    assert oth_underperforming(fleet, SCOPE, below_pct=50.0).count() == 0
    (top,) = dicts(oth_top_gap(fleet, SCOPE, k=1, min_routes=2))
    assert top["partner_name"] == "Partner A"


def test_incomplete_and_inverted_times_stay_out(spark, fleet):
    odd = tables(spark, routes_new=[
        route(6, "DELIVERY", "2025-04-10", "101", "201", PLAN, ("08:00", None)),
        route(7, "DELIVERY", "2025-04-10", "101", "201", PLAN, ("11:00", "08:00")),
        route(8, "DELIVERY", "2025-04-10", "101", "201", ("12:00", "08:00"), ("08:00", "11:00")),
        route(9, "DELIVERY", "2025-06-01", "101", "201", PLAN, ("08:00", "11:00")),
    ])
    assert oth_by_fleet(fleet.replace(routes_new=odd.routes_new), SCOPE).count() == 0


def test_whole_minutes_are_compared(spark, fleet):
    late = route(1, "DELIVERY", "2025-04-10", "101", "201", PLAN, ("08:00", "12:00"))
    late["actual_route_end_time"] = at("2025-04-10 12:00:59")
    frame = tables(spark, routes_new=[late]).routes_new
    (got,) = dicts(oth_by_fleet(fleet.replace(routes_new=frame), SCOPE))
    assert (got["oth_end_time_pct"], got["oth_duration_pct"]) == (0.0, 100.0)


def test_hour_as_extra_key_and_excluded_partner(spark, fleet):
    keyed = oth_by_fleet(fleet, SCOPE, ["country", "planned_end_hour"])
    assert [(r["country"], r["planned_end_hour"], r["total_routes"]) for r in dicts(keyed)] == [
        ("Brazil", 12, 4)
    ]
    out = spark.createDataFrame([("101",)], "partner_id string")
    scope = ReportScope(start="2025-04-01", end="2025-05-31", exclude_partners=out)
    assert [r["partner_name"] for r in dicts(oth_by_fleet(fleet, scope))] == ["Partner B"]
