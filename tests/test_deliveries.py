"""Productivity, effectiveness and network indicators on one small network."""

import pytest

from tests.frames import at, day, dicts, tables
from waybill.operators.scope import ReportScope
from waybill.plans import effectiveness, kpi, productivity

SCOPE = ReportScope(start="2025-04-01", end="2025-05-31")


def route(number, center, vehicle, planned, actual, partner="P1", **more):
    return {"route_id": number, "center_id": center, "vehicle_type_id": vehicle,
            "estimated_stops": planned, "actual_stops": actual, "partner_id": partner,
            "route_type": "DELIVERY", "route_status": "COMPLETED",
            "route_date": day("2025-04-10"), **more}


def shipment(number, route_id, status, hour=10, attempts=1):
    return {"shipment_id": number, "route_id": route_id, "last_status_detail": status,
            "delivery_attempt_count": attempts,
            "status_change_timestamp": at(f"2025-04-10 {hour:02d}:00:00")}


@pytest.fixture(scope="module")
def network(spark):
    return tables(
        spark,
        distribution_centers=[{"center_id": "C1", "country": "BR"},
                              {"center_id": "C2", "country": "CO"}],
        partners=[{"partner_id": "P1", "partner_name": "One", "country": "AR", "active_flag": 1},
                  {"partner_id": "P2", "partner_name": "Two", "country": "CO", "active_flag": -1}],
        vehicle_types=[{"vehicle_type_id": "V", "vehicle_type_name": "Van",
                        "max_capacity_units": 10}],
        routes_new=[
            route("R1", "C1", "V", 10, 9),
            route("R2", "C1", "V", 10, 5),
            route("R3", "C1", None, 10, 0),
            route("R4", "C2", "V", 4, 4, partner="P2"),
            route("R5", "C1", "V", 0, 0, partner=None),
            route("R6", "C1", "V", 10, 1, route_type="PICKUP"),
            route("R7", "C1", "V", 10, 1, route_status="CANCELLED"),
            route("R8", "C1", "V", 10, 1, route_date=day("2025-06-01")),
        ],
        shipments_new=[
            shipment("S1", "R1", "in_transit", 9), shipment("S1", "R1", "delivered", 12),
            shipment("S2", "R1", "delivered"),
            shipment("S3", "R1", "delivered", 9), shipment("S3", "R2", "failed", 11),
            shipment("S4", "R4", "failed"),
            shipment("S5", "R6", "delivered"),
            shipment("S6", "R9", "delivered"),
        ],
    )


def test_productivity(network):
    got = {r["country"]: r for r in dicts(productivity.productivity_by_country(network, SCOPE))}
    assert got["BR"] == {
        "country": "BR", "total_completed_routes": 3, "total_estimated_stops": 20,
        "total_actual_stops": 14, "stops_efficiency_pct": 70.0, "total_shipments_carried": 3,
        "total_max_capacity": 30, "capacity_utilization_pct": 10.0,
    }
    assert got["CO"]["total_shipments_carried"] == 1


def test_repeated_route_rows_are_summed_but_counted_once(spark, network):
    twice = network.replace(routes_new=network.routes_new.unionAll(network.routes_new))
    got = {r["country"]: r for r in dicts(productivity.productivity_by_country(twice, SCOPE))}
    assert got["BR"]["total_completed_routes"] == 3
    assert got["BR"]["total_actual_stops"] == 28


def test_underperforming_keeps_routes_without_vehicle(network):
    got = {r["country"]: r for r in dicts(productivity.underperforming_by_country(network, SCOPE))}
    assert (got["BR"]["total_completed_routes"], got["BR"]["underperforming_routes_count"]) == (4, 2)
    assert got["BR"]["underperforming_pct"] == 50.0


def test_worst_routes(network):
    (worst,) = dicts(productivity.worst_routes(network, SCOPE, "BR"))
    assert worst == {
        "route_id": "R2", "partner_name": "One", "vehicle_type_name": "Van", "estimated_stops": 10,
        "actual_stops": 5, "stops_efficiency_pct": 50.0, "shipments_carried": 1,
        "vehicle_capacity": 10,
    }
    both = dicts(productivity.worst_routes(network, SCOPE, "BR", keep_unassigned=True))
    assert [(r["route_id"], r["shipments_carried"]) for r in both] == [("R3", 0), ("R2", 1)]
    one = productivity.worst_routes(network, SCOPE, "BR", k=1, keep_unassigned=True)
    assert [r["route_id"] for r in dicts(one)] == ["R3"]


def test_packages_and_dedup_impact(network):
    packages = {r["country"]: r["packages_per_stop"]
                for r in dicts(productivity.packages_per_stop(network, SCOPE))}
    assert packages == {"BR": 0.2143, "CO": 0.25}
    impact = {r["country"]: r for r in dicts(productivity.dedup_impact(network, SCOPE))}
    assert (impact["BR"]["shipment_rows"], impact["BR"]["shipments_deduplicated"]) == (5, 3)
    assert impact["BR"]["rows_removed_pct"] == 40.0


def test_effectiveness_by_country(network):
    def rates(**options):
        return {r["country"]: (r["total_shipments"], r["delivered_shipments"],
                               r["success_rate_pct"])
                for r in dicts(effectiveness.effectiveness_by_country(network, SCOPE, **options))}

    assert rates() == {"BR": (3, 2, 66.67), "CO": (1, 0, 0.0)}
    assert rates(country_of="partner") == {"AR": (3, 2, 66.67), "CO": (1, 0, 0.0)}
    with pytest.raises(ValueError):
        effectiveness.effectiveness_by_country(network, SCOPE, country_of="moon")


def test_effectiveness_by_partner_outliers_and_extremes(network):
    partners = dicts(effectiveness.effectiveness_by_partner(network, SCOPE))
    assert [(r["country"], r["partner_id"], r["success_rate_pct"]) for r in partners] == [
        ("BR", "P1", 66.67), ("CO", "P2", 0.0),
    ]
    few = effectiveness.effectiveness_outliers(network, SCOPE, fewer_than=3, below_pct=10)
    assert [r["partner_id"] for r in dicts(few)] == ["P2"]
    sides = dicts(effectiveness.partner_extremes(network, SCOPE))
    assert sorted((r["country"], r["side"], r["partner_id"]) for r in sides) == [
        ("BR", "best", "P1"), ("BR", "worst", "P1"), ("CO", "best", "P2"), ("CO", "worst", "P2"),
    ]


def test_homogeneity(spark):
    rates = spark.createDataFrame([(81.0,), (81.3,), (80.2,), (None,)], "success_rate_pct double")
    (got,) = dicts(effectiveness.homogeneity(rates, baseline=81.0, tolerance=0.5))
    assert (got["group_count"], got["spread"], got["in_band_count"]) == (3, 1.1, 2)


def test_network_kpis(network):
    (card,) = dicts(kpi.network_kpis(network, SCOPE))
    assert card["stops_efficiency_pct"] == 75.0  # 18 / 24
    assert card["capacity_utilization_pct"] == 10.0  # 4 / 40
    assert card["success_rate_pct"] == 50.0
    assert card["oth_end_time_pct"] is None
    assert (card["active_partners"], card["total_partners"]) == (1, 2)


def test_scope_filters(spark, network):
    def ids(**fields):
        scope = ReportScope(start="2025-04-01", end="2025-05-31", **fields)
        return sorted(r["route_id"] for r in dicts(scope.routes(network)))

    assert ids() == ["R1", "R2", "R3", "R4", "R5"]
    assert ids(countries=["CO"]) == ["R4"]
    assert ids(centers=["C2"]) == ["R4"]
    assert ids(vehicle_types=["V"]) == ["R1", "R2", "R4", "R5"]
    assert ids(partner_id="P2") == ["R4"]
    out = spark.createDataFrame([("P1",)], "partner_id string")
    assert ids(exclude_partners=out) == ["R4", "R5"]
    assert "R6" in ids(route_type=None) and "R7" in ids(route_status=None)
