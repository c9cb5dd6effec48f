import pytest

from tests.frames import at, day, dicts, tables
from waybill.plans import consistency


def route(number, status="COMPLETED", start=None, end=None, date="2025-04-10", partner="P1",
          center="C1", vehicle="V1", **more):
    return {"route_id": number, "route_status": status, "partner_id": partner, "center_id": center,
            "vehicle_type_id": vehicle, "route_date": day(date),
            "actual_route_start_time": at(f"{date} {start}:00") if start else None,
            "actual_route_end_time": at(f"{date} {end}:00") if end else None, **more}


@pytest.fixture(scope="module")
def carriers(spark):
    return tables(
        spark,
        partners=[
            {"partner_id": "P1", "partner_name": "One", "active_flag": 1,
             "contract_end_date": day("2025-04-11")},
            {"partner_id": "P2", "partner_name": "Two", "active_flag": 0},
            {"partner_id": "P3", "partner_name": "Three", "active_flag": -1},
            {"partner_id": "P4", "partner_name": "Idle", "active_flag": 1},
        ],
        routes_new=[
            route("R1", start="08:00", end="12:00"),
            route("R2", start="09:00", end="10:00", center="C2"),
            route("R3", start="11:00", end="13:00", center="C2", vehicle="V2"),
            route("R4", start="15:00", end="14:00"),
            route("R5", start="15:00"),
            route("R6", status="IN_PROGRESS", date="2025-04-12"),
            route("R7", partner="P2", start="08:00", end="09:00"),
            route("R8", partner="P3", start="08:00", end="09:00"),
            route("R9", partner=None, start="08:00", end="09:00"),
        ],
    )


def by_partner(df):
    return {r["partner_id"]: r for r in dicts(df)}


def test_profile(carriers):
    got = by_partner(consistency.consistency_profile(carriers))
    assert set(got) == {"P1", "P2", "P3"}
    assert got["P1"] == {
        "partner_id": "P1", "partner_name": "One", "total_routes_assigned": 6,
        "stale_in_progress_count": 1, "stale_in_progress_pct": 16.67, "completed_routes_count": 5,
        "chrono_violations_count": 1, "chrono_violations_pct": 20.0,
        "gps_sync_failures_count": 1, "gps_sync_failures_pct": 20.0,
        "overlapping_routes_estimate": 3, "multi_hub_overlaps_count": 2,
        "impossible_vehicle_allocations_count": 1,
        "contract_expired_routes_count": 1, "contract_expired_routes_pct": 16.67,
    }
    assert got["P2"]["contract_expired_routes_pct"] == 100.0
    assert got["P3"]["contract_expired_routes_count"] == 0
    assert got["P3"]["overlapping_routes_estimate"] == 0


def test_profile_bounds_and_period(carriers):
    got = by_partner(
        consistency.consistency_profile(carriers, "P1", "2025-04-12", "2025-04-30")
    )
    assert list(got) == ["P1"] and got["P1"]["total_routes_assigned"] == 1
    weeks = dicts(consistency.consistency_profile(carriers, "P1", period="week"))
    assert [(r["period"], r["total_routes_assigned"]) for r in weeks] == [(day("2025-04-07"), 6)]


def test_stale_as_of(carriers):
    def stale(**options):
        return by_partner(consistency.stale_closure(carriers, **options))["P1"]

    assert stale()["stale_routes_count"] == 1
    assert stale(as_of="2025-04-12")["stale_routes_count"] == 0
    assert stale(as_of="2025-04-13")["stale_routes_count"] == 1
    assert stale()["route_closure_rate"] == 83.33


def test_overlap_summary_has_zeros(carriers):
    got = by_partner(consistency.overlap_summary(carriers))
    assert set(got) == {"P1", "P2", "P3", "P4"}
    assert got["P4"] == {
        "partner_id": "P4", "overlapping_routes_estimate": 0, "multi_hub_overlaps_count": 0,
        "impossible_vehicle_allocations_count": 0,
    }


def test_contract_violations(carriers):
    got = by_partner(consistency.contract_violations(carriers))
    assert set(got) == {"P1", "P2"}
    assert got["P1"]["earliest_violation_date"] == day("2025-04-12")
    assert got["P2"]["routes_after_expiration_count"] == 1


def test_exclusion(carriers):
    got = by_partner(consistency.partner_exclusion(carriers))
    assert (got["P1"]["combined_error_count"], got["P1"]["combined_error_pct"]) == (3, 50.0)
    assert [k for k, r in got.items() if r["excluded"]] == ["P1"]
    assert [r["partner_id"] for r in dicts(consistency.flagged_partners(carriers))] == ["P1"]
    assert [r["partner_id"] for r in dicts(consistency.deprecated_partners(carriers))] == ["P3"]


def test_gps_and_status(carriers):
    assert by_partner(consistency.gps_chronology(carriers))["P1"]["gps_sync_failures_count"] == 1
    statuses = dicts(consistency.route_status_breakdown(carriers, "P1"))
    assert {r["route_status"]: r["total_routes"] for r in statuses} == {
        "COMPLETED": 5, "IN_PROGRESS": 1,
    }


def test_partner_duplication(spark, carriers):
    parcels = [{"shipment_id": s, "route_id": r} for s, r in
               (("S1", "R1"), ("S1", "R1"), ("S1", "R2"), ("S2", "R1"), ("S3", "R7"))]
    frame = tables(spark, shipments_new=parcels).shipments_new
    got = by_partner(consistency.partner_duplication(carriers.replace(shipments_new=frame)))
    assert (got["P1"]["total_raw_shipments"], got["P1"]["unique_shipments"]) == (4, 2)
    assert (got["P1"]["duplicate_count"], got["P1"]["duplicate_pct"]) == (2, 50.0)
