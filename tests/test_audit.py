import pytest
from pyspark.sql import functions as F

from tests.frames import at, day, dicts, rows, tables
from waybill.operators import checks
from waybill.operators.checks import Check, run_checks
from waybill.plans import audit


@pytest.fixture(scope="module")
def messy(spark):
    def route(number, partner="P1", vehicle="V1", start="08:00", end="09:00", **more):
        return {"route_id": number, "partner_id": partner, "vehicle_type_id": vehicle,
                "route_date": day("2025-04-10"), "estimated_stops": 10, "actual_stops": 10,
                "actual_route_start_time": at(f"2025-04-10 {start}:00"),
                "actual_route_end_time": at(f"2025-04-10 {end}:00") if end else None, **more}

    return tables(
        spark,
        distribution_centers=[
            {"center_id": "C1", "active_flag": 1, "timezone_offset": -5,
             "operational_hours_start": 6, "operational_hours_end": 24},
            {"center_id": "C2", "active_flag": None, "timezone_offset": -13},
            {"center_id": "C2", "active_flag": 2, "timezone_offset": -5},
        ],
        partners=[{"partner_id": "P1", "active_flag": -1, "sla_compliance_pct": 101.0,
                   "average_delivery_time_hours": 0.0}, {"partner_id": "P2", "active_flag": 1}],
        vehicle_types=[{"vehicle_type_id": "V1", "fuel_type": "STEAM", "max_capacity_units": 0},
                       {"vehicle_type_id": "V2"}],
        routes_new=[
            route("R1", end="07:00"), route("R2", partner=None, end=None),
            route("R3", partner="P9", vehicle=None, actual_stops=16, route_distance_km=-1.0),
            route("R3", vehicle="V9", start="08:30", actual_stops=15),
        ],
        shipments_new=[
            {"shipment_id": "S1", "delivery_attempt_count": -1},
            {"shipment_id": "S1", "delivery_attempt_count": 11},
            {"shipment_id": "S2"},
        ],
        shipment_events_new=[
            {"event_id": "E1", "shipment_id": "S1", "event_hour_utc": 24,
             "event_timestamp": at("2025-04-10 10:00:00")},
            {"event_id": "E2", "shipment_id": "S9", "event_hour_utc": 0},
            {"event_id": "E3", "shipment_id": "S9", "event_timestamp": at("2025-04-10 10:00:00")},
        ],
    )


def test_unified_audit(messy):
    got = {r["audit_check"]: (r["total_records"], r["error_count"], r["error_pct"])
           for r in dicts(audit.unified_audit(messy))}
    assert got == {
        "shipments_new PK Duplication": (3, 1, 33.33),
        "routes_new Chrono Violations": (4, 1, 25.0),
        "routes_new Missing Partners": (4, 1, 25.0),
        "shipment_events_new Hour Corruption": (2, 1, 50.0),
        "partners Deprecated Contracts": (2, 1, 50.0),
    }
    pcts = [r["error_pct"] for r in dicts(audit.unified_audit(messy))]
    assert pcts == sorted(pcts, reverse=True)


def test_audit_of_empty_tables(spark):
    assert all(r["error_count"] == 0 and r["error_pct"] is None
               for r in dicts(audit.unified_audit(tables(spark))))


def test_generations(messy):
    got = {(r["generation"], r["audit_check"]): r["error_count"]
           for r in dicts(audit.compare_generations(messy))}
    assert len(got) == 6 and got[("Production", "PK Duplication")] == 1
    assert got[("Control", "Chrono Violations")] == 0


def test_domains_and_ranges(messy):
    domains = {r["table_name"]: r["error_count"] for r in dicts(audit.domain_checks(messy))}
    assert domains == {"distribution_centers": 2, "vehicle_types": 2}
    ranges = {(r["table_name"], r["rule"]): r["error_count"] for r in dicts(audit.range_checks(messy))}
    assert {k: v for k, v in ranges.items() if v} == {
        ("distribution_centers", "timezone_offset beyond 12"): 1,
        ("distribution_centers", "operational hours outside 0-23"): 1,
        ("partners", "sla_compliance_pct outside 0-100"): 1,
        ("partners", "average_delivery_time_hours not above 0"): 1,
        ("vehicle_types", "max_capacity_units not above 0"): 1,
        ("routes_new", "route_distance_km below 0"): 1,
        ("shipments_new", "delivery_attempt_count below 0"): 1,
        ("shipments_new", "delivery_attempt_count above 10"): 1,
        ("shipment_events_new", "event_hour_utc outside 0-23"): 1,
    }


def test_profiles(messy):
    shape = {r["table_name"]: (r["row_count"], r["column_count"])
             for r in dicts(audit.table_profile(messy))}
    assert shape["routes_new"] == (4, 14) and shape["routes"] == (0, 14)
    keys = {r["table_name"]: (r["duplicate_count"], r["duplicate_pct"])
            for r in dicts(audit.key_duplication(messy))}
    assert keys["routes_new"] == (1, 25.0) and keys["partners"] == (0, 0.0)
    nulls = {(r["table_name"], r["column_name"]): (r["null_count"], r["null_pct"])
             for r in dicts(audit.null_profile(messy))}
    assert nulls[("routes_new", "partner_id")] == (1, 25.0)
    assert ("routes_new", "route_id") not in nulls


def test_null_key_counts_as_duplicate(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    (got,) = dicts(checks.key_duplication(df, "k"))
    assert (got["distinct_keys"], got["duplicate_count"]) == (1, 2)


def test_orphans(messy):
    got = {(r["table_name"], r["column_name"]): (r["orphan_keys"], r["sample_key"])
           for r in dicts(audit.orphan_report(messy))}
    assert got[("routes_new", "partner_id")] == (1, "P9")
    assert got[("routes_new", "vehicle_type_id")] == (1, "V9")
    assert got[("shipment_events_new", "shipment_id")] == (1, "S9")
    assert got[("routes", "partner_id")] == (0, None)


def test_stops_unassigned_offsets_and_sample(messy):
    inflated = {r["table_name"]: r["error_count"] for r in dicts(audit.stop_inflation(messy))}
    assert inflated == {"routes": 0, "routes_new": 1}
    buckets = {r["partner_id"]: (r["total_routes"], r["unassigned_routes"])
               for r in dicts(audit.unassigned_routes(messy))}
    assert buckets == {"P1": (2, 0), "P9": (1, 1), "UNASSIGNED": (1, 1)}
    assert sorted(rows(audit.distinct_offsets(messy))) == [(-13,), (-5,)]
    assert [r["route_id"] for r in dicts(audit.inverted_sample(messy))] == ["R1"]
    assert rows(audit.adjacent_overlaps_by_partner(messy)) == []


def test_format_patterns(spark):
    df = spark.createDataFrame([("1/4/2025",), ("2/5/2025",), ("2025-01-01",), (None,)], "t string")
    got = {r["pattern"]: (r["row_count"], r["pct"]) for r in dicts(checks.format_patterns(df, "t"))}
    assert got == {"N/N/NNNN": (2, 66.67), "NNNN-NN-NN": (1, 33.33)}


def test_checks_on_one_table_share_a_scan(messy):
    plan = run_checks(
        messy.routes_new,
        [Check.rows("a", F.col("partner_id").isNull()), Check.rows("b", audit.inverted())],
    )._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
