import pytest

from tests.frames import at, day, dicts, frame
from waybill.sources import ingest, publish
from waybill.sources.ingest import (
    MissingColumn,
    RejectedValues,
    align,
    load_all,
    load_table,
    read_raw,
)
from waybill.sources.schemas import PRIMARY_KEYS, SCHEMAS, required_columns
from waybill.sources.tables import Tables

VEHICLES = "vehicle_type_id,vehicle_type_name,max_capacity_units,fuel_type,active_flag\n"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_schemas():
    assert {name: len(s) for name, s in SCHEMAS.items()} == {
        "distribution_centers": 11, "partners": 9, "vehicle_types": 5, "routes": 14,
        "routes_new": 14, "shipments": 8, "shipments_new": 5, "shipment_events": 6,
        "shipment_events_new": 6,
    }
    assert PRIMARY_KEYS["routes_new"] == "route_id"
    assert required_columns("partners") == ["partner_id"]


def test_load_cleans_and_aligns(spark, tmp_path):
    source = write(
        tmp_path / "routes_new.csv",
        "route_status,route_id,note,route_date,planned_route_start_time,estimated_stops,"
        "route_distance_km\n"
        'COMPLETED,R1,"two\nlines",1/4/2025,1/4/2025 8:05,12.0,3.5\n'
        "CANCELLED,R2,,2025-04-02,2025-04-02 08:05:30,,NaN\n",
    )
    outcome = load_table(spark, "routes_new", source, str(tmp_path / "out"))
    assert outcome.status == "loaded" and outcome.reconciled and outcome.rows_written == 2
    loaded = spark.read.schema(SCHEMAS["routes_new"]).parquet(str(tmp_path / "out"))
    assert loaded.columns == SCHEMAS["routes_new"].fieldNames()
    got = {r["route_id"]: r for r in dicts(loaded)}
    assert got["R1"]["route_date"] == day("2025-04-01")
    assert got["R1"]["planned_route_start_time"] == at("2025-04-01 08:05:00")
    assert (got["R1"]["estimated_stops"], got["R1"]["route_distance_km"]) == (12, 3.5)
    assert (got["R2"]["estimated_stops"], got["R2"]["route_distance_km"]) == (None, None)
    assert got["R2"]["planned_route_start_time"] == at("2025-04-02 08:05:30")
    assert got["R1"]["partner_id"] is None


def test_clock_times_land_on_the_route_date(spark, tmp_path):
    source = write(
        tmp_path / "routes.csv",
        "route_id,route_date,actual_route_start_time,actual_route_end_time\n"
        "R1,9/3/2025,02:30,02:30:15\nR2,2025-03-09,,\n",
    )
    load_table(spark, "routes", source, str(tmp_path / "out"))
    got = {r["route_id"]: r for r in dicts(spark.read.parquet(str(tmp_path / "out")))}
    assert got["R1"]["actual_route_start_time"] == at("2025-03-09 02:30:00")
    assert got["R1"]["actual_route_end_time"] == at("2025-03-09 02:30:15")
    assert got["R2"]["actual_route_start_time"] is None


def test_strict_load_leaves_the_old_table_alone(spark, tmp_path):
    good = write(tmp_path / "good.csv", VEHICLES + "V1,Van,10,FUEL,1\n")
    bad = write(tmp_path / "bad.csv", VEHICLES + "V1,Van,ten,FUEL,1\n,Van,10,FUEL,1\n")
    out = str(tmp_path / "out")
    load_table(spark, "vehicle_types", good, out)
    with pytest.raises(RejectedValues, match="max_capacity_units.*1"):
        load_table(spark, "vehicle_types", bad, out)
    assert spark.read.parquet(out).count() == 1
    outcome = load_table(spark, "vehicle_types", bad, out, strict=False)
    assert (outcome.rows_written, outcome.rejected) == (2, 2)


def test_load_is_repeatable(spark, tmp_path):
    source = write(tmp_path / "v.csv", VEHICLES + "V1,Van,10,FUEL,1\nV2,Truck,20,HUMAN,1\n")
    for _ in range(2):
        load_table(spark, "vehicle_types", source, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_missing_required_column_stops(spark, tmp_path):
    write(tmp_path / "partners.csv", "partner_name\nOne\n")
    with pytest.raises(MissingColumn):
        align(read_raw(spark, str(tmp_path / "partners.csv")), "partners")
    with pytest.raises(MissingColumn):
        load_all(spark, str(tmp_path), str(tmp_path / "out"), ["partners"])


def test_outcomes_per_table(spark, tmp_path):
    write(tmp_path / "vehicle_types.csv", VEHICLES + "V1,Van,ten,FUEL,1\n")
    write(tmp_path / "partners.csv", "partner_id,active_flag\nP1,1\n")
    outcomes = load_all(
        spark, str(tmp_path), str(tmp_path / "out"), ["vehicle_types", "shipments", "partners"]
    )
    assert [(o.table_name, o.status) for o in outcomes] == [
        ("vehicle_types", "failed"), ("shipments", "missing"), ("partners", "loaded"),
    ]
    assert ingest.outcomes_frame(spark, outcomes).count() == 3


def test_an_unreadable_file_does_not_stop_the_others(spark, tmp_path):
    (tmp_path / "vehicle_types.csv").mkdir()
    (tmp_path / "vehicle_types.csv" / "part.csv.gz").write_bytes(b"\x1f\x8b\x08 no gzip after that")
    write(tmp_path / "partners.csv", "partner_id,active_flag\nP1,1\n")
    outcomes = load_all(spark, str(tmp_path), str(tmp_path / "out"), ["vehicle_types", "partners"])
    assert [(o.table_name, o.status) for o in outcomes] == [("vehicle_types", "failed"), ("partners", "loaded")]


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    publish.write_table(spark.range(5), path)
    with pytest.raises(Exception, match="broken row"):
        publish.write_table(spark.range(9).selectExpr("if(id = 7, raise_error('broken row'), id) as id"), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_partitioned_load(spark, tmp_path):
    source = write(
        tmp_path / "r.csv", "route_id,route_date\nR1,2025-04-01\nR2,2025-04-02\nR3,2025-04-02\n"
    )
    load_table(spark, "routes_new", source, str(tmp_path / "t/routes_new"),
               partition_by=["route_date"])
    routes = Tables.from_parquet(spark, str(tmp_path / "t")).routes_new
    assert routes.filter("route_date = date'2025-04-02'").count() == 2


def test_csv_sink_round_trip(spark, tmp_path):
    df = frame(spark, "routes_new", {
        "route_id": 'R"1', "route_date": day("2025-04-01"),
        "actual_route_start_time": at("2025-03-09 02:30:00"), "actual_stops": 3,
    })
    publish.write_csv(df, str(tmp_path / "out"))
    (raw,) = dicts(read_raw(spark, str(tmp_path / "out")))
    assert (raw["route_id"], raw["route_date"]) == ('R"1', "2025-04-01")
    assert raw["actual_route_start_time"] == "2025-03-09 02:30:00"


def test_publish_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "report")
    first = spark.createDataFrame([("d1", 1), ("d2", 2)], "period string, n long")
    second = spark.createDataFrame([("d2", 20), ("d3", 30)], "period string, n long")
    publish.publish_partitions(first, path, ["period"])
    for _ in range(2):
        publish.publish_partitions(second, path, ["period"])
    got = publish.read_published(spark, path, like=first)
    assert sorted(tuple(r) for r in got.collect()) == [("d1", 1), ("d2", 20), ("d3", 30)]


def test_report_formats(spark, tmp_path):
    df = spark.createDataFrame([("BR", 1234, 70.0)], "country string, n long, pct double")
    shown = {"n": "thousands", "pct": "percent"}
    publish.write_report(df, str(tmp_path / "r.csv"), "csv", shown)
    assert dicts(read_raw(spark, str(tmp_path / "r.csv"))) == [
        {"country": "BR", "n": "1,234", "pct": "70.00%"}
    ]
    publish.write_report(df, str(tmp_path / "r.parquet"))
    assert dicts(spark.read.parquet(str(tmp_path / "r.parquet"))) == dicts(df)
    with pytest.raises(ValueError):
        publish.write_report(df, str(tmp_path / "x"), "xls")
