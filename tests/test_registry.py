import pytest

from tests.frames import tables
from waybill.plans.registry import METRICS, run_metric

DATES = {"start_date": "2025-04-01", "end_date": "2025-05-31"}


def test_every_metric_runs_on_empty_tables(spark):
    empty = tables(spark)
    for name, metric in METRICS.items():
        params = {**DATES, "partner_id": "P1"} if "partner_id" in metric.params else DATES
        df = run_metric(empty, name, **params)
        assert df.count() == (1 if name == "network_kpis" else 0), name


@pytest.mark.parametrize(
    ("name", "params"),
    [
        ("no_such_metric", DATES),
        ("route_productivity", {"start_date": "2025-04-01"}),
        ("route_productivity", {**DATES, "country": "BR"}),
        ("route_productivity", {**DATES, "end_date": "31/05/2025"}),
        ("route_productivity", {**DATES, "end_date": "2025-02-30"}),
        ("route_productivity", {**DATES, "end_date": 20250531}),
        ("route_productivity", {"start_date": "2025-06-01", "end_date": "2025-05-31"}),
        ("carrier_consistency", {**DATES, "partner_id": ""}),
        ("carrier_consistency", {**DATES, "partner_id": 14}),
    ],
)
def test_bad_parameters(spark, name, params):
    with pytest.raises(ValueError):
        run_metric(tables(spark), name, **params)


def test_parameters_are_values_not_sql(spark):
    odd = "P1' OR '1' = '1"
    assert run_metric(tables(spark), "carrier_consistency", partner_id=odd, **DATES).count() == 0
