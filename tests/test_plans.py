"""What the physical plans must and must not contain."""

import pytest

from tests.frames import tables
from waybill.operators.scope import ReportScope
from waybill.plans.productivity import underperforming_by_country
from waybill.plans.punctuality import oth_by_fleet
from waybill.sources.tables import Tables

def plan_of(df):
    utils = df.sparkSession._jvm.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    empty = tables(spark)
    for name in empty.names():
        empty[name].write.parquet(f"{root}/{name}")
    return Tables.from_parquet(spark, root)


def test_scope_reaches_the_scan(stored):
    scope = ReportScope(start="2025-04-01", end="2025-05-31")
    plan = plan_of(underperforming_by_country(stored, scope))
    pushed = next(line for line in plan.splitlines()
                  if line.startswith("PushedFilters") and "route_type" in line)
    for wanted in ("EqualTo(route_type,DELIVERY)", "EqualTo(route_status,COMPLETED)",
                   "GreaterThanOrEqual(route_date,2025-04-01)",
                   "LessThanOrEqual(route_date,2025-05-31)"):
        assert wanted in pushed
    schema = next(line for line in plan.splitlines()
                  if line.startswith("ReadSchema") and "route_type" in line)
    assert "route_distance_km" not in schema and "planned_route_start_time" not in schema


def test_routes_are_counted_before_they_meet_the_dimensions(stored):
    plan = oth_by_fleet(stored, ReportScope())._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    joins = [i for i, line in enumerate(lines) if " Join " in line or "Join Inner" in line]
    counts = [i for i, line in enumerate(lines) if "Aggregate" in line]
    assert len(joins) == 3 and max(counts) > max(joins)
