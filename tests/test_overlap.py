import itertools
import random
from datetime import date, datetime, timedelta

import pytest

from tests.frames import at, day
from waybill.operators.overlap import (
    adjacent_overlaps,
    overlap_counts,
    overlap_pairs,
    overlaps_per_interval,
)

SCHEMA = (
    "route_id string, partner_id string, route_date date, center_id string, "
    "vehicle_type_id string, actual_route_start_time timestamp_ntz, "
    "actual_route_end_time timestamp_ntz"
)


def random_routes(seed, n=160):
    """Crowded groups with inverted, empty and very long intervals, equal times, repeated ids."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        start = datetime(2025, 4, 1) + timedelta(minutes=rnd.randint(0, 60))
        end = start + timedelta(minutes=rnd.randint(-20, 25))
        if rnd.random() < 0.05:
            end = start + timedelta(days=20)
        out.append((
            f"R{rnd.randint(0, 140):03d}",
            rnd.choice(["P1", "P1", "P1", "P2", None]),
            date(2025, 4, 1 + (rnd.random() < 0.2)),
            rnd.choice(["A", "B", "C", None]),
            rnd.choice(["v", "w", None]),
            start if rnd.random() > 0.05 else None,
            end,
        ))
    return out


def brute_pairs(routes):
    for a, b in itertools.permutations(routes, 2):
        if None in (a[1], b[1], a[5], b[5]) or a[1:3] != b[1:3] or not a[0] < b[0]:
            continue
        if b[5] < a[6] and b[6] > a[5]:
            yield a, b


def brute_counts(routes, key):
    sums = {}
    for a, b in brute_pairs(routes):
        found = sums.setdefault(key(a), [set(), set(), 0, 0])
        found[0].add(a[0])
        found[1].add(b[0])
        apart = None not in (a[3], b[3]) and a[3] != b[3]
        found[2] += apart
        found[3] += apart and a[4] is not None and a[4] == b[4]
    return {k: (len(v[0]), len(v[1]), v[2], v[3]) for k, v in sums.items()}


@pytest.mark.parametrize("direct_up_to", [0, 40, 10_000])
def test_counts_match_brute_force(spark, direct_up_to):
    routes = random_routes(seed=11)
    got = overlap_counts(spark.createDataFrame(routes, SCHEMA), direct_up_to=direct_up_to)
    assert {
        (r.partner_id, r.route_date): (r.as_a, r.as_b, r.multi_hub, r.impossible_vehicle)
        for r in got.collect()
    } == brute_counts(routes, lambda a: a[1:3])


@pytest.mark.parametrize("direct_up_to", [0, 10_000])
def test_an_id_repeated_over_days_counts_once_per_partner(spark, direct_up_to):
    routes = random_routes(seed=12, n=90)
    got = overlap_counts(
        spark.createDataFrame(routes, SCHEMA), per=["partner_id"], direct_up_to=direct_up_to
    )
    assert {
        r.partner_id: (r.as_a, r.as_b, r.multi_hub, r.impossible_vehicle) for r in got.collect()
    } == brute_counts(routes, lambda a: a[1])


def test_overlaps_per_interval_match_brute_force(spark):
    routes = random_routes(seed=13)
    wanted = {}
    for a, b in brute_pairs(routes):
        apart = None not in (a[3], b[3]) and a[3] != b[3]
        for mine in (a, b):
            found = wanted.setdefault((*mine[1:3], mine[0]), [0, 0, 0])
            found[0] += 1
            found[1] += apart
            found[2] += apart and a[4] is not None and a[4] == b[4]
    got = overlaps_per_interval(spark.createDataFrame(routes, SCHEMA))
    assert {
        (r.partner_id, r.route_date, r.route_id): [r.overlaps, r.multi_hub, r.impossible_vehicle]
        for r in got.collect()
    } == wanted


def test_building_a_frame_starts_no_job(spark):
    df = spark.createDataFrame(random_routes(seed=17, n=20), SCHEMA)
    spark.sparkContext.setJobGroup("overlap-frames", "")
    overlap_counts(df)
    overlap_pairs(df)
    overlaps_per_interval(df)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("overlap-frames")


@pytest.mark.parametrize("direct_up_to", [0, 40, 10_000])
def test_pairs_match_brute_force(spark, direct_up_to):
    routes = random_routes(seed=14)
    got = overlap_pairs(spark.createDataFrame(routes, SCHEMA), direct_up_to=direct_up_to)
    found = sorted(
        str((r.partner_id, r.route_date, r.id_a, r.id_b, r.center_id_a, r.center_id_b,
             r.vehicle_type_id_a, r.vehicle_type_id_b, r.start_a, r.start_b, r.end_a, r.end_b))
        for r in got.collect()
    )
    wanted = sorted(
        str((*a[1:3], a[0], b[0], a[3], b[3], a[4], b[4], a[5], b[5], a[6], b[6]))
        for a, b in brute_pairs(routes)
    )
    assert found == wanted


def test_adjacent_overlaps_match_a_sweep(spark):
    routes = random_routes(seed=15)
    wanted = {}
    for key in {r[1:3] for r in routes if r[1] is not None}:
        group = sorted(
            (r for r in routes if r[1:3] == key and r[5] is not None),
            key=lambda r: (r[5], r[0], r[6]),
        )
        n = sum(a[6] > b[5] for a, b in itertools.pairwise(group))
        if n:
            wanted[key] = n
    got = adjacent_overlaps(spark.createDataFrame(routes, SCHEMA))
    assert {(r.partner_id, r.route_date): r.overlap_count for r in got.collect()} == wanted


def test_touching_intervals_do_not_overlap(spark):
    routes = [
        ("R1", "P", day("2025-04-01"), "A", "v", at("2025-04-01 08:00:00"), at("2025-04-01 09:00:00")),
        ("R2", "P", day("2025-04-01"), "B", "v", at("2025-04-01 09:00:00"), at("2025-04-01 10:00:00")),
    ]
    df = spark.createDataFrame(routes, SCHEMA)
    for limit in (0, 10):
        assert overlap_pairs(df, direct_up_to=limit).count() == 0
        assert overlap_counts(df, direct_up_to=limit).count() == 0


def test_no_step_compares_a_large_group_pairwise(spark):
    df = spark.createDataFrame(random_routes(seed=16, n=60), SCHEMA)
    plan = overlap_counts(df, direct_up_to=5)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "collect_set"):
        assert bad not in plan


def test_a_group_of_many_leaves_matches_brute_force(spark):
    """Several blocks of whole leaves, over hours and days, with repeated ids in them."""
    rnd = random.Random(18)
    routes = []
    for _ in range(600):
        start = datetime(2025, 4, 1) + timedelta(minutes=rnd.randint(0, 600))
        end = start + timedelta(minutes=rnd.choice([rnd.randint(-300, 400), 0, 5, 3000]))
        routes.append((
            f"R{rnd.randint(0, 450):03d}", "P1", date(2025, 4, 1), rnd.choice(["A", "B", None]),
            rnd.choice(["v", "w", None]), start, end,
        ))
    df = spark.createDataFrame(routes, SCHEMA)
    got = overlap_counts(df, direct_up_to=0).collect()
    assert {(r.partner_id, r.route_date): tuple(r)[2:] for r in got} == brute_counts(routes, lambda a: a[1:3])
    wanted = {}
    for a, b in brute_pairs(routes):
        apart = None not in (a[3], b[3]) and a[3] != b[3]
        for mine in (a, b):
            found = wanted.setdefault(mine[0], [0, 0, 0])
            found[0] += 1
            found[1] += apart
            found[2] += apart and a[4] is not None and a[4] == b[4]
    assert {r.route_id: list(r)[3:] for r in overlaps_per_interval(df).collect()} == {k: list(v) for k, v in wanted.items()}


def shuffled_rows(df):
    """Rows written to shuffles by running the frame, per the metrics of its final plan."""
    df.collect()
    done, rows, seen = [df._jdf.queryExecution().executedPlan()], 0, set()
    while done:
        node = done.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            done.append(node.executedPlan())
        elif "QueryStage" in name:
            done.append(node.plan())
        elif not name.startswith("Reused"):
            if name == "Exchange" and node.id() not in seen:
                rows += node.metrics().apply("shuffleRecordsWritten").value()
            seen.add(node.id())
            children = node.children()
            done += [children.apply(i) for i in range(children.size())]
    return rows


def small_groups(spark, n=600):
    routes = []
    for i in range(n):
        start = datetime(2025, 4, 1, 6) + timedelta(minutes=i * 37 % 360)
        routes.append((
            f"R{i:04d}", f"P{i % 30}", date(2025, 4, 1), f"DC-{i % 7}", f"v{i % 5}", start,
            start + timedelta(minutes=120 + i * 53 % 480),
        ))
    return spark.createDataFrame(routes, SCHEMA)


def test_ranked_counts_shuffle_few_rows(spark):
    assert shuffled_rows(overlap_counts(small_groups(spark), direct_up_to=0)) < 30 * 600


def test_overlaps_per_interval_shuffle_few_rows(spark):
    assert shuffled_rows(overlaps_per_interval(small_groups(spark))) < 30 * 600


def test_overlaps_per_interval_shuffle_rows_of_small_groups_once(spark):
    assert shuffled_rows(overlaps_per_interval(small_groups(spark))) < 3 * 600


@pytest.mark.parametrize("direct_up_to", [0, 40])
def test_overlaps_per_interval_of_both_ways_are_the_same(spark, direct_up_to):
    routes = spark.createDataFrame(random_routes(seed=19), SCHEMA)
    got = overlaps_per_interval(routes, direct_up_to=direct_up_to)
    assert sorted(map(str, got.collect())) == sorted(map(str, overlaps_per_interval(routes, direct_up_to=10_000).collect()))


def test_counts_of_both_ways_plan_few_exchanges(spark):
    plan = overlap_counts(small_groups(spark), per=["partner_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") < 100
