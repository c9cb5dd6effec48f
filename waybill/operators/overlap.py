"""Overlapping time intervals inside a group (by default: one partner on one day).

Two intervals overlap when each one starts before the other one ends. An inverted interval (end
before start) is not repaired: it overlaps exactly those intervals for which the two comparisons
hold. All functions need only the sort order of the times, so they fit any time resolution.

- ``overlap_pairs`` lists the overlapping pairs: a drill-down for chosen groups, as there may be
  quadratically many.
- ``overlaps_per_interval`` gives each interval's number of overlaps.
- ``overlap_counts`` gives the summary numbers without listing pairs, at a cost that grows with the
  rows of a group, not with the square of them.

Where two ways suit groups of different size, one lazy plan holds both and each row takes its
group's; building a frame starts no job.
- ``adjacent_overlaps`` compares each interval only with the next one to start.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.functions.measures import count_if
from waybill.functions.times import epoch_seconds
from waybill.operators.scan import following, running

PARTNER_DAY = ("partner_id", "route_date")
START = "actual_route_start_time"
END = "actual_route_end_time"


def _intervals(
    routes: DataFrame, keys: Sequence[str], id_col: str, start: str, end: str, *keep: str
) -> DataFrame:
    """Rows with keys, id and both times, spelled as one null test per column: comparisons then add
    no tests of their own, and the shuffle of the rows is the same, and reused, wherever they are."""
    needed = [*keys, id_col, start, end]
    complete = routes.dropna(subset=needed)
    for c in needed:
        complete = complete.filter(F.col(c).isNotNull())
    return complete.select(
        *keys, F.col(id_col).alias("id"), F.col(start).alias("s"), F.col(end).alias("e"), *keep
    )


def _small_and_large(
    rows: DataFrame, keys: Sequence[str], direct_up_to: int
) -> tuple[DataFrame, DataFrame]:
    """Rows of groups up to a size, and rows of larger groups, which are spread again: the join must
    not leave a group that holds a large share of the rows in one task."""
    if direct_up_to < 1:
        return rows.limit(0), rows
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > direct_up_to).select(*keys)
    return (
        rows.join(large, [*keys], "left_anti"),
        rows.join(large, [*keys], "left_semi").hint("rebalance"),
    )


#: Buckets that groups are counted in: what is broadcast is some of these numbers.
_BUCKETS = 1 << 18


def _sparse_and_crowded(
    rows: DataFrame, keys: Sequence[str], direct_up_to: int
) -> tuple[DataFrame, DataFrame]:
    """Rows of groups whose hash bucket has up to ``direct_up_to`` rows, dealt out by group, and all
    others.

    A bucket has at least as many rows as each of its groups. Counts of buckets, unlike those of
    groups, are few in every task, and the crowded ones are broadcast (at most ``_BUCKETS`` numbers),
    so no row is shuffled to be told apart. Dealt out here, the sparse rows are shuffled once for both
    sides of a self-join. Crowded rows are spread again.
    """
    if direct_up_to < 1:
        return rows.limit(0), rows
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)).cast("int")
    counts = rows.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    crowded = F.broadcast(counts.filter(F.col("n") > direct_up_to).select("_bucket"))
    marked = rows.withColumn("_bucket", bucket)
    return (
        marked.join(crowded, "_bucket", "left_anti").drop("_bucket").repartition(*keys),
        marked.join(crowded, "_bucket", "left_semi").drop("_bucket").hint("rebalance"),
    )


def _pairs_in_small_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlapping pairs with ``id`` below ``id_b``; every column of the second row ends in _b."""
    other = rows.withColumnsRenamed({c: f"{c}_b" for c in rows.columns if c not in keys})
    met = (F.col("id") < F.col("id_b")) & (F.col("s_b") < F.col("e")) & (F.col("e_b") > F.col("s"))
    return rows.join(other, [*keys]).filter(met)


def overlap_pairs(
    routes: DataFrame,
    keys: Sequence[str] = PARTNER_DAY,
    id_col: str = "route_id",
    start: str = START,
    end: str = END,
    keep: Sequence[str] = ("center_id", "vehicle_type_id"),
    direct_up_to: int = 1_000,
    bucket_hours: int = 1,
) -> DataFrame:
    """Every overlapping pair once, ``id_a < id_b``, with the ``keep`` columns of both sides.

    Groups of up to ``direct_up_to`` rows compare their rows with each other, larger ones are split
    by time; the result is the same.
    """
    rows = _intervals(routes, keys, id_col, start, end, *keep)
    names = {"id": "id", "s": "start", "e": "end", **{c: c for c in keep}}
    small, large = _small_and_large(rows, keys, direct_up_to)
    pairs = _pairs_in_small_groups(small, keys).select(*keys, *[
        F.col(f"{c}{mark}").alias(f"{name}_{side}")
        for c, name in names.items() for mark, side in (("", "a"), ("_b", "b"))
    ])
    return pairs.unionByName(_pairs_by_bucket(large, keys, names, bucket_hours * 3600))


#: Buckets of one level make up a bucket of the next, and levels there are: hours, two days, 96 days,
#: twelve years.
_FAN_OUT, _LEVELS = 48, 4


def _pairs_by_bucket(
    rows: DataFrame, keys: Sequence[str], names: Mapping[str, str], seconds: int
) -> DataFrame:
    """Of two overlapping intervals, one starts while the other is open: each start is looked up in
    the open intervals of its time bucket.

    A crowded group is split by bucket, and a pair meets in one bucket only. An interval is entered
    at the finest level at which it covers few buckets, and a start asks at every level.
    """
    def bucket(t: str, level: Column) -> Column:
        return F.floor(epoch_seconds(F.col(t)) / (seconds * F.pow(F.lit(_FAN_OUT), level)))

    covered = bucket("e", F.lit(0)) - bucket("s", F.lit(0))
    level = F.lit(_LEVELS - 1)
    for i in reversed(range(_LEVELS - 1)):
        level = F.when(covered < _FAN_OUT ** (i + 1), i).otherwise(level)
    opened = (
        rows.filter(F.col("s") < F.col("e"))
        .withColumn("level", level)
        .withColumn("bucket", F.explode(F.sequence(bucket("s", F.col("level")), bucket("e", F.col("level")))))
        .withColumnsRenamed({c: f"o_{c}" for c in names})
    )
    starts = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(_LEVELS - 1)))).withColumn(
        "bucket", bucket("s", F.col("level"))
    )
    met = (
        (F.col("o_id") != F.col("id"))
        & (F.col("o_s") <= F.col("s"))
        & (F.col("s") < F.col("o_e"))
        & (F.col("e") > F.col("o_s"))
        # Equal starts: either side could be the open one; the smaller id is.
        & ((F.col("o_s") < F.col("s")) | (F.col("o_id") < F.col("id")))
    )
    found = opened.join(starts, [*keys, "level", "bucket"]).filter(met)
    start_is_a = F.col("id") < F.col("o_id")
    columns = [*keys]
    for c, name in names.items():
        mine, other = F.col(c), F.col(f"o_{c}")
        columns.append(F.when(start_is_a, mine).otherwise(other).alias(f"{name}_a"))
        columns.append(F.when(start_is_a, other).otherwise(mine).alias(f"{name}_b"))
    return found.select(*columns)


def overlap_counts(
    routes: DataFrame,
    keys: Sequence[str] = PARTNER_DAY,
    per: Sequence[str] | None = None,
    id_col: str = "route_id",
    start: str = START,
    end: str = END,
    hub: str = "center_id",
    vehicle: str = "vehicle_type_id",
    direct_up_to: int = 1_000,
) -> DataFrame:
    """Overlaps within each group of ``keys``, reported per ``per`` (some of the keys, or all).

    ``as_a`` and ``as_b`` are the distinct ids that overlap a greater and a smaller id;
    ``multi_hub`` and ``impossible_vehicle`` are pairs at different hubs and, of these, those with
    the same vehicle. Nothing is reported for a group without an overlap.

    Groups of up to ``direct_up_to`` rows compare their rows with each other, larger ones go through
    ``_ranked_sides``; the result is the same.
    """
    per = list(keys if per is None else per)
    rows = _intervals(routes, keys, id_col, start, end, hub, vehicle)
    rows = rows.withColumnsRenamed({hub: "hub", vehicle: "vehicle"})
    small, large = _small_and_large(rows, keys, direct_up_to)
    sides = _ranked_sides(large, keys)
    if direct_up_to > 0:
        sides = _direct_sides(small, keys).unionByName(sides)
    return (
        sides.groupBy(*per, "id")
        .agg(
            F.max("is_a").alias("is_a"),
            F.max("is_b").alias("is_b"),
            F.sum("multi_hub").alias("multi_hub"),
            F.sum("impossible").alias("impossible"),
        )
        .groupBy(*per)
        .agg(
            count_if(F.col("is_a")).alias("as_a"),
            count_if(F.col("is_b")).alias("as_b"),
            # Both rows of a pair count each other; the sums are therefore even.
            F.shiftright(F.sum("multi_hub"), 1).alias("multi_hub"),
            F.shiftright(F.sum("impossible"), 1).alias("impossible_vehicle"),
        )
        .filter((F.col("as_a") > 0) | (F.col("as_b") > 0))
    )


def _direct_sides(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For both rows of each pair: the id, its side, and whether the hubs and vehicles count."""
    multi_hub, impossible = _apart("hub", "vehicle", "hub_b", "vehicle_b")

    def side(id_col: str, is_a: bool) -> Column:
        return F.struct(
            F.col(id_col).alias("id"),
            F.lit(is_a).alias("is_a"),
            F.lit(not is_a).alias("is_b"),
            multi_hub.alias("multi_hub"),
            impossible.alias("impossible"),
        )

    sides = F.array(side("id", True), side("id_b", False))
    return _pairs_in_small_groups(rows, keys).select(*keys, F.inline(sides))


def _apart(hub: str, vehicle: str, other_hub: str, other_vehicle: str) -> tuple[Column, Column]:
    """1 for a pair at different hubs, and 1 for such a pair with one vehicle; else 0."""
    multi_hub = F.coalesce(F.col(hub) != F.col(other_hub), F.lit(False))
    impossible = F.coalesce(multi_hub & (F.col(vehicle) == F.col(other_vehicle)), F.lit(False))
    return multi_hub.cast("long"), impossible.cast("long")


#: Rows a leaf holds. The rows before a limit are whole leaves and part of one leaf.
_LEAF_BITS = 6

#: Columns the rows of a scope agree on, the columns that must be present, and the weights of the
#: scope's pairs in the sums below. Pairs at different hubs are all pairs less those at one hub, and
#: per vehicle likewise. Two rows with one id are no pair: each scope is entered once more per id,
#: with opposite weights.
_SUMS = ("overlaps", "multi_hub", "impossible")
_SCOPES = (
    ((), (), (1, 0, 0)),
    ((), ("hub",), (0, 1, 0)),
    (("hub",), ("hub",), (0, -1, 0)),
    (("vehicle",), ("hub", "vehicle"), (0, 0, 1)),
    (("vehicle", "hub"), ("hub", "vehicle"), (0, 0, -1)),
)
_SCOPES += tuple(((*same, "id"), present, tuple(-w for w in ws)) for same, present, ws in _SCOPES)


def _scopes_of_row() -> Column:
    """The scopes a row belongs to, by number, with the values their rows agree on."""
    entries = []
    for number, (same, present, _) in enumerate(_SCOPES):
        belongs = F.lit(True)
        for c in present:
            belongs = belongs & F.col(c).isNotNull()
        agreed = [
            (F.col(c).cast("string") if c in same else F.lit("")).alias(f"same_{c}")
            for c in ("id", "hub", "vehicle")
        ]
        entries.append(F.when(belongs, F.struct(F.lit(number).alias("scope"), *agreed)))
    return F.array_compact(F.array(*entries))


def overlaps_per_interval(
    routes: DataFrame,
    keys: Sequence[str] = PARTNER_DAY,
    id_col: str = "route_id",
    start: str = START,
    end: str = END,
    hub: str = "center_id",
    vehicle: str = "vehicle_type_id",
    direct_up_to: int = 1_000,
) -> DataFrame:
    """Per id that overlaps others: in how many overlapping pairs it is, in how many of these the
    hubs differ, and of those in how many the vehicle is the same. At most one row an id and group.

    Rows of groups that are surely of up to ``direct_up_to`` rows are shuffled once, by group, and
    compared there; the others go through ``_matches``. The result is the same.
    """
    rows = _intervals(routes, keys, id_col, start, end, hub, vehicle)
    rows = rows.withColumnsRenamed({hub: "hub", vehicle: "vehicle"})
    small, large = _sparse_and_crowded(rows, keys, direct_up_to)

    def per_id(matches: DataFrame) -> DataFrame:
        overlaps, multi_hub, impossible = (F.sum(c) for c in _SUMS)
        return (
            matches.groupBy(*keys, F.col("id").alias(id_col))
            .agg(
                overlaps.alias("overlaps"),
                multi_hub.alias("multi_hub"),
                impossible.alias("impossible_vehicle"),
            )
            .filter("overlaps > 0")
        )

    counted = per_id(_matches(large, keys))
    if direct_up_to > 0:
        # Each is summed before they meet: the rows of small groups are together already.
        direct = _direct_sides(small, keys).withColumn("overlaps", F.lit(1).cast("long"))
        counted = per_id(direct).unionByName(counted)
    return counted


def _ranked_sides(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sides of ids and the sums of their pairs, some rows an id; both rows of a pair count it."""
    return _matches(rows, keys).select(
        *keys, "id",
        (F.col("id") < F.col("hi")).alias("is_a"),
        (F.col("id") > F.col("lo")).alias("is_b"),
        "multi_hub", "impossible",
    )


def _matches(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each row and the rows of other ids that start before its end and end after its start, in
    parts to be added up per id: the sums, and the greatest and least id (of its own id at most).

    Starts get their rank in the group, and a row's limit is the number of starts before its end.
    The ranks below a limit are whole leaves of 64 rows and a part of one leaf. Inside that leaf rows
    are compared. The whole leaves split into few power-of-two blocks (the binary digits of their
    number), and each leaf belongs to one block per digit. Inside a block only the ends still matter,
    which a running total over the ends answers (``scan.running``).
    """
    placed = _placed(rows, keys)
    starts, limits = placed.filter("is_start = 1"), placed.filter("is_start = 0")
    return _in_leaves(starts, limits, keys).unionByName(_in_blocks(starts, limits, keys))


def _placed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row twice, at its start and at its end, with the ``leaf`` of the next start's rank and the
    number of full leaves in the group.

    Ranks are counted within hours of a group and carried over its earlier hours, so no task holds a
    group's rows. Hours, unlike sampled ranges, are the same whenever a part of the plan is repeated.
    """
    ticks = F.explode(F.array(
        F.struct(F.col("s").alias("t"), F.lit(1).alias("is_start")),
        F.struct(F.col("e").alias("t"), F.lit(0).alias("is_start")),
    ))
    hour = F.floor(epoch_seconds(F.col("t")) / 3600)
    hours = [*keys, "hour"]
    ticked = rows.select("*", ticks.alias("tick")).select(*rows.columns, "tick.*").withColumn("hour", hour)
    # At one time value ends precede starts: a limit counts the starts strictly before it.
    order = Window.partitionBy(*hours).orderBy("t", "is_start", "id", "s", "e", "hub", "vehicle")
    before = F.coalesce(F.sum("is_start").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = ticked.groupBy(*hours).agg(F.sum("is_start").alias("starts"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)  # one row an hour
    carries = totals.select(
        *hours,
        F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("carry"),
        F.shiftright(F.sum("starts").over(group), _LEAF_BITS).alias("full_leaves"),
    )
    return ticked.withColumn("before", before).join(carries, hours).select(
        *rows.columns, "is_start", F.shiftright(F.col("carry") + F.col("before"), _LEAF_BITS).alias("leaf"), "full_leaves"
    )


def _in_leaves(starts: DataFrame, limits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matches in the leaf that a row's limit falls in."""
    other = starts.select(*keys, "leaf", *[F.col(c).alias(f"{c}_b") for c in ("id", "s", "e", "hub", "vehicle")])
    met = (F.col("id") != F.col("id_b")) & (F.col("s_b") < F.col("e")) & (F.col("e_b") > F.col("s"))
    multi_hub, impossible = _apart("hub", "vehicle", "hub_b", "vehicle_b")
    return limits.join(other, [*keys, "leaf"]).filter(met).select(
        *keys, "id",
        F.lit(1).cast("long").alias("overlaps"), multi_hub.alias("multi_hub"), impossible.alias("impossible"),
        F.col("id_b").alias("hi"), F.col("id_b").alias("lo"),
    )


def _in_blocks(starts: DataFrame, limits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matches in the whole leaves before a row's limit; a group without a full leaf has none."""
    def entered(rows: DataFrame, blocks: Column, t: str, asks: bool) -> DataFrame:
        found = None if asks else F.col("id")
        return (
            rows.withColumn("at", F.explode(blocks))
            .withColumn("in", F.explode(_scopes_of_row()))
            .select(
                *keys, "at.digit", "at.block", "in.*", "id", F.col(t).alias("t"),
                F.lit(asks).alias("asks"), F.lit(0 if asks else 1).cast("long").alias("n"),
                F.lit(found).alias("hi"), F.lit(found).alias("lo"),
            )
        )

    points = entered(starts.filter("leaf < full_leaves"), _blocks_of(F.col("leaf")), "e", False)
    asked = entered(limits.filter("leaf > 0"), _blocks_below(F.col("leaf")), "s", True)
    same = [*keys, "digit", "block", "scope", "same_id", "same_hub", "same_vehicle"]
    # Later ends come first; at one time value the question precedes the ends (strictly after).
    answers = running(
        points.unionByName(asked), same, [F.desc("t"), F.desc("asks"), F.col("id")],
        sums=["n"], maxima=["hi"], minima=["lo"],
    ).filter("asks AND run_n > 0")
    weights = [
        F.element_at(F.array(*[F.lit(ws[i]) for _, _, ws in _SCOPES]), F.col("scope") + 1) for i in range(len(_SUMS))
    ]
    return answers.select(
        *keys, "id",
        *[(F.col("run_n") * w).alias(name) for w, name in zip(weights, _SUMS, strict=True)],
        F.col("run_hi").alias("hi"), F.col("run_lo").alias("lo"),
    )


def _digits(rank: Column) -> Column:
    return F.when(rank == 0, F.lit(0)).otherwise(F.length(F.bin(rank)))


def _blocks_of(rank: Column) -> Column:
    """Blocks a rank belongs to: all ranks with as many digits (``digit`` -1), and one block per
    zero below the leading digit."""
    size = F.array(F.struct(F.lit(-1).alias("digit"), _digits(rank).cast("long").alias("block")))
    return F.concat(size, _digit_blocks(rank, 0, 0))


def _blocks_below(limit: Column) -> Column:
    """The disjoint blocks that make up the ranks below ``limit``: every shorter length, and one
    block per one below the leading digit."""
    shorter = F.transform(
        _count_up(_digits(limit)),
        lambda d: F.struct(F.lit(-1).alias("digit"), d.cast("long").alias("block")),
    )
    return F.concat(shorter, _digit_blocks(limit, 1, 1))


def _count_up(n: Column) -> Column:
    """``[0, n)`` as an array."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _digit_blocks(rank: Column, bit: int, back: int) -> Column:
    def shifted(i: Column) -> Column:
        return F.call_function("shiftright", rank, i)

    below_leading = _count_up(_digits(rank) - 1)
    at_bit = F.filter(below_leading, lambda i: shifted(i).bitwiseAND(F.lit(1)) == bit)
    return F.transform(
        at_bit,
        lambda i: F.struct(i.alias("digit"), (shifted(i) - back).cast("long").alias("block")),
    )


def adjacent_overlaps(
    routes: DataFrame,
    keys: Sequence[str] = PARTNER_DAY,
    id_col: str = "route_id",
    start: str = START,
    end: str = END,
) -> DataFrame:
    """Per group: how many intervals end after the next one (by start, then id) has started.

    Rows are first reduced per start: among equal starts, all but the last are followed by a row
    with that same start. The next distinct start comes from ``scan.following``: a ``lead`` inside a
    time range, and across ranges the first start of the next one, so no task holds a whole group.
    """
    order = F.struct("id", "e")
    per_start = (
        _intervals(routes, keys, id_col, start, end)
        .groupBy(*keys, "s")
        .agg(count_if(F.col("e") > F.col("s")).alias("open"), F.max_by("e", order).alias("last"))
    )
    inside = F.col("open") - F.when(F.col("last") > F.col("s"), 1).otherwise(0)
    across = F.when(F.col("last") > F.col("following"), 1).otherwise(0)
    return (
        following(per_start, keys, "s").withColumnRenamed("next_s", "following")
        .groupBy(*keys)
        .agg(F.sum(inside + across).alias("overlap_count"))
        .filter("overlap_count > 0")
    )
