from pyspark.sql import functions as F

from tests.frames import at, day, evaluate, parsed
from waybill.functions import cleaning, measures, times


def ntz(text):
    return F.expr(f"timestamp_ntz'{text}'")


def test_safe_pct(spark):
    got = evaluate(
        spark,
        half=measures.safe_pct(F.lit(1), F.lit(2)),
        third=measures.safe_pct(F.lit(1), F.lit(3)),
        zero=measures.safe_pct(F.lit(1), F.lit(0)),
        unknown=measures.safe_pct(F.lit(None).cast("long"), F.lit(3)),
    )
    assert got == {"half": 50.0, "third": 33.33, "zero": None, "unknown": None}


def test_display_formats(spark):
    null = F.lit(None).cast("double")
    got = evaluate(
        spark,
        n=measures.thousands(F.lit(1234567)),
        p=measures.percent_text(F.lit(7.5)),
        up=measures.signed_text(F.lit(4.95)),
        down=measures.signed_text(F.lit(-0.5)),
        h=measures.clock_hour_text(F.lit(7)),
        none=measures.percent_text(null),
    )
    assert got == {
        "n": "1,234,567", "p": "7.50%", "up": "+4.95", "down": "-0.50", "h": "07:00", "none": None,
    }


def test_durations_ignore_daylight_saving(spark):
    # In the session zone clocks jump from 02:00 to 03:00 on this day.
    got = evaluate(
        spark,
        jump=times.whole_minutes(ntz("2025-03-09 01:30:00"), ntz("2025-03-09 02:30:00")),
        cut=times.whole_minutes(ntz("2025-03-09 01:30:00"), ntz("2025-03-09 03:30:59")),
        back=times.whole_minutes(ntz("2025-03-09 03:30:59"), ntz("2025-03-09 01:30:00")),
        hour=times.hour_of(ntz("2025-03-09 02:30:00")),
        moved=times.shift_timestamp(ntz("2025-03-09 04:30:00"), F.lit(-2)),
    )
    assert got["jump"] == 60 and got["cut"] == 120 and got["back"] == -120
    assert got["hour"] == 2 and got["moved"] == at("2025-03-09 02:30:00")


def test_local_hour_equals_hour_of_shifted_timestamp(spark):
    hours = spark.sql(
        "select explode(sequence(0, 23)) as h, o from (select explode(sequence(-14, 14)) as o)"
    ).withColumn("ts", F.expr("timestampadd(HOUR, h, timestamp_ntz'2025-04-10 00:59:59')"))
    wrong = hours.filter(
        times.local_hour(F.col("ts"), F.col("o"))
        != times.hour_of(times.shift_timestamp(F.col("ts"), F.col("o")))
    )
    assert hours.count() == 24 * 29 and wrong.count() == 0


def test_hour_predicates_differ(spark):
    events = spark.createDataFrame(
        [("E1", 21, 0), ("E2", 22, 22), ("E3", 19, 0), ("E4", 23, 0), ("E5", None, 0),
         ("E6", 20, None)],
        "id string, true_hour long, logged long",
    ).withColumn("ts", F.expr("timestampadd(HOUR, true_hour, timestamp_ntz'2025-04-10 00:00:00')"))
    truncated = events.filter(times.hour_truncated(F.col("logged"), F.col("true_hour")))
    mismatch = events.filter(times.hour_mismatch(F.col("logged"), F.col("ts")))
    assert sorted(r.id for r in truncated.collect()) == ["E1", "E4"]
    assert sorted(r.id for r in mismatch.collect()) == ["E1", "E3", "E4"]


def test_parse_timestamp_row_by_row(spark):
    got = parsed(
        spark,
        cleaning.parse_timestamp,
        "2/5/2025 18:58:00", "2/5/2025 18:58", "1/4/2025", "2025-01-01 08:08:00",
        "2025-01-01 08:08:00.750", " 2025-03-09 02:30:00 ", "31/31/2025", "soon", "", None,
    )
    assert got == [
        at("2025-05-02 18:58:00"), at("2025-05-02 18:58:00"), at("2025-04-01 00:00:00"),
        at("2025-01-01 08:08:00"), at("2025-01-01 08:08:00"), at("2025-03-09 02:30:00"),
        None, None, None, None,
    ]


def test_parse_date(spark):
    assert parsed(spark, cleaning.parse_date, "1/4/2025", "2025-04-01", "x") == [
        day("2025-04-01"), day("2025-04-01"), None,
    ]


def test_complete_time(spark):
    assert parsed(spark, cleaning.complete_time, " 08:35 ", "08:35:10", None) == [
        "08:35:00", "08:35:10", None,
    ]


def test_time_on_date(spark):
    got = evaluate(
        spark,
        short=cleaning.time_on_date(F.expr("date'2025-03-09'"), F.lit("02:30")),
        bad=cleaning.time_on_date(F.expr("date'2025-03-09'"), F.lit("25:99")),
    )
    assert got == {"short": at("2025-03-09 02:30:00"), "bad": None}


def test_parse_numbers(spark):
    assert parsed(spark, cleaning.parse_long, "3", " 4 ", "3.0", "1e3", "3.7", "abc", None) == [
        3, 4, 3, 1000, None, None, None,
    ]
    assert parsed(spark, cleaning.parse_double, "3", " 4.5 ", "abc", "nan") == [3.0, 4.5, None, None]


def test_large_whole_numbers_keep_every_digit(spark):
    assert parsed(spark, cleaning.parse_long, "9007199254740993", "9007199254740993.0", "1e30") == [
        9007199254740993, 9007199254740993, None,
    ]


def test_junk_is_unreadable(spark):
    junk = ["1d", "12f", "0x1A", "Infinity", "-inf", "1e400", "1 2", "."]
    assert parsed(spark, cleaning.parse_long, *junk) == [None] * len(junk)
    assert parsed(spark, cleaning.parse_double, *junk) == [None] * len(junk)
    times = ["202504", "2025", "2025-04", "12025-04-01", "2025-04-01 08:00:00+02:00", "2025-04-01T08:00:00Z"]
    assert parsed(spark, cleaning.parse_timestamp, *times) == [None] * len(times)


def test_missing_tokens(spark):
    assert parsed(spark, cleaning.blank_to_null, "", "NULL", "NaN", "N/A", "none", "PT-1") == [
        None, None, None, None, "none", "PT-1",
    ]


def test_digit_pattern(spark):
    assert parsed(spark, cleaning.digit_pattern, "2/5/2025 18:58", None) == ["N/N/NNNN NN:NN", None]


def test_iso_text(spark):
    got = evaluate(
        spark,
        d=cleaning.iso_date(F.expr("date'2025-04-01'")),
        t=cleaning.iso_timestamp(F.expr("timestamp_ntz'2025-03-09 02:30:00.25'")),
    )
    assert got == {"d": "2025-04-01", "t": "2025-03-09 02:30:00"}
