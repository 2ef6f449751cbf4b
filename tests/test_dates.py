from datetime import date, datetime

from pyspark.sql import functions as F

from tarnlake.functions import date_dimension, date_dimension_for, date_key, key_to_date


def test_keys_go_both_ways(spark):
    days = [date(2024, 2, 29), date(1999, 12, 31), date(12, 1, 2), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select("d", date_key("d").alias("k"), key_to_date(date_key("d")).alias("back")).collect()
    assert [r.k for r in rows] == [20240229, 19991231, 120102, None]
    assert [r.back for r in rows] == days


def test_a_key_that_is_no_day_is_null(spark):
    df = spark.createDataFrame([(20240230,), (7,), (None,)], "k bigint")
    assert [r[0] for r in df.select(key_to_date("k")).collect()] == [None, None, None]


def test_calendar_attributes(spark):
    rows = {r.date_key: r for r in date_dimension(spark, date(2023, 12, 30), date(2024, 1, 1)).collect()}
    assert len(rows) == 3
    saturday, monday = rows[20231230], rows[20240101]
    assert tuple(saturday) == (20231230, "Saturday", 30, "Weekend", "December", 4, 2023)
    assert tuple(monday) == (20240101, "Monday", 1, "Weekday", "January", 1, 2024)


def test_derived_calendar_spans_all_sources(spark):
    a = spark.createDataFrame([(datetime(2024, 1, 5, 23, 59),), (None,)], "t timestamp_ntz")
    b = spark.createDataFrame([(date(2024, 1, 2),), (date(2024, 1, 3),)], "d date")
    derived = date_dimension_for((a, "t"), (b, "d"))
    fixed = date_dimension(spark, date(2024, 1, 2), date(2024, 1, 5))
    assert sorted(map(tuple, derived.collect())) == sorted(map(tuple, fixed.collect()))
    assert derived.dtypes == fixed.dtypes


def test_no_days_no_calendar(spark):
    empty = spark.createDataFrame([(None,)], "d date")
    assert date_dimension_for((empty, "d")).count() == 0
    assert date_dimension_for((empty.where(F.lit(False)), "d"), (empty, "d")).count() == 0


def test_days_around_the_year_10000_keep_their_attributes(spark):
    days = spark.sql("SELECT explode(sequence(DATE'9999-12-30', DATE'9999-12-30' + INTERVAL 4 DAY)) AS d")
    calendar = date_dimension_for((days, "d"))
    joined = days.select(date_key("d").alias("k")).join(calendar, F.col("k") == F.col("date_key"), "left")
    years = {r.k: r.calendar_year for r in joined.select("k", "calendar_year").collect()}
    assert years == {99991230: 9999, 99991231: 9999, 100000101: 10000, 100000102: 10000, 100000103: 10000}


def test_a_long_calendar_is_not_broadcast(spark, conf):
    facts = spark.range(10).select((F.col("id") + 20240101).alias("k"))
    for last, broadcast in ((date(2024, 12, 31), True), (date(9999, 12, 31), False)):
        calendar = date_dimension(spark, date(2024, 1, 1), last)
        conf(spark__sql__autoBroadcastJoinThreshold="1m")
        plan = facts.join(calendar, F.col("k") == F.col("date_key"), "left")._jdf.queryExecution().sparkPlan().toString()
        assert ("BroadcastHashJoin" in plan) == broadcast
