"""Edge rows for the scalar features (hour edges, zero denominators, bad input)."""

import datetime as dt

from pyspark.sql import functions as F

from lakemart.functions import features as fx


def test_time_of_day_and_rush_hour_edges(spark):
    hours = [4, 5, 7, 10, 11, 12, 16, 17, 19, 20, 21]
    df = spark.createDataFrame([(h,) for h in hours], "hour int")
    got = {r.hour: (r.tod, r.rush) for r in df.select(
        "hour", fx.time_of_day("hour").alias("tod"), fx.is_rush_hour("hour").alias("rush")).collect()}
    assert got[4][0] == "Ночь" and got[5][0] == "Утро" and got[11][0] == "Утро"
    assert got[12][0] == "День" and got[16][0] == "День" and got[17][0] == "Вечер"
    assert got[20][0] == "Вечер" and got[21][0] == "Ночь"
    assert [got[h][1] for h in (4, 7, 10, 11, 16, 19, 20)] == [0, 1, 1, 0, 1, 1, 0]


def test_zero_and_negative_durations(spark):
    df = spark.createDataFrame([(0.0, 10.0, 5.0), (-3.0, 10.0, 5.0), (30.0, 10.0, 0.0)],
                               "m double, dist double, fare double")
    r = df.select(fx.speed_kmh("dist", "m").alias("kmh"), fx.speed_mph("dist", "m").alias("mph"),
                  fx.per_minute("fare", "m").alias("rpm"), fx.ratio("dist", "fare").alias("ratio")).collect()
    assert r[0].kmh is None and r[0].mph == 0.0 and r[0].rpm is None
    assert r[1].kmh is None and r[1].mph == 0.0
    assert abs(r[2].kmh - 10 * 1.60934 / 0.5) < 1e-9 and r[2].ratio is None


def test_buckets_null_falls_to_last(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (9.99,), (None,)], "d double")
    got = [r[0] for r in df.select(fx.bucket("d", fx.DISTANCE_BUCKETS)).collect()]
    assert got == ["0-1 mi", "1-3 mi", "5-10 mi", "10+ mi"]


def test_typed_coalesce_and_dates_are_ansi_safe(spark):
    df = spark.createDataFrame([("12",), ("n/a",), (None,)], "s string")
    assert [r[0] for r in df.select(fx.typed_coalesce("s", "int")).collect()] == [12, 0, 0]
    d = spark.createDataFrame([("Dec 29, 2023",), ("Jun 2009",), ("2020-02-03",), ("TBA",)], "s string")
    got = [r[0] for r in d.select(fx.parse_multi_date("s")).collect()]
    assert got == [dt.date(2023, 12, 29), dt.date(2009, 6, 1), dt.date(2020, 2, 3), None]


def test_price_class_keeps_null(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (50.0,), (50.01,), (None,)], "p double")
    got = [r[0] for r in df.select(fx.price_class("p")).collect()]
    assert got == ["Дешевые", "Средняя стоимость", "Средняя стоимость", "Дорогие", None]


def test_growth_status(spark):
    df = spark.createDataFrame([(None, None), (5.0, 1.0), (0.0, 1.0), (-2.0, 3.0)], "ch double, prev double")
    got = [r[0] for r in df.select(fx.growth_status("ch", "prev")).collect()]
    assert got == ["Нет данных", "Рост", "Плато", "Падение"]


def test_pct_error_zero_actual(spark):
    df = spark.createDataFrame([(5.0, 0.0), (6.0, 4.0)], "p double, a double")
    assert [r[0] for r in df.select(fx.pct_error("p", "a")).collect()] == [0.0, 50.0]


def test_duration_on_ntz(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' a, TIMESTAMP_NTZ'2024-01-01 00:01:30.9' b")
    assert df.select(fx.duration_minutes("a", "b")).first()[0] == 1.5
