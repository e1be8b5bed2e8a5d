import datetime as dt

from pyspark.sql import functions as F

from stopgrid.functions import columns as C


def values(spark, texts, expr):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(expr("t")).collect()]


TEXTS = ["5", " 7 ", "3.7", "-3", "3.0", "", None, "x", "1d", "1e2"]


def test_csv_counts_keep_sign_and_cut_fraction(spark):
    assert values(spark, TEXTS, C.whole_or_zero) == [5, 7, 3, -3, 3, 0, 0, 0, 0, 100]


def test_page_counts_accept_plain_digits_only(spark):
    assert values(spark, TEXTS, C.digits_or_zero) == [5, 7, 0, 0, 0, 0, 0, 0, 0, 0]


def test_demand_counts_accept_signed_whole_numbers(spark):
    assert values(spark, TEXTS, C.integer_or_zero) == [5, 7, 0, -3, 0, 0, 0, 0, 0, 0]


def test_numbers(spark):
    assert values(spark, TEXTS, C.to_number) == [5.0, 7.0, 3.7, -3.0, 3.0, None, None, None, None, 100.0]


def test_dates_in_both_forms(spark):
    got = values(spark, ["20240229", " 2024-02-29 ", "20240230", "29.02.2024", None], C.parse_date)
    assert got == [dt.date(2024, 2, 29), dt.date(2024, 2, 29), None, None, None]


def numbers(spark, xs, expr):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    return [r[0] for r in df.select(expr("x")).collect()]


def test_crowding_edges(spark):
    loads = [33.0, 33.0001, 49.5, 49.5001, None]
    assert numbers(spark, loads, C.crowding) == ["free", "normal", "normal", "crowded", "crowded"]
    assert numbers(spark, loads, C.is_crowded) == [0, 0, 0, 1, 0]


def test_headway_is_capped(spark):
    assert numbers(spark, [0.0, None, 0.5, 4.0, 100.0], C.capped_headway) == [60.0, 60.0, 60.0, 15.0, 2.0]


def test_clip_keeps_null(spark):
    assert numbers(spark, [-1.0, 0.0, 2.0, None], C.clip_zero) == [0.0, 0.0, 2.0, None]


def test_ratio_guards(spark):
    assert numbers(spark, [0.0, 4.0, None], lambda x: C.ratio(F.lit(8.0), x)) == [None, 2.0, None]
    assert numbers(spark, [0.0, 4.0, None], lambda x: C.ratio_or_zero(F.lit(8.0), x)) == [0.0, 2.0, 0.0]


def test_moment_keeps_microseconds_and_passes_midnight(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), 86_400_000_001)], "d date, us bigint")
    assert df.select(C.moment("d", "us")).first()[0] == dt.datetime(2024, 2, 1, 0, 0, 0, 1)


def test_two_digits(spark):
    df = spark.createDataFrame([(3,), (10,), (123,)], "n bigint")
    assert [r[0] for r in df.select(C.two_digits("n")).collect()] == ["03", "10", "123"]
