import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from support import at
from ledgerloom.functions import scalars as s


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_elapsed_days_floor(spark):
    m = s.moment
    assert one(spark, s.elapsed_days(m("2024-01-01 12:00:00"), m("2024-01-02 11:59:59"))) == 0
    assert one(spark, s.elapsed_days(m("2024-01-01 12:00:00"), m("2024-01-03 12:00:00"))) == 2
    assert one(spark, s.elapsed_days(m("2024-01-02 00:00:00"), m("2024-01-01 23:00:00"))) == -1


def test_second_boundaries(spark):
    start, end = s.moment("2024-01-01 00:00:00.9"), s.moment("2024-01-01 00:00:02.1")
    assert one(spark, s.second_boundaries(start, end)) == 2


def test_rounding_is_half_up_on_decimals(spark):
    for value, expected in ((150, 200), (250, 300), (-150, -200), (149, 100)):
        assert one(spark, F.round(F.lit(Decimal(value)), -2)) == expected


def test_amount_buckets(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ("100", "100.01", "500", "1000", "1000.01")], "a decimal(10,2)")
    assert [r[0] for r in df.select(s.amount_bucket(F.col("a"))).collect()] == [
        "<100", "100-500", "100-500", "500-1000", ">1000",
    ]


def test_full_name_null(spark):
    assert one(spark, s.full_name(F.lit("a"), F.lit(None).cast("string"))) is None


def test_share_of_zero(spark):
    assert one(spark, s.share(F.lit(1), F.lit(0))) is None


def test_iso_calendar(spark):
    df = spark.createDataFrame([(at("2021-01-03 00:00:00"),), (at("2024-12-30 00:00:00"),)], "t timestamp_ntz")
    got = df.select(F.weekofyear("t"), F.weekday("t"), s.month_label(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(53, 6, "2021-01"), (1, 0, "2024-12")]
    assert dt.date(2021, 1, 3).isocalendar()[1] == 53


def test_json_null_is_sql_null(spark):
    df = spark.createDataFrame([("null",), ('{"a": 1}',), (None,)], "t string")
    got = df.select(s.sql_null(F.parse_json("t")).isNull().alias("n")).collect()
    assert [r["n"] for r in got] == [True, False, True]


def test_anonymous_number_is_stable_and_not_negative(spark):
    df = spark.range(1000).select(s.anonymous_number(F.col("id")).alias("h"))
    assert df.filter("h < 0 or h >= 9999999999999999").count() == 0
    assert df.collect() == df.collect()
