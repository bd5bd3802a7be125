import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattframe.functions import columns as C


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


@pytest.mark.parametrize(("year", "day"), [(2000, "2000-04-23"), (2008, "2008-03-23"), (2011, "2011-04-24"), (2019, "2019-04-21"), (2024, "2024-03-31"), (2025, "2025-04-20"), (2030, "2030-04-21")])
def test_easter(spark, year, day):
    assert str(one(spark, C.easter(F.lit(year)))) == day


def test_local_hours_that_clocks_skipped(spark):
    rows = spark.createDataFrame([("2018-11-04 00:00:00",), ("2018-11-04 01:00:00",), ("2019-02-16 23:00:00",), ("2020-11-01 00:00:00",)], "t string")
    t = F.col("t").cast("timestamp_ntz")
    got = rows.select(C.local_exists(t).alias("e"), C.to_utc(t).alias("u")).collect()
    assert [r.e for r in got] == [False, True, True, True]
    assert got[1].u == dt.datetime(2018, 11, 4, 3)
    assert got[0].u == got[1].u  # the same instant as the hour after it, so it has to go before rows are deduplicated


def test_day_of_167_hours_week(spark):
    start, end = (C.to_utc(F.lit(x).cast("timestamp_ntz")) for x in ("2018-11-03 00:00:00", "2018-11-10 00:00:00"))
    assert one(spark, C.hours_between(start, end)) == 167


def test_text_casts(spark):
    assert one(spark, C.comma_decimal(F.lit(",5"))) == 0.5
    assert one(spark, C.comma_decimal(F.lit(""))) is None
    assert one(spark, C.lenient(F.lit("x"), "int")) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, C.strict(F.lit("x"), "int"))


def test_null_rules(spark):
    null = F.lit(None).cast("double")
    assert one(spark, C.strict_greatest(F.lit(1.0), null)) is None
    assert one(spark, F.greatest(F.lit(1.0), null)) == 1.0
    assert one(spark, C.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, F.isnan(C.percent_change(F.lit(1.0), F.lit(0.0))))


def test_distance_and_formats(spark):
    assert one(spark, C.distance_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) == pytest.approx(111_195, abs=10)
    assert one(spark, C.local_number(F.lit(1234.5))) == "1.234,50"


def test_months_and_weekdays(spark):
    assert one(spark, C.month_index(F.lit("2020-01-31").cast("date"))) == 2020 * 12
    assert one(spark, C.iso_weekday(F.lit("2024-09-01").cast("date"))) == 7
    assert one(spark, C.hours_in_month(F.lit("2024-02-10").cast("date"))) == 29 * 24
    assert one(spark, C.utc_offset_hours(F.lit("2018-12-01 12:00:00"))) == -2
