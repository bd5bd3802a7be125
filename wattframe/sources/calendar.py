"""Calendars made by rule: holidays, the hour grid and its local attributes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.functions import columns as C

#: National holidays as (month, day, name, first year).
FIXED_HOLIDAYS = [
    (1, 1, "New Year", 2000),
    (4, 21, "Tiradentes", 2000),
    (5, 1, "Labour Day", 2000),
    (9, 7, "Independence", 2000),
    (10, 12, "Our Lady of Aparecida", 2000),
    (11, 2, "All Souls", 2000),
    (11, 15, "Republic", 2000),
    (11, 20, "Black Awareness", 2024),
    (12, 25, "Christmas", 2000),
]
GOOD_FRIDAY = "Good Friday"
#: Days from Good Friday to the two holidays that only the regulator counts.
CARNIVAL, CORPUS_CHRISTI = -45, 62
UNREGULATED = "Black Awareness"


def holidays(spark: SparkSession, first: int = 2000, last: int = 2030, since: int = 2000) -> DataFrame:
    """day, name: one row per date; names of one date are joined by '; '. What the lists have from 2000 on counts from `since` on."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("y"))
    fixed = spark.createDataFrame(FIXED_HOLIDAYS, "m int, d int, name string, since int")
    days = years.crossJoin(fixed).filter(F.col("y") >= F.when(F.col("since") == 2000, F.least(F.col("since"), F.lit(since))).otherwise(F.col("since"))).select(F.make_date("y", "m", "d").alias("day"), "name")
    friday = years.select(F.date_sub(C.easter("y"), 2).alias("day"), F.lit(GOOD_FRIDAY).alias("name"))
    return days.union(friday).groupBy("day").agg(F.array_join(F.array_sort(F.collect_list("name")), "; ").alias("name"))


def regulated_holidays(named: DataFrame) -> DataFrame:
    """day: the named holidays without the one the regulator doesn't list, Carnival Tuesday and Corpus Christi."""
    friday = named.filter(F.col("name").contains(GOOD_FRIDAY))
    return named.filter(~F.col("name").contains(UNREGULATED)).select("day").union(friday.select(F.date_add("day", CARNIVAL))).union(friday.select(F.date_add("day", CORPUS_CHRISTI))).distinct()


def business_days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """mi (month index), business: Mondays to Fridays that no calendar lists; dates of years before the lists' start count as listed later."""
    named = holidays(spark, int(first[:4]), int(last[:4]), since=int(first[:4]))
    off = named.select("day").union(regulated_holidays(named)).distinct()
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.last_day(F.lit(last).cast("date")))).alias("day"))
    return days.join(off, "day", "left_anti").groupBy(C.month_index("day").alias("mi")).agg(F.count_if(C.iso_weekday("day") < 6).alias("business"))


def hours(spark: SparkSession, first: str = "2000-01-01 00:00:00", last: str = "2030-12-31 23:00:00") -> DataFrame:
    """utc: every hour, both ends included; made in as many tasks as Spark gives a range."""
    a, b = datetime.fromisoformat(first), datetime.fromisoformat(last)
    n = int((b - a).total_seconds() // 3600) + 1
    return spark.range(max(n, 0)).select((F.lit(first).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("utc"))


def time_dimension(spark: SparkSession, first: str = "2000-01-01 00:00:00", last: str = "2030-12-31 23:00:00", peak_hour: int = 18, peak_hours: int = 3) -> DataFrame:
    """A row per UTC hour with the calendar of its local hour."""
    named = holidays(spark)
    h = hours(spark, first, last).withColumn("local", C.to_local("utc")).withColumn("day", F.col("local").cast("date"))
    h = h.join(named, "day", "left").join(regulated_holidays(named).withColumn("r", F.lit(True)), "day", "left")
    weekday, month, hour = C.iso_weekday("day"), F.month("day"), F.hour("local")
    holiday, regulated = F.col("name").isNotNull(), F.col("r").isNotNull()
    offset = F.timestamp_diff("HOUR", F.col("utc"), F.col("local"))
    return h.select(
        "utc", "local", "day", hour.alias("hour"), offset.alias("utc_offset"), (offset == -2).alias("is_dst"), F.year("day").alias("year"), month.alias("month"), F.day("day").alias("day_of_month"),
        weekday.alias("weekday"), holiday.alias("is_holiday"), F.when(holiday, F.size(F.split("name", "; "))).otherwise(0).alias("n_holidays"), F.coalesce("name", F.lit("")).alias("holiday_names"),
        F.when(holiday | (weekday == 7), "sunday_holiday").when(weekday == 6, "saturday").otherwise("business").alias("day_type"),
        F.when(month.isin(12, 1, 2), "summer").when(month.isin(3, 4, 5), "autumn").when(month.isin(6, 7, 8), "winter").otherwise("spring").alias("season"),
        regulated.alias("is_regulated_holiday"), (~regulated & weekday.between(1, 5) & hour.between(peak_hour, peak_hour + peak_hours - 1)).alias("is_peak"),
    )
