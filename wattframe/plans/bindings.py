"""The driver's tables as the library's entities, and the same in SQL as named CTEs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.session import scratch, table

ROUND3 = "round(({})::decimal(28,9), 3)::double"

CTES = {
    "hourly": f"hourly as (select event_type as market, date_trunc('hour', ts) as hour, {ROUND3.format('avg(value)')} as load from events group by 1, 2)",
    "monthly": f"monthly as (select r_name as market, date_trunc('month', o_orderdate)::date as month, {ROUND3.format('avg(o_totalprice)')} as value, count(*)::bigint as n from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2)",
    "series": f"series as (select date_trunc('month', o_orderdate)::date as month, {ROUND3.format('avg(o_totalprice)')} as value, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::int as mi from orders group by 1, 3)",
    "prices": "prices as (select date_trunc('month', l_shipdate)::date as month, l_shipdate::date as day, l_quantity as quantity, l_extendedprice / l_quantity as price, l_shipmode_ as mode from (select *, l_returnflag as l_shipmode_ from lineitem))",
}


def with_(*names: str) -> str:
    return "with " + ", ".join(CTES[n] for n in names) + " "


#: Tables written so far by name and folder, one dictionary for each written_once() around.
_written: list[dict[tuple[str, str], DataFrame]] = []


@contextmanager
def written_once() -> Iterator[None]:
    """Inside, entities marked with `shared` are made once and written to the shared folder: a plan of many branches then reads these
    small tables instead of scanning the inputs in each branch."""
    _written.append({})
    try:
        yield
    finally:
        _written.pop()


def shared(entity: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Marks an entity (spark, sf) whose rows are bounded by the calendar and not by the data."""

    @wraps(entity)
    def once(spark, sf, *more, **named):
        if not _written or more or named:
            return entity(spark, sf, *more, **named)
        key = (entity.__name__, sf)
        if key not in _written[-1]:
            df, path = entity(spark, sf), scratch(spark, entity.__name__)
            df.write.parquet(path)
            _written[-1][key] = spark.read.schema(df.schema).parquet(path)
        return _written[-1][key].select("*")

    return once


@shared
def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly load by market: market, hour, load."""
    e = table(spark, sf, "events")
    return e.groupBy(F.col("event_type").alias("market"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(C.stable_round(F.avg("value")).alias("load"))


def regional_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their region. Dimensions are joined without hints: Spark broadcasts them where they are small."""
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


@shared
def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly mean by market: market, month, value, n."""
    return regional_orders(spark, sf).groupBy(F.col("r_name").alias("market"), C.month_of("o_orderdate").alias("month")).agg(C.stable_round(F.avg("o_totalprice")).alias("value"), F.count("*").alias("n"))


@shared
def series(spark: SparkSession, sf: str) -> DataFrame:
    """One monthly series: month, value, mi (month index)."""
    out = table(spark, sf, "orders").groupBy(C.month_of("o_orderdate").alias("month")).agg(C.stable_round(F.avg("o_totalprice")).alias("value"))
    return out.withColumn("mi", C.month_index("month"))


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Unit prices by ship day: month, day, quantity, price, mode."""
    li = table(spark, sf, "lineitem")
    return li.select(C.month_of("l_shipdate").alias("month"), F.col("l_shipdate").cast("date").alias("day"), F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_returnflag").alias("mode"))


def clock_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
