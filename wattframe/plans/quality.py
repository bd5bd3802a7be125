"""Data-quality assertions: each returns the offending rows, with its name and severity."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe import registry
from wattframe.functions import columns as C
from wattframe.operators import relational as R
from wattframe.plans.aggregates import q, r3
from wattframe.plans.bindings import hourly, monthly, regional_orders, with_
from wattframe.plans.domain import CONSUMPTION_SQL, LADDER_SQL, STATES_SQL, bound_ladder, consumption, states
from wattframe.registry import query
from wattframe.session import table
from wattframe.sources import calendar


@dataclass(frozen=True)
class Assertion:
    name: str
    severity: str
    rows: Callable[..., DataFrame]


# Generic assertions: each gives the rows that break it.


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def related(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).join(to.select(F.col(field).alias(column)), column, "left_anti")


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(~F.col(column).between(low, high))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    n = a.agg(F.count("*").alias("left_n")).crossJoin(b.agg(F.count("*").alias("right_n")))
    return n.filter("left_n <> right_n")


def contiguous(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Rows that don't follow their predecessor by one."""
    before = F.lag(index).over((Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(index))
    return df.withColumn("gap", F.col(index) - before).filter("gap <> 1")


def known_exceptions(found: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Exceptions that nobody knows, and known ones that are gone."""
    new = found.select(*keys).distinct().join(known, keys, "left_anti").withColumn("problem", F.lit("unknown"))
    gone = known.join(found, keys, "left_anti").withColumn("problem", F.lit("gone"))
    return new.unionByName(gone)


@query("select 'not_null' as check, count_if(o_custkey is null)::bigint as n from orders union all select 'unique', (select count(*) from (select o_orderkey from orders group by 1 having count(*) > 1))::bigint union all select 'accepted', count_if(o_orderstatus not in ('F', 'O'))::bigint from orders union all select 'related', count(*)::bigint from orders where o_custkey not in (select c_custkey from customer where c_custkey % 50 <> 0)")
def dq_01_generic(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer").filter("c_custkey % 50 <> 0")
    n = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
    return n("not_null", not_null(o, "o_custkey")).union(n("unique", unique(o, "o_orderkey"))).union(n("accepted", accepted(o, "o_orderstatus", ["F", "O"]))).union(n("related", related(o, "o_custkey", c, "c_custkey")))


@query("select 'combination' as check, (select count(*) from (select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1))::bigint as n union all select 'rows', case when (select count(*) from orders) <> (select count(*) from lineitem) then 1 else 0 end::bigint union all select 'range', (select count(*) from lineitem where l_discount not between 0.01 and 0.09)::bigint")
def dq_02_combination_rows_range(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    n = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
    return n("combination", unique(li, "l_orderkey", "l_linenumber")).union(n("rows", same_rows(o, li))).union(n("range", in_range(li, "l_discount", 0.01, 0.09)))


@query("select max(o_orderdate)::date as last, case when datediff('day', max(o_orderdate), timestamp '2001-09-10') > 60 then 'error' when datediff('day', max(o_orderdate), timestamp '2001-09-10') > 30 then 'warn' else 'pass' end as state from orders")
def dq_03_freshness(spark, sf, as_of: str = "2001-09-10", warn: int = 30, error: int = 60):
    age = F.datediff(F.lit(as_of).cast("date"), F.max("o_orderdate"))
    return table(spark, sf, "orders").agg(F.max("o_orderdate").cast("date").alias("last"), F.when(age > error, "error").when(age > warn, "warn").otherwise("pass").alias("state"))


@query("with a as (select event_type as k, count(*)::bigint as n, count_if(value is null)::bigint as nulls, count_if(props = '')::bigint as blanks from events group by 1), b as (select event_type as k, count(*)::bigint as n from events where event_id % 100 <> 0 group by 1) select coalesce(a.k, b.k) as k, a.n as raw_n, b.n as file_n, nulls, blanks from a full join b on a.k = b.k where a.n is distinct from b.n")
def dq_04_raw_against_file(spark, sf):
    e = table(spark, sf, "events")
    a = e.groupBy(F.col("event_type").alias("k")).agg(F.count("*").alias("raw_n"), F.count_if(F.col("value").isNull()).alias("nulls"), F.count_if(F.col("props") == "").alias("blanks"))
    b = e.filter("event_id % 100 <> 0").groupBy(F.col("event_type").alias("k")).agg(F.count("*").alias("file_n"))
    return a.join(b, "k", "full").filter(~F.col("raw_n").eqNullSafe(F.col("file_n"))).select("k", "raw_n", "file_n", "nulls", "blanks")


@query(f"select count(*)::bigint as raw, count_if(timezone('{C.ZONE}', timezone('{C.ZONE}', o_orderdate)) <> o_orderdate)::bigint as dropped, (select count(*) from orders where timezone('{C.ZONE}', timezone('{C.ZONE}', o_orderdate)) = o_orderdate)::bigint as staged from orders")
def dq_05_row_conservation(spark, sf):
    exists = C.local_exists("o_orderdate")
    return table(spark, sf, "orders").agg(F.count("*").alias("raw"), F.count_if(~exists).alias("dropped"), F.count_if(exists).alias("staged"))


@query(with_("monthly") + "select market, month from (select market, month, datediff('month', lag(month) over (partition by market order by month), month) as gap from monthly) where gap <> 1")
def dq_06_contiguity(spark, sf):
    return contiguous(monthly(spark, sf).withColumn("mi", C.month_index("month")), ["market"], "mi").select("market", "month")


@query(with_("hourly") + "select market, strftime(hour, '%Y-%m-%d %H') as utc, load from hourly where load <= 0 or load > 95")
def dq_07_plausibility(spark, sf):
    return hourly(spark, sf).filter((F.col("load") <= 0) | (F.col("load") > 95)).select("market", F.date_format("hour", "yyyy-MM-dd HH").alias("utc"), "load")


@query("with f as (select distinct ts::date as day from events where value > 99.9), k(day) as (values (date '2024-01-02'), (date '2024-01-03'), (date '2030-01-01')) select day, 'unknown' as problem from f where day not in (select day from k) union all select day, 'gone' from k where day not in (select day from f)")
def dq_08_known_exceptions(spark, sf):
    found = table(spark, sf, "events").filter("value > 99.9").select(F.col("ts").cast("date").alias("day"))
    known = spark.createDataFrame([("2024-01-02",), ("2024-01-03",), ("2030-01-01",)], "day string").select(F.col("day").cast("date").alias("day"))
    return known_exceptions(found, known, ["day"])


@query(with_("monthly") + f", a as (select market, month, value from monthly), b as (select r_name as market, date_trunc('month', o_orderdate)::date as month, {q('sum(o_totalprice) / count(*)')} as value from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2) select count(*)::bigint as differing from a full join b using (market, month) where a.value is null or b.value is null or abs(a.value - b.value) > 0.01")
def dq_09_reconciliation(spark, sf):
    b = regional_orders(spark, sf).groupBy(F.col("r_name").alias("market"), C.month_of("o_orderdate").alias("month")).agg(r3(F.sum("o_totalprice") / F.count("*")).alias("value"))
    return R.reconcile(monthly(spark, sf), b, ["market", "month"], "value", 0.01).agg(F.count("*").alias("differing"))


@query(with_("monthly") + f", {LADDER_SQL}, {STATES_SQL} select 'ladder' as check, count(*)::bigint as n from ladder where (first_status = 'not_available') <> (first_adj is null) or (first_status = 'built_in' and first_adj <> 0) union all select 'fill', count(*)::bigint from states where imputed and stations > 0")
def dq_10_status_consistency(spark, sf):
    x = bound_ladder(spark, sf)
    wrong = ((F.col("first_status") == "not_available") != F.col("first_adj").isNull()) | ((F.col("first_status") == "built_in") & (F.col("first_adj") != 0))
    n = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
    return n("ladder", x.filter(wrong)).union(n("fill", states(spark, sf).filter("imputed and stations > 0")))


@query("select 285::bigint as holidays, 271752::bigint as hours, 11::bigint as regulated_most, 10::bigint as regulated_in_2000")
def dq_11_known_answers(spark, sf):
    named = calendar.holidays(spark)
    per_year = calendar.regulated_holidays(named).groupBy(F.year("day").alias("y")).agg(F.count("*").alias("n"))
    return named.agg(F.count("*").alias("holidays")).crossJoin(calendar.hours(spark).agg(F.count("*").alias("hours"))).crossJoin(per_year.agg(F.max("n").alias("regulated_most"), F.max(F.when(F.col("y") == 2000, F.col("n"))).alias("regulated_in_2000")))


@query(f"with c as (select user_id as station, count(distinct date_trunc('hour', ts))::bigint as hours from events group by 1) select station, {q('hours / 720.0', 6)} as share from c where hours / 720.0 < 0.095")
def dq_12_station_completeness(spark, sf, least: float = 0.095):
    c = table(spark, sf, "events").groupBy(F.col("user_id").alias("station")).agg(F.count_distinct(F.date_trunc("hour", "ts")).alias("hours"))
    return c.withColumn("s", F.col("hours") / 720.0).filter(F.col("s") < least).select("station", r3("s", 6).alias("share"))


@query(with_("hourly") + f", {CONSUMPTION_SQL} select count(distinct profile)::bigint as levels, min(profile) as low, coalesce(count_if(not is_open and profile <> 0.4), 0)::bigint as wrong_closed from consumption")
def dq_13_profile_invariants(spark, sf):
    return consumption(spark, sf).agg(F.count_distinct("profile").alias("levels"), F.min("profile").alias("low"), F.count_if(~F.col("is_open") & (F.col("profile") != 0.4)).alias("wrong_closed"))


@query("select 'deliberate' as problem from region where false")
def dq_14_deliberate_failure(spark, sf, fail: bool = False):
    return spark.range(1 if fail else 0).select(F.lit("deliberate").alias("problem"))


@query()
def dq_15_untested_queries(spark, sf):
    """Queries without SQL to hold them against."""
    names = sorted(set(registry.QUERIES) - set(registry.SQL))
    return spark.createDataFrame([(n,) for n in names], "query string")


ASSERTIONS = [
    Assertion("orders_contiguous_months", "error", dq_06_contiguity),
    Assertion("hourly_load_plausible", "warn", dq_07_plausibility),
    Assertion("known_exceptions_only", "warn", dq_08_known_exceptions),
    Assertion("no_deliberate_failure", "error", dq_14_deliberate_failure),
]


def run_assertions(spark, sf, assertions: list[Assertion] = ASSERTIONS) -> DataFrame:
    """name, severity, n (offending rows) and verdict: one query for all, so that inputs that several share are read and shuffled once."""
    counts = [a.rows(spark, sf).agg(F.count("*").alias("n")).select(F.lit(a.name).alias("name"), F.lit(a.severity).alias("severity"), "n") for a in assertions]
    found = counts[0]
    for more in counts[1:]:
        found = found.union(more)
    return found.withColumn("verdict", F.when(F.col("n") == 0, "pass").otherwise(F.col("severity")))
