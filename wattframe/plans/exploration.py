"""Exploration queries and dashboard tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import relational as R
from wattframe.operators import stats as S
from wattframe.plans.aggregates import q, r3
from wattframe.plans.bindings import hourly, monthly, series, with_
from wattframe.plans.domain import LADDER_SQL, bound_ladder
from wattframe.plans.scenario import LIMITS_SQL, REAL_SQL, SPOT_SQL, annual, bounds, spot
from wattframe.registry import query
from wattframe.session import table

Z = C.ZONE
DAY_TYPE = "case when isodow({0}) = 7 then 'sunday' when isodow({0}) = 6 then 'saturday' else 'business' end"


def day_type(day):
    w = C.iso_weekday(day)
    return F.when(w == 7, "sunday").when(w == 6, "saturday").otherwise("business")


@query(with_("hourly") + f"select date_trunc('month', hour)::date as month, {q('avg(load)')} as mean, count(load)::bigint as hours from hourly where market = (select min(event_type) from events) group by 1")
def qry_01_monthly_mean(spark, sf):
    h = hourly(spark, sf)
    one = h.join(F.broadcast(h.agg(F.min("market").alias("market"))), "market")
    return one.groupBy(C.month_of("hour").alias("month")).agg(r3(F.avg("load")).alias("mean"), F.count("load").alias("hours"))


@query(with_("hourly") + f", l as (select timezone('{Z}', timezone('UTC', hour)) as local, load from hourly) select {DAY_TYPE.format('local')} as day_type, hour(local)::int as h, {q('avg(load)')} as mean from l where local >= timestamp '2024-01-05' and local < timestamp '2024-01-26' group by 1, 2")
def qry_02_profile_by_day_type(spark, sf):
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    local = hourly(spark, sf).select(C.to_local("hour").alias("local"), "load").filter((F.col("local") >= at("2024-01-05")) & (F.col("local") < at("2024-01-26")))
    return local.groupBy(day_type("local").alias("day_type"), F.hour("local").alias("h")).agg(r3(F.avg("load")).alias("mean"))


@query(f"select ts::date as day, {q('avg(value)')} as load, {q('avg(user_id % 40)')} as temperature, any_value({DAY_TYPE.format('ts')}) as kind from events where isodow(ts) < 6 group by 1 having count(distinct hour(ts)) >= 20")
def qry_03_load_and_temperature(spark, sf):
    e = table(spark, sf, "events").filter(C.iso_weekday("ts") < 6)
    d = e.groupBy(F.col("ts").cast("date").alias("day")).agg(r3(F.avg("value")).alias("load"), r3(F.avg(F.col("user_id") % 40)).alias("temperature"), F.any_value(day_type("ts")).alias("kind"), F.count_distinct(F.hour("ts")).alias("n"))
    return d.filter("n >= 20").drop("n")


@query(f"with p as (select year(l_shipdate)::int as year, l_extendedprice as price from lineitem), m as (select year, min(price) as low from p group by 1) select p.year, {q('quantile_cont(price, 0.01)')} as p01, {q('quantile_cont(price, 0.25)')} as q1, {q('quantile_cont(price, 0.5)')} as q2, {q('quantile_cont(price, 0.75)')} as q3, {q('quantile_cont(price, 0.99)')} as p99, any_value(low) as low, {q('100.0 * count_if(price <= low + 0.005) / count(*)', 5)} as at_low from p join m using (year) group by 1")
def qry_04_price_quantiles(spark, sf):
    p = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("price"))
    low = p.groupBy("year").agg(F.min("price").alias("low"))
    levels = {"p01": 0.01, "q1": 0.25, "q2": 0.5, "q3": 0.75, "p99": 0.99}
    quantiles = S.selected_quantiles(p, ["year"], "price", list(levels.values()))
    quantiles = quantiles.toDF("year", "n", *levels)
    y = p.join(low, "year").groupBy("year").agg(F.any_value("low").alias("low"), r3(100.0 * F.count_if(F.col("price") <= F.col("low") + 0.005) / F.count("*"), 5).alias("at_low"))
    return y.join(quantiles, "year").select("year", *[r3(k).alias(k) for k in levels], "low", "at_low")


@query(f"with w as (select date_trunc('week', o_orderdate) as a, {q('avg(o_totalprice)')} as price from orders where o_orderdate < timestamp '1998-01-01' group by 1), e as (select year(a + d * interval 1 day)::int as year, price, 24.0 as h from w, (select unnest(range(0, 7)) as d)), u as (select year, sum(price * h) as x, sum(h) as h from e where year < 1998 group by 1 union all select year(o_orderdate)::int, sum(o_totalprice), count(*) from orders where o_orderdate >= timestamp '1998-01-01' group by 1) select year, {q('sum(x) / sum(h)')} as price from u group by 1")
def qry_05_annual_price(spark, sf):
    """Weekly prices weighted by their hours in the year up to a date, single prices after it, in one table."""
    o = table(spark, sf, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    w = o.filter(F.col("o_orderdate") < cut).groupBy(F.date_trunc("week", "o_orderdate").cast("timestamp_ntz").alias("a")).agg(r3(F.avg("o_totalprice")).alias("price")).withColumn("b", F.col("a") + F.expr("interval 7 day"))
    years = spark.range(1994, 1999).select(F.make_timestamp_ntz(F.col("id").cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("y0"), F.make_timestamp_ntz(F.col("id").cast("int") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("y1"))
    met = R.overlap_join(w, years, "a", "b", "y0", "y1", bucket="year").withColumn("h", C.hours_between("overlap_start", "overlap_end").cast("double")).withColumn("year", F.year("y0")).filter("year < 1998")
    old = met.groupBy("year").agg(F.sum(F.col("price") * F.col("h")).alias("x"), F.sum("h").alias("h"))
    new = o.filter(F.col("o_orderdate") >= cut).groupBy(F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("x"), F.count("*").cast("double").alias("h"))
    return old.unionByName(new).groupBy("year").agg(r3(F.sum("x") / F.sum("h")).alias("price"))


HOURLY_MEAN = "select {0} as h, round(avg(value)::decimal(28,9), 3)::double as mean, count(*)::bigint as n from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20' group by 1"


def _month_slice(spark, sf, text: bool):
    e = table(spark, sf, "events")
    if text:  # raw storage: everything is text and is cast leniently
        e = e.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.col("value").cast("string").alias("value"), "event_type").select(C.lenient("ts", "timestamp_ntz").alias("ts"), C.lenient("value", "double").alias("value"), "event_type")
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    return e.filter((F.col("ts") >= at("2024-01-05")) & (F.col("ts") < at("2024-01-20")))


@query(HOURLY_MEAN.format(f"hour(timezone('{Z}', timezone('UTC', ts)))::int"))
def qry_06_mean_by_local_hour_raw(spark, sf):
    return _month_slice(spark, sf, True).groupBy(F.hour(C.to_local("ts")).alias("h")).agg(r3(F.avg("value")).alias("mean"), F.count("*").alias("n"))


@query(HOURLY_MEAN.format(f"hour(timezone('{Z}', timezone('UTC', ts)))::int"))
def qry_07_mean_by_local_hour_typed(spark, sf):
    return _month_slice(spark, sf, False).groupBy(F.hour(C.to_local("ts")).alias("h")).agg(r3(F.avg("value")).alias("mean"), F.count("*").alias("n"))


@query(HOURLY_MEAN.format("hour(ts)::int"))
def qry_08_mean_by_utc_hour(spark, sf):
    return _month_slice(spark, sf, False).groupBy(F.hour("ts").alias("h")).agg(r3(F.avg("value")).alias("mean"), F.count("*").alias("n"))


@query(with_("monthly") + f", {LADDER_SQL} select market, any_value(factor) as factor, year(month)::int as year, {q('avg(first_adj)')} as first_adj, {q('avg(second_adj)')} as second_adj, {q('100 * avg(first_adj + second_adj) / avg(original)', 5)} as share, {q('avg(adjusted_whole - adjusted)')} as whole_minus_factor from ladder where first_adj is not null group by 1, 3")
def qry_09_adjustment_by_year(spark, sf):
    x = bound_ladder(spark, sf).filter("first_adj is not null")
    return x.groupBy("market", F.year("month").alias("year")).agg(F.any_value("factor").alias("factor"), r3(F.avg("first_adj")).alias("first_adj"), r3(F.avg("second_adj")).alias("second_adj"), r3(100 * F.avg(F.col("first_adj") + F.col("second_adj")) / F.avg("original"), 5).alias("share"), r3(F.avg(F.col("adjusted_whole") - F.col("adjusted"))).alias("whole_minus_factor"))


YOY_SQL = f"{LADDER_SQL}, yoy as (select market, month, {q('100 * (original / lag(original, 12) over w - 1)', 4)} as original, {q('100 * (adjusted / lag(adjusted, 12) over w - 1)', 4)} as adjusted, {q('100 * (rebuilt / lag(rebuilt, 12) over w - 1)', 4)} as rebuilt from ladder window w as (partition by market order by month))"


def yoy(spark, sf):
    w = Window.partitionBy("market").orderBy("month")
    change = lambda c: r3(100 * (F.col(c) / F.lag(c, 12).over(w) - 1), 4).alias(c)
    return bound_ladder(spark, sf).select("market", "month", *[change(c) for c in ("original", "adjusted", "rebuilt")])


@query(with_("monthly") + f", {YOY_SQL} select * from yoy where month between date '1998-01-01' and date '1999-12-01'")
def qry_10_change_around_breaks(spark, sf):
    return yoy(spark, sf).filter("month between date '1998-01-01' and date '1999-12-01'")


@query(with_("monthly") + f", {YOY_SQL} select market, max(case when month = date '1998-03-01' then original end) - max(case when month = date '1998-02-01' then original end) as jump, max(case when month = date '1998-03-01' then adjusted end) - max(case when month = date '1998-02-01' then adjusted end) as adjusted_jump from yoy group by 1")
def qry_11_jump_at_break(spark, sf):
    at = lambda c, d: F.max(F.when(F.col("month") == F.lit(d).cast("date"), F.col(c)))
    jump = lambda c: at(c, "1998-03-01") - at(c, "1998-02-01")
    return yoy(spark, sf).groupBy("market").agg(jump("original").alias("jump"), jump("adjusted").alias("adjusted_jump"))


@query(with_("monthly") + f", {LADDER_SQL} select market, count_if(unfinished)::bigint as unfinished, count_if(not covered)::bigint as gappy, min(month) as first, max(month) as last, min(case when adjusted is not null then month end) as first_adjusted from ladder group by 1")
def qry_12_coverage_span(spark, sf):
    x = bound_ladder(spark, sf)
    return x.groupBy("market").agg(F.count_if("unfinished").alias("unfinished"), F.count_if(~F.col("covered")).alias("gappy"), F.min("month").alias("first"), F.max("month").alias("last"), F.min(F.when(F.col("adjusted").isNotNull(), F.col("month"))).alias("first_adjusted"))


@query(f"select date_trunc('month', ts)::date as month, {q('avg(value)')} as temperature, count(value)::bigint as hours from events group by 1")
def qry_13_monthly_temperature(spark, sf):
    return table(spark, sf, "events").groupBy(C.month_of("ts").alias("month")).agg(r3(F.avg("value")).alias("temperature"), F.count("value").alias("hours"))


@query("with p as (select l_returnflag as method, l_orderkey as scenario, l_linenumber as h, l_extendedprice as price, (day(last_day(l_shipdate)) * 24)::double as hours from lineitem), y as (select method, scenario, sum(price * hours) / sum(hours) as price from p group by 1, 2) select method, count(distinct scenario)::bigint as scenarios, round(avg(price)::decimal(28,9), 3)::double as expected from y group by 1")
def qry_14_expected_price(spark, sf):
    hours = C.hours_in_month("l_shipdate").cast("double")
    y = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("method"), F.col("l_orderkey").alias("scenario")).agg((F.sum(F.col("l_extendedprice") * hours) / F.sum(hours)).alias("price"))
    return y.groupBy("method").agg(F.count_distinct("scenario").alias("scenarios"), r3(F.avg("price")).alias("expected"))


@query(f"select year(a + interval 3 day)::int as year, a::date as block, {q('min(price)')} as low, count(*)::bigint as n from (select date_trunc('week', l_shipdate) as a, l_extendedprice as price from lineitem) group by 1, 2")
def qry_15_floor_observations(spark, sf):
    """A week belongs to the year of its fourth day."""
    a = F.date_trunc("week", "l_shipdate").cast("timestamp_ntz")
    w = table(spark, sf, "lineitem").select(a.alias("a"), F.col("l_extendedprice").alias("price"))
    return w.groupBy(F.year(F.col("a") + F.expr("interval 3 day")).alias("year"), F.col("a").cast("date").alias("block")).agg(r3(F.min("price")).alias("low"), F.count("*").alias("n"))


@query("with r as (select event_id as job, event_id - event_id % 5 as parent, event_type, (value * 1000)::bigint as bytes from events), k as (select r.*, p.event_type as parent_type from r left join r p on p.job = r.parent) select case when parent_type = event_type then 'own' when parent_type is null then 'orphan' else 'child' end as class, count(*)::bigint as jobs, sum(bytes)::bigint as bytes from k group by 1")
def qry_16_bytes_by_job_class(spark, sf):
    i = F.col("event_id")
    r = table(spark, sf, "events").select(i.alias("job"), (i - i % 5).alias("parent"), "event_type", F.round(F.col("value") * 1000).cast("bigint").alias("bytes"))
    p = r.select(F.col("job").alias("parent"), F.col("event_type").alias("parent_type"))
    kind = F.when(F.col("parent_type") == F.col("event_type"), "own").when(F.col("parent_type").isNull(), "orphan").otherwise("child")
    return r.join(p, "parent", "left").groupBy(kind.alias("class")).agg(F.count("*").alias("jobs"), F.sum("bytes").alias("bytes"))


# Dashboard tables


@query(with_("series") + f", {REAL_SQL}, s as (select a.origin, n.cost - a.cost as saving from annual a join annual n on n.origin = a.origin and n.strategy = 'naive' where a.strategy = 'optimised') select origin, {q('saving', 2)} as saving, saving = max(saving) over () as is_largest from s")
def db_01_savings_concentration(spark, sf):
    a = annual(spark, sf)
    s = a.filter("strategy = 'optimised'").select("origin", "cost").join(a.filter("strategy = 'naive'").select("origin", F.col("cost").alias("base")), "origin").withColumn("s", F.col("base") - F.col("cost"))
    top = s.agg(F.max("s").alias("top"))
    return s.crossJoin(F.broadcast(top)).select("origin", r3("s", 2).alias("saving"), (F.col("s") == F.col("top")).alias("is_largest"))


@query(with_("monthly") + f", {LADDER_SQL}, l as (select market, month, original, lag(original, 12) over (partition by market order by month) as before from ladder) select market, max(month) as month, max_by(original, month) as value, max_by(before, month) as year_before, (select max(month) from ladder x where x.market = l.market and adjusted is not null) as last_adjusted from l group by 1")
def db_02_latest_month(spark, sf):
    w = Window.partitionBy("market").orderBy("month")
    x = bound_ladder(spark, sf).withColumn("before", F.lag("original", 12).over(w))
    return x.groupBy("market").agg(F.max("month").alias("month"), F.max_by("original", "month").alias("value"), F.max_by("before", "month").alias("year_before"), F.max(F.when(F.col("adjusted").isNotNull(), F.col("month"))).alias("last_adjusted"))


@query("with d as (select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-31', interval 1 day))::date as day), r as (select ts::date as day, count(*)::bigint as n, median(value) as mid from events group by 1) select d.day, coalesce(n, 0) as runs, n is null as missing, round(mid::decimal(28,9), 3)::double as mid from d left join r using (day)")
def db_03_run_health(spark, sf):
    days = spark.range(1).select(F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date"), F.expr("interval 1 day"))).alias("day"))
    r = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"), F.median("value").alias("m"))
    return days.join(r, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("runs"), F.col("n").isNull().alias("missing"), r3("m").alias("mid"))


@query("select 'orders' as source, max(o_orderdate)::date as last, datediff('day', max(o_orderdate), timestamp '2001-12-31')::bigint as age from orders union all select 'shipments', max(l_shipdate)::date, datediff('day', max(l_shipdate), timestamp '2001-12-31')::bigint from lineitem")
def db_04_freshness(spark, sf, as_of: str = "2001-12-31"):
    one = lambda t, c, n: table(spark, sf, t).agg(F.max(c).cast("date").alias("last")).select(F.lit(n).alias("source"), "last", F.datediff(F.lit(as_of).cast("date"), "last").cast("bigint").alias("age"))
    return one("orders", "o_orderdate", "orders").union(one("lineitem", "l_shipdate", "shipments"))


@query(with_("series") + f", {REAL_SQL} select origin, max(case when strategy = 'naive' then cost end) as naive, max(case when strategy = 'point' then cost end) as point, max(case when strategy = 'optimised' then cost end) as optimised from annual group by 1")
def db_05_cost_pivot(spark, sf):
    return annual(spark, sf).groupBy("origin").pivot("strategy", ["naive", "point", "optimised"]).agg(F.max("cost"))


@query(with_("series") + f", {SPOT_SQL}, y as (select year(month) as y, avg(price) as p from spot group by 1 having count(*) = 12) select y::int as year, {q('p - lag(p) over (order by y)')} as gap, case when p > lag(p) over (order by y) then 'above' when p < lag(p) over (order by y) then 'below' else 'first' end as reading from y")
def db_06_price_reading(spark, sf):
    y = spot(spark, sf).groupBy(F.year("month").alias("year")).agg(F.avg("price").alias("p"), F.count("*").alias("n")).filter("n = 12")
    before = F.lag("p").over(Window.partitionBy(F.lit(0)).orderBy("year"))
    return y.select("year", r3(F.col("p") - before).alias("gap"), F.when(F.col("p") > before, "above").when(F.col("p") < before, "below").otherwise("first").alias("reading"))


@query(with_("series") + ", d as (select s.month as target, s.value as actual, b.value as model, c.value as comparison from series s join series b on b.mi = s.mi - 12 left join series c on c.mi = s.mi - 24) select target, actual, model, comparison, abs(model - actual) > abs(comparison - actual) as loses from d order by target desc limit 36")
def db_07_forecast_page(spark, sf):
    s = series(spark, sf)
    ago = lambda k, n: s.select((F.col("mi") + k).alias("mi"), F.col("value").alias(n))
    d = s.join(ago(12, "model"), "mi").join(ago(24, "comparison"), "mi", "left").select(F.col("month").alias("target"), F.col("value").alias("actual"), "model", "comparison")
    return d.withColumn("loses", F.abs(F.col("model") - F.col("actual")) > F.abs(F.col("comparison") - F.col("actual"))).orderBy(F.desc("target")).limit(36)


@query(with_("series") + f", {REAL_SQL} select strategy, min(months_outside)::bigint as fewest, max(months_outside)::bigint as most, datediff('day', last_day(max(origin) + interval 12 month), date '2001-11-15')::bigint as days_since from annual group by 1")
def db_08_months_outside(spark, sf, as_of: str = "2001-11-15"):
    return annual(spark, sf).groupBy("strategy").agg(F.min("months_outside").alias("fewest"), F.max("months_outside").alias("most"), F.datediff(F.lit(as_of).cast("date"), F.last_day(F.add_months(F.max("origin"), 12))).cast("bigint").alias("days_since"))


@query(f"with {SPOT_SQL}, {LIMITS_SQL} select month, price, case when month < date '1997-01-01' then 'weekly' else 'hourly' end as source, floor, cap, assumed from spot join bounds on year = year(month)")
def db_09_monthly_price_with_limits(spark, sf):
    s = spot(spark, sf).withColumn("year", F.year("month"))
    return s.join(bounds(spark), "year").select("month", "price", F.when(F.col("month") < F.lit("1997-01-01").cast("date"), "weekly").otherwise("hourly").alias("source"), "floor", "cap", "assumed")


@query(with_("monthly") + f", {LADDER_SQL} select market, max(case when usable then month end) as last_closed, count_if(not usable)::bigint as open_or_incomplete from ladder group by 1")
def db_10_last_closed_month(spark, sf):
    return bound_ladder(spark, sf).groupBy("market").agg(F.max(F.when(F.col("usable"), F.col("month"))).alias("last_closed"), F.count_if(~F.col("usable")).alias("open_or_incomplete"))


@query("with d as (select distinct o_custkey as k from orders where o_orderstatus = 'P'), e as (select distinct o_custkey as k from orders where o_totalprice > 100000) select k from d where k not in (select k from e)")
def db_11_expected_price_coverage(spark, sf):
    o = table(spark, sf, "orders")
    d = o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")).distinct()
    return d.join(o.filter("o_totalprice > 100000").select(F.col("o_custkey").alias("k")), "k", "left_anti")


@query(f"with a as (select event_type as task, sum(case when ts < timestamp '2024-01-16' then value end) as x, sum(case when ts >= timestamp '2024-01-16' then value end) as y from events group by 1) select task, {q('x')} as before, {q('y')} as after, {q('100 * (y / x - 1)', 4)} as change from a")
def db_12_run_comparison(spark, sf):
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    a = table(spark, sf, "events").groupBy(F.col("event_type").alias("task")).agg(F.sum(F.when(F.col("ts") < cut, F.col("value"))).alias("x"), F.sum(F.when(F.col("ts") >= cut, F.col("value"))).alias("y"))
    return a.select("task", r3("x").alias("before"), r3("y").alias("after"), r3(C.percent_change("y", "x"), 4).alias("change"))


@query("select event_id, ('run ' || event_id || ' of ' || event_type || ' failed with value ' || printf('%.2f', value))[1:160] as message from events where value >= 99")
def db_13_failure_messages(spark, sf):
    """What a callback would post for failed runs: cut to 160 characters. Nothing is sent from here."""
    e = table(spark, sf, "events").filter("value >= 99")
    text = F.concat(F.lit("run "), F.col("event_id").cast("string"), F.lit(" of "), F.col("event_type"), F.lit(" failed with value "), F.format_number("value", 2))
    return e.select("event_id", F.substring(text, 1, 160).alias("message"))
