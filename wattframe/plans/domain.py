"""Staging tables, dimensions and facts of the energy domain, bound to the driver's tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import relational as R
from wattframe.plans.aggregates import q, r3
from wattframe.plans.bindings import hourly, monthly, with_, shared
from wattframe.plans.scalars import EASTER_SQL, YEARS_SQL
from wattframe.registry import query
from wattframe.session import table
from wattframe.sources import calendar

Z = C.ZONE


@dataclass(frozen=True)
class Parameters:
    """Dates and constants of the monthly load's definition changes and of the consumer."""

    as_of: str = "2001-08-15"
    api_start: str = "1996-01-01"
    first_break: str = "1998-03-01"
    second_break: str = "1999-05-01"
    rebuilt_from: str = "1995-06-01"
    noise_year: int = 1998
    noise_k: float = 3.0
    noise_months: int = 2
    least_coverage: float = 0.95
    base_share: float = 0.4
    open_business: tuple[int, int] = (7, 22)
    open_sunday: tuple[int, int] = (8, 20)
    consumer_k: float = 0.0032


P = Parameters()


@query(f"""with t as (select o_orderpriority as area, o_orderdate as local, o_totalprice::decimal(18,2)::double as load, o_orderkey as loaded from orders)
select area, strftime(timezone('UTC', timezone('{Z}', local)), '%Y-%m-%d %H:%M') as utc, load from t where timezone('{Z}', timezone('{Z}', local)) = local qualify row_number() over (partition by area, timezone('{Z}', local) order by loaded desc) = 1""")
def dom_01_staged_load(spark, sf):
    """Text to types, local to UTC, skipped hours dropped, the latest load wins."""
    o = table(spark, sf, "orders")
    raw = o.select(F.col("o_orderpriority").alias("area"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("local"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("load"), F.col("o_orderkey").alias("loaded"))
    return staged_load(raw).select("area", F.date_format("utc", "yyyy-MM-dd HH:mm").alias("utc"), "load")


def staged_load(raw: DataFrame) -> DataFrame:
    typed = raw.select("area", C.strict("local", "timestamp_ntz").alias("local"), C.strict("load", "double").alias("load"), "loaded")
    kept = typed.filter(C.local_exists("local")).withColumn("utc", C.to_utc("local"))
    return R.latest_wins(kept, ["area", "utc"], [F.desc("loaded"), F.desc("load")])


@query(f"""with t as (select l_returnflag as market, l_shipdate + l_linenumber * interval 1 hour as local, l_extendedprice::decimal(18,2) as price, l_orderkey as loaded, l_linenumber as n from lineitem)
select market, strftime(timezone('UTC', timezone('{Z}', local)), '%Y-%m-%d %H') as utc, price::double as price from t qualify row_number() over (partition by market, timezone('{Z}', local) order by loaded desc, n desc, price desc) = 1""")
def dom_02_staged_hourly_price(spark, sf):
    li = table(spark, sf, "lineitem")
    part = lambda f: F.date_format("l_shipdate", f)
    t = li.select(F.col("l_returnflag").alias("market"), C.wall_clock(part("yyyy"), part("M"), part("d"), F.col("l_linenumber").cast("string")).alias("local"), F.col("l_extendedprice").cast("decimal(18,2)").cast("decimal(38,9)").alias("price"), F.col("l_orderkey").alias("loaded"), F.col("l_linenumber").alias("n"))
    out = R.latest_wins(t.withColumn("utc", C.to_utc("local")), ["market", "utc"], [F.desc("loaded"), F.desc("n"), F.desc("price")])
    return out.select("market", F.date_format("utc", "yyyy-MM-dd HH").alias("utc"), F.col("price").cast("double").alias("price"))


WEEKS = "w as (select date_trunc('week', o_orderdate) as week, o_orderstatus as kind, round(avg(o_totalprice)::decimal(28,9), 3)::double as price from orders group by 1, 2)"


@shared
def weeks(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.date_trunc("week", "o_orderdate").cast("timestamp_ntz").alias("week"), F.col("o_orderstatus").alias("kind")).agg(r3(F.avg("o_totalprice")).alias("price"))


@query(f"with {WEEKS} select strftime(timezone('UTC', timezone('{Z}', week)), '%Y-%m-%d %H') as utc, price, row_number() over (partition by week order by price desc, kind)::bigint as place from w")
def dom_03_staged_weekly_price(spark, sf):
    """Rows of a week by price; equal rows stay, so nothing is deduplicated."""
    w = Window.partitionBy("week").orderBy(F.desc("price"), "kind")
    return weeks(spark, sf).select(F.date_format(C.to_utc("week"), "yyyy-MM-dd HH").alias("utc"), "price", F.row_number().over(w).cast("bigint").alias("place"))


@query("select strptime(strftime(o_orderdate, '%Y%m'), '%Y%m')::date as month, o_orderpriority as branch, o_totalprice::decimal(18,2)::double as use from orders qualify row_number() over (partition by date_trunc('month', o_orderdate), o_orderpriority order by o_orderkey desc) = 1")
def dom_04_staged_branch_use(spark, sf):
    raw = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("month"), F.col("o_orderpriority").alias("branch"), F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")).alias("use"), "o_orderkey")
    t = raw.select(C.month_from_text("month").alias("month"), "branch", C.comma_decimal("use").alias("use"), "o_orderkey")
    return R.latest_wins(t, ["month", "branch"], [F.desc("o_orderkey")]).drop("o_orderkey")


@query("select o_orderdate::date as day, o_orderpriority as name from orders qualify row_number() over (partition by o_orderdate::date order by o_orderkey desc) = 1")
def dom_05_staged_holidays(spark, sf):
    raw = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("name"), "o_orderkey")
    return R.latest_wins(raw.withColumn("day", C.strict("day", "date")), ["day"], [F.desc("o_orderkey")]).drop("o_orderkey")


@query("select user_id as station, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as utc, value::decimal(18,3)::double as temperature from events qualify row_number() over (partition by user_id, date_trunc('hour', ts) order by ts desc, event_id desc) = 1")
def dom_06_staged_weather(spark, sf):
    raw = table(spark, sf, "events").select(F.col("user_id").alias("station"), F.date_format("ts", "yyyy/MM/dd").alias("day"), F.concat(F.date_format("ts", "HH"), F.lit("00 UTC")).alias("hour"), F.replace(F.col("value").cast("decimal(18,3)").cast("string"), F.lit("."), F.lit(",")).alias("t"), "ts", "event_id")
    t = raw.select("station", C.instant_from_text("day", "hour").alias("utc"), C.comma_decimal("t").alias("temperature"), "ts", "event_id")
    return R.latest_wins(t, ["station", "utc"], [F.desc("ts"), F.desc("event_id")]).select("station", F.date_format("utc", "yyyy-MM-dd HH").alias("utc"), "temperature")


STATES_SQL = f"""o as (select (user_id % 3)::int as state, date_trunc('hour', ts) as utc, {q('avg(value)')} as temperature, count(value)::bigint as stations from events where hour(ts) not in (3, 4) group by 1, 2),
g as (select s.state, h.utc, o.temperature, coalesce(o.stations, 0) as stations from (select distinct state from o) s cross join (select unnest(generate_series(min(utc), max(utc), interval 1 hour)) as utc from o) h left join o on o.state = s.state and o.utc = h.utc),
states as (select state, utc, coalesce(temperature, last) as temperature, temperature is null and last is not null as imputed, stations from (select *, last_value(temperature ignore nulls) over (partition by state order by utc rows between 3 preceding and 1 preceding) as last from g))"""


@shared
def states(spark, sf):
    e = table(spark, sf, "events").filter(~F.hour("ts").isin(3, 4))
    o = e.groupBy((F.col("user_id") % 3).cast("int").alias("state"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("utc")).agg(r3(F.avg("value")).alias("temperature"), F.count("value").alias("stations"))
    g = R.complete_grid(o, "state", "utc", "1 hour").withColumn("stations", F.coalesce("stations", F.lit(0)))
    return R.fill_forward(g, "state", "utc", "temperature", 3)


@query(f"with {STATES_SQL} select state, strftime(utc, '%Y-%m-%d %H') as utc, temperature, imputed, stations from states")
def dom_07_state_temperature(spark, sf):
    return states(spark, sf).select("state", F.date_format("utc", "yyyy-MM-dd HH").alias("utc"), "temperature", "imputed", "stations")


@query(f"with {STATES_SQL} select strftime(utc, '%Y-%m-%d %H') as utc, {q('avg(temperature)')} as temperature, count(temperature)::bigint as states, count_if(imputed)::bigint as imputed from states group by utc")
def dom_08_market_temperature(spark, sf):
    return states(spark, sf).groupBy(F.date_format("utc", "yyyy-MM-dd HH").alias("utc")).agg(r3(F.avg("temperature")).alias("temperature"), F.count("temperature").alias("states"), F.count_if("imputed").alias("imputed"))


HOLIDAY_SQL = f"""{YEARS_SQL}, {EASTER_SQL}, fixed(m, d, name, since) as (values {", ".join(f"({m}, {d}, '{n}', {s})" for m, d, n, s in calendar.FIXED_HOLIDAYS)}),
raw_days as (select make_date(y, m, d) as day, name from years, fixed where y >= since union all select sunday - 2, 'Good Friday' from easter),
holidays as (select day, string_agg(name, '; ' order by name) as name from raw_days group by 1),
regulated as (select day from holidays where name not like '%Black Awareness%' union select day - 45 from holidays where name like '%Good Friday%' union select day + 62 from holidays where name like '%Good Friday%')"""
TIME_SQL = f"""{HOLIDAY_SQL}, h as (select unnest(generate_series(timestamp '2000-01-01', timestamp '2030-12-31 23:00:00', interval 1 hour)) as utc), l as (select utc, timezone('{Z}', timezone('UTC', utc)) as local from h),
j as (select l.*, local::date as day, hour(local) as hour, isodow(local) as weekday, month(local) as month, f.name, r.day is not null as reg from l left join holidays f on f.day = local::date left join regulated r on r.day = local::date),
times as (select utc, local, day, hour::int as hour, datesub('hour', utc, local)::bigint as utc_offset, datesub('hour', utc, local) = -2 as is_dst, year(local)::int as year, month::int as month, day(local)::int as day_of_month, weekday::int as weekday, name is not null as is_holiday,
 case when name is null then 0 else len(string_split(name, '; ')) end::int as n_holidays, coalesce(name, '') as holiday_names, case when name is not null or weekday = 7 then 'sunday_holiday' when weekday = 6 then 'saturday' else 'business' end as day_type,
 case when month in (12, 1, 2) then 'summer' when month in (3, 4, 5) then 'autumn' when month in (6, 7, 8) then 'winter' else 'spring' end as season, reg as is_regulated_holiday, not reg and weekday between 1 and 5 and hour between 18 and 20 as is_peak from j)"""


@query(f"{HOLIDAY_SQL} select day, name from holidays")
def src_08_holidays(spark, sf):
    return calendar.holidays(spark)


@query(f"{HOLIDAY_SQL} select day from regulated")
def dt_20_regulated_holidays(spark, sf):
    return calendar.regulated_holidays(calendar.holidays(spark))


@query(f"{HOLIDAY_SQL}, d as (select unnest(generate_series(timestamp '2000-01-01', timestamp '2030-12-31', interval 1 day))::date as day) select date_trunc('month', d.day)::date as month, count(*)::bigint as days, count_if(isodow(d.day) < 6)::bigint as weekdays, count_if(isodow(d.day) < 6 and r.day is null and h.day is null)::bigint as business_days from d left join holidays h on h.day = d.day left join regulated r on r.day = d.day group by 1")
def dt_19_month_features(spark, sf):
    named = calendar.holidays(spark)
    off = named.select("day").union(calendar.regulated_holidays(named)).distinct().withColumn("off", F.lit(True))
    days = spark.range(1).select(F.explode(F.sequence(F.lit("2000-01-01").cast("date"), F.lit("2030-12-31").cast("date"), F.expr("interval 1 day"))).alias("day"))
    week = C.iso_weekday("day") < 6
    return days.join(off, "day", "left").groupBy(C.month_of("day").alias("month")).agg(F.count("*").alias("days"), F.count_if(week).alias("weekdays"), F.count_if(week & F.col("off").isNull()).alias("business_days"))


@query(f"{TIME_SQL} select * exclude (utc, local), strftime(utc, '%Y-%m-%d %H') as utc, strftime(local, '%Y-%m-%d %H') as local from times")
def dom_09_time_dimension(spark, sf):
    return calendar.time_dimension(spark).withColumns({c: F.date_format(c, "yyyy-MM-dd HH") for c in ("utc", "local")})


@query("select * from (values ('AF', 'AFRICA', 'AFRICA,Africa'), ('AM', 'AMERICA', 'AMERICA,America'), ('AS', 'ASIA', 'ASIA,Asia'), ('EU', 'EUROPE', 'EUROPE,Europe'), ('ME', 'MIDDLE EAST', 'MIDDLE EAST,Middle East')) t(code, name, aliases)")
def dom_10_market_dimension(spark, sf):
    return market_dimension(spark).withColumn("aliases", F.array_join("aliases", ","))


def market_dimension(spark) -> DataFrame:
    """code, name and the names under which sources know a market."""
    rows = [("AF", "AFRICA", "Africa"), ("AM", "AMERICA", "America"), ("AS", "ASIA", "Asia"), ("EU", "EUROPE", "Europe"), ("ME", "MIDDLE EAST", "Middle East")]
    return spark.createDataFrame(rows, "code string, name string, alias string").select("code", "name", F.array("name", "alias").alias("aliases"))


@query(f"""with s as (select o_custkey as station, o_orderdate as t, o_orderkey as k, -20 - (o_orderkey % 50) / 1000.0 as lat, -45 - (o_orderkey % 30) / 1000.0 as lon, o_orderpriority as name from orders),
e as (select station, min_by(lat, (t, k))::double as lat0, min_by(lon, (t, k))::double as lon0, max_by(lat, (t, k))::double as lat1, max_by(lon, (t, k))::double as lon1, max_by(name, (t, k)) as name, count(distinct name)::bigint as names from s group by 1),
d as (select *, round((2 * 6371010.0 * asin(sqrt(least(power(sin(radians(lat1 - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat1)) * power(sin(radians(lon1 - lon0) / 2), 2), 1.0))))::decimal(28,9), 1)::double as moved_m from e)
select station, name, names, lat0, lat1, moved_m, moved_m > 500 as moved from d""")
def dom_11_station_dimension(spark, sf):
    k = F.col("o_orderkey")
    s = table(spark, sf, "orders").select(F.col("o_custkey").alias("station"), F.struct("o_orderdate", "o_orderkey").alias("at"), (-20 - (k % 50) / 1000.0).alias("lat"), (-45 - (k % 30) / 1000.0).alias("lon"), F.col("o_orderpriority").alias("name"))
    ends = R.first_and_last(s, ["station"], "at", ["lat", "lon", "name"])
    names = s.groupBy("station").agg(F.count_distinct("name").alias("names"))
    moved = r3(C.distance_m("first_lat", "first_lon", "last_lat", "last_lon"), 1)
    return ends.join(names, "station").select("station", F.col("last_name").alias("name"), "names", F.col("first_lat").alias("lat0"), F.col("last_lat").alias("lat1"), moved.alias("moved_m"), (moved > 500).alias("moved"))


@query(with_("hourly") + "select market as code, strftime(hour, '%Y-%m-%d %H') as utc, load as load_mw from hourly")
def dom_12_hourly_load_fact(spark, sf):
    return hourly(spark, sf).select(F.col("market").alias("code"), F.date_format("hour", "yyyy-MM-dd HH").alias("utc"), F.col("load").alias("load_mw"))


@query(with_("monthly") + "select r_regionkey as code, month, value as price from monthly left join region on r_name = market")
def dom_13_price_fact(spark, sf):
    m, r = monthly(spark, sf), table(spark, sf, "region")
    return m.join(r, m.market == r.r_name, "left").select(F.col("r_regionkey").alias("code"), "month", F.col("value").alias("price"))


@query("select user_id as station, (user_id % 3)::int as state, strftime(ts, '%Y-%m-%d %H:%M:%S') as at, value as temperature, event_id as id from events")
def dom_14_weather_fact(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("station"), (F.col("user_id") % 3).cast("int").alias("state"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("value").alias("temperature"), F.col("event_id").alias("id"))


@query(f"with d as (select distinct timezone('UTC', timezone('{Z}', date_trunc('week', o_orderdate))) as a from orders), e as (select a, coalesce(lead(a) over (order by a), a + interval 7 day) as b from d) select strftime(a, '%Y-%m-%d %H') as start, strftime(b, '%Y-%m-%d %H') as finish, datesub('hour', a, b)::bigint as hours from e")
def dom_15_weekly_price_fact(spark, sf):
    """Week ends by the next week's start, in UTC, so a week with a clock change has 167 or 169 hours."""
    d = table(spark, sf, "orders").select(C.to_utc(F.date_trunc("week", "o_orderdate")).alias("a")).distinct()
    e = R.interval_end(d, None, "a", F.col("a") + F.expr("interval 7 day"))
    return e.select(F.date_format("a", "yyyy-MM-dd HH").alias("start"), F.date_format("end", "yyyy-MM-dd HH").alias("finish"), C.hours_between("a", "end").alias("hours"))


@query(with_("hourly") + f", a as (select market, hour, load from hourly), b as (select market, hour, load + 1 as price from hourly where hour(hour) % 2 = 0), c as (select m.market, utc as hour, temperature from (select distinct market from hourly) m cross join (select date_trunc('hour', ts) as utc, {q('avg(value)')} as temperature from events where user_id % 3 = 0 group by 1) s) select coalesce(a.market, b.market, c.market) as market, strftime(coalesce(a.hour, b.hour, c.hour), '%Y-%m-%d %H') as utc, load, price, temperature from a full join b on a.market = b.market and a.hour = b.hour full join c on c.market = coalesce(a.market, b.market) and c.hour = coalesce(a.hour, b.hour)")
def dom_16_analysis_base(spark, sf):
    h = hourly(spark, sf)
    b = h.filter("hour(hour) % 2 = 0").select("market", "hour", (F.col("load") + 1).alias("price"))
    t = table(spark, sf, "events").filter("user_id % 3 = 0").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(r3(F.avg("value")).alias("temperature"))
    c = t.crossJoin(h.select("market").distinct())
    return h.join(b, ["market", "hour"], "full").join(c, ["market", "hour"], "full").select("market", F.date_format("hour", "yyyy-MM-dd HH").alias("utc"), "load", "price", "temperature")


# Monthly load with its definition adjusted: an API's net load, distributed generation and an independent monthly series
# are derived from the monthly values, so that every branch of the ladder occurs.

API_SQL = f"""api as (select market, month, round((value * 1.02 + case when month >= date '{P.first_break}' and month < date '1998-05-01' then 900 when month >= date '{P.first_break}' then -value * 0.02 + (month(month) % 5) else 400 end)::decimal(28,9), 3)::double as net, round((value * 0.01)::decimal(28,9), 3)::double as own,
 case when month >= date '{P.second_break}' and month < date '2000-05-01' then 'built_in' when month >= date '1997-01-01' and month < date '{P.second_break}' then 'measured' when month < date '1997-01-01' then 'partly_measured' end as own_status from monthly where month >= date '{P.api_start}' and month < date '2000-05-01')"""


def api(m: DataFrame) -> DataFrame:
    date = lambda x: F.lit(x).cast("date")
    month, value = F.col("month"), F.col("value")
    extra = F.when((month >= date(P.first_break)) & (month < date("1998-05-01")), F.lit(900.0)).when(month >= date(P.first_break), -value * 0.02 + (F.month(month) % 5)).otherwise(400.0)
    status = F.when((month >= date(P.second_break)) & (month < date("2000-05-01")), "built_in").when((month >= date("1997-01-01")) & (month < date(P.second_break)), "measured").when(month < date("1997-01-01"), "partly_measured")
    return m.filter((month >= date(P.api_start)) & (month < date("2000-05-01"))).select("market", "month", r3(value * 1.02 + extra).alias("net"), r3(value * 0.01).alias("own"), status.alias("own_status"))


LADDER_SQL = f"""grid as (select date_trunc('month', day)::date as month, count(distinct datediff('day', date '1970-01-01', day::date))::bigint as expected from (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day)) as day) group by 1),
base as (select market, month, valid from monthly join (select date_trunc('month', o_orderdate)::date as month, count(distinct o_orderdate::date)::bigint as valid from orders group by 1) using (month)),
{API_SQL}, gap as (select market, month, net - value as dif from monthly join api using (market, month)),
noise as (select market, {q(f'{P.noise_k} * stddev_samp(dif)')} as noise_limit from gap where year(month) = {P.noise_year} and month(month) > 5 group by 1),
inside as (select market, month, abs(dif) <= noise_limit as within from gap join noise using (market) where month >= date '{P.first_break}' and month < date '{P.second_break}'),
closed as (select market, min(month) as closed_at from (select market, month, within and coalesce(lead(within, 1) over (partition by market order by month), false) as run from inside) where run group by 1),
factor as (select market, {q('sum(value - net) / nullif(sum(own), 0)', 6)} as factor from monthly join api using (market, month) where own_status = 'built_in' group by 1),
joined as (select m.market, m.month, expected, valid, m.month >= date_trunc('month', date '{P.as_of}')::date as unfinished, valid / expected as coverage, value, noise_limit, coalesce(closed_at, date '{P.second_break}') as closed_at, factor, net, own,
 case when m.month < date '{P.api_start}' then 'not_available' when m.month < date '{P.first_break}' then 'measured' when m.month < coalesce(closed_at, date '{P.second_break}') then 'measured_transition' else 'built_in' end as first_status,
 coalesce(own_status, case when m.month >= date '{P.second_break}' then 'built_in' else 'zero_by_premise' end) as second_status, value * 1.03 as independent
 from monthly m join grid using (month) join base using (market, month) left join api using (market, month) left join noise using (market) left join closed using (market) left join factor using (market)),
adjusted as (select *, case when first_status in ('measured', 'measured_transition') then {q('net - value')} when first_status = 'built_in' then 0.0 end as first_adj, case when second_status in ('measured', 'partly_measured') then {q('factor * own')} else 0.0 end as second_adj, case when second_status in ('measured', 'partly_measured') then {q('own')} else 0.0 end as second_adj_whole,
 case when month >= date '{P.rebuilt_from}' and month < date '{P.api_start}' then 'rebuilt' else first_status end as rebuilt_status from joined),
ladder as (select market, month, expected, valid, unfinished, {q('coverage', 6)} as coverage, coverage >= {P.least_coverage} as covered, not unfinished and coverage >= {P.least_coverage} as usable, value as original, first_adj, first_status, noise_limit, closed_at, second_adj, second_status, factor, {q('value + first_adj + second_adj')} as adjusted, {q('value + first_adj + second_adj_whole')} as adjusted_whole, rebuilt_status,
 case when rebuilt_status = 'rebuilt' then {q('independent - value')} else first_adj end as rebuilt_adj, case when rebuilt_status = 'rebuilt' then {q('independent + second_adj')} else {q('value + first_adj + second_adj')} end as rebuilt from adjusted)"""


def ladder(m: DataFrame, valid: DataFrame, expected: DataFrame, api: DataFrame, independent: DataFrame, p: Parameters = P) -> DataFrame:
    """Monthly load with two definition changes adjusted.

    m: market, month, value; valid: market, month, valid; expected: month, expected; api: market, month, net, own,
    own_status; independent: market, month, independent.
    """
    date = lambda x: F.lit(x).cast("date")
    month = F.col("month")
    met = m.select("market", "month", "value").join(api, ["market", "month"])
    gap = met.select("market", "month", (F.col("net") - F.col("value")).alias("dif"))
    noise = gap.filter((F.year("month") == p.noise_year) & (F.month("month") > 5)).groupBy("market").agg(r3(p.noise_k * F.stddev_samp("dif")).alias("noise_limit"))
    window = gap.join(noise, "market").filter((month >= date(p.first_break)) & (month < date(p.second_break))).withColumn("within", F.abs("dif") <= F.col("noise_limit"))
    closed = R.closing_run(window, "market", "month", "within", p.noise_months)
    factor = met.filter("own_status = 'built_in'").groupBy("market").agg(r3(C.ratio(F.sum(F.col("value") - F.col("net")), F.sum("own")), 6).alias("factor"))
    joined = m.select("market", "month", "value").join(expected, "month").join(valid, ["market", "month"])
    joined = joined.join(api, ["market", "month"], "left").join(independent, ["market", "month"], "left").join(factor, "market", "left").join(noise, "market", "left").join(closed, "market", "left")
    end = F.coalesce("closed_at", date(p.second_break))
    first = F.when(month < date(p.api_start), "not_available").when(month < date(p.first_break), "measured").when(month < end, "measured_transition").otherwise("built_in")
    second = F.coalesce("own_status", F.when(month >= date(p.second_break), "built_in").otherwise("zero_by_premise"))
    joined = joined.withColumns({"closed_at": end, "first_status": first, "second_status": second, "unfinished": month >= F.trunc(date(p.as_of), "month"), "cover": C.ratio("valid", "expected")})
    measured = F.col("second_status").isin("measured", "partly_measured")
    adjusted = joined.withColumns({
        "first_adj": F.when(F.col("first_status").isin("measured", "measured_transition"), r3(F.col("net") - F.col("value"))).when(F.col("first_status") == "built_in", 0.0),
        "second_adj": F.when(measured, r3(F.col("factor") * F.col("own"))).otherwise(0.0), "second_adj_whole": F.when(measured, r3("own")).otherwise(0.0),
        "rebuilt_status": F.when((month >= date(p.rebuilt_from)) & (month < date(p.api_start)), "rebuilt").otherwise(F.col("first_status")),
    })
    whole = r3(F.col("value") + F.col("first_adj") + F.col("second_adj"))
    rebuilt = F.col("rebuilt_status") == "rebuilt"
    return adjusted.select(
        "market", "month", "expected", "valid", "unfinished", r3("cover", 6).alias("coverage"), (F.col("cover") >= p.least_coverage).alias("covered"), (~F.col("unfinished") & (F.col("cover") >= p.least_coverage)).alias("usable"),
        F.col("value").alias("original"), "first_adj", "first_status", "noise_limit", "closed_at", "second_adj", "second_status", "factor", whole.alias("adjusted"), r3(F.col("value") + F.col("first_adj") + F.col("second_adj_whole")).alias("adjusted_whole"), "rebuilt_status",
        F.when(rebuilt, r3(F.col("independent") - F.col("value"))).otherwise(F.col("first_adj")).alias("rebuilt_adj"), F.when(rebuilt, r3(F.col("independent") + F.col("second_adj"))).otherwise(whole).alias("rebuilt"),
    )


@shared
def bound_ladder(spark, sf) -> DataFrame:
    m = monthly(spark, sf)
    valid = table(spark, sf, "orders").groupBy(C.month_of("o_orderdate").alias("month")).agg(F.count_distinct(F.col("o_orderdate").cast("date")).alias("valid")).join(m.select("market", "month"), "month")
    days = spark.range(1).select(F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("2001-12-31").cast("date"), F.expr("interval 1 day"))).alias("day"))
    expected = days.groupBy(C.month_of("day").alias("month")).agg(F.count_distinct(F.unix_date("day")).alias("expected"))
    return ladder(m, valid, expected, api(m), m.select("market", "month", (F.col("value") * 1.03).alias("independent")))


@query(with_("monthly") + f", {LADDER_SQL} select * from ladder")
def dom_17_monthly_load_ladder(spark, sf):
    return bound_ladder(spark, sf)


CONSUMPTION_SQL = f"""base as (select hour, load, timezone('{Z}', timezone('UTC', hour)) as local from hourly where market = (select min(event_type) from events)),
days as (select local::date as day, {q('avg(load)')} as mean, count(*)::bigint as n from base group by 1 having count(*) >= 21 and count(load) = count(*)),
prof as (select b.*, b.local::date as day, d.mean, isodow(b.local) = 7 as sunday, hour(b.local) as h from base b join days d on d.day = b.local::date),
shop as (select *, case when sunday then {P.open_sunday[1] - P.open_sunday[0]} else {P.open_business[1] - P.open_business[0]} end as hours_open, case when sunday then h >= {P.open_sunday[0]} and h < {P.open_sunday[1]} else h >= {P.open_business[0]} and h < {P.open_business[1]} end as is_open from prof),
consumption as (select hour, day, mean, is_open, {q(f'case when is_open then {P.base_share} + (1 - {P.base_share}) * 24 / hours_open else {P.base_share} end', 6)} as profile, {q(f'{P.consumer_k} * mean * (case when is_open then {P.base_share} + (1 - {P.base_share}) * 24 / hours_open else {P.base_share} end)', 6)} as mwh from shop)"""


@shared
def consumption(spark, sf, p: Parameters = P) -> DataFrame:
    """Hourly use of a consumer: k times the local day's mean load times a profile of opening hours.

    The driver's events leave gaps in every day, so here a day counts from 21 hours on; with real data it is 24.
    """
    h = hourly(spark, sf)
    one = h.agg(F.min("market").alias("market"))
    base = h.join(F.broadcast(one), "market").withColumn("local", C.to_local("hour")).withColumn("day", F.col("local").cast("date"))
    days = base.groupBy("day").agg(r3(F.avg("load")).alias("mean"), F.count("*").alias("n"), F.count("load").alias("m")).filter("n >= 21 and m = n").select("day", "mean")
    sunday, clock = C.iso_weekday("day") == 7, F.hour("local")
    within = lambda span: (clock >= span[0]) & (clock < span[1])
    length = F.when(sunday, p.open_sunday[1] - p.open_sunday[0]).otherwise(p.open_business[1] - p.open_business[0])
    is_open = F.when(sunday, within(p.open_sunday)).otherwise(within(p.open_business))
    profile = F.when(F.col("is_open"), p.base_share + (1 - p.base_share) * 24 / F.col("length")).otherwise(p.base_share)
    out = base.join(days, "day").withColumns({"is_open": is_open, "length": length})
    return out.select("hour", "day", "mean", "is_open", r3(profile, 6).alias("profile"), r3(p.consumer_k * F.col("mean") * profile, 6).alias("mwh"))


@query(with_("hourly") + f", {CONSUMPTION_SQL} select strftime(hour, '%Y-%m-%d %H') as utc, day, mean, is_open, profile, mwh from consumption")
def dom_18_consumption(spark, sf):
    return consumption(spark, sf).select(F.date_format("hour", "yyyy-MM-dd HH").alias("utc"), "day", "mean", "is_open", "profile", "mwh")


@query(f"""with o as (select o_orderkey, o_orderdate as local from orders where timezone('{Z}', timezone('{Z}', o_orderdate)) = o_orderdate), g as (select date_trunc('month', d)::date as month, count(*)::bigint as days from (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day)) as d) group by 1)
select date_trunc('month', local)::date as month, count(distinct local::date)::bigint as days, any_value(g.days) as expected, count(distinct local::date) = any_value(g.days) as complete, sum(l_quantity)::double as quantity, {q('avg(l_extendedprice / l_quantity)')} as simple, {q('sum(l_extendedprice) / sum(l_quantity)')} as weighted, {q('sum(l_extendedprice) / sum(l_quantity) / avg(l_extendedprice / l_quantity)', 6)} as ratio
from o join lineitem on l_orderkey = o_orderkey join g on g.month = date_trunc('month', local)::date group by 1""")
def dom_19_weighted_price(spark, sf):
    """Consumption-weighted monthly price: skipped local hours dropped, local months, coverage, weighted and simple means."""
    o = table(spark, sf, "orders").filter(C.local_exists("o_orderdate")).select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    o = o.withColumn("month", C.month_of("day"))
    days = spark.range(1).select(F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("2001-12-31").cast("date"), F.expr("interval 1 day"))).alias("d"))
    grid = days.groupBy(C.month_of("d").alias("month")).agg(F.count("*").alias("expected"))
    li = table(spark, sf, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    weighted = F.sum("l_extendedprice") / F.sum("l_quantity")
    m = li.join(o, li.l_orderkey == o.o_orderkey).groupBy("month").agg(F.count_distinct("day").alias("days"), F.sum("l_quantity").alias("quantity"), r3(F.avg(price)).alias("simple"), r3(weighted).alias("weighted"), r3(weighted / F.avg(price), 6).alias("ratio"))
    return m.join(grid, "month").select("month", "days", "expected", (F.col("days") == F.col("expected")).alias("complete"), "quantity", "simple", "weighted", "ratio")


@query(with_("monthly") + f", {LADDER_SQL} select market, month, original, adjusted from ladder where usable and adjusted is not null")
def flt_11_usable_months(spark, sf):
    return bound_ladder(spark, sf).filter("usable and adjusted is not null").select("market", "month", "original", "adjusted")


@query(with_("monthly") + f"select o.month as origin, m.market, count(*)::bigint as known, {q('max(m.value)')} as top from monthly m join (select distinct month from monthly where month(month) = 12) o on m.month <= o.month group by 1, 2")
def flt_12_known_at_origin(spark, sf):
    m = monthly(spark, sf)
    origins = m.filter("month(month) = 12").select("market", F.col("month").alias("origin")).distinct()
    every = origins.select("origin").distinct().crossJoin(m.select("market").distinct())
    return R.known_at(m, every, "month", keys=["market"]).groupBy("origin", "market").agg(F.count("*").alias("known"), r3(F.max("value")).alias("top"))
