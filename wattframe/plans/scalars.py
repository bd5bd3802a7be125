"""Projections, filters and scalar functions as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators.relational import latest_wins
from wattframe.plans.bindings import clock_text
from wattframe.registry import query
from wattframe.session import table

Z = C.ZONE


@query("select o_orderkey as order_id, o_totalprice as total from orders")
def prj_01_rename(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total"))


@query("select r_regionkey, r_name, r_regionkey * 10 as code from region")
def prj_02_derived_column(spark, sf):
    return table(spark, sf, "region").withColumn("code", F.col("r_regionkey") * 10)


@query("select o_orderkey, nullif(case when o_orderkey % 7 = 0 then '' else o_orderkey::varchar end, '')::bigint as n from orders")
def prj_03_blank_to_null_strict_cast(spark, sf):
    text = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_orderkey").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", C.strict(text, "bigint").alias("n"))


@query("select o_orderkey, o_totalprice::decimal(18,2)::double as price from orders")
def prj_04_comma_decimal(spark, sf):
    text = F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    return table(spark, sf, "orders").select("o_orderkey", C.comma_decimal(text).alias("price"))


@query("select o_orderkey, try_cast(o_orderpriority[1:1] as int) as level, try_cast(o_orderpriority as int) as none from orders")
def prj_05_lenient_cast(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.lenient(F.substring("o_orderpriority", 1, 1), "int").alias("level"), C.lenient("o_orderpriority", "int").alias("none"))


@query("select o_orderkey, strftime(o_orderdate + interval 5 hour, '%Y-%m-%d %H:%M:%S') as at from orders")
def prj_06_text_to_wall_clock(spark, sf):
    d = F.col("o_orderdate")
    part = lambda f: F.date_format(d, f)
    return table(spark, sf, "orders").select("o_orderkey", clock_text(C.wall_clock(part("yyyy"), part("M"), part("dd"), F.lit("05"))).alias("at"))


@query("select o_orderkey, case when o_totalprice > 200000 then 'high' when o_totalprice > 50000 then 'mid' end as band, case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as code, case when o_totalprice > 1000 then 'y' else 'n' end as flag from orders")
def prj_07_conditional_column(spark, sf):
    p, s = F.col("o_totalprice"), F.col("o_orderstatus")
    return table(spark, sf, "orders").select("o_orderkey", F.when(p > 200000, "high").when(p > 50000, "mid").alias("band"), F.when(s == "F", 1).when(s == "O", 2).otherwise(3).alias("code"), F.when(p > 1000, "y").otherwise("n").alias("flag"))


@query("select o_orderkey, coalesce(case when o_orderkey % 3 = 0 then o_totalprice end, 0.0) as v from orders")
def prj_08_coalesce(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")), F.lit(0.0)).alias("v"))


@query("select event_id, value > 50 and event_type <> 'view' as a, (case when event_id % 2 = 0 then value end) is null and value is not null as b from events")
def prj_09_boolean_columns(spark, sf):
    odd = F.when(F.col("event_id") % 2 == 0, F.col("value"))
    return table(spark, sf, "events").select("event_id", ((F.col("value") > 50) & (F.col("event_type") != "view")).alias("a"), (odd.isNull() & F.col("value").isNotNull()).alias("b"))


@query("select o_orderkey from orders where o_orderdate between timestamp '1996-01-01' and timestamp '1996-12-31' and o_totalprice > 100")
def flt_01_range(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")) & (F.col("o_totalprice") > 100)).select("o_orderkey")


@query("select p_partkey from part where p_type like '%A%' and p_name not like '%z%'")
def flt_02_like(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_type").like("%A%") & ~F.col("p_name").like("%z%")).select("p_partkey")


@query("select o_orderkey from orders where o_orderstatus in ('F', 'P') and o_orderpriority not in ('1-URGENT')")
def flt_03_in_list(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("1-URGENT")).select("o_orderkey")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_custkey is not null and o_totalprice > 400000)")
def flt_04_not_in_subquery(spark, sf):
    o = table(spark, sf, "orders").filter("o_custkey is not null and o_totalprice > 400000")
    c = table(spark, sf, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("select n_name from nation where not list_contains(['BRAZIL', 'FRANCE', 'NATION_1'], n_name)")
def flt_05_not_in_array(spark, sf):
    return table(spark, sf, "nation").filter(~F.array_contains(F.array(F.lit("BRAZIL"), F.lit("FRANCE"), F.lit("NATION_1")), F.col("n_name"))).select("n_name")


@query("select event_id from events where (case when event_id % 2 = 0 then event_type end) is distinct from event_type")
def flt_06_null_predicates(spark, sf):
    half = F.when(F.col("event_id") % 2 == 0, F.col("event_type"))
    return table(spark, sf, "events").filter(~half.eqNullSafe(F.col("event_type"))).select("event_id")


@query("select o_custkey, count(*)::bigint as n from orders group by 1 having count(*) > 12 and count(o_orderstatus) > 12")
def flt_07_having(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count("o_orderstatus").alias("m")).filter("n > 12 and m > 12").select("o_custkey", "n")


@query("select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1")
def flt_08_qualify(spark, sf):
    return latest_wins(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(f"select o_orderkey from orders where timezone('{Z}', timezone('{Z}', o_orderdate)) = o_orderdate")
def flt_09_existing_local_hours(spark, sf):
    return table(spark, sf, "orders").filter(C.local_exists("o_orderdate")).select("o_orderkey")


@query("select l_orderkey, l_linenumber from lineitem where abs(l_extendedprice - l_quantity * 1000) > 500.25")
def flt_10_tolerance(spark, sf):
    return table(spark, sf, "lineitem").filter(F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1000) > 500.25).select("l_orderkey", "l_linenumber")


@query("select user_id, count(*)::bigint as n from events where props is not null and value is not null group by 1")
def flt_13_drop_nulls(spark, sf):
    return table(spark, sf, "events").dropna(subset=["props", "value"]).groupBy("user_id").agg(F.count("*").alias("n"))


def _dates(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("d"))


@query("select o_orderkey, strptime(strftime(o_orderdate, '%Y%m'), '%Y%m')::date as month from orders")
def dt_01_parse_month(spark, sf):
    return _dates(spark, sf).select("o_orderkey", C.month_from_text(F.date_format("d", "yyyyMM")).alias("month"))


@query("select o_orderkey, strftime(o_orderdate + interval 3 hour, '%Y-%m-%d %H:%M:%S') as at from orders")
def dt_02_parse_instant(spark, sf):
    return _dates(spark, sf).select("o_orderkey", clock_text(C.instant_from_text(F.date_format("d", "yyyy/MM/dd"), F.lit("0300 UTC"))).alias("at"))


@query("select o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) as first, strftime(make_timestamp(year(o_orderdate), month(o_orderdate), 2, 7, 0, 0), '%Y-%m-%d %H:%M:%S') as at from orders")
def dt_03_constructors(spark, sf):
    y, m = F.year("d"), F.month("d")
    return _dates(spark, sf).select("o_orderkey", F.make_date(y, m, F.lit(1)).alias("first"), clock_text(C.wall_clock(y, m, F.lit(2), F.lit(7))).alias("at"))


@query(f"select o_orderkey, strftime(timezone('UTC', timezone('{Z}', o_orderdate)), '%Y-%m-%d %H:%M:%S') as utc from orders")
def dt_04_local_to_utc(spark, sf):
    return _dates(spark, sf).select("o_orderkey", clock_text(C.to_utc("d")).alias("utc"))


@query(f"select event_id, strftime(timezone('{Z}', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S') as local, timezone('{Z}', timezone('UTC', ts))::date as day from events")
def dt_05_utc_to_local(spark, sf):
    return table(spark, sf, "events").select("event_id", clock_text(C.to_local("ts")).alias("local"), C.to_local("ts").cast("date").alias("day"))


@query("select o_orderkey, date_trunc('month', o_orderdate)::date as month from orders")
def dt_06_truncate_month(spark, sf):
    return _dates(spark, sf).select("o_orderkey", C.month_of("d").alias("month"))


@query("select event_id, year(ts)::bigint as y, month(ts)::bigint as m, day(ts)::bigint as d, hour(ts)::bigint as h, dayofweek(ts)::bigint + 1 as w from events")
def dt_07_extract(spark, sf):
    f = {"y": F.year, "m": F.month, "d": F.day, "h": F.hour, "w": F.dayofweek}
    return table(spark, sf, "events").select("event_id", *[g("ts").cast("bigint").alias(k) for k, g in f.items()])


@query("select o_orderkey, isodow(o_orderdate)::bigint as weekday from orders")
def dt_08_iso_weekday(spark, sf):
    return _dates(spark, sf).select("o_orderkey", C.iso_weekday("d").cast("bigint").alias("weekday"))


@query(f"select o_orderkey, datesub('hour', o_orderdate, timezone('{Z}', timezone('UTC', o_orderdate)))::bigint as hours from orders")
def dt_09_utc_offset(spark, sf):
    return _dates(spark, sf).select("o_orderkey", C.utc_offset_hours("d").alias("hours"))


@query("select l_orderkey, l_linenumber, datesub('hour', o_orderdate, l_shipdate)::bigint as hours from lineitem join orders on l_orderkey = o_orderkey")
def dt_10_hours_between(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", C.hours_between("o_orderdate", "l_shipdate").alias("hours"))


@query("select o_orderkey, datediff('month', timestamp '1995-03-15', o_orderdate)::bigint as months, datediff('day', timestamp '1995-03-15', o_orderdate)::bigint as days from orders")
def dt_11_boundaries_between(spark, sf):
    base = F.lit("1995-03-15").cast("date")
    return _dates(spark, sf).select("o_orderkey", (C.month_index("d") - C.month_index(base)).cast("bigint").alias("months"), F.datediff("d", base).cast("bigint").alias("days"))


@query("select o_orderkey, strftime(o_orderdate + interval 7 day, '%Y-%m-%d %H:%M:%S') as week, o_orderdate::date - 45 as before, o_orderdate::date + 62 as after from orders")
def dt_12_add_days(spark, sf):
    return _dates(spark, sf).select("o_orderkey", clock_text(F.col("d") + F.expr("interval 7 day")).alias("week"), F.date_sub("d", 45).alias("before"), F.date_add("d", 62).alias("after"))


@query("select o_orderkey, datediff('day', date '1970-01-01', o_orderdate::date)::bigint as days from orders")
def dt_13_unix_day(spark, sf):
    return _dates(spark, sf).select("o_orderkey", F.unix_date(F.col("d").cast("date")).cast("bigint").alias("days"))


@query("select o_orderkey, last_day(o_orderdate) as last, (day(last_day(o_orderdate)) * 24)::bigint as hours from orders")
def dt_14_hours_in_month(spark, sf):
    return _dates(spark, sf).select("o_orderkey", F.last_day("d").alias("last"), C.hours_in_month("d").cast("bigint").alias("hours"))


@query("select month, month >= date '2001-05-01' as current_or_later from (select distinct date_trunc('month', o_orderdate)::date as month from orders)")
def dt_15_as_of(spark, sf, as_of: str = "2001-05-17"):
    """The clock is a parameter: transformations never read it."""
    return _dates(spark, sf).select(C.month_of("d").alias("month")).distinct().withColumn("current_or_later", F.col("month") >= F.trunc(F.lit(as_of).cast("date"), "month"))


@query("select month, (month - interval 1 month)::date as before, (month + interval 11 month)::date as after, len(generate_series(month, month + interval 11 month, interval 1 month))::bigint as n from (select distinct date_trunc('month', o_orderdate)::date as month from orders)")
def dt_16_month_arithmetic(spark, sf):
    m = _dates(spark, sf).select(C.month_of("d").alias("month")).distinct()
    return m.select("month", F.add_months("month", -1).alias("before"), F.add_months("month", 11).alias("after"), F.size(F.sequence("month", F.add_months("month", 11), F.expr("interval 1 month"))).cast("bigint").alias("n"))


@query("select event_id, strftime(ts, '%Y-%m') as month, floor(epoch(ts))::bigint as seconds from events")
def dt_17_format_time(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM").alias("month"), F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("seconds"))


#: Easter in SQL by the same computus, over a column y.
EASTER_SQL = """
e1 as (select y, y % 19 as g, y // 100 as c from years),
e2 as (select *, c - c // 4 - (8 * c + 13) // 25 as l from e1),
e3 as (select *, (l + 19 * g + 15) % 30 as p from e2),
e4 as (select *, p - (p // 28) * (1 - (p // 28) * (29 // (p + 1)) * ((21 - g) // 11)) as i from e3),
e5 as (select *, i - (y + y // 4 + i + 2 - c + c // 4) % 7 as s from e4),
e6 as (select *, 3 + (s + 40) // 44 as m from e5),
easter as (select y, make_date(y, m, s + 28 - 31 * (m // 4)) as sunday from e6)"""
YEARS_SQL = "with years as (select unnest(range(2000, 2031)) as y)"


def years(spark, first: int = 2000, last: int = 2030):
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("y"))


@query(f"{YEARS_SQL}, {EASTER_SQL} select y::int as year, sunday, sunday - 48 as carnival_monday, sunday - 47 as carnival_tuesday, sunday + 60 as corpus_christi from easter")
def dt_18_easter(spark, sf):
    e = C.easter("y")
    return years(spark).select(F.col("y").alias("year"), e.alias("sunday"), F.date_sub(e, 48).alias("carnival_monday"), F.date_sub(e, 47).alias("carnival_tuesday"), F.date_add(e, 60).alias("corpus_christi"))


@query("select n_nationkey, n_name[1:3] || '-' || lpad(n_nationkey::varchar, 3, '0') as code, replace(n_name, '_', ' ') as words, nullif(n_name, 'BRAZIL') as other, len(string_split(n_name, '_'))::bigint as parts from nation")
def str_01_text(spark, sf):
    n = F.col("n_name")
    return table(spark, sf, "nation").select("n_nationkey", F.concat(F.substring(n, 1, 3), F.lit("-"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("code"), F.replace(n, F.lit("_"), F.lit(" ")).alias("words"), F.nullif(n, F.lit("BRAZIL")).alias("other"), F.size(F.split(n, "_")).cast("bigint").alias("parts"))


@query("select o_orderpriority, regexp_full_match(o_orderpriority, '[0-9]-[A-Z ]+') as ok from (select distinct o_orderpriority from orders)")
def str_02_full_match(spark, sf):
    return table(spark, sf, "orders").select("o_orderpriority").distinct().withColumn("ok", F.rlike("o_orderpriority", F.lit(r"^(?:[0-9]-[A-Z ]+)$")))


@query("select c_custkey, regexp_replace(c_name, '[0-9]', '9', 'g') as mask, split_part(c_name, '#', 2) as number from customer")
def str_03_mask_and_parts(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", C.digit_mask("c_name").alias("mask"), F.split_part("c_name", F.lit("#"), F.lit(2)).alias("number"))


@query("select o_orderkey, translate(format('{:,.2f}', o_totalprice::decimal(18,2)::double), ',.', '.,') as text from orders")
def str_04_local_number(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.local_number(F.col("o_totalprice").cast("decimal(18,2)")).alias("text"))


@query("select l_orderkey, l_linenumber, round((l_extendedprice * l_discount)::decimal(28,9), 2)::double as v from lineitem")
def num_01_round(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", C.stable_round(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("v"))


@query("select l_orderkey, l_linenumber, abs(l_quantity - 25) as a, power(l_linenumber, 2)::double as p, l_orderkey % 7 as m, greatest(l_quantity, 30.0) as g, case when l_linenumber = 1 then null else least(l_quantity, 20.0) end as s from lineitem")
def num_02_arithmetic(spark, sf):
    some = F.when(F.col("l_linenumber") != 1, F.lit(20.0))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.abs(F.col("l_quantity") - 25).alias("a"), F.pow("l_linenumber", F.lit(2)).alias("p"), (F.col("l_orderkey") % 7).alias("m"), F.greatest("l_quantity", F.lit(30.0)).alias("g"), C.strict_least("l_quantity", some).alias("s"))


@query("select event_id, case when event_id % 5 = 0 then null else round((value / (event_id % 5))::decimal(28,9), 6)::double end as v from events")
def num_03_safe_divide(spark, sf):
    return table(spark, sf, "events").select("event_id", C.stable_round(C.ratio("value", F.col("event_id") % 5), 6).alias("v"))


@query("select o_orderkey, round(ln(o_totalprice)::decimal(28,9), 6)::double as l, round(exp(o_orderkey % 5)::decimal(28,9), 6)::double as e, round(sqrt(o_totalprice)::decimal(28,9), 6)::double as s, least(greatest(o_totalprice, 1000.0), 200000.0) as c from orders")
def num_04_logs_and_clip(spark, sf):
    p = F.col("o_totalprice")
    return table(spark, sf, "orders").select("o_orderkey", C.stable_round(F.ln(p), 6).alias("l"), C.stable_round(F.exp(F.col("o_orderkey") % 5), 6).alias("e"), C.stable_round(F.sqrt(p), 6).alias("s"), C.clip(p, F.lit(1000.0), F.lit(200000.0)).alias("c"))


@query("select event_id, case when event_id % 4 = 0 then null else round((100 * (value / (event_id % 4) - 1))::decimal(28,9), 6)::double end as v, event_id % 4 = 0 as undefined from events")
def num_05_percent_change(spark, sf):
    change = C.percent_change("value", (F.col("event_id") % 4).cast("double"))
    return table(spark, sf, "events").select("event_id", C.stable_round(F.nanvl(change, F.lit(None).cast("double")), 6).alias("v"), F.isnan(change).alias("undefined"))


@query("select n_nationkey, len([n_name, 'X'])::bigint as n, list_contains(['NATION_1', 'BRAZIL'], n_name) as has, len(coalesce(case when n_nationkey > 5 then [n_name] end, []))::bigint as some from nation")
def arr_01_arrays(spark, sf):
    some = F.coalesce(F.when(F.col("n_nationkey") > 5, F.array("n_name")), F.array().cast("array<string>"))
    return table(spark, sf, "nation").select("n_nationkey", F.size(F.array("n_name", F.lit("X"))).cast("bigint").alias("n"), F.array_contains(F.array(F.lit("NATION_1"), F.lit("BRAZIL")), F.col("n_name")).alias("has"), F.size(some).cast("bigint").alias("some"))


@query("select n_nationkey, unnest(string_split(n_name, '_')) as part from nation")
def arr_02_unnest(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", F.explode(F.split("n_name", "_")).alias("part"))


@query("with p as (select n_nationkey, n_nationkey - 12.5 as lat, n_nationkey * 2 - 60.25 as lon from nation) select n_nationkey, round((2 * 6371010.0 * asin(sqrt(least(power(sin(radians(lat + 0.05 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(lat + 0.05)) * power(sin(radians(0.07) / 2), 2), 1.0))))::decimal(28,9), 1)::double as metres from p")
def geo_01_distance(spark, sf):
    p = table(spark, sf, "nation").select("n_nationkey", (F.col("n_nationkey") - 12.5).alias("lat"), (F.col("n_nationkey") * 2 - 60.25).alias("lon"))
    return p.select("n_nationkey", C.stable_round(C.distance_m("lat", "lon", F.col("lat") + 0.05, F.col("lon") + 0.07), 1).alias("metres"))


@query("select event_id, (props->>'$.k')::bigint as k, '{\"event\":' || event_id || ',\"k\":' || (props->>'$.k') || '}' as json from events")
def jsn_01_json(spark, sf):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").select("event_id", k.alias("k"), F.to_json(F.struct(F.col("event_id").alias("event"), k.alias("k"))).alias("json"))


@query("select n_nationkey, sha256(n_name || '|' || n_nationkey)[1:12] as id, md5(n_name) as m from nation")
def hsh_01_ids(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", C.short_id("n_name", F.col("n_nationkey").cast("string")).alias("id"), F.md5("n_name").alias("m"))


@query("select o_orderkey, concat('0x', sha256('7:' || o_orderkey)[1:15])::bigint % 80 as draw from orders")
def rng_01_derived_draws(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.drawn_index(F.concat(F.lit("7:"), F.col("o_orderkey").cast("string")), 80).alias("draw"))
