"""Aggregations as queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import relational as R
from wattframe.operators import stats as S
from wattframe.plans.bindings import hourly, monthly, prices, regional_orders, series, with_
from wattframe.registry import query
from wattframe.session import table


def r3(c, places=3):
    return C.stable_round(c, places)


def q(text: str, places: int = 3) -> str:
    return f"round(({text})::decimal(28,9), {places})::double"


@query(f"select l_returnflag, count(*)::bigint as n, count(l_quantity)::bigint as m, min(l_quantity) as low, max(l_quantity) as high, sum(l_quantity)::double as total, {q('avg(l_extendedprice)')} as mean from lineitem group by 1")
def agg_01_by_keys(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count("l_quantity").alias("m"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.sum("l_quantity").alias("total"), r3(F.avg("l_extendedprice")).alias("mean"))


@query("select count(*)::bigint as n, min(o_orderdate)::date as first, max(o_orderdate)::date as last from orders")
def agg_02_global(spark, sf):
    return table(spark, sf, "orders").agg(F.count("*").alias("n"), F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last"))


@query("select event_type, count_if(value > 50)::bigint as high from events group by 1")
def agg_03_count_if(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("high"))


@query("select event_type, count(distinct user_id)::bigint as users, count(distinct datediff('day', date '1970-01-01', ts::date) * 24 + hour(ts))::bigint as hours from events group by 1")
def agg_04_count_distinct(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct(F.unix_date(F.col("ts").cast("date")) * 24 + F.hour("ts")).alias("hours"))


@query("select event_type, count(distinct case when value > 50 then user_id end)::bigint as users from events group by 1")
def agg_05_conditional_distinct(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count_distinct(F.when(F.col("value") > 50, F.col("user_id"))).alias("users"))


@query("select distinct o_orderstatus, o_orderpriority from orders")
def agg_06_distinct(spark, sf):
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(with_("monthly") + f"select market, {q('3 * stddev_samp(value)')} as threshold from monthly where year(month) = 1997 group by 1")
def agg_07_noise_threshold(spark, sf):
    return monthly(spark, sf).filter("year(month) = 1997").groupBy("market").agg(r3(3 * F.stddev_samp("value")).alias("threshold"))


@query(f"select l_returnflag, {q('sum(l_extendedprice * l_discount) / nullif(sum(l_extendedprice), 0)', 6)} as share, sum(l_quantity) / nullif(sum(case when l_quantity < 0 then 1 end), 0) as none from lineitem group by 1")
def agg_08_ratio_of_sums(spark, sf):
    p, d = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(r3(C.ratio(F.sum(p * d), F.sum(p)), 6).alias("share"), C.ratio(F.sum("l_quantity"), F.sum(F.when(F.col("l_quantity") < 0, 1))).alias("none"))


@query(with_("prices") + f"select month, {q('sum(quantity * price) / sum(quantity)')} as weighted, {q('avg(price)')} as simple, {q('sum(quantity * price) / sum(quantity) / avg(price)', 6)} as ratio from prices group by 1")
def agg_09_weighted_mean(spark, sf):
    w = F.sum(F.col("quantity") * F.col("price")) / F.sum("quantity")
    return prices(spark, sf).groupBy("month").agg(r3(w).alias("weighted"), r3(F.avg("price")).alias("simple"), r3(w / F.avg("price"), 6).alias("ratio"))


@query("select o_custkey, bool_and(o_totalprice > 10000) as all_large from orders group by 1")
def agg_10_every(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.bool_and(F.col("o_totalprice") > 10000).alias("all_large"))


@query("select o_custkey, any_value(c_name) as name, count(*)::bigint as n from orders join customer on c_custkey = o_custkey group by 1")
def agg_11_any_value(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy("o_custkey").agg(F.any_value("c_name").alias("name"), F.count("*").alias("n"))


@query(with_("monthly") + "select market, max(case when month = date '1996-01-01' then value end) as jan96, max(case when month = date '1997-01-01' then value end) as jan97 from monthly group by 1")
def agg_12_conditional_pivot(spark, sf):
    at = lambda d: F.max(F.when(F.col("month") == F.lit(d).cast("date"), F.col("value")))
    return monthly(spark, sf).groupBy("market").agg(at("1996-01-01").alias("jan96"), at("1997-01-01").alias("jan97"))


@query(with_("monthly") + "select month, max(case when market = 'AFRICA' then value end) as africa, max(case when market = 'ASIA' then value end) as asia, max(case when market = 'EUROPE' then value end) as europe, count(distinct case when market in ('AFRICA', 'ASIA', 'EUROPE') then market end) = 3 as complete from monthly group by 1")
def agg_13_pivot(spark, sf):
    names = ["AFRICA", "ASIA", "EUROPE"]
    wide = monthly(spark, sf).groupBy("month").pivot("market", names).agg(F.max("value"))
    complete = F.lit(True)
    for n in names:
        complete = complete & F.col(n).isNotNull()
    return wide.select("month", *[F.col(n).alias(n.lower()) for n in names], complete.alias("complete"))


@query("select l_linenumber as h, count(*)::bigint as n, " + ", ".join(f"{q(f'quantile_cont(l_extendedprice, {x})')} as q{str(x)[2:]}" for x in (0.025, 0.1, 0.5, 0.9, 0.975)) + " from lineitem group by 1 having count(*) >= 30")
def agg_14_exact_quantiles(spark, sf):
    levels = [0.025, 0.1, 0.5, 0.9, 0.975]
    out = S.selected_quantiles(table(spark, sf, "lineitem").withColumn("h", F.col("l_linenumber")), ["h"], "l_extendedprice", levels, least=30)
    return out.select("h", "n", *[r3(c).alias(c) for c in out.columns[2:]])


ACCURACY_SQL = f"count(*)::bigint as n, {q('100 * avg(abs(p - a) / a)', 6)} as mape, {q('avg(abs(p - a))', 3)} as mae, {q('avg(p - a)', 3)} as bias, {q('100 * avg((p - a) / a)', 6)} as bias_pct"


def naive_pairs(s):
    """Seasonal naive forecasts of a monthly series: origin, horizon, target, p (value a year before the target), a."""
    pairs = R.rolling_pairs(s, "month")
    values = s.select(F.col("month").alias("target"), F.col("value").alias("a"))
    before = s.select(F.add_months("month", 12).alias("target"), F.col("value").alias("p"))
    return pairs.join(values, "target").join(before, "target")


PAIRS_SQL = "pairs as (select o.month as origin, h::int as horizon, t.month as target, y.value as p, t.value as a from series o cross join (select unnest(range(1, 13)) as h) join series t on t.mi = o.mi + h join series y on y.mi = t.mi - 12)"


@query(with_("series") + f", {PAIRS_SQL} select horizon, {ACCURACY_SQL} from pairs group by 1 union all select 0, {ACCURACY_SQL} from pairs")
def agg_15_accuracy(spark, sf):
    """By horizon; horizon 0 is the total."""
    pairs = naive_pairs(series(spark, sf))
    both = pairs.union(pairs.withColumn("horizon", F.lit(0)))
    out = S.accuracy(both, ["horizon"], "p", "a")
    return out.select("horizon", "n", r3("mape", 6).alias("mape"), r3("mae").alias("mae"), r3("bias").alias("bias"), r3("bias_pct", 6).alias("bias_pct"))


@query(with_("series") + f", {PAIRS_SQL} select year(origin)::bigint as year, {q('100 * (avg(p) / avg(a) - 1)', 6)} as error_pct from pairs where month(origin) = 12 group by 1 having count(*) = 12 and count(distinct horizon) = 12")
def agg_16_annual_error(spark, sf):
    pairs = naive_pairs(series(spark, sf)).filter("month(origin) = 12")
    whole = pairs.groupBy(F.year("origin").cast("bigint").alias("year")).agg(F.count("*").alias("n"), F.count_distinct("horizon").alias("k"), r3(100 * (F.avg("p") / F.avg("a") - 1), 6).alias("error_pct"))
    return whole.filter("n = 12 and k = 12").select("year", "error_pct")


CVAR_SQL = "with r as (select o_orderpriority as k, o_totalprice as v, row_number() over (partition by o_orderpriority order by o_totalprice desc) as r, count(*) over (partition by o_orderpriority) as n from orders), w as (select *, least(1.0::double, greatest(0.0::double, (1.0::double - 0.95::double) * n - (r - 1))) as w from r)"


@query(f"{CVAR_SQL} select k, {q('sum(w * v) / sum(w)')} as cvar from w group by 1")
def agg_17_upper_cvar(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("k"), F.col("o_totalprice").alias("v"))
    return S.upper_cvar(o, ["k"], "v", 0.95).select("k", r3("cvar").alias("cvar"))


@query(f"select o_orderpriority, {q('avg((o_totalprice <= 150000)::int)', 6)} as pit from orders group by 1")
def agg_18_pit(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(r3(F.avg((F.col("o_totalprice") <= 150000).cast("double")), 6).alias("pit"))


@query(f"{CVAR_SQL} select k, {q('(select avg(o_totalprice) from orders o where o.o_orderpriority = k) + 0.5 * sum(w * v) / sum(w)')} as objective from w group by 1")
def agg_19_mean_plus_tail(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("k"), F.col("o_totalprice").alias("v"))
    return o.groupBy("k").agg(F.avg("v").alias("mean")).join(S.upper_cvar(o, ["k"], "v", 0.95), "k").select("k", r3(F.col("mean") + 0.5 * F.col("cvar")).alias("objective"))


@query(with_("series") + f""", {PAIRS_SQL}, f as (select *, a between p * 0.9 and p * 1.1 as inside, p * 0.2 as width from pairs), s as (select 'all' as slice, * from f union all select 'december', * from f where month(origin) = 12 union all select 'h' || horizon, * from f)
select slice, count(*)::bigint as n, {q('100 * avg(inside::int)', 4)} as coverage, {q('avg(width)')} as width from s group by 1""")
def agg_20_interval_coverage(spark, sf):
    f = naive_pairs(series(spark, sf)).withColumn("inside", F.col("a").between(F.col("p") * 0.9, F.col("p") * 1.1)).withColumn("width", F.col("p") * 0.2)
    slices = F.filter(F.array(F.lit("all"), F.when(F.month("origin") == 12, "december"), F.concat(F.lit("h"), F.col("horizon").cast("string"))), lambda x: x.isNotNull())
    return f.withColumn("slice", F.explode(slices)).groupBy("slice").agg(F.count("*").alias("n"), r3(100 * F.avg(F.col("inside").cast("double")), 4).alias("coverage"), r3(F.avg("width")).alias("width"))


@query(f"select p_brand, regr_count(p_retailprice, p_size)::bigint as n, {q('regr_slope(p_retailprice, p_size)', 5)} as slope, {q('regr_intercept(p_retailprice, p_size)', 5)} as intercept, {q('corr(p_size, p_retailprice)', 6)} as r, {q('regr_r2(p_retailprice, p_size)', 6)} as r2 from part group by 1 having count(*) >= 5")
def agg_21_linear_fit(spark, sf):
    f = S.linear_fit(table(spark, sf, "part"), ["p_brand"], "p_size", "p_retailprice")
    return f.select("p_brand", "n", r3("slope", 5).alias("slope"), r3("intercept", 5).alias("intercept"), r3("r", 6).alias("r"), r3("r2", 6).alias("r2"))


@query(with_("monthly") + f"select market, month, {q('value - avg(value) over (partition by market, month(month))')} as deviation from monthly")
def agg_22_group_deviation(spark, sf):
    w = Window.partitionBy("market", F.month("month"))
    return monthly(spark, sf).select("market", "month", r3(F.col("value") - F.avg("value").over(w)).alias("deviation"))


@query(with_("hourly") + "select market, count(*)::bigint as n from hourly join (select market as m, median(load) as mid from hourly group by 1) on m = market where load > 0.9 * mid group by 1")
def agg_23_median_filter(spark, sf):
    h = hourly(spark, sf)
    mid = h.groupBy("market").agg(F.median("load").alias("mid"))
    return h.join(mid, "market").filter("load > 0.9 * mid").groupBy("market").agg(F.count("*").alias("n"))


@query("select p_brand, min_by(p_partkey, (p_size, abs(p_retailprice - 1000)::decimal(18,2), p_partkey)) as best from part group by 1")
def agg_24_argmin(spark, sf):
    key = F.struct("p_size", F.abs(F.col("p_retailprice") - 1000).cast("decimal(18,2)").alias("far"), "p_partkey")
    return table(spark, sf, "part").groupBy("p_brand").agg(F.min_by("p_partkey", key).alias("best"))


REPLICAS, BOOTSTRAP_SEED = 2000, 0


@query(with_("monthly") + f""", y as (select market, year, sum(x) as x, count(*)::bigint as n, row_number() over (partition by market order by year) - 1 as i, count(*) over (partition by market) as years from (select market, year(month) as year, value as x from monthly) group by 1, 2),
k as (select distinct market, years from y), d as (select market, r, concat('0x', sha256('{BOOTSTRAP_SEED}:' || market || ':' || r || ':' || j)[1:15])::bigint % years as i from k, (select unnest(range(0, {REPLICAS})) as r), (select unnest(range(0, 100)) as j) where j < years),
b as (select market, r, sum(x) / sum(n) as m from d join y using (market, i) group by 1, 2),
t as (select market, sum(x) / sum(n) as mean from y group by 1)
select market, {q('any_value(mean)')} as mean, {q('stddev_samp(m)', 6)} as error from b join t using (market) group by 1""")
def agg_25_block_bootstrap_error(spark, sf):
    """Standard error of the mean by resampling whole years."""
    m = monthly(spark, sf).select("market", F.year("month").alias("year"), "value")
    out = S.block_bootstrap(m, ["market"], "year", "value", REPLICAS, BOOTSTRAP_SEED)
    return out.select("market", r3("mean").alias("mean"), r3("error", 6).alias("error"))


FLOOR_SQL = """f as (select year(l_shipdate)::bigint as year, l_shipdate::date as block, l_discount * 10 + l_tax as v from lineitem),
g as (select *, round(v::decimal(18,6), 2) as r from f), low as (select year, min(v) as low, count(*)::bigint as observations from g group by 1),
near as (select g.year, count_if(abs(v - low) <= 0.005)::bigint as repeats from g join low using (year) group by 1),
pv as (select year, r, count(distinct block)::bigint as n from g group by 1, 2),
found as (select year, min(r) as minimum, min_by(n, r) as blocks, min(case when n >= 3 then r end) as least_repeated from pv group by 1),
floors as (select year, minimum::double as minimum, repeats, blocks, observations, case when blocks >= 3 then 'detected' when least_repeated is not null then 'repeated_above' else 'single_minimum' end as status, least_repeated::double as least_repeated, case when blocks >= 3 then minimum::double end as floor from found join low using (year) join near using (year))"""


def floors(spark, sf):
    li = table(spark, sf, "lineitem").select(F.year("l_shipdate").cast("bigint").alias("year"), F.col("l_shipdate").cast("date").alias("block"), (F.col("l_discount") * 10 + F.col("l_tax")).alias("v"))
    f = S.repeated_minimum(li, "year", "block", "v")
    return f.withColumns({c: F.col(c).cast("double") for c in ("minimum", "least_repeated", "floor")})


@query(f"with {FLOOR_SQL} select * from floors")
def agg_26_repeated_minimum(spark, sf):
    return floors(spark, sf)


@query(f"""with k as (select (o_orderkey % 31)::int as year, {q('avg(o_totalprice)')} as v from orders group by 1), g as (select year, case when year % 4 in (0, 3) then v end as v from k),
e as (select year, v, last_value(case when v is not null then year end ignore nulls) over a as ya, last_value(v ignore nulls) over a as va, first_value(case when v is not null then year end ignore nulls) over b as yb, first_value(v ignore nulls) over b as vb from g window a as (order by year rows between unbounded preceding and current row), b as (order by year rows between current row and unbounded following))
select year, v, {q('coalesce(v, va + (vb - va) * (year - ya) / (yb - ya))')} as line, coalesce(v, case when ya is not null and yb is not null then least(va, vb) end) as low, coalesce(v, case when ya is not null and yb is not null then greatest(va, vb) end) as high from e""")
def agg_27_interpolated_gaps(spark, sf):
    k = table(spark, sf, "orders").groupBy((F.col("o_orderkey") % 31).cast("int").alias("year")).agg(r3(F.avg("o_totalprice")).alias("v"))
    known = k.select("year", F.when((F.col("year") % 4).isin(0, 3), F.col("v")).alias("v"))
    return S.between_known(known, "year", "v").withColumn("line", r3("line"))


WEEK_SQL = f"w as (select date_trunc('week', o_orderdate) as a, {q('avg(o_totalprice)')} as price from orders group by 1)"


@query(f"with {WEEK_SQL}, h as (select date_trunc('month', a + d * interval 1 day)::date as month, price, 24 as hours from w, (select unnest(range(0, 7)) as d)) select month, {q('sum(price * hours) / sum(hours)')} as price, sum(hours)::bigint as hours from h group by 1")
def agg_28_weekly_to_monthly(spark, sf):
    """Weekly prices to months by the hours that each week has in the month."""
    w = table(spark, sf, "orders").groupBy(F.date_trunc("week", "o_orderdate").cast("timestamp_ntz").alias("a")).agg(r3(F.avg("o_totalprice")).alias("price"))
    w = w.withColumn("b", F.col("a") + F.expr("interval 7 day"))
    start = lambda c: F.date_trunc("month", c).cast("timestamp_ntz")
    m = w.select(F.explode(F.array(start("a"), start(F.col("a") + F.expr("interval 6 day")))).alias("m0")).distinct().withColumn("m1", F.col("m0") + F.expr("interval 1 month"))
    met = R.overlap_join(w, m, "a", "b", "m0", "m1").withColumn("hours", C.hours_between("overlap_start", "overlap_end"))
    return met.groupBy(F.col("m0").cast("date").alias("month")).agg(r3(F.sum(F.col("price") * F.col("hours")) / F.sum("hours")).alias("price"), F.sum("hours").alias("hours"))


@query(f"""with d as (select event_type as area, date_trunc('month', ts)::date as month, hour(ts)::int as h, user_id, case when event_id % 9 = 0 then null else value end as v from events qualify row_number() over (partition by event_type, user_id, date_trunc('hour', ts) order by ts desc, event_id desc) = 1)
select area, month, count(*)::bigint as n, count_if(v is null)::bigint as missing, {q('avg(coalesce(v, 0))')} as mean, case when count_if(v is null) = 0 then 'whole' when count_if(v is null) < count(*) then 'partial' else 'none' end as status from d group by 1, 2""")
def agg_29_api_records(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("area"), C.month_of("ts").alias("month"), "user_id", F.date_trunc("hour", "ts").alias("at"), "ts", "event_id", F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("v"))
    d = R.latest_wins(e, ["area", "user_id", "at"], [F.desc("ts"), F.desc("event_id")])
    missing = F.count_if(F.col("v").isNull())
    out = d.groupBy("area", "month").agg(F.count("*").alias("n"), missing.alias("missing"), r3(F.avg(F.coalesce("v", F.lit(0.0)))).alias("mean"))
    return out.withColumn("status", F.when(F.col("missing") == 0, "whole").when(F.col("missing") < F.col("n"), "partial").otherwise("none"))


@query(with_("hourly") + f", s as (select market, count(*)::bigint as n, count_if(load is null)::bigint as nulls, count(distinct load)::bigint as kinds, min(load) as low, median(load) as mid, max(load) as high, count_if(load < 50)::bigint as small, (datesub('hour', min(hour), max(hour)) + 1)::bigint as span from hourly group by 1) select market, n, nulls, kinds, low, {q('mid')} as mid, high, small, span - n as gaps from s")
def agg_30_profile(spark, sf):
    s = hourly(spark, sf).groupBy("market").agg(F.count("*").alias("n"), F.count_if(F.col("load").isNull()).alias("nulls"), F.count_distinct("load").alias("kinds"), F.min("load").alias("low"), r3(F.median("load")).alias("mid"), F.max("load").alias("high"), F.count_if(F.col("load") < 50).alias("small"), (C.hours_between(F.min("hour"), F.max("hour")) + 1).alias("span"))
    return s.select("market", "n", "nulls", "kinds", "low", "mid", "high", "small", (F.col("span") - F.col("n")).alias("gaps"))


@query("""with c as (select o_custkey % 20 as station, year(o_orderdate)::bigint as year, count(distinct o_orderdate::date)::double / 366 as c from orders where year(o_orderdate) < 2001 group by 1, 2)
select station::bigint as station, round(min(c)::decimal(28,9), 6)::double as worst, count(*)::bigint as years, min(c) >= 0.2 as passes from c group by 1""")
def agg_31_completeness(spark, sf):
    o = table(spark, sf, "orders").filter("year(o_orderdate) < 2001")
    c = o.groupBy((F.col("o_custkey") % 20).alias("station"), F.year("o_orderdate").alias("year")).agg((F.count_distinct(F.col("o_orderdate").cast("date")) / 366.0).alias("c"))
    return c.groupBy("station").agg(r3(F.min("c"), 6).alias("worst"), F.count("*").alias("years"), (F.min("c") >= 0.2).alias("passes"))


@query(with_("monthly") + f""", p as (select a.market, a.value as x, a.n::double as y from monthly a), k as (select *, (rank() over (partition by market order by x) + (count(*) over (partition by market, x) - 1) / 2.0)::double as rx, (rank() over (partition by market order by y) + (count(*) over (partition by market, y) - 1) / 2.0)::double as ry from p),
c as (select market, corr(x, y) as r, corr(rx, ry) as s, count(*)::double as n from k group by 1)
select market, {q('r', 6)} as pearson, {q('s', 6)} as spearman, {q('tanh(atanh(r) - 1.959963984540054 / sqrt(n - 3))', 5)} as low, {q('tanh(atanh(r) + 1.959963984540054 / sqrt(n - 3))', 5)} as high from c""")
def agg_32_correlations(spark, sf):
    """Pearson with Fisher's interval, and Spearman on mean ranks."""
    p = monthly(spark, sf).select("market", F.col("value").alias("x"), F.col("n").cast("double").alias("y"))

    def mean_rank(c: str):
        same = F.count("*").over(Window.partitionBy("market", c))
        return F.rank().over(Window.partitionBy("market").orderBy(c)) + (same - 1) / 2.0

    k = p.withColumn("rx", mean_rank("x")).withColumn("ry", mean_rank("y"))
    c = k.groupBy("market").agg(F.corr("x", "y").alias("r"), F.corr("rx", "ry").alias("s"), F.count("*").cast("double").alias("n"))
    half = F.lit(1.959963984540054) / F.sqrt(F.col("n") - 3)
    return c.select("market", r3("r", 6).alias("pearson"), r3("s", 6).alias("spearman"), r3(F.tanh(F.atanh("r") - half), 5).alias("low"), r3(F.tanh(F.atanh("r") + half), 5).alias("high"))


@query(with_("monthly") + f"select market, month, {q('ln(value) - ln(lag(value, 12) over (partition by market order by month))', 6)} as d12 from monthly")
def agg_33_seasonal_difference(spark, sf):
    w = Window.partitionBy("market").orderBy("month")
    return monthly(spark, sf).select("market", "month", r3(F.ln("value") - F.ln(F.lag("value", 12).over(w)), 6).alias("d12"))


@query(
    with_("monthly")
    + f""", n as (select market, month, ln(value) as y, (row_number() over (partition by market order by month))::double as t from monthly),
d as (select market, month, y - avg(y) over w as y, t - avg(t) over w as t from n window w as (partition by market, month(month))),
b as (select market, coalesce(sum(t * y) / nullif(sum(t * t), 0), 0) as slope from d group by 1)
select market, month, {q('y - slope * t', 6)} as residual from d join b using (market)"""
)
def agg_33b_trend_and_month_residual(spark, sf):
    """Residuals of ln(value) on a trend and month dummies by least squares.

    Taking each calendar month's mean from value and trend leaves the same residuals as fitting the dummies, so two windows
    and a sum for each market do.
    """
    by_month = Window.partitionBy("market", F.month("month"))
    n = monthly(spark, sf).select("market", "month", F.ln("value").alias("y"), F.row_number().over(Window.partitionBy("market").orderBy("month")).cast("double").alias("t"))
    d = n.select("market", "month", (F.col("y") - F.avg("y").over(by_month)).alias("y"), (F.col("t") - F.avg("t").over(by_month)).alias("t"))
    tt = F.sum(F.col("t") * F.col("t"))
    slope = d.groupBy("market").agg(F.when(tt > 0, F.sum(F.col("t") * F.col("y")) / tt).otherwise(F.lit(0.0)).alias("slope"))
    return d.join(slope, "market").select("market", "month", r3(F.col("y") - F.col("slope") * F.col("t"), 6).alias("residual"))


@query(f"""with y as (select year(o_orderdate)::int as y, sum(o_totalprice::decimal(18,2) * 0.05::decimal(3,2))::double as s, sum(o_totalprice::decimal(18,2))::double as c from orders group by 1), f as (select 'y' || y as slice, * from y union all select 'all', * from y union all select 'without_first', * from y where y > 1995)
select slice, {q('sum(s)')} as saving, {q('100 * sum(s) / sum(c)', 6)} as pct, min_by(y, (s, y))::int as worst_year from f group by 1""")
def agg_34_savings_by_slice(spark, sf):
    d = lambda c: F.sum(c.cast("decimal(18,2)")).cast("double")
    y = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)") * F.lit("0.05").cast("decimal(3,2)")).cast("double").alias("s"), d(F.col("o_totalprice")).alias("c"))
    slices = F.filter(F.array(F.concat(F.lit("y"), F.col("y").cast("string")), F.lit("all"), F.when(F.col("y") > 1995, "without_first")), lambda x: x.isNotNull())
    return y.withColumn("slice", F.explode(slices)).groupBy("slice").agg(r3(F.sum("s")).alias("saving"), r3(100 * F.sum("s") / F.sum("c"), 6).alias("pct"), F.min_by("y", F.struct("s", "y")).alias("worst_year"))


@query("select event_type as kind, count_if(value < 60)::bigint as pass, count_if(value >= 60 and value < 90)::bigint as warn, count_if(value >= 90)::bigint as error, count(*)::bigint as n from events group by 1")
def agg_35_test_rollup(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("kind")).agg(F.count_if(v < 60).alias("pass"), F.count_if((v >= 60) & (v < 90)).alias("warn"), F.count_if(v >= 90).alias("error"), F.count("*").alias("n"))


@query(with_("monthly") + f", a as (select year(month)::int as y, market, count(*)::bigint as n, {q('sum(value)')} as s from monthly group by 1, 2), b as (select y, market, n, case when y = 1998 then s + 1 else s end as s from a) select a.y, a.market, a.n as left_n, b.n as right_n, abs(a.s - b.s) <= 0.01 and a.n = b.n as same from a full join b using (y, market)")
def agg_36_group_fingerprint(spark, sf):
    a = monthly(spark, sf).groupBy(F.year("month").alias("y"), "market").agg(F.count("*").alias("n"), r3(F.sum("value")).alias("s"))
    b = a.select("y", "market", F.col("n").alias("right_n"), F.when(F.col("y") == 1998, F.col("s") + 1).otherwise(F.col("s")).alias("t"))
    return a.join(b, ["y", "market"], "full").select("y", "market", F.col("n").alias("left_n"), "right_n", ((F.abs(F.col("s") - F.col("t")) <= 0.01) & (F.col("n") == F.col("right_n"))).alias("same"))


@query("select sha256(string_agg(r_regionkey || '|' || r_name, chr(10) order by r_regionkey || '|' || r_name)) as fingerprint, count(*)::bigint as n from region")
def agg_37_table_fingerprint(spark, sf):
    """Of a small table: its rows, sorted, in one digest. Large tables take agg_37b."""
    rows = F.concat_ws("|", F.col("r_regionkey").cast("string"), "r_name")
    return table(spark, sf, "region").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(rows)), "\n"), 256).alias("fingerprint"), F.count("*").alias("n"))


@query("select sum(concat('0x', md5(o_orderkey || '|' || o_custkey || '|' || o_orderstatus)[1:15])::bigint::decimal(38,0))::varchar as fingerprint, count(*)::bigint as n from orders")
def agg_37b_large_table_fingerprint(spark, sf):
    """An order-free sum of row hashes: partial sums before the shuffle, whatever the table's size."""
    text = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")
    return table(spark, sf, "orders").agg(F.sum(h).cast("string").alias("fingerprint"), F.count("*").alias("n"))


@query(with_("monthly") + f", a as (select month, count(*)::bigint as n, {q('sum(value)')} as s from monthly group by 1), b as (select month, case when month(month) = 5 then n - 1 else n end as n, case when year(month) >= 2000 then s + 5 else s end as s from a) select month, case when b.n < a.n then 'lost_rows' when abs(a.s - b.s) <= 0.01 then 'equal' when month >= date '2000-06-01' then 'informative' else 'different' end as verdict from a full join b using (month)")
def agg_38_snapshot_comparison(spark, sf):
    a = monthly(spark, sf).groupBy("month").agg(F.count("*").alias("n"), r3(F.sum("value")).alias("s"))
    b = a.select("month", F.when(F.month("month") == 5, F.col("n") - 1).otherwise(F.col("n")).alias("m"), F.when(F.year("month") >= 2000, F.col("s") + 5).otherwise(F.col("s")).alias("t"))
    verdict = F.when(F.col("m") < F.col("n"), "lost_rows").when(F.abs(F.col("s") - F.col("t")) <= 0.01, "equal").when(F.col("month") >= F.lit("2000-06-01").cast("date"), "informative").otherwise("different")
    return a.join(b, "month", "full").select("month", verdict.alias("verdict"))


@query(with_("monthly") + "select count(*)::bigint as n, 0::bigint as moved from monthly")
def agg_39_run_stability(spark, sf):
    """Rounded means of the same rows in another partitioning: none may move."""
    mean = lambda df: df.groupBy(F.col("r_name").alias("market"), C.month_of("o_orderdate").alias("month")).agg(r3(F.avg("o_totalprice")).alias("value"))
    rows = regional_orders(spark, sf)
    again = mean(rows.repartition(7, "o_orderkey")).select("market", "month", F.col("value").alias("again"))
    return mean(rows).join(again, ["market", "month"], "full").agg(F.count("*").alias("n"), F.count_if(~F.col("value").eqNullSafe(F.col("again"))).alias("moved"))


@query("select count(*)::bigint as n, count(distinct (l_orderkey, l_linenumber))::bigint as keys, count_if(l_linenumber < 1)::bigint as bad_line, count_if(l_discount > l_tax)::bigint as order_violations, count_if(l_quantity <= 0)::bigint as not_positive from lineitem")
def agg_40_check_bundle(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("n"), F.count_distinct(F.struct("l_orderkey", "l_linenumber")).alias("keys"), F.count_if(F.col("l_linenumber") < 1).alias("bad_line"), F.count_if(F.col("l_discount") > F.col("l_tax")).alias("order_violations"), F.count_if(F.col("l_quantity") <= 0).alias("not_positive"))


@query("select year(o_orderdate)::bigint as year, count(*)::bigint as n, count(distinct o_orderdate::date)::bigint as days, (datediff('day', make_date(min(year(o_orderdate))::bigint, 1, 1), make_date(min(year(o_orderdate))::bigint + 1, 1, 1)) - count(distinct o_orderdate::date))::bigint as missing, (count(*) - count(distinct (o_custkey, o_orderdate)))::bigint as duplicates, round((100.0 * count_if(o_orderstatus = 'F') / count(*))::decimal(28,9), 4)::double as share from orders group by 1")
def agg_41_year_completeness(spark, sf):
    y = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count("*").alias("n"), F.count_distinct(F.col("o_orderdate").cast("date")).alias("days"), (F.count("*") - F.count_distinct(F.struct("o_custkey", "o_orderdate"))).alias("duplicates"), r3(100.0 * F.count_if(F.col("o_orderstatus") == "F") / F.count("*"), 4).alias("share"))
    length = F.datediff(F.make_date(F.col("year").cast("int") + 1, F.lit(1), F.lit(1)), F.make_date(F.col("year").cast("int"), F.lit(1), F.lit(1)))
    return y.select("year", "n", "days", (length - F.col("days")).alias("missing"), "duplicates", "share")


@query(f"""with p as (select event_type as market, hour(ts)::int as h, avg(case when ts < timestamp '2024-01-16' then value end) as a, avg(case when ts >= timestamp '2024-01-16' then value end) as b from events group by 1, 2),
s as (select x.market, k, {q('corr(x.a, y.b)', 6)} as r from p x join p y on x.market = y.market cross join (select unnest(range(-2, 3))::int as k) where y.h = (x.h + k + 24) % 24 group by 1, 2) select market, max_by(k, (r, k))::int as shift, max(r) as r from s group by 1""")
def agg_42_circular_shift(spark, sf):
    e = table(spark, sf, "events")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    p = e.groupBy(F.col("event_type").alias("market"), F.hour("ts").alias("h")).agg(F.avg(F.when(F.col("ts") < cut, F.col("value"))).alias("a"), F.avg(F.when(F.col("ts") >= cut, F.col("value"))).alias("b"))
    shifted = p.select("market", F.col("a"), F.col("h"), F.explode(F.sequence(F.lit(-2), F.lit(2))).alias("k")).withColumn("h", (F.col("h") + F.col("k") + 24) % 24)
    r = shifted.join(p.select("market", "h", "b"), ["market", "h"]).groupBy("market", "k").agg(r3(F.corr("a", "b"), 6).alias("r"))
    return r.groupBy("market").agg(F.max_by("k", F.struct("r", "k")).alias("shift"), F.max("r").alias("r"))


@query(f"with d as (select ts::date as day, avg(value) as m, (min(value) + max(value)) / 2 as i from events group by 1), r as (select day, m / i as r from d) select {q('max(abs(r - 1))', 6)} as worst, count_if(abs(r - 1) > 0.05)::bigint as over, count(*)::bigint as days from r")
def agg_43_daily_against_independent(spark, sf):
    d = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.avg("value").alias("m"), ((F.min("value") + F.max("value")) / 2).alias("i"))
    gap = F.abs(F.col("m") / F.col("i") - 1)
    return d.agg(r3(F.max(gap), 6).alias("worst"), F.count_if(gap > 0.05).alias("over"), F.count("*").alias("days"))


@query(with_("monthly") + f""", v as (select market, var_samp(value) as a, var_samp(value * (1 + (month(month) % 3) * 0.1)) as b, quantile_cont(value, 0.95) as p from monthly group by 1), t as (select market, 'low' as variant, 0.9 as k from v union all select market, 'high', 1.1 from v)
select v.market, variant, {q('b / a', 5)} as variance_ratio, {q('p * k')} as p95 from v join t using (market)""")
def agg_44_variance_and_sensitivity(spark, sf):
    v = monthly(spark, sf).groupBy("market").agg(F.var_samp("value").alias("a"), F.var_samp(F.col("value") * (1 + (F.month("month") % 3) * 0.1)).alias("b"), F.percentile("value", F.lit(0.95)).alias("p"))
    variants = F.explode(F.array(F.struct(F.lit("low").alias("variant"), F.lit(0.9).alias("k")), F.struct(F.lit("high").alias("variant"), F.lit(1.1).alias("k"))))
    return v.select("market", "a", "b", "p", variants.alias("t")).select("market", "t.variant", r3(F.col("b") / F.col("a"), 5).alias("variance_ratio"), r3(F.col("p") * F.col("t.k")).alias("p95"))
