"""Windows, sorts and set operations as queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import relational as R
from wattframe.plans.bindings import hourly, monthly, series, with_
from wattframe.registry import query
from wattframe.session import table


@query("select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_totalprice desc, o_orderkey) = 1")
def win_01_latest_wins(spark, sf):
    return R.latest_wins(table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_extendedprice, l_linenumber)::bigint as place from lineitem")
def win_02_ordinal(spark, sf):
    w = Window.partitionBy("l_orderkey").orderBy("l_extendedprice", "l_linenumber")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.row_number().over(w).cast("bigint").alias("place"))


@query("select user_id, min_by(event_id, (ts, event_id)) as first_event_id, max_by(event_id, (ts, event_id)) as last_event_id from events group by 1")
def win_03_first_last_record(spark, sf):
    e = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return R.first_and_last(e, ["user_id"], "at", ["event_id"])


@query("with d as (select distinct l_shipdate as a from lineitem where l_returnflag = 'R') select strftime(a, '%Y-%m-%d') as a, datesub('hour', a, coalesce(lead(a) over (order by a), a + interval 7 day))::bigint as hours from d")
def win_04_interval_end(spark, sf):
    d = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_shipdate").alias("a")).distinct()
    return R.interval_end(d, None, "a", F.col("a") + F.expr("interval 7 day")).select(F.date_format("a", "yyyy-MM-dd").alias("a"), C.hours_between("a", "end").alias("hours"))


@query(with_("monthly") + ", f as (select market, month, value > (select avg(value) from monthly) as up from monthly), g as (select *, up and coalesce(lead(up, 1) over w, false) and coalesce(lead(up, 2) over w, false) as run from f window w as (partition by market order by month)) select market, min(month) as closed_at from g where run group by 1")
def win_05_run_of_flags(spark, sf):
    m = monthly(spark, sf)
    mean = m.agg(F.avg("value").alias("mean"))
    return R.closing_run(m.crossJoin(F.broadcast(mean)).withColumn("up", F.col("value") > F.col("mean")), "market", "month", "up", 3)


@query(with_("hourly") + "select market, strftime(hour, '%Y-%m-%d %H') as at, gap from (select market, hour, datesub('hour', lag(hour) over (partition by market order by hour), hour)::bigint as gap from hourly) where gap > 1")
def win_06_gap_check(spark, sf):
    w = Window.partitionBy("market").orderBy("hour")
    gap = C.hours_between(F.lag("hour").over(w), "hour")
    return hourly(spark, sf).withColumn("gap", gap).filter("gap > 1").select("market", F.date_format("hour", "yyyy-MM-dd HH").alias("at"), "gap")


@query(with_("monthly") + "select market, month, round((100 * (value / lag(value, 12) over (partition by market order by month) - 1))::decimal(28,9), 4)::double as change from monthly")
def win_07_year_on_year(spark, sf):
    return monthly(spark, sf).select("market", "month", C.stable_round(100 * (F.col("value") / F.lag("value", 12).over(Window.partitionBy("market").orderBy("month")) - 1), 4).alias("change"))


@query(with_("hourly") + """, g as (select m.market, g.hour, h.load from (select distinct market from hourly) m cross join (select unnest(generate_series(min(hour), max(hour), interval 1 hour)) as hour from hourly) g left join hourly h on h.market = m.market and h.hour = g.hour),
l as (select *, last_value(load ignore nulls) over (partition by market order by hour rows between 3 preceding and 1 preceding) as last from g)
select market, strftime(hour, '%Y-%m-%d %H') as at, coalesce(load, last) as load, load is null and last is not null as imputed from l""")
def win_08_bounded_fill(spark, sf):
    g = R.complete_grid(hourly(spark, sf), "market", "hour", "1 hour")
    return R.fill_forward(g, "market", "hour", "load", 3).select("market", F.date_format("hour", "yyyy-MM-dd HH").alias("at"), "load", "imputed")


@query(with_("series") + """, s as (select month, sum(value) over a as y0, count(value) over a as n0, sum(value) over b as y1, count(value) over b as n1 from series window a as (order by mi rows between 11 preceding and current row), b as (order by mi rows between 23 preceding and 12 preceding))
select month, case when n0 = 12 and n1 = 12 then round((y0 / y1)::decimal(28,9), 6)::double end as growth from s""")
def win_09_trailing_growth(spark, sf):
    return trailing_growth(series(spark, sf)).select("month", "growth")


def trailing_growth(s):
    """Sum of the last 12 months over that of the 12 before; null unless all 24 are there. One series of months: a bounded window."""
    order = Window.partitionBy(F.lit(0)).orderBy("mi")
    now, before = order.rowsBetween(-11, 0), order.rowsBetween(-23, -12)
    full = (F.count("value").over(now) == 12) & (F.count("value").over(before) == 12) & (F.col("mi") - F.min("mi").over(order.rowsBetween(-23, 0)) == 23)
    return s.withColumn("growth", F.when(full, C.stable_round(F.sum("value").over(now) / F.sum("value").over(before), 6)))


@query(with_("series") + "select a.month, a.value, b.value as last_year from series a left join series b on b.mi = a.mi - 12")
def win_10_seasonal_lag(spark, sf):
    s = series(spark, sf)
    return s.join(s.select((F.col("mi") + 12).alias("mi"), F.col("value").alias("last_year")), "mi", "left").select("month", "value", "last_year")


@query(with_("series") + "select o.month as origin, count(*)::bigint as n, min(h.month) as first, round(sum(h.value)::decimal(28,9), 3)::double as total from series o join series h on h.mi between o.mi - 71 and o.mi group by 1 having count(*) = 72")
def win_11_training_window(spark, sf):
    w = Window.partitionBy(F.lit(0)).orderBy("mi").rangeBetween(-71, 0)
    s = series(spark, sf)
    return s.select(F.col("month").alias("origin"), F.count("*").over(w).alias("n"), F.min("month").over(w).alias("first"), C.stable_round(F.sum("value").over(w)).alias("total")).filter("n = 72")


@query(with_("series") + "select month as block, vs as values from (select month, month(month) as m, list(value) over w as vs, max(mi) over w - mi as span from series window w as (order by mi rows between current row and 11 following)) where m = 1 and span = 11 and len(vs) = 12")
def win_12_calendar_blocks(spark, sf):
    return R.contiguous_blocks(series(spark, sf), "month", "value").filter("month(block) = 1")


@query("select l_orderkey, l_linenumber, round((l_quantity - avg(l_quantity) over (partition by l_linenumber))::decimal(28,9), 6)::double as centred from lineitem")
def win_13_centre_by_horizon(spark, sf):
    mean = F.avg("l_quantity").over(Window.partitionBy("l_linenumber"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", C.stable_round(F.col("l_quantity") - mean, 6).alias("centred"))


@query(with_("monthly") + "select market, month, value from monthly qualify row_number() over (partition by market order by month desc) <= 36")
def win_14_tail(spark, sf):
    w = Window.partitionBy("market").orderBy(F.desc("month"))
    return monthly(spark, sf).withColumn("k", F.row_number().over(w)).filter("k <= 36").select("market", "month", "value")


@query("select event_id, row_number() over (partition by user_id order by ts, event_id)::bigint - 1 as before from events")
def win_15_cumulative_count(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf, "events").select("event_id", (F.row_number().over(w) - 1).cast("bigint").alias("before"))


@query("select o_orderkey, o_orderdate::date as day from orders order by o_orderdate, o_orderkey")
def srt_01_order_by(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")).orderBy("day", "o_orderkey")


@query("select o_orderpriority, count(*)::bigint as n, list_position(['5-LOW', '3-MEDIUM', '1-URGENT'], o_orderpriority)::bigint as place from orders where o_orderpriority in ('5-LOW', '3-MEDIUM', '1-URGENT') group by 1")
def srt_02_enumerated_order(spark, sf):
    order = F.array(*map(F.lit, ["5-LOW", "3-MEDIUM", "1-URGENT"]))
    n = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n")).withColumn("place", F.array_position(order, F.col("o_orderpriority")))
    return n.filter("place > 0").orderBy("place")


@query("""with c as (select p_brand as model, avg(p_retailprice) as err, abs(avg(p_size) - 25) as bias, count(*)::bigint as complexity from part group by 1), t as (select *, min(err) over () as best from c), e as (select *, round(err::decimal(28,9), 3)::double as score, err <= best * 1.02 as tied from t)
select model, score from e where tied order by round(bias::decimal(28,9), 6), complexity, model limit 1""")
def srt_03_lexicographic_choice(spark, sf):
    """Of the models within 2% of the best error, the least biased, then the simplest."""
    c = table(spark, sf, "part").groupBy(F.col("p_brand").alias("model")).agg(F.avg("p_retailprice").alias("err"), F.abs(F.avg("p_size") - 25).alias("bias"), F.count("*").alias("complexity"))
    best = c.agg(F.min("err").alias("best"))
    key = F.struct(C.stable_round("bias", 6).alias("a"), F.col("complexity"), F.col("model").alias("m"))
    return c.crossJoin(F.broadcast(best)).filter("err <= best * 1.02").agg(F.min_by(F.struct("model", C.stable_round("err").alias("score")), key).alias("x")).select("x.model", "x.score")


@query("select o_orderkey, o_totalprice from orders order by o_orderdate desc, o_orderkey desc limit 30")
def srt_04_newest_n(spark, sf):
    return table(spark, sf, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(30).select("o_orderkey", "o_totalprice")


@query("select max_by(o_orderkey, (o_orderdate, o_orderkey)) as newest from orders")
def srt_05_newest_by_key(spark, sf):
    return table(spark, sf, "orders").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("newest"))


@query(with_("monthly") + "select max(a.month) as latest from monthly a join monthly b on a.month = b.month and a.market = 'ASIA' and b.market = 'EUROPE' and a.n > 20")
def srt_06_latest_common(spark, sf):
    m = monthly(spark, sf)
    return m.filter("market = 'ASIA' and n > 20").select("month").join(m.filter("market = 'EUROPE'").select("month"), "month").agg(F.max("month").alias("latest"))


@query("select distinct n_nationkey, n_name from nation join customer on c_nationkey = n_nationkey")
def srt_07_drop_duplicates(spark, sf):
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    return n.join(c, n.n_nationkey == c.c_nationkey).select("n_nationkey", "n_name").dropDuplicates(["n_nationkey"])


@query("select o_orderdate::date as d from orders where o_orderstatus = 'F' union select o_orderdate::date - 45 from orders where o_orderstatus = 'P' union select o_orderdate::date + 62 from orders where o_orderstatus = 'P'")
def set_01_union_distinct(spark, sf):
    o = table(spark, sf, "orders")
    p = o.filter("o_orderstatus = 'P'")
    return o.filter("o_orderstatus = 'F'").select(F.col("o_orderdate").cast("date").alias("d")).union(p.select(F.date_sub("o_orderdate", 45))).union(p.select(F.date_add("o_orderdate", 62))).distinct()


@query("select o_orderkey as id, 'order' as kind from orders union all select event_id, 'event' from events")
def set_02_union_all(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind")).unionByName(table(spark, sf, "events").select(F.col("event_id").alias("id"), F.lit("event").alias("kind")))


@query("(select o_custkey as k, 'left' as side from orders where o_orderstatus = 'P' except select o_custkey, 'left' from orders where o_totalprice > 300000) union all (select o_custkey, 'right' from orders where o_totalprice > 300000 except select o_custkey, 'right' from orders where o_orderstatus = 'P')")
def set_03_except_both_ways(spark, sf):
    o = table(spark, sf, "orders")
    a, b = o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), o.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("k"))
    return a.subtract(b).withColumn("side", F.lit("left")).union(b.subtract(a).withColumn("side", F.lit("right")))


@query("select c_custkey as k, o_custkey is not null as both from customer left join (select distinct o_custkey from orders where o_totalprice > 400000) on o_custkey = c_custkey")
def set_04_difference_and_intersection(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    o = table(spark, sf, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("k"))
    return c.join(o, "k", "left_semi").withColumn("both", F.lit(True)).union(c.join(o, "k", "left_anti").withColumn("both", F.lit(False)))


@query(with_("monthly") + "select market, month, value from monthly a where a.n > 30 and exists (select 1 from monthly b where b.market = a.market and b.month = a.month and b.value > 100000)")
def set_05_same_pairs(spark, sf):
    m = monthly(spark, sf)
    return R.same_pairs(m.filter("n > 30"), m.filter("value > 100000"), ["market", "month"]).select("market", "month", "value")


@query("select 'supplier' as source, s_name as name, s_acctbal as balance from supplier union all select 'customer', c_name, c_acctbal from customer")
def set_06_stacked_results(spark, sf):
    parts = [("supplier", "s"), ("customer", "c")]
    frames = [table(spark, sf, t).select(F.lit(t).alias("source"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_acctbal").alias("balance")) for t, p in parts]
    first = frames[0]
    for f in frames[1:]:
        if f.columns != first.columns:
            raise ValueError("results differ in their columns")
        first = first.unionByName(f)
    return first
