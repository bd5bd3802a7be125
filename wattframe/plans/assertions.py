"""The suite of assertions on calendars, dimensions and facts: each returns the rows that break it."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import relational as R
from wattframe.plans import quality as Q
from wattframe.plans.aggregates import r3
from wattframe.plans.bindings import hourly, monthly, regional_orders, series, written_once
from wattframe.plans.domain import P, api, bound_ladder, consumption, dom_11_station_dimension, market_dimension, states, weeks
from wattframe.plans.quality import Assertion
from wattframe.plans.scenario import annual, bounds, sc_07_price_transform, spot
from wattframe.registry import query
from wattframe.session import table
from wattframe.sources import calendar


def _times(spark, first="2016-01-01 00:00:00", last="2021-12-31 23:00:00"):
    return calendar.time_dimension(spark, first, last)


def _wrong_count(df, n: int):
    return df.agg(F.count("*").alias("n")).filter(F.col("n") != n)


def api_net_of_generation(spark, sf):
    return api(monthly(spark, sf)).filter(F.col("net").isNull() | F.col("own").isNull() | (F.col("own") < 0))


def three_rows_a_week(spark, sf):
    return weeks(spark, sf).groupBy("week").agg(F.count("*").alias("n")).filter("n > 3")


def stations_that_moved(spark, sf):
    return dom_11_station_dimension(spark, sf).filter("moved and moved_m < 500")


def stations_all_there(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey, "left_anti")


def market_names_covered(spark, sf):
    aliases = market_dimension(spark).select(F.explode("aliases").alias("r_name"))
    return table(spark, sf, "region").join(aliases, "r_name", "left_anti")


def market_rows(spark, sf):
    return _wrong_count(market_dimension(spark), 5)


def compound_holiday_is_split(spark, sf):
    return _wrong_count(_times(spark, "2000-04-21 03:00:00", "2000-04-22 02:00:00").filter("n_holidays = 2"), 24)


def holidays_per_year(spark, sf):
    per_year = calendar.holidays(spark).groupBy(F.year("day").alias("y")).agg(F.count("*").alias("n"))
    want = F.when(F.col("y") == 2000, 8).when(F.col("y") >= 2024, 10).otherwise(9)
    return per_year.filter(F.col("n") != want)


def dst_ends_in_2019(spark, sf):
    return _times(spark).filter("is_dst and day > '2019-02-16'")


def hours_contiguous(spark, sf):
    return Q.contiguous(_times(spark).withColumn("i", C.hours_between(F.lit("2016-01-01 00:00:00").cast("timestamp_ntz"), "utc")), ["year"], "i").filter("gap > 1 and not (month = 1 and day_of_month = 1)")


def peak_on_business_days(spark, sf):
    return _times(spark).filter("is_peak and (weekday > 5 or is_regulated_holiday or hour not between 18 and 20)")


def hours_expected(spark, sf):
    return _wrong_count(calendar.hours(spark), 271_752)


def load_plausible(spark, sf):
    return hourly(spark, sf).filter("load <= 0 or load > 100000")


def nulls_only_on_known_days(spark, sf):
    return hourly(spark, sf).filter("load is null")


def null_exceptions_still_there(spark, sf):
    """The first and the last day of a market are known to be cut: which of them has all of its hours by now?"""
    days = hourly(spark, sf).groupBy("market", F.col("hour").cast("date").alias("day")).agg(F.count("load").alias("n"))
    ends = days.groupBy("market").agg(F.explode(F.array(F.min("day"), F.max("day"))).alias("day"))
    return days.join(ends, ["market", "day"]).filter("n >= 24")


def adjustment_where_due(spark, sf):
    x = bound_ladder(spark, sf)
    return x.filter((F.col("first_status") == "not_available") != F.col("first_adj").isNull())


def closed_months_covered(spark, sf):
    return bound_ladder(spark, sf).filter(f"not unfinished and coverage < {P.least_coverage}")


def transition_closes_with_noise(spark, sf):
    return bound_ladder(spark, sf).filter("first_status = 'built_in' and month < closed_at")


def gaps_only_known(spark, sf):
    return bound_ladder(spark, sf).filter("not unfinished and valid < expected and month not in (date '1995-01-01', date '2001-08-01')")


def unfinished_is_current(spark, sf):
    return bound_ladder(spark, sf).filter(F.col("unfinished") & (F.col("month") < F.trunc(F.lit(P.as_of).cast("date"), "month")))


def months_contiguous(spark, sf):
    return Q.contiguous(monthly(spark, sf).withColumn("mi", C.month_index("month")), ["market"], "mi")


def monthly_is_mean_of_orders(spark, sf):
    one = series(spark, sf).select("month", "value")
    again = table(spark, sf, "orders").groupBy(C.month_of("o_orderdate").alias("month")).agg(r3(F.sum("o_totalprice") / F.count("*")).alias("value"))
    return R.reconcile(one, again, ["month"], "value", 0.01)


def rebuilt_near_independent(spark, sf):
    return bound_ladder(spark, sf).filter("rebuilt_status = 'rebuilt' and abs(rebuilt / original - 1.03) > 0.02")


def rebuilt_where_due(spark, sf):
    inside = F.col("month").between(F.lit(P.rebuilt_from).cast("date"), F.add_months(F.lit(P.api_start).cast("date"), -1))
    return bound_ladder(spark, sf).filter((F.col("rebuilt_status") == "rebuilt") != inside)


def stations_complete(spark, sf):
    return Q.dq_12_station_completeness(spark, sf)


def temperature_plausible(spark, sf):
    """Means lie between the least and the largest single value of the state."""
    e = table(spark, sf, "events").groupBy((F.col("user_id") % 3).cast("int").alias("state")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return states(spark, sf).join(e, "state", "left").filter("low is null or temperature < low - 1e-3 or temperature > high + 1e-3")


def states_match_stations(spark, sf):
    e = table(spark, sf, "events").select((F.col("user_id") % 3).cast("int").alias("state")).distinct()
    return states(spark, sf).select("state").distinct().join(e, "state", "left_anti")


def profile_values(spark, sf):
    return consumption(spark, sf).filter("not is_open and profile <> 0.4 or is_open and profile not in (1.36, 1.6)")


def profile_mean(spark, sf):
    """Over a whole day the profile's mean is one; the bound days lack hours, so a day's weights are held against its own."""
    d = consumption(spark, sf).groupBy("day").agg(F.count("*").alias("n"), F.avg("profile").alias("m"))
    return d.filter("n = 24 and abs(m - 1) > 1e-6")


def holidays_run_as_sundays(spark, sf):
    return _times(spark).filter("is_holiday and day_type <> 'sunday_holiday'")


def use_hours_unique(spark, sf):
    return Q.unique(consumption(spark, sf), "hour")


def use_reconciles(spark, sf):
    """A day's use against its mean load, taken anew from the hours of the one market."""
    h = hourly(spark, sf)
    mean = h.join(h.agg(F.min("market").alias("market")), "market").groupBy(C.to_local("hour").cast("date").alias("day")).agg(F.avg("load").alias("fresh"))
    d = consumption(spark, sf).groupBy("day").agg(F.sum("mwh").alias("mwh"), F.sum("profile").alias("profile"))
    want = P.consumer_k * F.col("fresh") * F.col("profile")
    return d.join(mean, "day", "left").filter(F.col("fresh").isNull() | (F.abs(F.col("mwh") - want) > 1e-4 * F.abs(want) + 1e-3))


def use_scale(spark, sf):
    d = consumption(spark, sf).agg(F.count("*").alias("n"), F.avg("mwh").alias("m"))
    return d.filter("n > 0 and m <= 0")


def price_within_limits(spark, sf):
    """Prices moved into the next year's terms lie within its limits."""
    moved = sc_07_price_transform(spark, sf).withColumn("year", F.year("month") + 1).join(bounds(spark), "year", "left")
    return moved.filter("floor is null or shifted not between floor and cap or clipped not between floor and cap")


def weighted_between_extremes(spark, sf):
    li = table(spark, sf, "lineitem")
    p = F.col("l_extendedprice") / F.col("l_quantity")
    m = li.groupBy(C.month_of("l_shipdate").alias("month")).agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("w"), F.min(p).alias("a"), F.max(p).alias("b"))
    return m.filter("w < a or w > b")


def price_months_contiguous(spark, sf):
    return Q.contiguous(spot(spark, sf), [], "mi")


def sources_keep_their_rows(spark, sf):
    """Orders that meet their customer, nation and region are as many as there are: none lost, none twice."""
    return Q.same_rows(table(spark, sf, "orders"), regional_orders(spark, sf))


def grid_complete(spark, sf):
    g = states(spark, sf).groupBy("state").agg(F.count("*").alias("n"), (C.hours_between(F.min("utc"), F.max("utc")) + 1).alias("want"))
    return g.filter("n <> want")


def fill_only_where_missing(spark, sf):
    return states(spark, sf).filter("imputed and stations > 0")


def only_skipped_hours_dropped(spark, sf):
    o = table(spark, sf, "orders").filter(~C.local_exists("o_orderdate"))
    return o.filter(~F.month("o_orderdate").isin(10, 11))


def rows_conserved(spark, sf):
    return Q.dq_05_row_conservation(spark, sf).filter("raw <> dropped + staged")


def strategies_complete(spark, sf):
    n = F.count("*").over(Window.partitionBy("origin"))
    return annual(spark, sf).withColumn("k", n).filter("k <> 3 or months <> 12")


WARN = {"stations_that_moved", "gaps_only_known", "null_exceptions_still_there", "rebuilt_near_independent", "stations_complete"}
SUITE = [
    Assertion(f.__name__, "warn" if f.__name__ in WARN else "error", f)
    for f in (
        api_net_of_generation, three_rows_a_week, stations_that_moved, stations_all_there, market_names_covered, market_rows, compound_holiday_is_split, holidays_per_year, dst_ends_in_2019, hours_contiguous, peak_on_business_days,
        hours_expected, load_plausible, null_exceptions_still_there, nulls_only_on_known_days, adjustment_where_due, closed_months_covered, transition_closes_with_noise, gaps_only_known, unfinished_is_current, months_contiguous,
        monthly_is_mean_of_orders, rebuilt_near_independent, rebuilt_where_due, stations_complete, temperature_plausible, states_match_stations, profile_values, profile_mean, holidays_run_as_sundays, use_hours_unique, use_reconciles,
        use_scale, price_within_limits, weighted_between_extremes, price_months_contiguous, sources_keep_their_rows, grid_complete, fill_only_where_missing, only_skipped_hours_dropped, rows_conserved, strategies_complete,
        Q.dq_14_deliberate_failure,
    )
]


@query()
def dq_16_assertion_suite(spark, sf):
    """name, severity, n (offending rows) and verdict of every assertion."""
    with written_once():
        return Q.run_assertions(spark, sf, SUITE)
