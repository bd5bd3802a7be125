"""Forecasting on monthly series: rolling origins, baselines, shocks, models, calibration and selection."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import relational as R
from wattframe.operators import resumable
from wattframe.operators import stats as S
from wattframe.operators.models import autoregression, boosted, ridge, smoothing
from wattframe.plans.aggregates import ACCURACY_SQL, PAIRS_SQL, naive_pairs, q, r3
from wattframe.plans.bindings import series, with_
from wattframe.plans.windows import trailing_growth
from wattframe.registry import query
from wattframe.session import scratch

GROWTH_SQL = "s as (select month, sum(value) over a as y0, count(value) over a as n0, sum(value) over b as y1, count(value) over b as n1 from series window a as (order by mi rows between 11 preceding and current row), b as (order by mi rows between 23 preceding and 12 preceding)), growth as (select month, case when n0 = 12 and n1 = 12 then round((y0 / y1)::decimal(28,9), 6)::double end as growth from s)"
#: Fixed window of the shock in the bound series, and the months before it that define what is normal.
SHOCK = ("1999-03-01", "1999-12-01")
REFERENCE_MONTHS, SIGMAS = 36, 1.0


@query(with_("series") + "select o.month as origin, h::int as horizon, (o.month + h * interval 1 month)::date as target from series o cross join (select unnest(range(1, 13)) as h)")
def fc_01_rolling_pairs(spark, sf):
    return R.rolling_pairs(series(spark, sf).select("month"), "month").select("origin", "horizon", "target")


@query(with_("series") + f", {PAIRS_SQL} select origin, horizon, p as forecast from pairs")
def fc_02_seasonal_naive(spark, sf):
    return naive_pairs(series(spark, sf)).select("origin", "horizon", F.col("p").alias("forecast"))


def growth_pairs(s: DataFrame) -> DataFrame:
    """Seasonal naive times the growth that is known at the origin; origins without it drop out."""
    g = trailing_growth(s).filter("growth is not null").select(F.col("month").alias("origin"), "growth")
    return naive_pairs(s).join(g, "origin").withColumn("p", r3(F.col("p") * F.col("growth")))


@query(with_("series") + f", {PAIRS_SQL}, {GROWTH_SQL} select origin, horizon, {q('p * growth')} as forecast from pairs join growth on month = origin where growth is not null")
def fc_03_naive_with_growth(spark, sf):
    return growth_pairs(series(spark, sf)).select("origin", "horizon", F.col("p").alias("forecast"))


@query(with_("series") + f", {PAIRS_SQL}, {GROWTH_SQL}, two as (select origin, horizon, target, {q('p * growth')} as p, a from pairs join growth on month = origin where growth is not null), b as (select 'naive' as model, * from pairs where exists (select 1 from two t where t.origin = pairs.origin and t.horizon = pairs.horizon) union all select 'growth', * from two) select model, {ACCURACY_SQL} from b group by 1")
def fc_04_baselines_on_same_pairs(spark, sf):
    s = series(spark, sf)
    two = growth_pairs(s).select("origin", "horizon", "target", "p", "a")
    one = R.same_pairs(naive_pairs(s).select("origin", "horizon", "target", "p", "a"), two, ["origin", "horizon"])
    out = S.accuracy(one.withColumn("model", F.lit("naive")).unionByName(two.withColumn("model", F.lit("growth"))), ["model"], "p", "a")
    return out.select("model", "n", *[r3(c, 3 if c in ("mae", "bias") else 6).alias(c) for c in ("mape", "mae", "bias", "bias_pct")])


SHOCK_SQL = f"""yoy as (select a.month, a.mi, a.value, b.value as before, ln(a.value / b.value) as g from series a left join series b on b.mi = a.mi - 12),
ref as (select avg(g) as mu, stddev_samp(g) as sd, count(g) as n from yoy where month >= (date '{SHOCK[0]}' - interval {REFERENCE_MONTHS} month)::date and month < date '{SHOCK[0]}'),
flagged as (select yoy.*, coalesce(month between date '{SHOCK[0]}' and date '{SHOCK[1]}' and n = {REFERENCE_MONTHS} and abs(g - mu) > {SIGMAS} * sd, false) as shocked from yoy, ref)"""


def shocked(s: DataFrame) -> DataFrame:
    """Adds before (a year earlier) and shocked: months of the event whose yearly log change is off the reference."""
    before = s.select((F.col("mi") + 12).alias("mi"), F.col("value").alias("before"))
    yoy = s.join(before, "mi", "left").withColumn("g", F.ln(F.col("value") / F.col("before")))
    date = lambda x: F.lit(x).cast("date")
    ref = yoy.filter((F.col("month") >= F.add_months(date(SHOCK[0]), -REFERENCE_MONTHS)) & (F.col("month") < date(SHOCK[0]))).agg(F.avg("g").alias("mu"), F.stddev_samp("g").alias("sd"), F.count("g").alias("n"))
    off = F.col("month").between(date(SHOCK[0]), date(SHOCK[1])) & (F.col("n") == REFERENCE_MONTHS) & (F.abs(F.col("g") - F.col("mu")) > SIGMAS * F.col("sd"))
    return yoy.crossJoin(F.broadcast(ref)).withColumn("shocked", F.coalesce(off, F.lit(False)))


@query(with_("series") + f", {SHOCK_SQL} select month, shocked from flagged")
def fc_05_shock_detection(spark, sf):
    return shocked(series(spark, sf)).select("month", "shocked")


@query(with_("series") + f", {SHOCK_SQL}, {GROWTH_SQL} select f.month, case when shocked then {q('before * growth')} else value end as value from flagged f, growth g where g.month = (date '{SHOCK[0]}' - interval 1 month)::date")
def fc_06_shock_imputation(spark, sf):
    """Shocked months take the original value of a year earlier times the growth before the event."""
    s = series(spark, sf)
    g = trailing_growth(s).filter(F.col("month") == F.add_months(F.lit(SHOCK[0]).cast("date"), -1)).select("growth")
    return shocked(s).crossJoin(F.broadcast(g)).select("month", F.when(F.col("shocked"), r3(F.col("before") * F.col("growth"))).otherwise(F.col("value")).alias("value"))


@query(with_("series") + f"select o.month as origin, min(h.month) as first, count(*)::bigint as n, {q('avg(h.value)')} as mean from series o join series h on h.mi between o.mi - 71 and o.mi group by 1 having count(*) = 72")
def fc_07_training_windows(spark, sf):
    s = series(spark, sf)
    return training_windows(s).groupBy("origin").agg(F.min("month").alias("first"), F.count("*").alias("n"), r3(F.avg("value")).alias("mean"))


def training_windows(s: DataFrame, months: int = 72) -> DataFrame:
    """origin, month, value: the last months known at each origin that has all of them without a gap."""
    full = s.withColumn("__n", F.count("*").over(Window.partitionBy(F.lit(0)).orderBy("mi").rangeBetween(-(months - 1), 0))).filter(F.col("__n") == months)
    reach = full.select(F.col("month").alias("origin"), F.explode(F.sequence(F.col("mi") - (months - 1), F.col("mi"))).alias("mi"))
    return reach.join(s.select("mi", "month", "value"), "mi")


def _by_origin(s: DataFrame, model) -> DataFrame:
    """Runs predict(values, last month number) -> 12 forecasts on each origin's window: 72 rows to a group."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("mi")
        forecast = model(pdf.value.to_numpy(), int(pdf.mi.iloc[-1]))
        return pd.DataFrame({"origin": key[0], "horizon": np.arange(1, 13), "forecast": forecast})

    return training_windows(s).groupBy("origin").applyInPandas(run, "origin date, horizon int, forecast double")


MODELS = {"smoothing": smoothing, "autoregression": autoregression, "ridge": ridge, "boosted": boosted}


@query()
def fc_08_smoothing(spark, sf):
    return _by_origin(series(spark, sf), smoothing)


@query()
def fc_09_autoregression(spark, sf):
    return _by_origin(series(spark, sf), autoregression)


@query()
def fc_10_ridge(spark, sf):
    return _by_origin(series(spark, sf), ridge)


@query()
def fc_11_boosted(spark, sf):
    return _by_origin(series(spark, sf), boosted)


COMBINED_SQL = f"two as (select origin, horizon, target, {q('p * growth')} as p, a from pairs join growth on month = origin where growth is not null), combined as (select origin, horizon, target, {q('avg(p)')} as p, any_value(a) as a from (select * from pairs union all select * from two) group by 1, 2, 3 having count(*) = 2)"


def combined(s: DataFrame) -> DataFrame:
    """The mean of the components where all of them have the pair."""
    both = naive_pairs(s).select("origin", "horizon", "target", "p", "a").unionByName(growth_pairs(s).select("origin", "horizon", "target", "p", "a"))
    return both.groupBy("origin", "horizon", "target").agg(F.count("*").alias("n"), r3(F.avg("p")).alias("p"), F.any_value("a").alias("a")).filter("n = 2").drop("n")


@query(with_("series") + f", {PAIRS_SQL}, {GROWTH_SQL}, {COMBINED_SQL} select origin, horizon, p as forecast from combined")
def fc_12_combination(spark, sf):
    return combined(series(spark, sf)).select("origin", "horizon", F.col("p").alias("forecast"))


ALL_SQL = f"{PAIRS_SQL}, {GROWTH_SQL}, {COMBINED_SQL}, every as (select 'naive' as model, * from pairs where exists (select 1 from combined c where c.origin = pairs.origin and c.horizon = pairs.horizon) union all select 'growth', * from two union all select 'combined', * from combined)"


def every_model(s: DataFrame) -> DataFrame:
    cols = ["origin", "horizon", "target", "p", "a"]
    c = combined(s)
    frames = {"naive": R.same_pairs(naive_pairs(s).select(*cols), c, cols[:2]), "growth": growth_pairs(s).select(*cols), "combined": c.select(*cols)}
    out = None
    for name, f in frames.items():
        f = f.withColumn("model", F.lit(name))
        out = f if out is None else out.unionByName(f)
    return out


@query(with_("series") + f", {ALL_SQL}, y as (select model, year(target) as y, avg(abs(p - a) / a) as m from every group by 1, 2), w as (select model, {q('100 * max(m)', 6)} as worst_year from y group by 1), sm as (select model, {q('100 * avg(abs(p - a) / a)', 6)} as mape, {q('abs(100 * avg((p - a) / a))', 6)} as bias from every group by 1) select model, mape, bias, worst_year, model = (select model from sm where mape <= (select min(mape) from sm) + 0.05 order by bias, model limit 1) as chosen from sm join w using (model)")
def fc_13_selection(spark, sf):
    """Of the models within 0.05 points of the best MAPE, the least biased."""
    e = every_model(series(spark, sf))
    miss = F.abs(F.col("p") - F.col("a")) / F.col("a")
    worst = e.groupBy("model", F.year("target").alias("y")).agg(F.avg(miss).alias("m")).groupBy("model").agg(r3(100 * F.max("m"), 6).alias("worst_year"))
    s = e.groupBy("model").agg(r3(100 * F.avg(miss), 6).alias("mape"), r3(F.abs(100 * F.avg((F.col("p") - F.col("a")) / F.col("a"))), 6).alias("bias"))
    best = s.agg(F.min("mape").alias("best"))
    pick = s.crossJoin(best).filter("mape <= best + 0.05").agg(F.min_by("model", F.struct("bias", "model")).alias("pick"))
    return s.join(worst, "model").crossJoin(F.broadcast(pick)).select("model", "mape", "bias", "worst_year", (F.col("model") == F.col("pick")).alias("chosen"))


LEVELS = [0.025, 0.1, 0.5, 0.9, 0.975]
ERRORS_SQL = f"{PAIRS_SQL}, errors as (select origin, horizon, target, p, a, {q('ln(a / p)', 6)} as e from pairs)"
CALIBRATION_SQL = f"{ERRORS_SQL}, calibration as (select o.month as origin, e.horizon, count(*)::bigint as n, " + ", ".join(f"{q(f'quantile_cont(e.e, {x})', 6)} as q{str(x)[2:]}" for x in LEVELS) + " from (select month from series where month(month) = 12) o join errors e on e.target <= o.month group by 1, 2 having count(*) >= 30)"


def errors(s: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """e: log(actual / predicted) of the given pairs, of the seasonal naive where none are given."""
    return (naive_pairs(s) if pairs is None else pairs).withColumn("e", r3(F.ln(F.col("a") / F.col("p")), 6))


def calibration(s: DataFrame, least: int = 30) -> DataFrame:
    """Quantiles of log(actual / predicted) by horizon, of errors whose target is known at the origin."""
    origins = s.filter("month(month) = 12").select(F.col("month").alias("at"))
    known = errors(s).select("horizon", "target", "e").join(origins, F.col("target") <= F.col("at")).withColumnRenamed("at", "origin")
    out = S.exact_quantiles(known, ["origin", "horizon"], "e", LEVELS, least=least)
    return out.select("origin", "horizon", "n", *[r3(c, 6).alias(c) for c in out.columns[3:]])


@query(with_("series") + f", {CALIBRATION_SQL} select * from calibration")
def fc_14_calibration(spark, sf):
    return calibration(series(spark, sf))


@query(with_("series") + f", {CALIBRATION_SQL} select p.origin, p.horizon, {q('p * exp(q1)')} as low, {q('p * exp(q9)')} as high from pairs p join calibration c on c.origin = p.origin and c.horizon = p.horizon")
def fc_15_intervals(spark, sf):
    s = series(spark, sf)
    return naive_pairs(s).join(calibration(s), ["origin", "horizon"]).select("origin", "horizon", r3(F.col("p") * F.exp("q1")).alias("low"), r3(F.col("p") * F.exp("q9")).alias("high"))


@query(with_("series") + ", o as (select max(month) as origin, max(mi) as mi from series where month < date '2001-08-01') select 'v1' as version, origin, h::int as horizon, (origin + h * interval 1 month)::date as target, value as forecast, value > 0 as valid from o cross join (select unnest(range(1, 13)) as h) join series s on s.mi = o.mi + h - 12")
def fc_16_production_rows(spark, sf):
    s = series(spark, sf)
    o = s.filter(F.col("month") < F.lit("2001-08-01").cast("date")).agg(F.max("month").alias("origin"), F.max("mi").alias("omi"))
    rows = o.select("origin", "omi", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("horizon")).withColumn("mi", F.col("omi") + F.col("horizon") - 12)
    return rows.join(s.select("mi", "value"), "mi").select(F.lit("v1").alias("version"), "origin", "horizon", F.add_months("origin", F.col("horizon")).alias("target"), F.col("value").alias("forecast"), (F.col("value") > 0).alias("valid"))


@query(with_("series") + f", {PAIRS_SQL} select origin, horizon, {q('p - a')} as error, {q('100 * (p - a) / a', 6)} as error_pct from pairs where target <= date '2000-12-01'")
def fc_17_realised_errors(spark, sf):
    e = naive_pairs(series(spark, sf)).filter(F.col("target") <= F.lit("2000-12-01").cast("date"))
    return e.select("origin", "horizon", r3(F.col("p") - F.col("a")).alias("error"), r3(100 * (F.col("p") - F.col("a")) / F.col("a"), 6).alias("error_pct"))


@query(with_("series") + "select sha256(string_agg(month || '=' || (value::decimal(18,3))::varchar, ';' order by month)) as hash, count(*)::bigint as n, sum(value::decimal(18,3))::varchar as total, max(month) as last from series")
def fc_18_input_fingerprint(spark, sf):
    exact = F.col("value").cast("decimal(18,3)")
    line = F.concat(F.col("month").cast("string"), F.lit("="), exact.cast("string"))
    return series(spark, sf).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ";"), 256).alias("hash"), F.count("*").alias("n"), F.sum(exact).cast("string").alias("total"), F.max("month").alias("last"))


@query(with_("series") + "select max(month) as last_complete, max(month) > date '2001-06-01' as has_new from series where month < date '2001-08-01'")
def fc_19_new_month_gate(spark, sf, as_of: str = "2001-08-15", done: str = "2001-06-01"):
    last = F.max("month")
    return series(spark, sf).filter(F.col("month") < F.trunc(F.lit(as_of).cast("date"), "month")).agg(last.alias("last_complete"), (last > F.lit(done).cast("date")).alias("has_new"))


@query(with_("series") + f", {ERRORS_SQL} select origin, " + ", ".join(f"max(case when horizon = {h} then e end) as h{h}" for h in range(1, 13)) + ", count(*) = 12 as complete from errors group by 1")
def fc_20_errors_by_origin(spark, sf):
    wide = errors(series(spark, sf)).groupBy("origin").pivot("horizon", list(range(1, 13))).agg(F.max("e"))
    complete = F.lit(True)
    for h in range(1, 13):
        complete = complete & F.col(str(h)).isNotNull()
    return wide.select("origin", *[F.col(str(h)).alias(f"h{h}") for h in range(1, 13)], complete.alias("complete"))


@query(with_("series") + f", {ALL_SQL}, sl as (select 'all' as slice, * from every union all select 'december', * from every where month(origin) = 12) select slice, model, {ACCURACY_SQL} from sl group by 1, 2")
def fc_21_report_by_slice(spark, sf):
    e = every_model(series(spark, sf)).withColumn("slice", F.explode(F.filter(F.array(F.lit("all"), F.when(F.month("origin") == 12, "december")), lambda x: x.isNotNull())))
    out = S.accuracy(e, ["slice", "model"], "p", "a")
    return out.select("slice", "model", "n", *[r3(c, 3 if c in ("mae", "bias") else 6).alias(c) for c in ("mape", "mae", "bias", "bias_pct")])


@query(with_("series") + f", {ALL_SQL} select model, year(target)::bigint as year, {q('100 * avg(abs(p - a) / a)', 6)} as mape from every group by 1, 2")
def fc_22_mape_by_year(spark, sf):
    return every_model(series(spark, sf)).groupBy("model", F.year("target").cast("bigint").alias("year")).agg(r3(100 * F.avg(F.abs(F.col("p") - F.col("a")) / F.col("a")), 6).alias("mape"))


@query(with_("series") + f", {ALL_SQL} select model, origin, count(*)::bigint as pairs from every where year(origin) >= 1999 group by 1, 2")
def fc_23_resumable_results(spark, sf):
    """A first run does the origins of one year and stops; the next one goes on from its markers with the others."""
    every, path = every_model(series(spark, sf)).filter("year(origin) >= 1999"), scratch(spark, "results")
    todo = every.select("model", "origin").distinct()
    pairs = lambda keys: every.join(keys, ["model", "origin"], "left_semi").select("model", "origin", "horizon", "p", "a")
    resumable.resume(todo.filter("year(origin) = 1999"), ["model", "origin"], path, pairs, batches=1)
    return resumable.resume(todo, ["model", "origin"], path, pairs, batches=1).groupBy("model", "origin").agg(F.count("*").alias("pairs"))


@query(with_("series") + f", {ERRORS_SQL} select 'history-1' as version, 'imported' as kind, origin, horizon, e from errors where year(origin) < 1998 union all select 'v1', 'own', origin, horizon, e from errors where year(origin) >= 1998")
def fc_24_imported_errors(spark, sf):
    e = errors(series(spark, sf))
    tag = lambda f, v, k: f.select(F.lit(v).alias("version"), F.lit(k).alias("kind"), "origin", "horizon", "e")
    return tag(e.filter("year(origin) < 1998"), "history-1", "imported").unionByName(tag(e.filter("year(origin) >= 1998"), "v1", "own"))


def _parameters(name: str) -> str:
    return json.dumps({"name": name, "months": 72, "horizons": 12, "penalty": 1.0 if name == "ridge" else None}, sort_keys=True)


@query("select model, parameters, sha256(parameters)[1:12] as version from (values " + ", ".join(f"('{n}', '{_parameters(n)}')" for n in MODELS) + ") t(model, parameters)")
def fc_25_model_registry(spark, sf):
    """Parameters of each model and their hash; a change of a parameter is a new version."""
    rows = spark.createDataFrame([(n, _parameters(n)) for n in MODELS], "model string, parameters string")
    return rows.withColumn("version", F.substring(F.sha2("parameters", 256), 1, 12))
