"""Selection, production rows and contract decisions on fitted models.

Candidates are the seasonal naive, four models fitted at every origin, and two means of them; the chosen one's errors
calibrate its intervals and make the consumption scenarios. The choice is made anew at every origin, from pairs whose target is
known there, so that a backtested decision sees nothing of what came after it. Windows hold MONTHS months: the bound series has 80, and longer
windows would leave no December whose next year is known. A window with a gap or a value that isn't positive has no forecast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import relational as R
from wattframe.operators import resumable
from wattframe.operators import stats as S
from wattframe.operators.models import boosted, ridge, smoothing
from wattframe.operators.state_space import arima
from wattframe.plans import scenario
from wattframe.plans.aggregates import naive_pairs, r3
from wattframe.plans.bindings import series
from wattframe.plans.forecast import LEVELS, errors
from wattframe.registry import query
from wattframe.session import scratch
from wattframe.sources import calendar

MONTHS = 36
MODELS = {
    "ridge": lambda values, last, business: ridge(values, last, business=business), "smoothing": lambda values, last, business: smoothing(values, last),
    "arima": lambda values, last, business: arima(values, last), "boosted": lambda values, last, business: boosted(values, last),
}
MEANS = {"smoothing_arima": ["smoothing", "arima"], "smoothing_arima_ridge": ["smoothing", "arima", "ridge"]}
#: Fixed order of simplicity, the last tie-break.
COMPLEXITY = {"naive": 0, "ridge": 1, "smoothing": 2, "arima": 3, "smoothing_arima": 4, "smoothing_arima_ridge": 5, "boosted": 6}
#: Fixed rule of the choice: points of MAPE that count as a difference, and the share of target years to be better in.
POINTS, YEARS_BETTER = 0.25, 5 / 8
LEAST_ERRORS = 8
MODEL_ROWS = "model string, origin date, horizon int, forecast double"


def windows(spark: SparkSession, s: DataFrame, months: int) -> DataFrame:
    """origin, mi, value, business: each whole window and, without values, the twelve months after it."""
    ahead = Window.partitionBy(F.lit(0)).orderBy("mi").rangeBetween(-(months - 1), 0)
    whole = s.withColumn("n", F.count_if(F.col("value") > 0).over(ahead)).filter(F.col("n") == months)
    reach = whole.select(F.col("month").alias("origin"), F.col("mi").alias("last"), F.explode(F.sequence(F.col("mi") - (months - 1), F.col("mi") + 12)).alias("mi"))
    met = reach.join(calendar.business_days(spark, "1990-01-01", "2035-12-01"), "mi").join(s.select("mi", "value"), "mi", "left")
    return met.select("origin", "mi", F.when(F.col("mi") <= F.col("last"), F.col("value")).alias("value"), "business")


def model_rows(spark: SparkSession, s: DataFrame, names: list[str] | None = None, months: int = MONTHS, wanted: DataFrame | None = None) -> DataFrame:
    """model, origin, horizon, forecast of the single models; a group is one origin's window.

    wanted: the only (model, origin) to fit.
    """
    every = list(MODELS) if names is None else names
    shown = windows(spark, s, months)
    if wanted is None:
        shown = shown.withColumn("names", F.array(*map(F.lit, every)))
    else:
        shown = shown.join(wanted.filter(F.col("model").isin(every)).groupBy("origin").agg(F.array_sort(F.collect_set("model")).alias("names")), "origin")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, names = pdf.sort_values("mi"), list(pdf.names.iloc[0])
        values, business = pdf.value.to_numpy()[:months].astype(float), pdf.business.to_numpy().astype(float)
        last = int(pdf.mi.iloc[months - 1])
        found = [pd.DataFrame({"model": n, "origin": key[0], "horizon": np.arange(1, 13), "forecast": MODELS[n](values, last, business)}) for n in names]
        return pd.concat(found)

    return shown.groupBy("origin").applyInPandas(run, MODEL_ROWS)


def resumed_rows(spark: SparkSession, s: DataFrame, path: str, until: str | None = None, names: list[str] | None = None, months: int = MONTHS, batches: int = resumable.BATCHES) -> DataFrame:
    """model_rows with what an earlier run left at the path; until: the last origin of this run."""
    every = F.explode(F.array(*map(F.lit, names or list(MODELS)))).alias("model")
    todo = windows(spark, s, months).select("origin").distinct().select(every, "origin")
    todo = todo if until is None else todo.filter(F.col("origin") <= F.lit(until).cast("date"))
    return resumable.resume(todo, ["model", "origin"], path, lambda keys: model_rows(spark, s, names, months, keys), batches)


def with_means(rows: DataFrame) -> DataFrame:
    """Adds the means; a mean has a row only where all of its parts have one."""
    of = F.explode(F.array(*[F.struct(F.lit(k).alias("mean"), F.array(*map(F.lit, parts)).alias("parts")) for k, parts in MEANS.items()]))
    met = rows.select("*", of.alias("m")).filter(F.array_contains("m.parts", F.col("model")))
    mean = met.groupBy(F.col("m.mean").alias("model"), "origin", "horizon").agg(F.avg("forecast").alias("forecast"), F.count("forecast").alias("n"), F.max(F.size("m.parts")).alias("k")).filter("n = k")
    return rows.unionByName(mean.drop("n", "k"))


def candidate_pairs(spark: SparkSession, s: DataFrame, months: int = MONTHS) -> DataFrame:
    """model, origin, horizon, target, p, a on the pairs that every model has; written once, since each use would fit the models anew."""
    cols = ["model", "origin", "horizon", "target", "p", "a"]
    naive = naive_pairs(s).withColumn("model", F.lit("naive"))
    known = naive.select("origin", "horizon", "target", "a")
    fitted = with_means(model_rows(spark, s, months=months)).join(known, ["origin", "horizon"]).withColumn("p", r3("forecast"))
    every = naive.select(*cols).unionByName(fitted.select(*cols)).filter("p is not null")
    shared = every.groupBy("origin", "horizon").agg(F.count_distinct("model").alias("n")).filter(F.col("n") == len(COMPLEXITY))
    path = scratch(spark, "candidates")
    R.same_pairs(every, shared, ["origin", "horizon"]).write.parquet(path)
    return spark.read.parquet(path)


def selection(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A row per model with its measures, whether it can be chosen, and whether it is; by: columns that separate choices.

    Eligible are models better than the naive by more than POINTS of MAPE and in YEARS_BETTER of the target years. Of those
    within POINTS of the best the least biased is chosen, then by the December origins' annual error, the worst year and
    simplicity; the naive, where none is eligible.
    """
    by = by or []
    miss = F.abs(F.col("p") - F.col("a")) / F.col("a")
    total = pairs.groupBy(*by, "model").agg(F.count("*").alias("n"), r3(100 * F.avg(miss), 6).alias("mape"), r3(100 * F.avg((F.col("p") - F.col("a")) / F.col("a")), 6).alias("bias"))
    hours = C.hours_in_month("target")
    december = pairs.filter("month(origin) = 12").groupBy(*by, "model", "origin").agg(F.count("*").alias("k"), F.sum(F.col("p") * hours).alias("p"), F.sum(F.col("a") * hours).alias("a")).filter("k = 12")
    december = december.groupBy(*by, "model").agg(r3(100 * F.avg(miss), 6).alias("december_error"))
    years = pairs.groupBy(*by, "model", F.year("target").alias("year")).agg(r3(100 * F.avg(miss), 6).alias("m"))
    naive_years = years.filter("model = 'naive'").select(*by, "year", F.col("m").alias("b"))
    years = years.join(naive_years, [*by, "year"]).groupBy(*by, "model").agg(F.max("m").alias("worst_year"), F.count_if(F.col("m") < F.col("b")).alias("years_better"), F.count("*").alias("years"))
    simple = pairs.sparkSession.createDataFrame(list(COMPLEXITY.items()), "model string, complexity int")
    out = total.join(december, [*by, "model"], "left").join(years, [*by, "model"]).join(simple, "model")
    # One row a model in each choice: what the rest needs are windows over these few.
    choice = Window.partitionBy(*by, *([] if by else [F.lit(0)]))
    naive = F.max(F.when(F.col("model") == "naive", F.col("mape"))).over(choice)
    out = out.withColumn("gain", r3(naive - F.col("mape"), 6))
    out = out.withColumn("eligible", F.coalesce((F.col("model") != "naive") & (F.col("gain") > POINTS) & (F.col("years_better") >= YEARS_BETTER * F.col("years")), F.lit(False)))
    best = F.min(F.when(F.col("eligible"), F.col("mape"))).over(choice)
    order = F.struct(F.abs("bias").alias("a"), F.coalesce("december_error", F.lit(float("inf"))).alias("b"), F.col("worst_year").alias("c"), F.col("complexity").alias("d"))
    near = F.col("eligible") & (F.col("mape") - F.col("__best") <= POINTS)
    out = out.withColumn("__best", best).withColumn("__pick", F.min_by("model", F.when(near, order)).over(choice))
    return out.withColumn("chosen", F.col("model") == F.coalesce("__pick", F.lit("naive"))).drop("__best", "__pick")


def choices(pairs: DataFrame) -> DataFrame:
    """selection() anew at each origin (column at), from the pairs whose target is known there; origins without such pairs have none."""
    origins = pairs.select(F.col("origin").alias("at")).distinct()
    # Months against months: as many rows as the calendar has pairs, whatever the data.
    return selection(pairs.join(origins, F.col("target") <= F.col("at")), ["at"])


def chosen_pairs(pairs: DataFrame) -> DataFrame:
    """origin, horizon, target, p, a of the model chosen at each origin; the naive where nothing is known yet."""
    names = choices(pairs).filter("chosen").select(F.col("at").alias("origin"), F.col("model").alias("__chosen"))
    return pairs.join(names, "origin", "left").filter(F.col("model") == F.coalesce("__chosen", F.lit("naive"))).drop("model", "__chosen")


@query()
def fc_09b_seasonal_arima(spark, sf):
    return model_rows(spark, series(spark, sf), ["arima"], 72).drop("model")


@query()
def fc_10b_ridge_business_days(spark, sf):
    return model_rows(spark, series(spark, sf), ["ridge"], 72).drop("model")


@query()
def fc_12b_fitted_combinations(spark, sf):
    return with_means(model_rows(spark, series(spark, sf))).filter(F.col("model").isin(list(MEANS)))


@query()
def fc_13b_fitted_selection(spark, sf):
    """The choice at each December origin, and the measures of all candidates that it rests on."""
    return choices(candidate_pairs(spark, series(spark, sf))).filter("month(at) = 12")


@query()
def fc_23b_resumed_fits(spark, sf):
    """Ridge fits of a run that stopped in 1999 and of the one after it."""
    s, path = series(spark, sf), scratch(spark, "results")
    resumed_rows(spark, s, path, "1999-06-01", ["ridge"], batches=2)
    return resumed_rows(spark, s, path, names=["ridge"], batches=2)


@query()
def fc_16b_chosen_production(spark, sf):
    return production(spark, series(spark, sf))


def production(spark: SparkSession, s: DataFrame, before: str = "2001-08-01") -> DataFrame:
    """The chosen model's forecasts at the last month before `before`, with bounds from its own errors; later months are not read.

    valid: forecast and bounds positive and in order, from at least LEAST_ERRORS errors of that horizon.
    """
    s = s.filter(F.col("month") < F.lit(before).cast("date"))
    pairs = candidate_pairs(spark, s)
    name = selection(pairs).filter("chosen").select("model")
    last = s.agg(F.max("month").alias("origin"))
    before_it = R.rolling_pairs(s, "month").join(s.select(F.add_months("month", 12).alias("target"), F.col("value").alias("forecast")), "target").select(F.lit("naive").alias("model"), "origin", "horizon", "forecast")
    rows = with_means(model_rows(spark, s)).unionByName(before_it).join(F.broadcast(name), "model").join(F.broadcast(last), "origin")
    known = errors(s, pairs.join(F.broadcast(name), "model", "left_semi"))
    q = S.exact_quantiles(known, ["horizon"], "e", LEVELS)
    bound = lambda level: r3(F.col("forecast") * F.exp(level))
    out = rows.join(q, "horizon", "left").select("model", "origin", "horizon", F.add_months("origin", F.col("horizon")).alias("target"), r3("forecast").alias("forecast"), bound("q025").alias("p025"), bound("q1").alias("p10"), bound("q9").alias("p90"), bound("q975").alias("p975"), "n")
    ordered = (F.col("p025") > 0) & (F.col("p025") <= F.col("p10")) & (F.col("p10") <= F.col("p90")) & (F.col("p90") <= F.col("p975"))
    return out.withColumn("valid", F.coalesce((F.col("forecast") > 0) & ordered & (F.col("n") >= LEAST_ERRORS), F.lit(False)))


@query()
def fc_20b_chosen_errors(spark, sf):
    s = series(spark, sf)
    return errors(s, chosen_pairs(candidate_pairs(spark, s))).select("origin", "horizon", "e")


@query()
def fc_21b_fitted_report(spark, sf):
    e = candidate_pairs(spark, series(spark, sf)).withColumn("slice", F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.month("origin") == 12, "december")))))
    out = S.accuracy(e, ["slice", "model"], "p", "a")
    return out.select("slice", "model", "n", *[r3(c, 3 if c in ("mae", "bias") else 6).alias(c) for c in ("mape", "mae", "bias", "bias_pct")])


def decision_pairs(spark, sf) -> DataFrame:
    """The chosen model's pairs, written once: scenarios, volumes and errors all start from them."""
    path = scratch(spark, "chosen")
    chosen_pairs(candidate_pairs(spark, series(spark, sf))).write.parquet(path)
    return spark.read.parquet(path)


@query()
def sc_04b_chosen_use_scenarios(spark, sf):
    s, pairs = series(spark, sf), decision_pairs(spark, sf)
    return scenario.use_scenarios(s, scenario.draw(scenario.known_vectors(s, pairs)), pairs)


@query()
def ct_06b_chosen_decision(spark, sf):
    best = scenario.decision(spark, sf, pairs=decision_pairs(spark, sf))
    return best.select("origin", "r", r3("volume", 6).alias("volume"), "price", r3("objective", 2).alias("objective"))


@query()
def ct_08b_chosen_realised_cost(spark, sf):
    return scenario.annual(spark, sf, pairs=decision_pairs(spark, sf))
