"""Values of queries that SQL can't say, against plain Python."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattframe import registry
from wattframe.operators import models
from wattframe.plans import assertions, quality, scenario
from wattframe.plans.bindings import series

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def plain_choice(pairs, candidates, alpha, weight):
    """Least mean cost plus weighted tail of a decision, by loops; ties go to the ratio closest to 1."""
    found = []
    for c in candidates.itertuples():
        contracted = c.volume * pairs.hours
        within = pairs.use.clip(contracted * (1 - c.band), contracted * (1 + c.band))
        cost = (within * c.price + (pairs.use - within) * pairs.spot).groupby(pairs.scenario).sum().sort_values(ascending=False).to_numpy()
        share = np.clip((1 - alpha) * len(cost) - np.arange(len(cost)), 0, 1)
        found.append((cost.mean() + weight * (share * cost).sum() / share.sum(), c.r))
    low = min(found)[0]
    return min((abs(r - 1), r) for o, r in found if o <= low + 1e-9 * max(1.0, abs(low)))[1]


def test_every_sensitivity_has_its_decision(spark, monkeypatch):
    monkeypatch.setattr(scenario, "N", 40)
    for f in (scenario.draw, scenario.simple_bootstrap, scenario.block_bootstrap):
        monkeypatch.setattr(f, "__defaults__", tuple(40 if d == 2000 else d for d in f.__defaults__))
    got = scenario.ct_16_sensitivity_batch(spark, SF).toPandas()
    assert set(got.id) == {n for n, _, _ in scenario.SENSITIVITIES}
    assert not got.duplicated(["id", "origin"]).any() and got.groupby("id").size().nunique() == 1
    base = scenario.candidates(spark, SF).toPandas()
    origin = max(got.origin)
    for name, change, alpha, weight in (("alpha90", {}, 0.9, scenario.WEIGHT), ("lam10", {}, scenario.ALPHA, 1.0), ("disp150", {"dispersion": 1.5}, scenario.ALPHA, scenario.WEIGHT), ("simple", {"method": "simple"}, scenario.ALPHA, scenario.WEIGHT), ("clip", {"shift": False}, scenario.ALPHA, scenario.WEIGHT)):
        pairs = scenario.paired(spark, SF, **change).toPandas()
        want = plain_choice(pairs[pairs.origin == origin], base[base.origin == origin], alpha, weight)
        assert got[(got.id == name) & (got.origin == origin)].r.item() == pytest.approx(want), name


@pytest.fixture(scope="module")
def windows(spark):
    s = series(spark, SF).toPandas().sort_values("mi").reset_index(drop=True)
    return {s.month[k]: (s.value.to_numpy()[k - 71 : k + 1], int(s.mi[k])) for k in range(71, len(s)) if s.mi[k] - s.mi[k - 71] == 71}


@pytest.mark.parametrize(("name", "model"), [("fc_08_smoothing", models.smoothing), ("fc_09_autoregression", models.autoregression), ("fc_10_ridge", models.ridge), ("fc_11_boosted", models.boosted)])
def test_models_see_their_own_window(spark, windows, name, model):
    """Every origin with 72 gapless months, twelve horizons, and the forecast of that window alone."""
    got = registry.queries()[name](spark, SF).toPandas()
    assert set(got.origin) == set(windows) and (got.groupby("origin").horizon.apply(lambda h: sorted(h) == list(range(1, 13)))).all()
    for origin in list(windows)[:: max(1, len(windows) // 3)]:
        mine = got[got.origin == origin].sort_values("horizon").forecast.to_numpy()
        assert np.allclose(mine, model(*windows[origin]), rtol=1e-9)


def test_ridge_by_gradient():
    """The penalised optimum, found by descent instead of normal equations."""
    rng = np.random.default_rng(1)
    y = 100 + 10 * np.sin(np.arange(72) / 6) + rng.normal(size=72)
    last = 2000 * 12 + 5
    months = last + np.arange(-71, 13)
    days = [pd.Period(year=m // 12, month=m % 12 + 1, freq="M").days_in_month for m in months]
    x = np.c_[(months - last) / 12.0, [[m % 12 == k for k in range(1, 12)] for m in months], np.log(days)].astype(float)
    z = (x - x[:72].mean(0)) / x[:72].std(0, ddof=1)
    t, b = np.log(y), np.zeros(z.shape[1])
    for _ in range(20000):
        b -= 0.002 * (z[:72].T @ (z[:72] @ b - (t - t.mean())) + b)
    assert np.allclose(models.ridge(y, last), np.exp(t.mean() + z[72:] @ b), rtol=1e-6)


def test_autoregression_continues_its_own_process():
    """A series that follows the recursion exactly is continued by it."""
    d = [0.02, -0.01]
    for _ in range(82):
        d.append(0.001 + 0.5 * d[-1] - 0.2 * d[-2])
    log = list(np.log(100 + np.arange(12)))
    for x in d:
        log.append(log[-12] + x)
    y = np.exp(np.array(log))
    assert np.allclose(models.autoregression(y[:72], 100), y[72:84], rtol=1e-3)


def test_smoothing_and_boosting_of_an_even_season():
    y = np.tile(100 + 10 * np.arange(12.0), 6)
    assert np.allclose(models.smoothing(y, 100), y[:12], rtol=1e-6)
    assert np.allclose(models.boosted(y, 100), y[:12], rtol=1e-6) and np.allclose(models.boosted(y * np.repeat(1.1 ** np.arange(6), 12), 100), y[:12] * 1.1**6, rtol=1e-6)


def test_assertion_suite_counts_offending_rows(spark):
    some = quality.ASSERTIONS[:2]
    got = {r.name: (r.n, r.verdict) for r in quality.run_assertions(spark, SF, some).collect()}
    for a in some:
        n = len(a.rows(spark, SF).collect())
        assert got[a.name] == (n, "pass" if n == 0 else a.severity)


def _scaled(name, column, factor):
    real = getattr(assertions, name)
    return lambda *a: real(*a).withColumn(column, F.col(column) * factor)


@pytest.mark.parametrize(
    ("assertion", "broken"),
    [("temperature_plausible", ("states", "temperature", 1e6)), ("use_reconciles", ("consumption", "mwh", 1.01)), ("price_within_limits", ("sc_07_price_transform", "shifted", 1e6)), ("sources_keep_their_rows", None), ("null_exceptions_still_there", None)],
)
def test_assertions_that_broken_inputs_fail(spark, monkeypatch, assertion, broken):
    rows = getattr(assertions, assertion)
    hours = spark.range(48).select(F.lit("M").alias("market"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int))").alias("hour"), F.lit(100.0).alias("load"))
    if assertion == "use_reconciles":  # the smallest tables have no whole day
        monkeypatch.setattr(assertions, "hourly", lambda *a: hours)
        use = spark.createDataFrame([(dt.date(2024, 1, 1), 2.0), (dt.date(2024, 1, 1), 0.5)], "day date, profile double")
        monkeypatch.setattr(assertions, "consumption", lambda *a: use.withColumn("mwh", assertions.P.consumer_k * 100.0 * F.col("profile")))
    before = rows(spark, SF).count()
    if broken:
        monkeypatch.setattr(assertions, broken[0], _scaled(*broken))
    elif assertion == "sources_keep_their_rows":
        real = assertions.regional_orders
        monkeypatch.setattr(assertions, "regional_orders", lambda *a: real(*a).filter("n_nationkey <> 3"))
    else:
        monkeypatch.setattr(assertions, "hourly", lambda *a: hours)
        assert rows(spark, SF).count() == 2  # both cut days are whole by now
        return
    assert before == 0 < rows(spark, SF).count()
