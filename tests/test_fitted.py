"""Fitted models, their selection, and the sensitivity tables, against plain Python."""

import os
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattframe.operators import models, state_space
from wattframe.plans import fitted, scenario, sensitivity
from wattframe.plans.bindings import series
from wattframe.sources import calendar

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def month(k):
    return date(k // 12, k % 12 + 1, 1)


def test_arima_continues_growth_and_season():
    y = np.exp(0.01 * np.arange(84) + np.tile(np.sin(np.arange(12)), 7))
    assert np.allclose(state_space.arima(y[:72], 100), y[72:], rtol=1e-6)


@pytest.mark.parametrize("weights", [(0.5, 0.3, -0.4, -0.6), (0, 0, 0.9, -0.9), (-0.8, 0.9, 0.2, 0.1), (0, 0, 0, 0), (0.7, 0, 0, -0.5)])
def test_likelihood_equals_the_normal_density(weights):
    """Autocovariances from the weights of all past shocks, the density by Cholesky."""
    w, weights = np.random.default_rng(3).normal(size=40), np.array(weights, dtype=float)
    values, shocks = state_space.polynomials(weights)
    psi = np.zeros(6000)
    psi[:14] = np.r_[1.0, shocks]
    for k in range(1, len(psi)):
        psi[k] += sum(values[j - 1] * psi[k - j] for j in (1, 12, 13) if k >= j)
    cov = np.array([psi[: len(psi) - h] @ psi[h:] for h in range(40)])[np.abs(np.subtract.outer(np.arange(40), np.arange(40)))]
    root = np.linalg.cholesky(cov)
    z = np.linalg.solve(root, w)
    variance = z @ z / 40
    density = -0.5 * (40 * np.log(2 * np.pi * variance) + 40) - np.log(np.diag(root)).sum()
    assert state_space.log_likelihood(w, weights) == pytest.approx((density, variance), abs=1e-8)
    # The forecast is the conditional mean of the same density.
    model = state_space.StateSpace.of(weights)
    joint = np.array([psi[: len(psi) - h] @ psi[h:] for h in range(46)])[np.abs(np.subtract.outer(np.arange(46), np.arange(46)))]
    assert np.allclose(model.ahead(model.filter(w)[2], 6), joint[40:, :40] @ np.linalg.solve(cov, w), atol=1e-8)


@pytest.mark.parametrize("orders", state_space.ORDERS)
def test_simplex_finds_the_best_likelihood_of_a_grid(orders):
    rng = np.random.default_rng(5)
    w = np.convolve(rng.normal(size=71), np.r_[1, -0.5, np.zeros(10), -0.4, 0.2])[13:-13]
    found = state_space.fit(w, orders)
    free = np.array([orders[0][0], orders[1][0], orders[0][1], orders[1][1]], dtype=bool)
    axes = np.meshgrid(*[np.linspace(-0.95, 0.95, 13)] * int(free.sum()))
    best = -np.inf
    for point in np.stack([x.ravel() for x in axes], axis=1):
        weights = np.zeros(4)
        weights[free] = point
        best = max(best, state_space.log_likelihood(w, weights)[0])
    assert found.likelihood >= best - 1e-3 and not found.weights[~free].any()
    assert state_space.log_likelihood(w, found.weights) == pytest.approx((found.likelihood, found.variance))


def test_ridge_with_business_days_by_gradient():
    rng = np.random.default_rng(2)
    y, last, business = 100 + rng.normal(size=72), 2000 * 12 + 5, rng.integers(18, 24, 84).astype(float)
    months = last + np.arange(-71, 13)
    days = [pd.Period(year=m // 12, month=m % 12 + 1, freq="M").days_in_month for m in months]
    x = np.c_[(months - last) / 12.0, [[m % 12 == k for k in range(1, 12)] for m in months], np.log(days), np.log(business)].astype(float)
    z = (x - x[:72].mean(0)) / x[:72].std(0, ddof=1)
    t, b = np.log(y), np.zeros(z.shape[1])
    for _ in range(20000):
        b -= 0.002 * (z[:72].T @ (z[:72] @ b - (t - t.mean())) + b)
    assert np.allclose(models.ridge(y, last, business=business), np.exp(t.mean() + z[72:] @ b), rtol=1e-6)


def test_business_days(spark):
    got = {r.mi: r.business for r in calendar.business_days(spark, "1998-12-01", "2001-02-01").collect()}
    assert len(got) == 27
    assert got[1998 * 12 + 11] == 22  # Christmas on a Friday, before the lists' first year
    assert got[2001 * 12] == 22 and got[2001 * 12 + 1] == 19  # New Year on a Monday; Carnival Tuesday


def test_windows_need_every_month_above_zero(spark):
    s = spark.createDataFrame([(month(24000 + k), 24000 + k, 0.0 if k == 30 else 1.0 + k) for k in range(70) if k != 9], "month date, mi int, value double")
    got = fitted.windows(spark, s, 12).toPandas()
    assert set(got.origin) == {month(24000 + k) for k in [*range(21, 30), *range(42, 70)]}
    one = got[got.origin == month(24000 + 21)].sort_values("mi")
    assert list(one.mi) == list(range(24010, 24034)) and list(one.value[:12]) == [1.0 + k for k in range(10, 22)] and one.value[12:].isna().all()
    assert fitted.model_rows(spark, s.limit(0), months=12).count() == 0


def test_means_need_all_parts(spark):
    rows = [("smoothing", date(2000, 1, 1), 1, 2.0), ("ridge", date(2000, 1, 1), 1, 9.0), ("smoothing", date(2000, 2, 1), 1, 2.0), ("arima", date(2000, 2, 1), 1, 4.0)]
    got = fitted.with_means(spark.createDataFrame(rows, fitted.MODEL_ROWS)).filter(F.col("model").isin(list(fitted.MEANS))).collect()
    assert [(r.model, r.origin, r.forecast) for r in got] == [("smoothing_arima", date(2000, 2, 1), 3.0)]


def plain_selection(df):
    out = {}
    naive = {}
    for name in sorted(set(df.model), key=lambda n: n != "naive"):
        d = df[df.model == name]
        miss = (d.p - d.a).abs() / d.a
        years = {y: 100 * miss[[t.year == y for t in d.target]].mean() for y in {t.year for t in d.target}}
        if name == "naive":
            naive = years
        out[name] = {"mape": 100 * miss.mean(), "bias": 100 * ((d.p - d.a) / d.a).mean(), "worst": max(years.values()), "better": sum(years[y] < naive[y] for y in years), "years": len(years)}
    return out


@pytest.mark.parametrize("skill", [0.2, 3.0])
def test_selection_by_loops(spark, skill):
    rng = np.random.default_rng(8)
    rows = []
    for o in range(24000, 24048):
        for h in range(1, 13):
            a = 100 + 10 * rng.random()
            for k, name in enumerate(fitted.COMPLEXITY):
                noise = 1.0 if name == "naive" else skill * (1 + k / 50)
                rows.append((name, month(o), h, month(o + h), float(round(a * (1 + 0.05 * noise * rng.normal()), 3)), float(round(a, 3))))
    df = pd.DataFrame(rows, columns=["model", "origin", "horizon", "target", "p", "a"])
    got = fitted.selection(spark.createDataFrame(df, "model string, origin date, horizon int, target date, p double, a double")).toPandas().set_index("model")
    want = plain_selection(df)
    for name, w in want.items():
        g = got.loc[name]
        assert (g.mape, g.bias, g.worst_year) == pytest.approx((w["mape"], w["bias"], w["worst"]), abs=2e-6) and (g.years_better, g.years) == (w["better"], w["years"])
        d = df[(df.model == name) & np.array([o.month == 12 for o in df.origin])]
        hours = np.array([pd.Period(t, "M").days_in_month * 24 for t in d.target])
        errors = [abs((x.p * hours[i] - x.a * hours[i]).sum()) / (x.a * hours[i]).sum() * 100 for i, x in ((np.flatnonzero(d.origin == o), d[d.origin == o]) for o in sorted(set(d.origin)))]
        assert g.december_error == pytest.approx(np.mean(errors), abs=2e-6)
    able = [n for n, w in want.items() if n != "naive" and want["naive"]["mape"] - w["mape"] > 0.25 and w["better"] >= 5 / 8 * w["years"]]
    assert sorted(got.index[got.eligible]) == sorted(able)
    best = min((want[n]["mape"] for n in able), default=0)
    near = [n for n in able if want[n]["mape"] - best <= 0.25]
    pick = min(near, key=lambda n: abs(want[n]["bias"])) if near else "naive"
    assert list(got.index[got.chosen]) == [pick] and (pick == "naive") == (skill > 1)


def test_choices_see_nothing_of_what_comes_after(spark):
    """All values after an origin are corrupted: choices and chosen forecasts up to it stay, those after it don't."""
    rng = np.random.default_rng(21)
    values = np.exp(0.01 * np.arange(60) + 0.2 * np.tile(np.sin(np.arange(12)), 5) + 0.02 * rng.normal(size=60)) * 100
    at = 24000 + 50

    def chosen(v):
        s = spark.createDataFrame([(month(24000 + k), 24000 + k, float(x)) for k, x in enumerate(v)], "month date, mi int, value double")
        pairs = fitted.candidate_pairs(spark, s, months=30)
        picks = {r["at"]: r.model for r in fitted.choices(pairs).filter("chosen").collect()}
        return picks, {(r.origin, r.horizon): r.p for r in fitted.chosen_pairs(pairs).collect()}

    picks, p = chosen(values)
    after, q = chosen(np.r_[values[:51], values[51:] * rng.uniform(0.2, 5, 9)])
    upto = lambda d: {k: v for k, v in d.items() if (k[0] if isinstance(k, tuple) else k) <= month(at)}
    assert upto(picks) == upto(after) and upto(p) == upto(q) and upto(p) and p != q
    assert set(picks.values()) - {"naive"}


@needs_tables
def test_chosen_forecasts_reach_production_and_decisions(spark):
    s = series(spark, SF)
    rows = fitted.production(spark, s).toPandas().sort_values("horizon")
    assert list(rows.horizon) == list(range(1, 13)) and rows.valid.all() and rows.model.nunique() == 1
    pairs = fitted.decision_pairs(spark, SF)
    volume = scenario.point_volume(s, pairs).toPandas().set_index("origin").volume
    p = pairs.toPandas()
    for origin, v in volume.items():
        mine = p[p.origin == origin]
        hours = np.array([pd.Period(t, "M").days_in_month * 24 for t in mine.target])
        assert v == pytest.approx(scenario.SCALE * (mine.p * hours).sum() / hours.sum(), abs=2e-6)
    assert not volume.equals(scenario.point_volume(s).toPandas().set_index("origin").volume)


@needs_tables
def test_sensitivity_tables_by_loops(spark):
    """Given ratios stand for the optimised ones; base and two variants share some of them."""
    origins = sorted(r.origin for r in scenario.decision_origins(series(spark, SF)).collect())
    ratio = {(v, o): 1.0 + 0.01 * k * (v == "f05" or k == 1 and v == "spread40") for v in ("base", "f05", "spread40", "lam10") for k, o in enumerate(origins)}
    chosen = spark.createDataFrame([(v, o, r) for (v, o), r in ratio.items()], "id string, origin date, r double")
    got = sensitivity.backtest(spark, SF, chosen).filter("id in ('base', 'f05', 'spread40', 'lam10')")
    rows = got.toPandas()
    point = {r.origin: r.volume for r in scenario.point_volume(series(spark, SF)).collect()}
    s, spot = series(spark, SF).toPandas(), scenario.spot(spark, SF).toPandas().set_index("month").price
    price = {r.origin: r.price for r in scenario.contract_price(spark, SF, 0.0).collect()}
    terms = {"base": (0.1, 20.0), "f05": (0.05, 20.0), "spread40": (0.1, 40.0), "lam10": (0.1, 20.0)}
    assert len(rows) == 4 * 3 * len(origins)
    for r in rows.itertuples():
        band, spread = terms[r.id]
        if r.strategy == "optimised":
            assert r.volume == pytest.approx(round(ratio[r.id, r.origin] * point[r.origin], 6), abs=1e-6)
        cost = short = surplus = outside = 0
        for m in s[[m.year == r.origin.year + 1 for m in s.month]].itertuples():
            hours = pd.Period(m.month, "M").days_in_month * 24
            use, have = scenario.SCALE * m.value * hours, r.volume * hours
            taken = min(max(use, have * (1 - band)), have * (1 + band))
            cost += taken * (price[r.origin] + spread) + (use - taken) * spot[m.month]
            short, surplus = short + max(use - have * (1 + band), 0), surplus + max(have * (1 - band) - use, 0)
            outside += use > have * (1 + band) or use < have * (1 - band)
        assert (r.cost, r.short, r.surplus) == pytest.approx((cost, short, surplus), abs=0.011) and r.months_outside == outside
    saved = sensitivity.savings(got, sensitivity.variants(spark)).toPandas()
    wide = rows.pivot_table(index=["id", "origin"], columns="strategy", values="cost")
    for name in terms:
        w = wide.loc[name]
        total = saved[(saved.id == name) & saved.year.isna()].iloc[0]
        single = 100 * (1 - w.optimised / w.naive)
        assert total.saving_pct == pytest.approx(100 * (1 - w.optimised.sum() / w.naive.sum()), abs=1e-4)
        assert total.worst_saving_pct == pytest.approx(single.min(), abs=1e-4) and single[date(int(total.worst_year) - 1, 12, 1)] == pytest.approx(single.min())
        assert total.forecast_value == pytest.approx((w.naive - w.point).sum(), abs=0.02)
    same = sensitivity.invariances(got).toPandas().set_index("id")
    assert same.loc["lam10"].drop("years_same_ratio").drop("n_same_ratio").all() and same.loc["lam10"].n_same_ratio == len(origins)
    assert not same.loc["f05"].naive_cost_same and same.loc["f05"].naive_volume_same and not same.loc["f05"].naive_exposure_same
    assert not same.loc["spread40"].point_cost_same and same.loc["spread40"].point_exposure_same
    assert same.loc["spread40"].years_same_ratio == " ".join(str(o.year + 1) for k, o in enumerate(origins) if k != 1)
