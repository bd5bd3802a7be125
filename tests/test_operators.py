import datetime as dt
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wattframe import registry
from wattframe.operators import contract as K
from wattframe.operators import models
from wattframe.operators import relational as R
from wattframe.operators import stats as S
from wattframe.plans import bindings, domain, joins
from wattframe.sources import calendar


def test_latest_wins_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "c"), (None, 1, "d")], "k int, t int, v string")
    got = {(r.k, r.v) for r in R.latest_wins(df, ["k"], [F.desc("t"), F.desc("v")]).collect()}
    assert got == {(1, "b"), (2, "c"), (None, "d")}


def test_fill_is_bounded(spark):
    h = lambda n: dt.datetime(2024, 1, 1, n)
    df = spark.createDataFrame([("s", h(0), 1.0), ("s", h(5), 2.0)], "state string, utc timestamp_ntz, t double")
    got = [(r.t, r.imputed) for r in R.fill_forward(R.complete_grid(df, "state", "utc", "1 hour"), "state", "utc", "t", 3).orderBy("utc").collect()]
    assert got == [(1.0, False), (1.0, True), (1.0, True), (1.0, True), (None, False), (2.0, False)]


def test_overlap_join_counts_each_pair_once(spark):
    at = lambda *x: dt.datetime(*x)
    a = spark.createDataFrame([(1, at(2024, 1, 28), at(2024, 3, 3)), (2, at(2024, 2, 1), at(2024, 2, 1))], "id int, a timestamp_ntz, b timestamp_ntz")
    m = spark.createDataFrame([(at(2024, k, 1), at(2024, k + 1, 1)) for k in range(1, 5)], "m0 timestamp_ntz, m1 timestamp_ntz")
    got = sorted((r.id, r.m0.month, (r.overlap_end - r.overlap_start).days) for r in R.overlap_join(a, m, "a", "b", "m0", "m1").collect())
    assert got == [(1, 1, 4), (1, 2, 29), (1, 3, 2)]


def test_entities_are_written_once_inside(spark, tmp_path):
    """Branches that share a monthly series read its table, not the orders again; outside nothing is kept."""
    at = lambda *x: dt.datetime(*x)
    spark.createDataFrame([(at(2024, k % 3 + 1, 5), float(k)) for k in range(9)], "o_orderdate timestamp_ntz, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    sf = str(tmp_path)
    plain = bindings.series(spark, sf)
    with bindings.written_once():
        one, two = bindings.series(spark, sf), bindings.series(spark, sf)
    for df in (one, two, one.join(two.select("month"), "month").select(one.columns)):
        assert sorted(df.collect()) == sorted(plain.collect()) and df.columns == plain.columns
    assert one.inputFiles() == two.inputFiles() and not any("orders" in f for f in one.inputFiles())
    assert all("orders" in f for f in bindings.series(spark, sf).inputFiles())


def test_scenarios_pair_without_making_pairs(spark, tmp_path):
    """join_17 with repeated keys and nulls: as its SQL has it, and no join in the plan."""
    rows = [(1, 1, 2.0, 1.0), (1, 1, 3.0, 1.0), (1, 2, 5.0, 1.0), (2, 1, 4.0, 1.0), (2, 2, None, 1.0), (3, 2, 1.0, 1.0), (4, 1, None, 1.0), (None, 1, 1.0, 1.0), (5, None, 1.0, 1.0), (5, 1, 7.0, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    out = joins.join_17_scenario_pairing(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    want = sorted(con.execute(registry.oracle_sql()["join_17_scenario_pairing"]).fetchall())
    assert sorted(map(tuple, out.collect())) == want and [r[0] for r in want] == [2, 4, 5]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_intervals_meet_a_calendar_without_a_shuffle(spark, tmp_path):
    """join_10's rows by order and month aren't shuffled, however large the orders that its months come from."""
    at = lambda *x: dt.datetime(*x)
    spark.createDataFrame([(1, at(2024, 1, 28)), (1, at(2024, 2, 28)), (2, at(2024, 2, 1))], "l_orderkey long, l_shipdate timestamp_ntz").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(at(2024, k, 5),) for k in range(1, 5)], "o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = joins.join_10_interval_overlap(spark, str(tmp_path))
        got = sorted((r.id, r.month.month, r.days) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(1, 1, 4), (1, 2, 29), (1, 3, 1), (2, 2, 3)]
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_closing_run_needs_a_next_month(spark):
    rows = [("a", m, f) for m, f in [(1, True), (2, False), (3, True), (4, True), (5, False)]] + [("b", 1, False), ("b", 2, True)]
    got = {r.k: r.closed_at for r in R.closing_run(spark.createDataFrame(rows, "k string, m int, f boolean"), "k", "m", "f", 2).collect()}
    assert got == {"a": 3}


def test_carry_forward_marks_what_is_assumed(spark):
    known = spark.createDataFrame([(2000, 1.0), (2001, 2.0)], "y int, v double")
    wanted = spark.createDataFrame([(1999,), (2001,), (2003,)], "y int")
    got = sorted((r.y, r.v, r.assumed) for r in R.carry_forward(known, wanted, "y", "v").collect())
    assert got == [(1999, None, False), (2001, 2.0, False), (2003, 2.0, True)]


@pytest.mark.parametrize(("values", "alpha", "expected"), [([1, 2, 3, 4], 0.75, 4.0), ([1, 2, 3, 4], 0.5, 3.5), ([1, 2, 3, 4], 0.6, (4 + 0.6 * 3) / 1.6), ([5], 0.95, 5.0)])
def test_cvar_takes_a_fraction_of_the_last_item(spark, values, alpha, expected):
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    assert S.upper_cvar(df, ["k"], "v", alpha).first().cvar == pytest.approx(expected)


def test_repeated_minimum_statuses(spark):
    rows = [(2001, b, 10.0) for b in range(3)] + [(2001, 9, 11.0)] + [(2002, 1, 9.0), *[(2002, b, 9.5) for b in range(3)]] + [(2003, 1, 8.0), (2003, 2, 8.5)]
    got = {r.year: (r.status, r.floor) for r in S.repeated_minimum(spark.createDataFrame(rows, "year int, block int, v double"), "year", "block", "v").collect()}
    assert got[2001][0] == "detected" and float(got[2001][1]) == 10.0
    assert got[2002] == ("repeated_above", None) and got[2003] == ("single_minimum", None)


def test_gaps_are_not_extrapolated(spark):
    df = spark.createDataFrame([(1, None), (2, 10.0), (3, None), (4, None), (5, 40.0), (6, None)], "y int, v double")
    got = {r.y: (r.line, r.low, r.high) for r in S.between_known(df, "y", "v").collect()}
    assert got[1] == (None, None, None) and got[6] == (None, None, None)
    assert got[3] == (20.0, 10.0, 40.0)


def test_cost_inside_and_outside_the_band(spark):
    lit = lambda x: F.lit(float(x))
    cost = lambda use: spark.range(1).select(K.monthly_cost(lit(use), lit(1), lit(100), lit(0.1), lit(10), lit(50)).alias("c")).first().c
    assert cost(105).cost == 1050 and cost(105).short == 0
    assert cost(130).cost == pytest.approx(110 * 10 + 20 * 50) and cost(130).short == pytest.approx(20)
    assert cost(60).cost == pytest.approx(90 * 10 - 30 * 50) and cost(60).surplus == pytest.approx(30)


def test_choice_is_the_brute_force_optimum(spark):
    rng = np.random.default_rng(1)
    use, spot = rng.uniform(80, 120, (20, 12)), rng.uniform(20, 80, (20, 12))
    scenarios = spark.createDataFrame([("o", s, float(use[s, h]), float(spot[s, h]), 1.0) for s in range(20) for h in range(12)], "origin string, scenario int, use double, spot double, hours double")
    grid = K.ratio_grid(spark.createDataFrame([(0.1,)], "band double"))
    cands = grid.select(F.lit("o").alias("origin"), "r", (F.col("r") * 100).alias("volume"), "band", F.lit(45.0).alias("price"))
    best = K.choose(K.evaluate(scenarios, cands, ["origin"]), ["origin"]).first()
    objective = {}
    for r in [x.r for x in grid.collect()]:
        e = np.clip(use, r * 100 * 0.9, r * 100 * 1.1)
        year = np.sort((e * 45 + (use - e) * spot).sum(axis=1))[::-1]
        objective[r] = year.mean() + 0.5 * year[0]
    assert best.objective == pytest.approx(min(objective.values()))
    assert len(objective) == 83


def test_grid_and_holidays(spark):
    assert calendar.holidays(spark).count() == 285
    assert calendar.hours(spark).count() == 271_752
    double = calendar.holidays(spark).filter("day = '2000-04-21'").first()
    assert double.name == "Good Friday; Tiradentes"
    regulated = {r.y: r.n for r in calendar.regulated_holidays(calendar.holidays(spark)).groupBy(F.year("day").alias("y")).agg(F.count("*").alias("n")).collect()}
    assert regulated.pop(2000) == 10 and set(regulated.values()) == {11}


def test_staging_drops_skipped_hours_before_it_deduplicates(spark):
    rows = [("SE", "2018-11-04 00:00:00", "", 9), ("SE", "2018-11-04 01:00:00", "5.0", 1), ("SE", "2018-11-04 01:00:00", "6.0", 2)]
    got = domain.staged_load(spark.createDataFrame(rows, "area string, local string, load string, loaded int")).collect()
    assert [(r.load, r.utc) for r in got] == [(6.0, dt.datetime(2018, 11, 4, 3))]


@pytest.mark.parametrize("model", [models.smoothing, models.autoregression, models.ridge, models.boosted])
def test_models_follow_a_seasonal_series(model):
    t = np.arange(84)
    y = 1000 * (1 + 0.002 * t) * (1 + 0.1 * np.sin(2 * np.pi * t / 12))
    assert np.abs(model(y[:72], 2006 * 12 + 11) / y[72:] - 1).mean() < 0.03


@pytest.mark.parametrize("buckets", [2, S.BUCKETS])
def test_selected_quantiles_equal_the_sorted_ones(spark, monkeypatch, buckets):
    """Groups of one value, of two, of ties, of denormals, of the widest range, null keys; nulls and NaN take no part."""
    monkeypatch.setattr(S, "BUCKETS", buckets)
    rng = np.random.default_rng(9)
    groups = {
        "one": [3.5], "two": [1.0, 2.0], "ties": [7.0] * 50 + [8.0], "tiny": [0.0, 5e-324, 1e-323, 1.0], "wide": [-1.7e308, 1.7e308, 0.0, 1.0, -2.5], None: list(rng.normal(size=200)),
        "skewed": list(np.exp(rng.normal(size=300) * 20)), "cents": list(np.round(rng.uniform(0, 100, 500), 2)), "odd": [float("nan"), 1.0, 2.0, 4.0],
    }
    if buckets == 2:  # two buckets halve a range: only what doesn't take a thousand passes
        groups = {k: v for k, v in groups.items() if k in ("one", "two", "ties", "odd")}
    df = spark.createDataFrame([(k, None if x is None else float(x)) for k, v in groups.items() for x in [*v, None]], "k string, x double")
    levels = [0.0, 0.025, 0.25, 0.5, 0.9, 1.0]
    got = {r[0]: r[1:] for r in S.selected_quantiles(df, ["k"], "x", levels).collect()}
    assert set(got) == set(groups)
    for k, v in groups.items():
        v = sorted(x for x in v if x == x)
        assert got[k][0] == len(v)
        for level, x in zip(levels, got[k][1:], strict=True):
            at = level * (len(v) - 1)
            a, b = v[math.floor(at)], v[math.ceil(at)]
            assert x == pytest.approx(a if a == b else a * (math.ceil(at) - at) + b * (at - math.floor(at)), rel=1e-12, abs=5e-324), (k, level)


def test_selected_quantiles_of_the_whole_table(spark):
    df = spark.range(20_000).select((F.pmod(F.xxhash64("id"), F.lit(9973)) / 7).alias("x"), F.lit(1).alias("v"))
    levels = [0.01, 0.5, 0.99]
    want = df.agg(F.percentile("x", F.array(*map(F.lit, levels)))).first()[0]
    got = S.selected_quantiles(df, [], "x", levels).first()
    assert got[0] == 20_000 and list(got[1:]) == pytest.approx(want)
    assert S.selected_quantiles(df.limit(0), [], "x", levels).count() == 0
    assert S.selected_quantiles(df.limit(5), [], "x", levels, least=6).count() == 0
    with pytest.raises(ValueError):
        S.selected_quantiles(df.select(F.lit(float("inf")).alias("x")), [], "x", levels)
