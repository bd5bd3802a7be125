"""Tables on the sensitivities of the contract decision, and the stability of its tail over seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import contract as K
from wattframe.operators import stats as S
from wattframe.plans import scenario
from wattframe.plans.aggregates import naive_pairs, q, r3
from wattframe.plans.bindings import series, with_, written_once
from wattframe.plans.scenario import ALPHA, BAND, DRAW, HOURS, KNOWN_SQL, N, SCALE, SENSITIVITIES, SPREAD
from wattframe.registry import query
from wattframe.session import scratch

#: Seeds of the stability of the tail, and the numbers of scenarios it is measured at.
SEEDS, SIZES = 30, (500, N)
TOLERANCE, SAME_RATIO = 1e-5, 1e-6

_TAIL = "sum(least(1.0::double, greatest(0.0::double, (1.0::double - {a}::double) * n - (r - 1))) * total) / sum(least(1.0::double, greatest(0.0::double, (1.0::double - {a}::double) * n - (r - 1))))".format(a=ALPHA)
STABILITY_SQL = (
    f"{KNOWN_SQL}, totals as (select k.origin, k.i, k.n, {q(f'sum({SCALE} * p.p * exp(k.v[p.horizon]) * {HOURS.format('p.target')})')} as total from known k join pairs p on p.origin = k.origin group by 1, 2, 3, k.vector), "
    f"exact as (select origin, {_TAIL} as exact from (select origin, n, total, row_number() over (partition by origin order by total desc) as r from totals) group by 1), "
    f"drawn as (select o.origin, seed, s, t.total from (select distinct origin, n from totals) o cross join (select unnest(range(0, {SEEDS})) as seed) cross join (select unnest(range(0, {max(SIZES)})) as s) join totals t on t.origin = o.origin and t.i = {DRAW.format('''concat(seed, ':', o.origin, ':', s)''', 'o.n')}), "
    f"ranked as (select origin, size, seed, total, size as n, row_number() over (partition by origin, size, seed order by total desc) as r from drawn cross join (select unnest([{', '.join(map(str, SIZES))}]) as size) where s < size), "
    f"tails as (select origin, size, seed, {_TAIL} as cvar from ranked group by 1, 2, 3) "
    f"select origin, size::int as size, count(*)::bigint as seeds, {q('any_value(exact)')} as exact, {q('100 * stddev_pop(cvar) / any_value(exact)', 4)} as sd_pct, {q('100 * (avg(cvar) / any_value(exact) - 1)', 4)} as bias_pct from tails join exact using (origin) group by 1, 2"
)


@query(with_("series") + f", {STABILITY_SQL}")
def sc_12b_tail_stability(spark, sf):
    """Spread and bias of the tail over seeds against the tail of all known vectors, by number of scenarios."""
    s = series(spark, sf)
    pairs = naive_pairs(s).select("origin", "horizon", "target", "p")
    long = scenario.known_vectors(s).select("origin", "vector", "i", "n", F.posexplode("v").alias("h", "e")).withColumn("horizon", F.col("h") + 1)
    use = SCALE * F.col("p") * F.exp("e") * C.hours_in_month("target")
    totals = long.join(pairs, ["origin", "horizon"]).groupBy("origin", "vector", "i", "n").agg(r3(F.sum(use)).alias("total"))
    exact = S.upper_cvar(totals, ["origin"], "total", ALPHA, "exact")
    grid = totals.select("origin", "n").distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(SEEDS - 1))).alias("seed")).select("*", F.explode(F.sequence(F.lit(0), F.lit(max(SIZES) - 1))).alias("s"))
    key = F.concat_ws(":", F.col("seed").cast("string"), F.col("origin").cast("string"), F.col("s").cast("string"))
    drawn = grid.withColumn("i", C.drawn_index(key, F.col("n"))).drop("n").join(totals.select("origin", "i", "total"), ["origin", "i"])
    sized = drawn.select("*", F.explode(F.array(*map(F.lit, SIZES))).alias("size")).filter("s < size")
    tails = S.upper_cvar(sized, ["origin", "size", "seed"], "total", ALPHA).join(exact, "origin")
    one = F.any_value("exact")
    return tails.groupBy("origin", "size").agg(F.count("*").alias("seeds"), r3(one).alias("exact"), r3(100 * F.stddev_pop("cvar") / one, 4).alias("sd_pct"), r3(100 * (F.avg("cvar") / one - 1), 4).alias("bias_pct"))


def variant_decisions(spark, sf) -> DataFrame:
    """id, origin, r of the base case and every variant."""
    base = scenario.decision(spark, sf).select(F.lit("base").alias("id"), "origin", "r")
    return base.unionByName(scenario.ct_16_sensitivity_batch(spark, sf).select("id", "origin", "r"))


def variants(spark) -> DataFrame:
    """id, parameter, value, band, spread: what of a variant the realised cost depends on besides the volume."""
    base = {"band": BAND, "spread": SPREAD}
    rows = [("base", "none", 0.0, BAND, SPREAD)]
    for name, parameter, value in SENSITIVITIES:
        own = base | ({parameter: value} if parameter in base else {})
        rows.append((name, parameter, value, own["band"], own["spread"]))
    return spark.createDataFrame(rows, "id string, parameter string, value double, band double, spread double")


def backtest(spark, sf, chosen: DataFrame) -> DataFrame:
    """id, origin, strategy, r, volume, cost, short, surplus, months_outside: the year after each origin under each variant's own terms."""
    s = series(spark, sf)
    hours = C.hours_in_month("month").cast("double")
    plain = s.groupBy(F.year("month").alias("y")).agg(F.count("*").alias("n"), r3(F.sum(SCALE * F.col("value") * hours) / F.sum(hours), 6).alias("volume")).filter("n = 12")
    origins = scenario.decision_origins(s).withColumn("y", F.year("origin"))
    point = scenario.point_volume(s)
    naive = origins.join(plain, "y").select("origin", F.lit("naive").alias("strategy"), "volume")
    fixed = naive.unionByName(point.withColumn("strategy", F.lit("point")))
    ids = variants(spark)
    volumes = fixed.crossJoin(F.broadcast(ids.select("id"))).withColumn("r", F.lit(None).cast("double"))
    best = chosen.join(point, "origin").select("origin", F.lit("optimised").alias("strategy"), r3(F.col("r") * F.col("volume"), 6).alias("volume"), "id", "r")
    terms = volumes.unionByName(best).join(F.broadcast(ids), "id").join(scenario.contract_price(spark, sf, 0.0), "origin").withColumn("price", F.col("price") + F.col("spread"))
    months = s.join(scenario.spot(spark, sf).select("month", F.col("price").alias("spot")), "month").withColumns({"y": F.year("month") - 1, "hours": hours}).withColumn("use", SCALE * F.col("value") * F.col("hours"))
    real = origins.join(months.select("y", "month", "use", "spot", "hours"), "y").join(terms, "origin")
    cost = K.monthly_cost(*[F.col(c) for c in ("use", "volume", "hours", "band", "price", "spot")])
    c = real.withColumn("c", cost)
    outside = (F.col("c.short") > 0) | (F.col("c.surplus") > 0)
    sums = [r3(F.sum(f"c.{x}"), 2).alias(x) for x in ("cost", "short", "surplus")]
    return c.groupBy("id", "origin", "strategy").agg(F.any_value("r").alias("r"), F.any_value("volume").alias("volume"), *sums, F.count_if(outside).alias("months_outside"))


def settled_backtest(spark, sf) -> DataFrame:
    path = scratch(spark, "sensitivities")
    with written_once():
        backtest(spark, sf, variant_decisions(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


@query()
def ct_10b_variant_backtest(spark, sf):
    return backtest(spark, sf, variant_decisions(spark, sf))


@query()
def ct_10c_variant_savings(spark, sf):
    return savings(settled_backtest(spark, sf), variants(spark))


def savings(rows: DataFrame, names: DataFrame) -> DataFrame:
    """A row per variant and year, and one per variant over all years (year null), with the ratio's bounds that the band sets.

    forecast_value: naive less point cost; optimisation_value: point less optimised cost. The row over all years names the
    worst year; a year's row its ratio.
    """
    wide = rows.groupBy("id", "origin").pivot("strategy", ["naive", "point", "optimised"]).agg(F.any_value("cost").alias("cost"), F.any_value("short").alias("short"), F.any_value("surplus").alias("surplus"), F.any_value("months_outside").alias("outside"))
    ratio = rows.filter("strategy = 'optimised'").select("id", "origin", "r")
    year = wide.join(ratio, ["id", "origin"]).withColumn("year", F.year("origin") + 1).withColumn("saving", 100 * (1 - F.col("optimised_cost") / F.col("naive_cost")))
    sums = [F.sum(f"{s}_{c}").alias(f"{s}_{c}") for s in ("naive", "point", "optimised") for c in ("cost", "short", "surplus", "outside")]
    cut = year.select("*", F.explode(F.array(F.col("year"), F.lit(None).cast("int"))).alias("cut"))
    lone = F.col("cut").isNotNull()
    out = cut.groupBy("id", F.col("cut").alias("year")).agg(*sums, F.max(F.when(lone, F.col("r"))).alias("r"), F.min_by(F.when(~lone, cut["year"]), F.struct("saving", cut["year"])).alias("worst_year"), F.min(F.when(~lone, r3("saving", 4))).alias("worst_saving_pct"))
    value = lambda a, b: r3(F.col(f"{a}_cost") - F.col(f"{b}_cost"), 2)
    out = out.join(F.broadcast(names), "id").withColumns({"forecast_value": value("naive", "point"), "optimisation_value": value("point", "optimised"), "saving_pct": r3(100 * (1 - F.col("optimised_cost") / F.col("naive_cost")), 4)})
    kept = [f"{s}_{c}" for s in ("naive", "point", "optimised") for c in ("short", "surplus")]
    return out.select("id", "parameter", "value", "year", "r", r3(1 / (1 + F.col("band")), 6).alias("r_low"), r3(1 / (1 - F.col("band")), 6).alias("r_high"), "forecast_value", "optimisation_value", "saving_pct", "worst_year", "worst_saving_pct", *[r3(c, 2).alias(c) for c in kept], *[f"{s}_outside" for s in ("naive", "point", "optimised")])


@query()
def ct_10d_invariances(spark, sf):
    return invariances(settled_backtest(spark, sf))


def invariances(rows: DataFrame) -> DataFrame:
    """What of each variant is as in the base case: costs, volumes and exposures of the fixed strategies over all years, the years
    of equal ratios, and whether the optimised cost is equal wherever the ratio is."""
    values = ["r", "volume", "cost", "short", "surplus"]
    base = rows.filter("id = 'base'").select("origin", "strategy", *[F.col(c).alias(f"base_{c}") for c in values])
    met = rows.filter("id <> 'base'").join(base, ["origin", "strategy"])
    same = lambda c, tolerance: F.abs(F.col(c) - F.col(f"base_{c}")) <= tolerance
    fixed = []
    for s in ("naive", "point"):
        every = lambda cond, s=s: F.bool_and(F.when(F.col("strategy") == s, cond))
        fixed += [every(same("cost", TOLERANCE)).alias(f"{s}_cost_same"), every(same("volume", SAME_RATIO)).alias(f"{s}_volume_same"), every(same("short", TOLERANCE) & same("surplus", TOLERANCE)).alias(f"{s}_exposure_same")]
    equal = (F.col("strategy") == "optimised") & same("r", SAME_RATIO)
    years = F.array_join(F.array_sort(F.collect_list(F.when(equal, (F.year("origin") + 1).cast("string")))), " ")
    where = F.coalesce(F.bool_and(F.when(equal, same("cost", TOLERANCE))), F.lit(False))
    return met.groupBy("id").agg(*fixed, years.alias("years_same_ratio"), F.count_if(equal).alias("n_same_ratio"), where.alias("cost_same_where_ratio_same"))
