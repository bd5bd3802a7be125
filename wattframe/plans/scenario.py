"""Scenarios of consumption and price, contract decisions, backtest and sensitivities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators import contract as K
from wattframe.operators import relational as R
from wattframe.operators import stats as S
from wattframe.plans.aggregates import FLOOR_SQL, floors, naive_pairs, q, r3
from wattframe.plans.bindings import series, with_, shared
from wattframe.plans.forecast import ERRORS_SQL, errors
from wattframe.registry import query
from wattframe.session import scratch, table
from wattframe.sources import locks

#: Scenarios of each origin: at 0.95 the tail holds a hundred of them.
N = 2000
SEED = 7
SCALE = 0.0001
BAND, SPREAD, WEIGHT, ALPHA = 0.1, 20.0, 0.5, 0.95

HOURS = "(day(last_day({})) * 24)::double"
DRAW = "concat('0x', sha256({})[1:15])::bigint % {}"

VECTORS_SQL = f"{ERRORS_SQL}, vectors as (select origin as vector, list(e order by horizon) as v from errors group by 1 having count(*) = 12 and count(distinct horizon) = 12)"
ORIGINS_SQL = "origins as (select origin from pairs where month(origin) = 12 and year(origin) >= 1997 group by 1 having count(*) = 12)"
KNOWN_SQL = f"{VECTORS_SQL}, {ORIGINS_SQL}, known as (select origin, vector, v, row_number() over (partition by origin order by vector) - 1 as i, count(*) over (partition by origin) as n from origins join vectors on (vector + interval 12 month)::date <= origin)"
DRAWS_SQL = f"{KNOWN_SQL}, draws as (select k.origin, s::int as scenario, k.vector, k.v from (select distinct origin, n from known) o cross join (select unnest(range(0, {N})) as s) join known k on k.origin = o.origin and k.i = {DRAW.format(f'''concat('{SEED}:', o.origin, ':', s)''', 'o.n')})"
USE_SQL = f"{DRAWS_SQL}, use as (select d.origin, d.scenario, p.horizon, p.target, {q(f'{SCALE} * p.p * exp(d.v[p.horizon]) * {HOURS.format('p.target')}')} as use, {HOURS.format('p.target')} as hours from draws d join pairs p on p.origin = d.origin)"


# Wherever pairs (origin, horizon, target, p, a) can be given, they are the forecasts to use instead of the seasonal naive ones.


def vectors(s: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """vector (its origin), v: the 12 errors of each complete origin."""
    e = errors(s, pairs)
    whole = e.groupBy(F.col("origin").alias("vector")).agg(F.count("*").alias("n"), F.count_distinct("horizon").alias("k"), F.array_sort(F.collect_list(F.struct("horizon", "e"))).alias("hs"))
    return whole.filter("n = 12 and k = 12").select("vector", F.transform("hs", lambda x: x["e"]).alias("v"))


def decision_origins(s: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Decembers whose next 12 months are known."""
    p = (naive_pairs(s) if pairs is None else pairs).filter("month(origin) = 12 and year(origin) >= 1997")
    return p.groupBy("origin").agg(F.count("*").alias("n")).filter("n = 12").select("origin")


def known_vectors(s: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """origin, vector, v, i, n: the vectors that are complete at each origin, numbered by age."""
    met = decision_origins(s, pairs).join(vectors(s, pairs), F.add_months("vector", 12) <= F.col("origin"))
    return met.withColumn("i", F.row_number().over(Window.partitionBy("origin").orderBy("vector")) - 1).withColumn("n", F.count("*").over(Window.partitionBy("origin")))


def draw(known: DataFrame, n: int = N, seed: int = SEED) -> DataFrame:
    """origin, scenario, vector, v. A draw is a hash of seed, origin and scenario: the first n of a larger set are the same."""
    sizes = known.select("origin", "n").distinct().select("origin", "n", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("scenario"))
    key = F.concat(F.lit(f"{seed}:"), F.col("origin").cast("string"), F.lit(":"), F.col("scenario").cast("string"))
    return sizes.withColumn("i", C.drawn_index(key, F.col("n"))).select("origin", "scenario", "i").join(known.select("origin", "i", "vector", "v"), ["origin", "i"]).select("origin", "scenario", "vector", "v")


def use_scenarios(s: DataFrame, drawn: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """origin, scenario, horizon, target, use: forecast times exp(error) times hours."""
    p = (naive_pairs(s) if pairs is None else pairs).select("origin", "horizon", "target", "p")
    use = SCALE * F.col("p") * F.exp(F.element_at("v", F.col("horizon"))) * C.hours_in_month("target")
    return drawn.join(p, "origin").select("origin", "scenario", "horizon", "target", r3(use).alias("use"))


@query(with_("series") + f", {VECTORS_SQL} select vector, array_to_string(v, ';') as v from (select vector, list_transform(v, lambda x: (x::decimal(12,6))::varchar) as v from vectors)")
def sc_01_error_vectors(spark, sf):
    return vectors(series(spark, sf)).select("vector", F.array_join(F.transform("v", lambda x: x.cast("decimal(12,6)").cast("string")), ";").alias("v"))


@query(with_("series") + f", {DRAWS_SQL} select origin, scenario, vector from draws")
def sc_02_resampling(spark, sf):
    return draw(known_vectors(series(spark, sf))).select("origin", "scenario", "vector")


STRETCH_SQL = f"m as (select origin, h, avg(v[h]) as mean from known cross join (select unnest(range(1, 13)) as h) group by 1, 2), stretched as (select k.origin, k.vector, h::int as horizon, {q('mean + 1.25 * (v[h] - mean)', 6)} as e from known k join m using (origin))"


def stretch(known: DataFrame, k: float) -> DataFrame:
    """origin, vector, horizon, e: deviations from each horizon's mean, times k."""
    long = known.select("origin", "vector", F.posexplode("v").alias("h", "e")).withColumn("horizon", F.col("h") + 1)
    if k == 1.0:
        return long.select("origin", "vector", "horizon", "e")
    mean = F.avg("e").over(Window.partitionBy("origin", "horizon"))
    return long.withColumn("m", mean).select("origin", "vector", "horizon", r3(F.col("m") + k * (F.col("e") - F.col("m")), 6).alias("e"))


@query(with_("series") + f", {KNOWN_SQL}, {STRETCH_SQL} select * from stretched")
def sc_03_stretched_errors(spark, sf):
    return stretch(known_vectors(series(spark, sf)), 1.25)


@query(with_("series") + f", {USE_SQL} select * exclude (hours) from use")
def sc_04_use_scenarios(spark, sf):
    s = series(spark, sf)
    return use_scenarios(s, draw(known_vectors(s)))


SPOT_SQL = f"spot as (select date_trunc('month', l_shipdate)::date as month, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::int as mi, {q('sum(l_extendedprice) / sum(l_quantity) / 10')} as price from lineitem group by 1, 2)"
#: Fixed limits by year: floor and cap; the last year holds for later ones.
LIMITS = [(1995, 40.0, 250.0), (1996, 42.5, 255.0), (1997, 45.0, 260.0), (1998, 47.5, 262.5), (1999, 50.0, 265.0), (2000, 52.5, 270.0)]
LIMITS_SQL = "limits(year, floor, cap) as (values " + ", ".join(f"({y}, {a}::double, {b}::double)" for y, a, b in LIMITS) + "), bounds as (select y as year, coalesce(l.floor, t.floor) as floor, coalesce(l.cap, t.cap) as cap, y > 2000 as assumed from (select unnest(range(1995, 2005)) as y) left join limits l on l.year = y cross join (select floor, cap from limits order by year desc limit 1) t)"


@shared
def spot(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    out = li.groupBy(C.month_of("l_shipdate").alias("month")).agg(r3(F.sum("l_extendedprice") / F.sum("l_quantity") / 10).alias("price"))
    return out.withColumn("mi", C.month_index("month"))


def bounds(spark) -> DataFrame:
    limits = spark.createDataFrame(LIMITS, "year int, floor double, cap double")
    years = spark.range(1995, 2005).select(F.col("id").cast("int").alias("year"))
    floor = R.carry_forward(limits.select("year", "floor"), years, "year", "floor")
    return floor.join(R.carry_forward(limits.select("year", "cap"), years, "year", "cap").drop("assumed"), "year").select("year", "floor", "cap", "assumed")


@query(with_("series") + f", {ERRORS_SQL}, {ORIGINS_SQL}, {SPOT_SQL}, {LIMITS_SQL}, {FLOOR_SQL} select origin, month, price, coalesce(b.floor, f.floor) as floor, case when b.floor is not null then 'limit' when f.floor is not null then 'detected' else 'gap' end as source from origins join spot on month <= origin left join bounds b on b.year = year(month) and b.year >= 1996 left join floors f on f.year = year(month)")
def sc_05_price_history(spark, sf):
    """Prices known at each origin with the floor of their year and where that comes from."""
    b = bounds(spark).filter("year >= 1996").select("year", F.col("floor").alias("bf"))
    f = floors(spark, sf).select(F.col("year").cast("int").alias("year"), F.col("floor").alias("ff"))
    met = decision_origins(series(spark, sf)).join(spot(spark, sf), F.col("month") <= F.col("origin")).withColumn("year", F.year("month"))
    met = met.join(b, "year", "left").join(f, "year", "left")
    source = F.when(F.col("bf").isNotNull(), "limit").when(F.col("ff").isNotNull(), "detected").otherwise("gap")
    return met.select("origin", "month", "price", F.coalesce("bf", "ff").alias("floor"), source.alias("source"))


@query(f"with {LIMITS_SQL} select year::int as year, floor, cap, assumed from bounds")
def sc_06_year_limits(spark, sf):
    return bounds(spark)


def shifted(price, floor_then, floor_now, cap_now):
    """The price moved from its year's floor to the target year's, within the target's limits."""
    return C.clip(price - floor_then + floor_now, floor_now, cap_now)


@query(f"with {SPOT_SQL}, {LIMITS_SQL} select month, {q('least(greatest(price - a.floor + b.floor, b.floor), b.cap)')} as shifted, {q('least(greatest(price, b.floor), b.cap)')} as clipped from spot join bounds a on a.year = year(month) join bounds b on b.year = year(month) + 1")
def sc_07_price_transform(spark, sf):
    b = bounds(spark)
    s = spot(spark, sf).withColumn("year", F.year("month"))
    met = s.join(b.select("year", F.col("floor").alias("f0")), "year").join(b.select((F.col("year") - 1).alias("year"), F.col("floor").alias("f1"), F.col("cap").alias("c1")), "year")
    p, f0, f1, c1 = (F.col(c) for c in ("price", "f0", "f1", "c1"))
    return met.select("month", r3(shifted(p, f0, f1, c1)).alias("shifted"), r3(C.clip(p, f1, c1)).alias("clipped"))


HISTORY_SQL = f"{ERRORS_SQL}, {ORIGINS_SQL}, {SPOT_SQL}, {LIMITS_SQL}, history as (select origin, month, price, row_number() over (partition by origin order by month) - 1 as i, count(*) over (partition by origin) as n from origins join spot on month <= origin)"
MOVE = q("least(greatest(k.price - a.floor + b.floor, b.floor), b.cap)")
SIMPLE_SQL = f"{HISTORY_SQL}, simple as (select o.origin, s::int as scenario, h::int as horizon, k.month, {MOVE} as price from (select distinct origin, n from history) o cross join (select unnest(range(0, {N})) as s) cross join (select unnest(range(1, 13)) as h) join history k on k.origin = o.origin and k.i = {DRAW.format(f'''concat('{SEED}:simple:', o.origin, ':', s, ':', h)''', 'o.n')} join bounds a on a.year = year(k.month) join bounds b on b.year = year(o.origin) + 1)"
BLOCK_SQL = f"{HISTORY_SQL}, starts as (select o.origin, s.month, s.mi, row_number() over (partition by o.origin order by s.month) - 1 as i, count(*) over (partition by o.origin) as n from origins o join spot s on month(s.month) = 1 and (s.month + interval 11 month)::date <= o.origin where (select count(*) from spot t where t.mi between s.mi and s.mi + 11) = 12), blocks as (select o.origin, s::int as scenario, h::int as horizon, k.month, {MOVE} as price from (select distinct origin, n from starts) o cross join (select unnest(range(0, {N})) as s) join starts st on st.origin = o.origin and st.i = {DRAW.format(f'''concat('{SEED}:block:', o.origin, ':', s)''', 'o.n')} cross join (select unnest(range(1, 13)) as h) join spot k on k.mi = st.mi + h - 1 join bounds a on a.year = year(k.month) join bounds b on b.year = year(o.origin) + 1)"


def _moved(drawn: DataFrame, spark, shift: bool = True) -> DataFrame:
    """Drawn prices in the target year's terms: moved with the floor and clipped, or only clipped."""
    b = bounds(spark)
    then = b.select(F.col("year").alias("y0"), F.col("floor").alias("f0"))
    now = b.select(F.col("year").alias("y1"), F.col("floor").alias("f1"), F.col("cap").alias("c1"))
    met = drawn.withColumns({"y0": F.year("month"), "y1": F.year("origin") + 1}).join(F.broadcast(then), "y0").join(F.broadcast(now), "y1")
    price = shifted(F.col("price"), F.col("f0"), F.col("f1"), F.col("c1")) if shift else C.clip(F.col("price"), F.col("f1"), F.col("c1"))
    return met.select("origin", "scenario", "horizon", "month", r3(price).alias("price"))


def simple_bootstrap(spark, sf, n: int = N) -> DataFrame:
    """Months drawn one by one from those known at the origin."""
    met = decision_origins(series(spark, sf)).join(spot(spark, sf), F.col("month") <= F.col("origin"))
    history = met.withColumn("i", F.row_number().over(Window.partitionBy("origin").orderBy("month")) - 1).withColumn("n", F.count("*").over(Window.partitionBy("origin")))
    grid = history.select("origin", "n").distinct().select("origin", "n", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("scenario")).select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("horizon"))
    key = F.concat(F.lit(f"{SEED}:simple:"), F.col("origin").cast("string"), F.lit(":"), F.col("scenario").cast("string"), F.lit(":"), F.col("horizon").cast("string"))
    drawn = grid.withColumn("i", C.drawn_index(key, F.col("n"))).drop("n").join(history.select("origin", "i", "month", "price"), ["origin", "i"])
    return _moved(drawn, spark)


def block_bootstrap(spark, sf, n: int = N, shift: bool = True) -> DataFrame:
    """Whole calendar years drawn from those complete at the origin."""
    blocks = R.contiguous_blocks(spot(spark, sf), "month", "price").filter("month(block) = 1")
    met = decision_origins(series(spark, sf)).join(blocks, F.add_months("block", 11) <= F.col("origin"))
    numbered = met.withColumn("i", F.row_number().over(Window.partitionBy("origin").orderBy("block")) - 1).withColumn("n", F.count("*").over(Window.partitionBy("origin")))
    grid = numbered.select("origin", "n").distinct().select("origin", "n", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("scenario"))
    key = F.concat(F.lit(f"{SEED}:block:"), F.col("origin").cast("string"), F.lit(":"), F.col("scenario").cast("string"))
    drawn = grid.withColumn("i", C.drawn_index(key, F.col("n"))).drop("n").join(numbered.select("origin", "i", "block", "values"), ["origin", "i"])
    long = drawn.select("origin", "scenario", "block", F.posexplode("values").alias("h", "price"))
    return _moved(long.select("origin", "scenario", (F.col("h") + 1).alias("horizon"), F.add_months("block", F.col("h")).alias("month"), "price"), spark, shift)


@query(with_("series") + f", {SIMPLE_SQL} select * from simple")
def sc_08_simple_bootstrap(spark, sf):
    return simple_bootstrap(spark, sf)


@query(with_("series") + f", {BLOCK_SQL} select * from blocks")
def sc_09_block_bootstrap(spark, sf):
    return block_bootstrap(spark, sf)


@query(with_("series") + f", {BLOCK_SQL}, y as (select origin, scenario, sum(price * {HOURS.format('(origin + horizon * interval 1 month)::date')}) / sum({HOURS.format('(origin + horizon * interval 1 month)::date')}) as price from blocks group by 1, 2) select origin, count(*)::bigint as scenarios, {q('avg(price)')} as expected, {q('min(price)')} as low, {q('max(price)')} as high from y group by 1")
def sc_10_annual_price(spark, sf):
    hours = C.hours_in_month(F.add_months("origin", F.col("horizon")))
    y = block_bootstrap(spark, sf).groupBy("origin", "scenario").agg((F.sum(F.col("price") * hours) / F.sum(hours)).alias("price"))
    return y.groupBy("origin").agg(F.count("*").alias("scenarios"), r3(F.avg("price")).alias("expected"), r3(F.min("price")).alias("low"), r3(F.max("price")).alias("high"))


@query(with_("series") + f", {ERRORS_SQL}, {ORIGINS_SQL} select origin, sha256(origin || '|{SEED}|{N}|block')[1:12] as run, {SEED} as seed, {N} as n from origins")
def sc_11_provenance(spark, sf):
    return decision_origins(series(spark, sf)).select("origin", C.short_id(F.col("origin").cast("string"), F.lit(str(SEED)), F.lit(str(N)), F.lit("block")).alias("run"), F.lit(SEED).alias("seed"), F.lit(N).alias("n"))


@query(with_("series") + f", {USE_SQL}, y as (select origin, scenario, sum(use) as total from use group by 1, 2), a as (select origin, sum({SCALE} * a * {HOURS.format('target')}) as real from pairs where month(origin) = 12 group by 1), r as (select y.origin, total, real, row_number() over (partition by y.origin order by total desc) as r from y join a using (origin)), w as (select *, least(1.0::double, greatest(0.0::double, (1.0::double - 0.95::double) * {N} - (r - 1))) as w from r) select origin, {q('sum(w * total) / sum(w)')} as cvar, {q('avg((total <= real)::int)', 6)} as pit, bool_or(total <= real) and bool_or(total >= real) as inside from w group by 1")
def sc_12_coverage_and_tail(spark, sf):
    s = series(spark, sf)
    y = use_scenarios(s, draw(known_vectors(s))).groupBy("origin", "scenario").agg(F.sum("use").alias("total"))
    real = naive_pairs(s).filter("month(origin) = 12").groupBy("origin").agg(F.sum(SCALE * F.col("a") * C.hours_in_month("target")).alias("real"))
    y2 = y.join(real, "origin").groupBy("origin").agg(r3(F.avg((F.col("total") <= F.col("real")).cast("double")), 6).alias("pit"), (F.bool_or(F.col("total") <= F.col("real")) & F.bool_or(F.col("total") >= F.col("real"))).alias("inside"))
    return S.upper_cvar(y, ["origin"], "total", ALPHA).select("origin", r3("cvar").alias("cvar")).join(y2, "origin")


@query(with_("series") + f", {SIMPLE_SQL}, t as (select 'history' as kind, price, b.floor, b.cap from spot join bounds b on b.year = year(month) union all select 'scenario', s.price, b.floor, b.cap from simple s join bounds b on b.year = year(origin) + 1) select kind, count(*)::bigint as n, {q('avg((price <= floor + 0.01)::int)', 6)} as at_floor, {q('avg((price >= cap - 0.01)::int)', 6)} as at_cap, {q('avg(price)')} as mean, {q('stddev_samp(price)')} as sd, {q('quantile_cont(price, 0.1)')} as p10, {q('quantile_cont(price, 0.5)')} as p50, {q('quantile_cont(price, 0.9)')} as p90 from t group by 1")
def sc_13_distributions(spark, sf):
    b = bounds(spark).select("year", "floor", "cap")
    a = spot(spark, sf).withColumn("year", F.year("month")).join(b, "year").select(F.lit("history").alias("kind"), "price", "floor", "cap")
    c = simple_bootstrap(spark, sf).withColumn("year", F.year("origin") + 1).join(b, "year").select(F.lit("scenario").alias("kind"), "price", "floor", "cap")
    share = lambda cond: r3(F.avg(cond.cast("double")), 6)
    p = F.col("price")
    return a.unionByName(c).groupBy("kind").agg(F.count("*").alias("n"), share(p <= F.col("floor") + 0.01).alias("at_floor"), share(p >= F.col("cap") - 0.01).alias("at_cap"), r3(F.avg(p)).alias("mean"), r3(F.stddev_samp(p)).alias("sd"), *[r3(F.percentile(p, F.lit(x))).alias(f"p{int(x * 100)}") for x in (0.1, 0.5, 0.9)])


@query(with_("series") + f", {DRAWS_SQL}, m as (select origin, h, avg(v[h]) as mean from known cross join (select unnest(range(1, 13)) as h) group by 1, 2), t as (select k as dispersion, known.origin, vector, {q('sum(mean + k * (v[h] - mean))', 5)} as total from known join m using (origin) cross join (select unnest([1.0::double, 1.25::double, 1.5::double]) as k) group by 1, 2, 3) select dispersion, d.origin, scenario, total from draws d join t on t.origin = d.origin and t.vector = d.vector")
def sc_14_paired_dispersion(spark, sf):
    """The same draws with wider errors: scenario by scenario, only the dispersion differs."""
    known = known_vectors(series(spark, sf))
    drawn = draw(known).select("origin", "scenario", F.posexplode("v").alias("h", "e"))
    mean = known.select("origin", F.posexplode("v").alias("h", "e")).groupBy("origin", "h").agg(F.avg("e").alias("m"))
    sets = F.explode(F.array(F.lit(1.0), F.lit(1.25), F.lit(1.5)))
    return drawn.join(mean, ["origin", "h"]).select("*", sets.alias("dispersion")).groupBy("dispersion", "origin", "scenario").agg(r3(F.sum(F.col("m") + F.col("dispersion") * (F.col("e") - F.col("m"))), 5).alias("total"))


@query(with_("series") + f", {ERRORS_SQL}, {ORIGINS_SQL}, n as (select max(month) as origin from series where month < date '2001-08-01') select n.origin, n.origin in (select origin from origins) as is_backtest, sha256(n.origin || '|production')[1:12] as run from n")
def sc_15_production_origin(spark, sf):
    s = series(spark, sf)
    new = s.filter(F.col("month") < F.lit("2001-08-01").cast("date")).agg(F.max("month").alias("origin"))
    used = decision_origins(s).withColumn("u", F.lit(True))
    return new.join(used, "origin", "left").select("origin", F.col("u").isNotNull().alias("is_backtest"), C.short_id(F.col("origin").cast("string"), F.lit("production")).alias("run"))


@query(with_("series") + f", {ERRORS_SQL}, {ORIGINS_SQL} select origin from origins")
def sc_16_decision_origins(spark, sf):
    return decision_origins(series(spark, sf))


# Contract decisions. Scenarios pair consumption and block prices by (origin, scenario, horizon).

BOTH_SQL = f"{USE_SQL}, " + BLOCK_SQL.removeprefix(f"{ERRORS_SQL}, {ORIGINS_SQL}, ") + f", paired as (select u.origin, u.scenario, u.horizon, u.use, b.price as spot, u.hours from use u join blocks b on b.origin = u.origin and b.scenario = u.scenario and b.horizon = u.horizon)"
BASE_SQL = f"{BOTH_SQL}, point as (select p.origin, {q(f'sum({SCALE} * p.p * {HOURS.format('p.target')}) / sum({HOURS.format('p.target')})', 6)} as volume from pairs p join origins using (origin) group by 1), priced as (select o.origin, {q(f'sum(s.price * {HOURS.format('s.month')}) / sum({HOURS.format('s.month')}) + {SPREAD}')} as price from origins o join spot s on year(s.month) = year(o.origin) group by 1 having count(*) = 12)"
GRID_SQL = f"grid as (select distinct round(r::decimal(28,15), 12)::double as r from (select 1 / (1 + {BAND}::double) + k * 0.0025::double as r from (select unnest(range(0, 200)) as k) where 1 / (1 + {BAND}::double) + k * 0.0025::double < 1 / (1 - {BAND}::double) - 1e-12 union all select 1.0::double union all select 1 / (1 - {BAND}::double)))"
COST = "least(greatest(use, {v} * hours * (1 - {f})), {v} * hours * (1 + {f})) * price + (use - least(greatest(use, {v} * hours * (1 - {f})), {v} * hours * (1 + {f}))) * spot"
EVAL_SQL = f"{BASE_SQL}, {GRID_SQL}, cost as (select origin, r, scenario, sum({COST.format(v='(r * volume)', f=f'{BAND}::double')}) as cost from paired join point using (origin) join priced using (origin) cross join grid group by 1, 2, 3), ranked as (select *, row_number() over (partition by origin, r order by cost desc) as k, count(*) over (partition by origin, r) as n from cost), evaluated as (select origin, r, avg(cost) as expected, sum(least(1.0::double, greatest(0.0::double, (1.0::double - {ALPHA}::double) * n - (k - 1))) * cost) / sum(least(1.0::double, greatest(0.0::double, (1.0::double - {ALPHA}::double) * n - (k - 1)))) as cvar from ranked group by 1, 2), objective as (select *, expected + {WEIGHT} * cvar as objective from evaluated), chosen as (select origin, min_by(r, (abs(r - 1), r)) as r from objective join (select origin, min(objective) as low from objective group by 1) using (origin) where objective <= low + 1e-9 * greatest(1.0, abs(low)) group by 1)"


def paired(spark, sf, dispersion: float = 1.0, method: str = "block", shift: bool = True, pairs: DataFrame | None = None) -> DataFrame:
    """Consumption and price of each scenario; the draws are the same whatever the dispersion of the errors."""
    s = series(spark, sf)
    known = known_vectors(s, pairs)
    drawn = draw(known)
    if dispersion != 1.0:
        wide = stretch(known, dispersion).groupBy("origin", "vector").agg(F.array_sort(F.collect_list(F.struct("horizon", "e"))).alias("hs"))  # twelve to a group
        drawn = drawn.drop("v").join(wide.select("origin", "vector", F.transform("hs", lambda x: x["e"]).alias("v")), ["origin", "vector"])
    use = use_scenarios(s, drawn, pairs)
    drawn_prices = simple_bootstrap(spark, sf) if method == "simple" else block_bootstrap(spark, sf, shift=shift)
    price = drawn_prices.select("origin", "scenario", "horizon", F.col("price").alias("spot"))
    return use.join(price, ["origin", "scenario", "horizon"]).select("origin", "scenario", "horizon", "use", "spot", C.hours_in_month("target").cast("double").alias("hours"))


def point_volume(s: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    hours = C.hours_in_month("target")
    return (naive_pairs(s) if pairs is None else pairs).join(decision_origins(s, pairs), "origin").groupBy("origin").agg(r3(F.sum(SCALE * F.col("p") * hours) / F.sum(hours), 6).alias("volume"))


def contract_price(spark, sf, spread: float = SPREAD) -> DataFrame:
    """The origin year's hour-weighted price and a spread."""
    hours = C.hours_in_month("month")
    y = spot(spark, sf).groupBy(F.year("month").alias("y")).agg(F.count("*").alias("n"), r3(F.sum(F.col("price") * hours) / F.sum(hours) + spread).alias("price")).filter("n = 12")
    return decision_origins(series(spark, sf)).withColumn("y", F.year("origin")).join(y, "y").select("origin", "price")


def candidates(spark, sf, band: float = BAND, spread: float = SPREAD, r_max: float | None = None, pairs: DataFrame | None = None) -> DataFrame:
    bands = spark.createDataFrame([(band, r_max)], "band double, r_max double")
    base = point_volume(series(spark, sf), pairs).join(contract_price(spark, sf, spread), "origin")
    return base.crossJoin(K.ratio_grid(bands)).select("origin", "r", (F.col("r") * F.col("volume")).alias("volume"), "band", "price")


ROW_COST = "least(greatest(l_quantity, 0.03::double * 720 * 0.9::double), 0.03::double * 720 * 1.1::double)"


@query(f"select l_orderkey, l_linenumber, {q(f'{ROW_COST} * 100 + (l_quantity - {ROW_COST}) * l_tax * 1000', 4)} as cost, {q('greatest(l_quantity - 0.03::double * 720 * 1.1::double, 0.0::double)', 4)} as short, {q('greatest(0.03::double * 720 * 0.9::double - l_quantity, 0.0::double)', 4)} as surplus from lineitem")
def ct_01_monthly_cost(spark, sf):
    """Cost, short and surplus of a month; here each line's quantity is a month's use."""
    d = lambda x: F.lit(float(x))
    c = K.monthly_cost(F.col("l_quantity"), d(0.03), d(720), d(BAND), d(100), F.col("l_tax") * 1000)
    return table(spark, sf, "lineitem").withColumn("c", c).select("l_orderkey", "l_linenumber", *[r3(f"c.{k}", 4).alias(k) for k in ("cost", "short", "surplus")])


@query(with_("series") + f", {BASE_SQL} select * from priced")
def ct_02_contract_price(spark, sf):
    return contract_price(spark, sf)


@query(with_("series") + f", {BASE_SQL} select * from point")
def ct_03_mean_volume(spark, sf):
    return point_volume(series(spark, sf))


@query(f"with {GRID_SQL} select r from grid")
def ct_04_ratio_grid(spark, sf):
    return K.ratio_grid(spark.createDataFrame([(BAND,)], "band double")).select("r")


@query(with_("series") + f", {EVAL_SQL} select origin, r, {q('expected', 2)} as expected, {q('cvar', 2)} as cvar, {q('objective', 2)} as objective from objective")
def ct_05_evaluated_grid(spark, sf):
    e = K.evaluate(paired(spark, sf), candidates(spark, sf), ["origin"], WEIGHT, ALPHA)
    return e.select("origin", "r", *[r3(c, 2).alias(c) for c in ("expected", "cvar", "objective")])


@query(with_("series") + f", {EVAL_SQL} select origin, c.r, {q('c.r * volume', 6)} as volume, price, {q('objective', 2)} as objective from chosen c join objective using (origin) join point using (origin) join priced using (origin) where objective.r = c.r")
def ct_06_decision(spark, sf):
    best = decision(spark, sf)
    return best.select("origin", "r", r3(F.col("volume"), 6).alias("volume"), "price", r3("objective", 2).alias("objective"))


def decision(spark, sf, band: float = BAND, spread: float = SPREAD, weight: float = WEIGHT, alpha: float = ALPHA, r_max: float | None = None, pairs: DataFrame | None = None) -> DataFrame:
    c = candidates(spark, sf, band, spread, r_max, pairs)
    best = K.choose(K.evaluate(paired(spark, sf, pairs=pairs), c, ["origin"], weight, alpha), ["origin"])
    return best.join(c.select("origin", "r", "volume", "price"), ["origin", "r"])


STRATEGIES_SQL = f"{EVAL_SQL}, strategies as (select 'naive' as strategy, o.origin, {q(f'sum({SCALE} * s.value * {HOURS.format('s.month')}) / sum({HOURS.format('s.month')})', 6)} as volume from origins o join series s on year(s.month) = year(o.origin) group by 2 having count(*) = 12 union all select 'point', origin, volume from point union all select 'optimised', origin, {q('r * volume', 6)} from chosen join point using (origin))"


def strategies(spark, sf, pairs: DataFrame | None = None) -> DataFrame:
    s = series(spark, sf)
    hours = C.hours_in_month("month")
    y = s.groupBy(F.year("month").alias("y")).agg(F.count("*").alias("n"), r3(F.sum(SCALE * F.col("value") * hours) / F.sum(hours), 6).alias("volume")).filter("n = 12")
    naive = decision_origins(s, pairs).withColumn("y", F.year("origin")).join(y, "y").select(F.lit("naive").alias("strategy"), "origin", "volume")
    return naive.unionByName(point_volume(s, pairs).withColumn("strategy", F.lit("point"))).unionByName(decision(spark, sf, pairs=pairs).select(F.lit("optimised").alias("strategy"), "origin", r3("volume", 6).alias("volume")))


@query(with_("series") + f", {STRATEGIES_SQL} select * from strategies")
def ct_07_strategies(spark, sf):
    return strategies(spark, sf)


REAL_SQL = f"{STRATEGIES_SQL}, real as (select o.origin, s.month, {SCALE} * s.value * {HOURS.format('s.month')} as use, t.price as spot, {HOURS.format('s.month')} as hours from origins o join series s on year(s.month) = year(o.origin) + 1 join spot t on t.month = s.month), realised as (select strategy, origin, month, {COST.format(v='volume', f=f'{BAND}::double')} as cost, use > volume * hours * (1 + {BAND}) or use < volume * hours * (1 - {BAND}) as outside from real join strategies using (origin) join priced using (origin)), annual as (select strategy, origin, {q('sum(cost)', 2)} as cost, count_if(outside)::bigint as months_outside, count(*)::bigint as months from realised group by 1, 2)"


def annual(spark, sf, band: float = BAND, pairs: DataFrame | None = None) -> DataFrame:
    """Realised cost of each strategy in the year after its origin."""
    s = series(spark, sf)
    real = s.join(spot(spark, sf).select("month", F.col("price").alias("spot")), "month").withColumn("y", F.year("month") - 1)
    real = decision_origins(s, pairs).withColumn("y", F.year("origin")).join(real, "y")
    hours = C.hours_in_month("month").cast("double")
    met = real.withColumns({"hours": hours, "use": SCALE * F.col("value") * hours}).join(strategies(spark, sf, pairs), "origin").join(contract_price(spark, sf), "origin")
    c = met.withColumn("c", K.monthly_cost(F.col("use"), F.col("volume"), F.col("hours"), F.lit(band), F.col("price"), F.col("spot")))
    outside = (F.col("c.short") > 0) | (F.col("c.surplus") > 0)
    return c.groupBy("strategy", "origin").agg(r3(F.sum("c.cost"), 2).alias("cost"), F.count_if(outside).alias("months_outside"), F.count("*").alias("months"))


@query(with_("series") + f", {REAL_SQL} select * from annual")
def ct_08_realised_cost(spark, sf):
    return annual(spark, sf)


#: Fixed registry: a sensitivity changes one parameter of the base case.
SENSITIVITIES = [
    ("f00", "band", 0.0), ("f05", "band", 0.05), ("f15", "band", 0.15), ("spread00", "spread", 0.0), ("spread40", "spread", 40.0), ("lam00", "weight", 0.0), ("lam10", "weight", 1.0),
    ("alpha90", "alpha", 0.9), ("rmax120", "r_max", 1.2), ("simple", "method", 0.0), ("disp125", "dispersion", 1.25), ("disp150", "dispersion", 1.5), ("clip", "transform", 1.0),
]


@query("select * from (values " + ", ".join(f"('{a}', '{b}', {c}::double)" for a, b, c in SENSITIVITIES) + ") t(id, parameter, value)")
def ct_09_sensitivity_registry(spark, sf):
    return spark.createDataFrame(SENSITIVITIES, "id string, parameter string, value double")


LAM0 = f", {EVAL_SQL}, l0 as (select origin, min_by(r, (abs(r - 1), r)) as r from evaluated join (select origin, min(expected) as low from evaluated group by 1) using (origin) where expected <= low + 1e-9 * greatest(1.0, abs(low)) group by 1), l1 as (select origin, min_by(r, (abs(r - 1), r)) as r from (select *, expected + cvar as j from evaluated) join (select origin, min(expected + cvar) as low from evaluated group by 1) using (origin) where j <= low + 1e-9 * greatest(1.0, abs(low)) group by 1)"


@query(with_("series") + LAM0 + " select b.origin, b.r as base, l0.r as lam00, l1.r as lam10 from chosen b join l0 using (origin) join l1 using (origin)")
def ct_10_sensitivity_table(spark, sf):
    """Chosen ratios by origin, a column for each variant."""
    variants = {"base": {}, "lam00": {"weight": 0.0}, "lam10": {"weight": 1.0}}
    out = None
    for name, change in variants.items():
        f = decision(spark, sf, **change).select("origin", F.col("r").alias(name))
        out = f if out is None else out.join(f, "origin")
    return out


@query(with_("series") + f", {REAL_SQL} select 'backtest' as kind, a.origin, a.strategy, a.cost, s.volume, {q('100 * (1 - a.cost / n.cost)', 4)} as saving_pct from annual a join strategies s on s.origin = a.origin and s.strategy = a.strategy join annual n on n.origin = a.origin and n.strategy = 'naive'")
def ct_11_recommendation_fact(spark, sf):
    a = annual(spark, sf)
    naive = a.filter("strategy = 'naive'").select("origin", F.col("cost").alias("base"))
    return a.join(strategies(spark, sf), ["strategy", "origin"]).join(naive, "origin").select(F.lit("backtest").alias("kind"), "origin", "strategy", "cost", "volume", r3(100 * (1 - F.col("cost") / F.col("base")), 4).alias("saving_pct"))


@query(with_("series") + f", {SPOT_SQL} select 'use' as source, max(month) as last, (2001 * 12 + 10 - max(mi))::bigint as months_old, 2001 * 12 + 10 - max(mi) > 2 as stale from series union all select 'price', max(month), (2001 * 12 + 10 - max(mi))::bigint, 2001 * 12 + 10 - max(mi) > 2 from spot")
def ct_12_staleness(spark, sf, as_of: str = "2001-11-15"):
    now = C.month_index(F.lit(as_of).cast("date"))
    age = lambda df, name: df.agg(F.max("month").alias("last"), F.max("mi").alias("m")).select(F.lit(name).alias("source"), "last", (now - F.col("m")).cast("bigint").alias("months_old"), (now - F.col("m") > 2).alias("stale"))
    return age(series(spark, sf), "use").union(age(spot(spark, sf), "price"))


@query(with_("series") + f", {SPOT_SQL}, a as (select sha256(string_agg(month || '=' || value::decimal(18,3)::varchar, ';' order by month)) as h from series), b as (select sha256(string_agg(month || '=' || price::decimal(18,3)::varchar, ';' order by month)) as h from spot) select 'use' as input, h from a union all select 'price', h from b")
def ct_13_frozen_inputs(spark, sf):
    """Fingerprints that a run froze while it held the lock; a run whose inputs have others is refused."""
    now = lambda: fingerprints(series(spark, sf), spot(spark, sf))
    return locks.frozen_run(spark, scratch(spark, "run"), "ct_13", now, lambda lock: lock.renew())


def fingerprints(use: DataFrame, price: DataFrame) -> DataFrame:
    one = lambda df, c: F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat(F.col("month").cast("string"), F.lit("="), F.col(c).cast("decimal(18,3)").cast("string")))), ";"), 256)
    return use.agg(one(use, "value").alias("h")).select(F.lit("use").alias("input"), "h").union(price.agg(one(price, "price").alias("h")).select(F.lit("price"), "h"))


@query(with_("series") + f", {REAL_SQL} select count(*)::bigint as n, count(distinct (origin, strategy))::bigint as keys, count_if(month(origin) <> 12)::bigint as not_december, count_if(months <> 12)::bigint as incomplete, count_if(cost is null or cost <= 0)::bigint as bad_cost from annual")
def ct_14_recommendation_checks(spark, sf):
    return annual(spark, sf).agg(F.count("*").alias("n"), F.count_distinct(F.struct("origin", "strategy")).alias("keys"), F.count_if(F.month("origin") != 12).alias("not_december"), F.count_if(F.col("months") != 12).alias("incomplete"), F.count_if(F.col("cost").isNull() | (F.col("cost") <= 0)).alias("bad_cost"))


@query(with_("series") + f" select o.month as origin, {q(f'sum({SCALE} * s.value * {HOURS.format('s.month')})')} as use from series o join series s on s.mi between o.mi - 11 and o.mi group by 1 having count(*) = 12")
def ct_15_trailing_use(spark, sf):
    w = Window.partitionBy(F.lit(0)).orderBy("mi").rangeBetween(-11, 0)
    s = series(spark, sf).withColumn("use", SCALE * F.col("value") * C.hours_in_month("month"))
    return s.select(F.col("month").alias("origin"), r3(F.sum("use").over(w)).alias("use"), F.count("*").over(w).alias("n")).filter("n = 12").drop("n")


@query()
def ct_16_sensitivity_batch(spark, sf):
    """The chosen ratio of every variant of the registry at every origin.

    Bands, spreads and limits of all variants are candidates of one evaluation, weights are applied to its result, and
    only another alpha needs a second pass over the scenarios. Variants of the scenarios (price method, dispersion,
    transform) are sets of their own, keyed by variant, in one evaluation of the base candidates.
    """
    base = {"id": "base", "band": BAND, "spread": SPREAD, "r_max": None, "weight": WEIGHT, "alpha": ALPHA}
    rows = [base | {"id": name, parameter: value} for name, parameter, value in SENSITIVITIES if parameter in base]
    s = series(spark, sf)
    plain = point_volume(s).join(contract_price(spark, sf, 0.0), "origin")
    scenarios = paired(spark, sf)
    out = None
    for alpha in sorted({r["alpha"] for r in rows}):
        some = [r for r in rows if r["alpha"] == alpha]
        table_ = spark.createDataFrame([(r["id"], r["band"], r["spread"], r["r_max"], r["weight"]) for r in some], "id string, band double, spread double, r_max double, weight double")
        grid = K.ratio_grid(table_.select("band", "r_max").distinct())
        c = table_.alias("t").join(grid.alias("g"), F.col("t.band").eqNullSafe(F.col("g.band")) & F.col("t.r_max").eqNullSafe(F.col("g.r_max"))).select("id", "t.band", "spread", "weight", "r")
        c = c.crossJoin(plain).select("id", "origin", "r", (F.col("r") * F.col("volume")).alias("volume"), "band", (F.col("price") + F.col("spread")).alias("price"))
        e = K.evaluate(scenarios, c, ["origin"], 0.0, alpha, more=["id"]).join(table_.select("id", "weight"), "id").withColumn("objective", F.col("expected") + F.col("weight") * F.col("cvar"))
        best = K.choose(e, ["id", "origin"]).select("id", "origin", "r", "objective")
        out = best if out is None else out.unionByName(best)
    sets = None
    for name, parameter, value in SENSITIVITIES:
        if parameter in base:
            continue
        change = {"method": {"method": "simple"}, "dispersion": {"dispersion": value}, "transform": {"shift": False}}[parameter]
        one = paired(spark, sf, **change).withColumn("id", F.lit(name))
        sets = one if sets is None else sets.unionByName(one)
    ids = sets.select("id").distinct()
    e = K.evaluate(sets, candidates(spark, sf).crossJoin(ids), ["id", "origin"], WEIGHT, ALPHA)  # a handful of variants
    return out.unionByName(K.choose(e, ["id", "origin"]).select("id", "origin", "r", "objective"))


@query("select distinct event_type as id, (props->>'$.k')::bigint as k, sha256(event_type || '|' || (props->>'$.k'))[1:12] as registration from events")
def ct_17_registrations_from_log(spark, sf):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf, "events").select(F.col("event_type").alias("id"), k.alias("k"), C.short_id("event_type", k.cast("string")).alias("registration")).distinct()
