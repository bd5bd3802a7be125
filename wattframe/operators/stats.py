"""Statistical aggregates as DataFrame compositions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.session import scratch

#: Buckets of one refinement: three passes tell 10^10 places of a range apart.
BUCKETS = 4096
#: Most ranges that are broadcast to the rows (some 100 bytes each); beyond that they meet by a shuffle.
MOST_RANGES = 200_000


def upper_cvar(df: DataFrame, keys: Sequence[str], value: str, alpha: float, out: str = "cvar") -> DataFrame:
    """Mean of the largest (1 - alpha) share of each group, the last item by its fraction.

    Ranks need a group's rows together; groups are the candidates of one decision, of bounded size.
    """
    down = Window.partitionBy(*keys).orderBy(F.desc(value))
    ranked = df.withColumn("__r", F.row_number().over(down)).withColumn("__n", F.count("*").over(Window.partitionBy(*keys)))
    mass = F.lit(1.0 - alpha) * F.col("__n")
    weight = F.least(F.lit(1.0), F.greatest(F.lit(0.0), mass - (F.col("__r") - 1)))
    return ranked.groupBy(*keys).agg((F.sum(weight * F.col(value)) / F.sum(weight)).alias(out))


def accuracy(df: DataFrame, keys: Sequence[str], predicted: str, actual: str) -> DataFrame:
    """n, MAPE, MAE, bias and bias in percent. The error is predicted minus actual."""
    error = F.col(predicted) - F.col(actual)
    good = df.filter(F.col(predicted).isNotNull() & F.col(actual).isNotNull())
    return good.groupBy(*keys).agg(
        F.count("*").alias("n"), (F.avg(F.abs(error) / F.col(actual)) * 100).alias("mape"), F.avg(F.abs(error)).alias("mae"),
        F.avg(error).alias("bias"), (F.avg(error / F.col(actual)) * 100).alias("bias_pct"),
    )


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, levels: Sequence[float], least: int = 1) -> DataFrame:
    """Linearly interpolated quantiles of groups with at least `least` rows, a group in one buffer: for groups of bounded size."""
    grouped = df.groupBy(*keys).agg(F.count(value).alias("n"), F.percentile(value, F.array(*map(F.lit, levels))).alias("__q")).filter(F.col("n") >= least)
    return grouped.select(*keys, "n", *[F.col("__q")[i].alias(f"q{str(level).replace('0.', '')}") for i, level in enumerate(levels)])


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucket(v: Column, low: Column, high: Column, by_size: bool) -> Column:
    """The place of v in its range: never falls as v rises, and the range's ends get different places.

    Places are even steps, BUCKETS of them. Halves keep the width of the widest range finite; a range too narrow to be halved
    has two places. by_size: a range around or beside zero, or whose ends differ by a factor, is told apart by sign and
    logarithm instead (some 5,000 places for all doubles; logarithms don't fall as numbers rise, whatever their rounding).
    """
    place = F.floor((v / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0)) * BUCKETS).cast("int")
    even = F.coalesce(F.least(place, F.lit(BUCKETS - 1)), (v > low).cast("int") * (BUCKETS - 1))
    if not by_size:
        return even
    size = F.floor((F.ln(F.abs(v)) + 745) * 1.4).cast("int")
    signed = F.when(v > 0, 3000 + size).when(v < 0, 2100 - size).otherwise(2500)
    far = (low <= 0) & (high >= 0) | (F.greatest(F.abs(low), F.abs(high)) / 16 > F.least(F.abs(low), F.abs(high)))
    return F.when(far, signed).otherwise(even)


def selected_quantiles(df: DataFrame, keys: Sequence[str], value: str, levels: Sequence[float], least: int = 1) -> DataFrame:
    """exact_quantiles for groups of any size: values are selected by refining histograms, and no group is ever held together.

    A level lies between two ranks. Each rank has a range of values that holds it, at first the whole group's. A pass counts the
    values of every range in BUCKETS buckets, with the least and the largest value of each; the bucket that
    holds the rank is its next range, until its ends are equal. Counts are summed where the rows are, so that a group of all rows
    costs its buckets and not its rows. Buckets are even in one pass and by sign and logarithm in the next where a range is wide, so
    that seven passes or so tell any doubles apart; usual values take two or three.

    Null and NaN values take no part. keys may be empty. Infinite values are refused, since no width holds them.
    """
    spark = df.sparkSession
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(value).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    whole = rows.groupBy(*names).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).filter(F.col("n") >= least)
    at = [F.lit(float(x)) * (F.col("n") - 1) for x in levels]
    ends = F.explode(F.array_distinct(F.array(*map(F.floor, at), *map(F.ceil, at)))).alias("rank")
    #: Of each rank: the range that holds it, and how many of the group's values lie below that.
    ranks = first = _kept(whole.select(*names, "n", ends, "low", "high", F.lit(0).cast("long").alias("below")), "ranks")
    done, turn = None, 0
    while True:
        found = ranks.filter("low = high").select(*names, "rank", F.col("low").alias("q"))
        done = found if done is None else done.unionByName(found)
        todo = ranks.filter("low < high").select(*names, "rank", "low", "high", "below")
        left = ranks.agg(F.count_if(F.col("low") < F.col("high")).alias("ranks"), F.count_if((F.abs("low") == float("inf")) | (F.abs("high") == float("inf"))).alias("infinite")).first()
        if left.infinite:
            raise ValueError("quantiles of infinite values")
        if not left.ranks:
            break
        turn += 1
        side = todo.select(*[F.col(c).alias(f"r_{c}") for c in [*names, "low", "high"]]).distinct()
        side = F.broadcast(side) if left.ranks <= MOST_RANGES else side
        met = (F.col("v") >= F.col("r_low")) & (F.col("v") <= F.col("r_high"))
        for n in names:
            met = met & F.col(n).eqNullSafe(F.col(f"r_{n}"))
        inside = rows.join(side, met).select(*names, F.col("r_low").alias("low"), F.col("r_high").alias("high"), "v")
        counts = inside.groupBy(*names, "low", "high", _bucket(F.col("v"), F.col("low"), F.col("high"), turn % 2 == 0).alias("bucket")).agg(F.count("*").alias("m"), F.min("v").alias("first"), F.max("v").alias("last"))
        up = Window.partitionBy(*names, "low", "high").orderBy("bucket")
        counts = counts.withColumn("before", F.sum("m").over(up) - F.col("m"))
        held = todo.join(counts.toDF(*[f"c_{c}" for c in counts.columns]), [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in [*names, "low", "high"]])
        start = F.col("below") + F.col("c_before")
        held = held.filter((F.col("rank") >= start) & (F.col("rank") < start + F.col("c_m")))
        ranks = _kept(held.select(*names, "rank", F.col("c_first").alias("low"), F.col("c_last").alias("high"), start.alias("below")), "ranks")
    level = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), x.alias("at")) for i, x in enumerate(at)])).alias("x")
    wanted = first.select(*names, "n").distinct().select(*names, "n", level).select(*names, "n", "x.level", "x.at")
    wanted = wanted.select("*", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank"))
    done = done.toDF(*[f"d_{c}" for c in done.columns])
    met = wanted.join(done, [*[F.col(n).eqNullSafe(F.col(f"d_{n}")) for n in names], F.col("rank") == F.col("d_rank")])
    share = F.when(F.floor("at") == F.ceil("at"), 1.0).when(F.col("rank") == F.floor("at"), F.ceil("at") - F.col("at")).otherwise(F.col("at") - F.floor("at"))
    each = met.groupBy(*names, "n", "level").agg(F.sum(share * F.col("d_q")).alias("q"))
    out = each.groupBy(*names, "n").agg(*[F.max(F.when(F.col("level") == i, F.col("q"))).alias(f"q{str(level).replace('0.', '').replace('.', '_')}") for i, level in enumerate(levels)])
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], *out.columns[len(names) :])


def block_bootstrap(df: DataFrame, keys: Sequence[str], block: str, value: str, replicas: int, seed: int) -> DataFrame:
    """Mean of each group, and its standard error by resampling whole blocks: keys, mean, error.

    Blocks are summed first. Replica r draws as many blocks as there are, the j-th by a hash of (seed, keys, r, j); draws are
    rows that meet the blocks by a join, so that replicas are spread over tasks and any engine can draw the same.
    """
    parts = df.groupBy(*keys, block).agg(F.sum(value).alias("x"), F.count(value).alias("n"))
    place = Window.partitionBy(*keys).orderBy(block)
    parts = parts.withColumn("i", F.row_number().over(place) - 1)
    groups = parts.groupBy(*keys).agg(F.count("*").alias("blocks"), (F.sum("x") / F.sum("n")).alias("mean"))
    draws = groups.select(*keys, "blocks", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("r"))
    draws = draws.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("j"))
    key = F.concat_ws(":", F.lit(seed).cast("string"), *[F.col(k).cast("string") for k in keys], F.col("r").cast("string"), F.col("j").cast("string"))
    drawn = draws.select(*keys, "r", C.drawn_index(key, F.col("blocks")).alias("i"))
    means = drawn.join(parts, [*keys, "i"]).groupBy(*keys, "r").agg((F.sum("x") / F.sum("n")).alias("m"))
    return groups.join(means.groupBy(*keys).agg(F.stddev_samp("m").alias("error")), list(keys)).select(*keys, "mean", "error")


def linear_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, least: int = 5) -> DataFrame:
    """Slope, intercept, r and r squared of groups with enough pairs."""
    return df.groupBy(*keys).agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.corr(x, y).alias("r"), F.regr_r2(y, x).alias("r2"),
    ).filter(F.col("n") >= least)


def repeated_minimum(df: DataFrame, year: str, block: str, value: str, blocks: int = 3, tolerance: float = 0.005) -> DataFrame:
    """The floor of each year: its minimum, if that stands in enough blocks.

    year, minimum, repeats, blocks, observations, status (detected, repeated_above, single_minimum), least_repeated, floor.
    """
    rounded = df.select(F.col(year).alias("year"), F.col(block).alias("block"), F.col(value).alias("v"), F.round(F.col(value).cast("decimal(18,6)"), 2).alias("r"))
    low = rounded.groupBy("year").agg(F.min("v").alias("low"), F.count("*").alias("observations"))
    near = rounded.join(low, "year").groupBy("year").agg(F.count_if(F.abs(F.col("v") - F.col("low")) <= tolerance).alias("repeats"))
    per_value = rounded.groupBy("year", "r").agg(F.count_distinct("block").alias("n"))
    found = per_value.groupBy("year").agg(F.min("r").alias("minimum"), F.min_by("n", "r").alias("blocks"), F.min(F.when(F.col("n") >= blocks, F.col("r"))).alias("least_repeated"))
    status = F.when(F.col("blocks") >= blocks, "detected").when(F.col("least_repeated").isNotNull(), "repeated_above").otherwise("single_minimum")
    return found.join(low, "year").join(near, "year").select("year", "minimum", "repeats", "blocks", "observations", status.alias("status"), "least_repeated", F.when(F.col("blocks") >= blocks, F.col("minimum")).alias("floor"))


def between_known(df: DataFrame, key: str, value: str) -> DataFrame:
    """Nulls between known keys by linear interpolation, and the lower and the higher neighbour; none beyond the ends."""
    before = Window.partitionBy(F.lit(0)).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(F.lit(0)).orderBy(key).rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(key).alias("k"), F.col(value).alias("v")))
    a, b = F.last(known, ignorenulls=True).over(before), F.first(known, ignorenulls=True).over(after)
    ends = df.withColumn("__a", a).withColumn("__b", b)
    x, y, width = F.col("__a.v"), F.col("__b.v"), F.col("__b.k") - F.col("__a.k")
    line = F.when(width > 0, x + (y - x) * (F.col(key) - F.col("__a.k")) / width)
    return ends.select(key, value, F.coalesce(value, line).alias("line"), F.coalesce(value, F.when(width > 0, F.least(x, y))).alias("low"), F.coalesce(value, F.when(width > 0, F.greatest(x, y))).alias("high"))
