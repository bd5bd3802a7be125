"""Contract cost, the grid of volumes and the choice under mean plus tail risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions import columns as C
from wattframe.operators.stats import upper_cvar

STEP = 0.0025
TIE = 1e-9


def monthly_cost(use: Column, volume: Column, hours: Column, band: Column, price: Column, spot: Column) -> Column:
    """contracted, delivered, cost, short and surplus of a month: use within the band at the contract's price, the rest at spot."""
    contracted = volume * hours
    low, high = contracted * (1 - band), contracted * (1 + band)
    delivered = C.clip(use, low, high)
    return F.struct(
        contracted.alias("contracted"), delivered.alias("delivered"), (delivered * price + (use - delivered) * spot).alias("cost"),
        F.greatest(use - high, F.lit(0.0)).alias("short"), F.greatest(low - use, F.lit(0.0)).alias("surplus"),
    )


def ratio_grid(bands: DataFrame, step: float = STEP) -> DataFrame:
    """The bands' columns and r: steps from 1 / (1 + band) up to 1 / (1 - band) (or r_max where given), 1 and both ends; rounded to 12 places."""
    low = 1 / (1 + F.col("band"))
    high = F.coalesce(F.col("r_max"), 1 / (1 - F.col("band"))) if "r_max" in bands.columns else 1 / (1 - F.col("band"))
    ends = bands.withColumns({"low": low, "high": high})
    inner = F.transform(F.sequence(F.lit(0), F.ceil((F.col("high") - F.col("low")) / step).cast("int")), lambda k: F.col("low") + k * step)
    points = F.concat(F.filter(inner, lambda r: r < F.col("high") - 1e-12), F.array(F.lit(1.0), F.col("high")))
    # Rounding to twelve places goes through a decimal: equal points meet whatever way they were computed.
    return ends.select(*bands.columns, F.explode(F.array_distinct(F.transform(points, lambda r: F.round(r.cast("decimal(28,15)"), 12).cast("double")))).alias("r"))


def evaluate(scenarios: DataFrame, candidates: DataFrame, keys: list[str], weight: float = 0.5, alpha: float = 0.95, more: list[str] | None = None) -> DataFrame:
    """Expected cost, CVaR and objective of each candidate.

    scenarios: keys, scenario, use, spot, hours; candidates: keys, more (further keys), r, volume, band, price. The join is by
    key; a key's scenarios times its grid are the decision's own, fixed size.
    """
    met = scenarios.join(candidates, keys)
    keys = [*(more or []), *keys]
    cost = monthly_cost(F.col("use"), F.col("volume"), F.col("hours"), F.col("band"), F.col("price"), F.col("spot"))["cost"]
    year = met.groupBy(*keys, "r", "scenario").agg(F.sum(cost).alias("cost"))
    tail = upper_cvar(year, [*keys, "r"], "cost", alpha)
    mean = year.groupBy(*keys, "r").agg(F.avg("cost").alias("expected"))
    return mean.join(tail, [*keys, "r"]).withColumn("objective", F.col("expected") + weight * F.col("cvar"))


def choose(evaluated: DataFrame, keys: list[str]) -> DataFrame:
    """The least objective; of those within the tolerance the ratio closest to 1, then the smaller."""
    low = F.min("objective").over(Window.partitionBy(*keys))
    near = evaluated.withColumn("__low", low).filter(F.col("objective") <= F.col("__low") + TIE * F.greatest(F.lit(1.0), F.abs("__low")))
    key = F.struct(F.abs(F.col("r") - 1).alias("a"), F.col("r").alias("b"))
    return near.groupBy(*keys).agg(F.min_by(F.struct("r", "expected", "cvar", "objective"), key).alias("x")).select(*keys, "x.*")
