"""Quantile sketches of a number per period, kept as a table and added up at will.

A sketch counts values in bins whose borders grow by a fixed ratio, so that every value is
within ``error`` of the middle of its bin, relative to the value. Bins are the same for
every period and table: the sketch of a month is the sum of its days' sketches, bin by bin,
whichever tasks or runs made them, and a stored sketch takes new rows by adding their
counts. Zero and negative values have bins of their own; nulls and values that are not
numbers are counted beside the bins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ERROR = 0.01
#: Values nearer to zero than this count as zero.
LEAST = 1e-9


def _ratio(error: float) -> float:
    if not 0 < error < 1:
        raise ValueError("error must lie between 0 and 1")
    return (1 + error) / (1 - error)


def bin_of(value: Column, error: float = ERROR) -> Column:
    """The bin's number, in order of the values: its sign is the value's, 0 is zero, null
    no number."""
    shift = _shift(error)
    size = F.ceil(F.log(F.abs(value)) / F.lit(math.log(_ratio(error)))) + F.lit(shift)
    signed = F.when(F.abs(value) < LEAST, F.lit(0)).when(value > 0, size).otherwise(-size)
    sound = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(sound, signed.cast("int"))


def _shift(error: float) -> int:
    """Moves the bin of ``LEAST`` to 1, so that a bin's sign is its values'."""
    return 1 - math.ceil(math.log(LEAST) / math.log(_ratio(error)))


def value_of(number: Column, error: float = ERROR) -> Column:
    """The value a bin stands for: within ``error`` of each of its members."""
    ratio = _ratio(error)
    power = F.exp((F.abs(number) - F.lit(_shift(error))) * F.lit(math.log(ratio)))
    return F.when(number == 0, F.lit(0.0)).otherwise(F.signum(number.cast("double")) * power * F.lit(2 / (1 + ratio)))


def sketch(df: DataFrame, period: str, value: str, error: float = ERROR) -> DataFrame:
    """``(period, bin, n)``: one row per bin in use. ``bin`` is null for what is no number.

    Counts combine in each task, so a period with a third of all rows sends as much as
    any other.
    """
    number = F.col(f"`{value}`").cast("double")
    return df.groupBy(F.col(f"`{period}`").alias("period"), bin_of(number, error).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def merge(*sketches: DataFrame, period: Column | None = None) -> DataFrame:
    """Sketches added up; ``period`` maps the periods to coarser ones (a day to its month)."""
    every = sketches[0]
    for s in sketches[1:]:
        every = every.unionByName(s)
    return every.groupBy((F.col("period") if period is None else period).alias("period"), "bin").agg(F.sum("n").alias("n"))


def quantiles(sketched: DataFrame, wanted: Sequence[float], error: float = ERROR) -> DataFrame:
    """``(period, q, value)``: the value of rank ``ceil(q * n)`` (at least 1), within ``error``.

    The windows run over the bins of a period, whose number is bounded by the error.
    """
    bins = sketched.where("bin is not null")
    by = Window.partitionBy("period")
    upto = F.sum("n").over(by.orderBy("bin"))
    placed = bins.select("period", "bin", "n", upto.alias("upto"), F.sum("n").over(by).alias("total"))
    asked = placed.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in wanted])))
    rank = F.greatest(F.ceil(F.col("q") * F.col("total")), F.lit(1))
    hit = asked.where((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank))
    return hit.select("period", "q", value_of(F.col("bin"), error).alias("value"))


def drift(sketched: DataFrame, parts: int = 10, floor: float = 1e-6) -> DataFrame:
    """``(period, n, psi)``: population stability index of each period against the first,
    over ``parts`` ranges that hold about as many of the first period's values each.

    The ranges are runs of the first period's bins. What is no number is a range of its own.
    """
    everything = Window.partitionBy()
    first = sketched.withColumn("least", F.min("period").over(everything)).where(F.col("period") == F.col("least"))
    upto = F.sum("n").over(Window.partitionBy("period").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy("period"))
    cut = first.where("bin is not null").select("bin", F.ceil(upto * F.lit(parts) / total).cast("int").alias("part"))
    # The highest bin of each part but the last: at most ``parts - 1`` rows.
    tops = cut.groupBy("part").agg(F.max("bin").alias("top")).where(F.col("part") < parts)
    borders = tops.agg(F.array_sort(F.collect_list("top")).alias("tops"))
    number = F.when(F.col("bin").isNull(), F.lit(-1)).otherwise(F.size(F.filter("tops", lambda t: t < F.col("bin"))))
    counts = sketched.crossJoin(F.broadcast(borders)).groupBy("period", number.alias("part")).agg(F.sum("n").alias("n"))
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("period")))
    # Periods by the few ranges.
    ranges = counts.agg(F.collect_set("part").alias("every"))
    grid = sketched.select("period").distinct().crossJoin(F.broadcast(ranges)).select("period", F.explode("every").alias("part"))
    full = grid.join(shares, ["period", "part"], "left")
    own = F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(floor))
    base = F.first(own).over(Window.partitionBy("part").orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = full.select("period", F.coalesce("n", F.lit(0)).alias("n"), own.alias("own"), base.alias("base"))
    return held.groupBy("period").agg(
        F.sum("n").alias("n"), F.sum((F.col("own") - F.col("base")) * F.log(F.col("own") / F.col("base"))).alias("psi")
    )
