"""Exact quantiles of groups by iterated histograms (key F3).

Sorting a group, or collecting it, would hold the whole of it in one task.
Here a round counts every group's values in BINS equal bins of the interval
that still holds the wanted places (first: from its least to its largest
value), with the least and largest value of each bin; partial counts are
combined map-side, so a task sends at most BINS rows a group, whatever the
group's share of the rows. The next interval of a place is its bin, shrunk to
the values in it, and a place is found when its bin holds one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmill.operators.prefix import materialize

BINS = 1024


def quantiles(df: DataFrame, group: str, value: str, names: dict[str, float]) -> DataFrame:
    """One row per group with a column for each of ``names`` (column: share
    between 0 and 1): the value at place share * (n - 1) of the group's
    sorted values, between two values in proportion, as a double. Null and
    NaN values are left out; a null group is a group, and one without values
    has no row."""
    if not names or any(not 0 <= p <= 1 for p in names.values()):
        raise ValueError("shares must be between 0 and 1")
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))\
        .where("v is not null and not isnan(v)")
    ends = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    places = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(p) * (F.col("n") - 1)).alias("at"))
                       for name, p in names.items()])
    both = ends.select("g", "lo", "hi", F.explode(places).alias("p")).select("g", "lo", "hi", "p.name", "p.at")
    wanted = materialize(both.select("*", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("place"))
                         .select("g", "lo", "hi", "name", "at", "place", F.lit(0).cast("long").alias("below")))
    while not wanted.where("lo < hi").isEmpty():
        wanted = materialize(_narrowed(rows, wanted))
    part = F.when(F.col("place") == F.floor("at"), 1 - (F.col("at") - F.floor("at"))).otherwise(F.col("at") - F.floor("at"))
    # of an infinite value a share of 0 is 0
    each = wanted.groupBy("g", "name").agg(F.sum(F.when(part > 0, F.col("lo") * part).otherwise(0.0)).alias("q"))
    return each.groupBy("g").agg(*[F.max(F.when(F.col("name") == name, F.col("q"))).alias(name) for name in names]) \
        .withColumnRenamed("g", group)


def _narrowed(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Each open place with its bin as the new interval."""
    open_ = wanted.where("lo < hi")
    spans = open_.select("g", "lo", "hi").distinct()
    inside = rows.join(spans.select(F.col("g").alias("g2"), "lo", "hi"),
                       F.col("g").eqNullSafe(F.col("g2")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
    # halves keep the width of an interval of very large values finite
    share = F.try_divide(F.col("v") / 2 - F.col("lo") / 2, F.col("hi") / 2 - F.col("lo") / 2)
    step = F.when(F.col("v") == F.col("lo"), 0).when(F.col("v") == F.col("hi"), BINS - 1).otherwise(
        F.least(F.floor(F.coalesce(F.nanvl(share, F.lit(0.5)), F.lit(0.5)) * (BINS - 2)) + 1, F.lit(BINS - 2)))
    bins = inside.groupBy("g", "lo", "hi", step.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
    upto = F.sum("c").over(Window.partitionBy("g", "lo", "hi").orderBy("bin")
                           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = bins.withColumn("upto", upto).select(F.col("g").alias("g2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                                                  "least", "most", "c", "upto")
    found = open_.join(summed, F.col("g").eqNullSafe(F.col("g2")) & (F.col("lo") == F.col("lo2")) & (F.col("hi") == F.col("hi2"))
                       & (F.col("place") < F.col("below") + F.col("upto"))
                       & (F.col("place") >= F.col("below") + F.col("upto") - F.col("c")))
    narrowed = found.select("g", F.col("least").alias("lo"), F.col("most").alias("hi"), "name", "at", "place",
                            (F.col("below") + F.col("upto") - F.col("c")).alias("below"))
    return narrowed.union(wanted.where("lo = hi"))
