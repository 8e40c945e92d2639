"""Distributed running totals over a global order.

A global ``sum(...) over (order by k)`` without a partition runs in one
task. Instead the order is cut into *buckets* that are monotone in the
order and bounded in size (a block of rows of one file, or the top bits of
a uniform hash):

1. one hash shuffle by bucket; inside each bucket a windowed running sum;
2. per-bucket totals by a partial aggregation of the input (map-side
   combine: one row per task and bucket crosses the network);
3. exclusive running sum over the bucket totals (one row per bucket, so
   its size grows with data / bucket size, not with data);
4. join the offsets back; the big side is already partitioned by bucket,
   so only the small offsets table moves (AQE may broadcast it once its
   real size is known).

The order columns must be unique together (end them with a key) so the
result is deterministic and survives task re-execution.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on ``keys`` where null equals null (a null group is
    a group like any other); the right side's key columns are dropped."""
    keys = list(keys)
    nullable = any(left.schema[k].nullable or right.schema[k].nullable for k in keys)
    if not nullable:
        return left.join(right, on=keys, how="inner")
    renamed = right.select(*[F.col(k).alias(f"_nk{i}") for i, k in enumerate(keys)],
                           *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(renamed[f"_nk{i}"]) for i, k in enumerate(keys)]
    return left.join(renamed, on=cond, how="inner").drop(*[f"_nk{i}" for i in range(len(keys))])


def running_total(df: DataFrame, value: Column, order: Sequence[str],
                  bucket: Sequence[str], before: str = "before",
                  total: str | None = None, group: Sequence[str] = ()) -> DataFrame:
    """Add ``before`` = sum of ``value`` over all rows strictly earlier in
    (bucket, order) order, restarted for every ``group`` value. ``bucket``
    columns must sort consistently with ``order`` (a bucket is a coarsening
    of the order). With ``total`` set, also add the group's total."""
    group, bucket, order = list(group), list(bucket), list(order)
    keys = group + bucket
    valued = df.withColumn("_rt_v", value.cast("bigint"))
    parted = valued.repartition(*keys)
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = parted.withColumn("_rt_in", F.sum("_rt_v").over(inside))
    # totals from the unpartitioned input: map-side partial sums, so only one
    # row per (task, bucket) is shuffled
    totals = valued.groupBy(*keys).agg(F.sum("_rt_v").alias("_rt_bt"))
    prior = Window.partitionBy(*group).orderBy(*bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        F.coalesce(F.sum("_rt_bt").over(prior), F.lit(0)).alias("_rt_off"),
        *([F.sum("_rt_bt").over(Window.partitionBy(*group)).alias(total)] if total else []))
    out = join_null_safe(ranked, offsets, keys)
    return out.withColumn(before, F.col("_rt_off") + F.col("_rt_in") - F.col("_rt_v")).drop(
        "_rt_v", "_rt_in", "_rt_off")


def dense_position(df: DataFrame, order: Sequence[str], bucket: Sequence[str],
                   name: str) -> DataFrame:
    """0-based dense position of every row in the global order."""
    return running_total(df, F.lit(1), order, bucket, before=name)


def global_index(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """0-based position of every row in an arbitrary global order whose
    keys are unique together, for orders with no natural bounded bucket
    (e.g. a vocabulary by count desc, token).

    Spark's range-partitioned sort balances the partitions from a sample;
    the sorted table is written with ``checkpoint()`` to the shared
    checkpoint folder so the partition contents are fixed; each row gets
    ``monotonically_increasing_id`` (partition id in the high bits, row in
    the partition below); per-partition counts (one row per partition)
    give the offsets."""
    from talkmill.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    fixed = df.orderBy(*order).checkpoint(eager=True)
    mid = fixed.withColumn("_gi_mid", F.monotonically_increasing_id())
    mid = mid.withColumn("_gi_part", F.shiftright("_gi_mid", 33)).withColumn(
        "_gi_pos", F.col("_gi_mid") - F.shiftleft(F.col("_gi_part"), 33))
    counts = mid.groupBy("_gi_part").agg(F.count(F.lit(1)).alias("_gi_n"))
    prior = Window.orderBy("_gi_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_gi_part", F.coalesce(F.sum("_gi_n").over(prior), F.lit(0))
                            .alias("_gi_off"))
    out = mid.join(offsets, on="_gi_part", how="inner")
    return out.withColumn(name, (F.col("_gi_off") + F.col("_gi_pos")).cast("bigint")).drop(
        "_gi_mid", "_gi_part", "_gi_pos", "_gi_off")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written
    files. Used on *narrow* tables (keys + counts) that several branches of
    one plan read, so the lineage above them (scan + tokenise) runs once; the
    copy survives executor loss, and its size is known to the planner.
    ``session.release_tables`` deletes such tables after a job."""
    from talkmill.session import new_path
    path = new_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
