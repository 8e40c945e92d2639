"""Sharding by sampled splitters (DataFrame functions only).

1. Size-weighted sample of record keys: the ``samples`` smallest values of
   ``-ln(u) / size`` with ``u`` a hash of the key in (0, 1). Tasks send only
   values below a threshold that about ``samples`` records of the whole table
   pass, so what reaches the driver does not grow with the tasks.
2. Quantiles of the sampled keys cut the key order into fine ranges.
3. The exact records and bytes of every range are counted (one row per
   range). A range above ``overfull`` times the mean that holds more than
   one key is cut again by a sample drawn from it alone, until none is left.
4. Records move once, to their range (a narrow pass before it counts the
   shards' records). A running sum inside a range plus the
   range's offset is a record's place in the whole order, and its middle
   byte decides its shard, so shard sizes differ by less than two records
   from each other. A range that straddles a border is cut there.

Keys sort by (hash of the group column, id): equal texts stay side by side
without ever being one undividable key, so a group of copies that holds a
third of all rows is cut like any other stretch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 4096
RANGES_PER_SHARD = 8
OVERFULL = 4.0


def _range_of(key: Column, splitters: list[str]) -> Column:
    """Number of splitters that are not above the key: a binary search over
    a constant array, log2(n) comparisons a record."""
    if not splitters:
        return F.lit(0)
    table = F.split(F.lit(",".join(splitters)), ",")
    steps = [1 << b for b in range(len(splitters).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(splitters)) & (F.get(table, low + step - 1) <= key),
            low + step).otherwise(low))


def _digits(number: Column) -> Column:
    """16 hex digits that sort as the signed 64-bit number."""
    return F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def _sample(keyed: DataFrame, weight: Column, total: float, n: int, salt: int) -> list[str]:
    """Up to ``n`` keys drawn without replacement, likelier the larger their
    weight: the ``n`` smallest of -ln(u) / weight. ``total`` is the sum of the
    weights: at most that many times t records are expected below t."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(salt), "_key"), 11) + 1) / F.lit(float((1 << 53) + 1))
    few = (n + 4 * n ** 0.5 + 16) / max(total, 1e-300)
    rows = keyed.select("_key", (-F.ln(u) / weight).alias("_p")).where(F.col("_p") < few) \
        .orderBy("_p", "_key").limit(n).collect()
    return sorted({r["_key"] for r in rows})


def _per_range(values: dict[int, float]) -> Column:
    """The value of a record's range, looked up in a constant array."""
    table = F.split(F.lit(",".join(str(values.get(k, 0)) for k in range(max(values) + 1))), ",")
    return F.get(table, F.col("_range"))


def shard(df: DataFrame, n_shards: int, size: Column, group: Column, key: str,
          samples: int = SAMPLES, ranges_per_shard: int = RANGES_PER_SHARD,
          overfull: float = OVERFULL) -> DataFrame:
    """Add ``shard`` (0 to n_shards - 1; sums of ``size`` near equal) and
    ``slot`` (gapless from 0 in each shard) to every row.

    ``size`` must be positive, ``key`` a whole-number id; ``group`` holds
    together what should lie side by side. Null ids and null groups sort
    first. Rows that repeat a key wholly are kept: they fall into the same
    range, their order among themselves is by size and then undefined (they
    are equal rows). An empty table gives an empty result. Columns named
    shard or slot are replaced; all others are kept, whatever their names."""
    group_hash = F.when(group.isNull(), F.lit(-(1 << 63))).otherwise(F.xxhash64(group))
    number = F.when(F.col(key).isNull(), F.lit("-")).otherwise(_digits(F.col(key).cast("long")))
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    keyed = df.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("_row"),
                      size.cast("long").alias("_size"), F.concat(_digits(group_hash), number).alias("_key"))
    own_columns = [F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(kept)]

    n_ranges = n_shards * ranges_per_shard
    total = keyed.select(F.sum("_size")).first()[0] or 0
    drawn = _sample(keyed, F.col("_size"), total, max(samples, n_ranges), 0)
    splitters = sorted({drawn[len(drawn) * k // n_ranges] for k in range(1, n_ranges)}) if drawn else []
    salt = 0
    while True:
        ranged = keyed.withColumn("_range", _range_of(F.col("_key"), splitters))
        totals = ranged.groupBy("_range").agg(
            F.count(F.lit(1)).alias("n"), F.sum("_size").alias("b"),
            F.min("_key").alias("lo"), F.max("_key").alias("hi")).orderBy("_range").collect()
        n_bytes, n_rows = sum(r["b"] for r in totals), sum(r["n"] for r in totals)
        full = [r for r in totals if r["lo"] != r["hi"] and (
            r["b"] > overfull * n_bytes / n_ranges or r["n"] > 2 * overfull * n_rows / n_ranges)]
        if not full:
            break
        salt += 1  # one pass draws from all overfull ranges, as many keys from each
        inside = ranged.where(F.col("_range").isin([r["_range"] for r in full]))
        weight = F.greatest(F.col("_size") / _per_range({r["_range"]: r["b"] for r in full}).cast("double"),
                            1 / _per_range({r["_range"]: r["n"] for r in full}).cast("double"))
        got = _sample(inside, weight, len(full), 32 * len(full), salt)  # each range weighs one to two
        more = {r["hi"] for r in full}
        for r in full:
            own = [k for k in got if r["lo"] < k <= r["hi"]]
            more |= {own[len(own) * k // 8] for k in range(8) if own}
        splitters = sorted(set(splitters) | more)

    before, at = {}, [0, 0]
    for r in totals:
        before[r["_range"]] = tuple(at)
        at = [at[0] + r["b"], at[1] + r["n"]]
    if not before:
        return keyed.select(*own_columns, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    in_range = Window.partitionBy("_range").orderBy("_key", "_size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("_upto", F.sum("_size").over(in_range)
        + _per_range({k: v[0] for k, v in before.items()}).cast("long")).withColumn(
        "_place", F.count(F.lit(1)).over(in_range) - 1
        + _per_range({k: v[1] for k, v in before.items()}).cast("long"))
    middle = (F.col("_upto") - F.expr("_size div 2")).cast("decimal(38,0)")
    placed = placed.withColumn("shard", F.least(
        F.floor(middle * n_shards / F.lit(max(n_bytes, 1)).cast("decimal(38,0)")),
        F.lit(n_shards - 1)).cast("int"))
    counts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    starts = [sum(counts.get(j, 0) for j in range(k)) for k in range(n_shards)]
    first = F.get(F.split(F.lit(",".join(map(str, starts))), ","), F.col("shard")).cast("long")
    return placed.select(*own_columns, "shard", (F.col("_place") - first).alias("slot"))
