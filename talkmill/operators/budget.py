"""Token budgets, balanced mixes, epochs and share-based blends
(keys G2, G3, G4, G5).

All four rest on one rule: order rows by a seeded hash of their key and
keep a row while the tokens *before* it stay under the budget. The
running sum is the bucketed prefix sum of ``talkmill.operators.prefix``:
hash buckets are uniform, so no task holds more than ``rows / 2**bits``
rows whatever the data. Budgets that depend on the data are scalar
subqueries (``DataFrame.scalar()``), never a driver round trip.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.functions.hashing import hash_bucket, hash_order
from talkmill.operators.prefix import join_null_safe, materialize, running_total

DEFAULT_BITS = 16  # 65,536 uniform buckets: ~N/65536 rows per window task


def _budget(b) -> Column:
    return b if isinstance(b, Column) else F.lit(b)


def token_subset(df: DataFrame, n_tok: str, key: str | Column, budget,
                 seed: int | str = 0, group: Sequence[str] = (),
                 bits: int = DEFAULT_BITS) -> DataFrame:
    """Keep rows in seeded-hash order while tokens before < budget.

    ``budget`` is a number or a Column (per-row/group budgets, scalar
    subqueries). Adds ``tokens_before``. With ``group`` the order and the
    budget restart per group value."""
    h = hash_order(seed, key)
    keyed = df.withColumn("_h", h).withColumn("_hb", hash_bucket("_h", bits)).withColumn(
        "_hk", (F.col(key) if isinstance(key, str) else key).cast("string"))
    ranked = running_total(keyed, F.col(n_tok), order=["_h", "_hk"], bucket=["_hb"],
                           before="tokens_before", group=group)
    return ranked.where(F.col("tokens_before") < _budget(budget)).drop("_h", "_hb", "_hk")


def total_tokens(df: DataFrame, n_tok: str) -> Column:
    """Scalar subquery: total tokens of ``df`` (0 for an empty one)."""
    return df.agg(F.coalesce(F.sum(n_tok).cast("bigint"), F.lit(0))).scalar()


def balance_1to1(a: DataFrame, b: DataFrame, n_tok: str, key_a: str | Column,
                 key_b: str | Column, seed: int | str = 0) -> DataFrame:
    """Equal tokens from two sides: budget = least(total_a, total_b),
    G2 on both, union with ``origin`` a / b. The sides differ by less than
    one row's tokens."""
    budget = F.least(total_tokens(a, n_tok), total_tokens(b, n_tok))
    sa = token_subset(a, n_tok, key_a, budget, seed).withColumn("origin", F.lit("a"))
    sb = token_subset(b, n_tok, key_b, budget, seed).withColumn("origin", F.lit("b"))
    return sa.unionByName(sb, allowMissingColumns=True)


def epochs(df: DataFrame, n_tok: str, key: str, e, seed: int | str = 0,
           group: Sequence[str] = (), bits: int = DEFAULT_BITS,
           group_total: Column | None = None) -> DataFrame:
    """Repeat every row ``ceil(e)`` times (``copy_no`` 0..); the last
    copy of a fractional ``e`` keeps, in hash order, rows while tokens
    before < frac(e) x total tokens (of the group). ``e`` may be a number
    or a Column constant within each group; e = 0 keeps nothing.

    The partial copy is decided once per *input* row (one ranked pass in
    the hash order of ``key:copy_no``); copies are generated afterwards
    with ``explode`` and filtered, so the data is never split into two
    lineages. With ``group`` the group totals come from ``group_total``
    when the caller has them on every row (``blend``), else from a
    per-group aggregate joined back (AQE broadcasts it: one row per
    group)."""
    group = list(group)
    e_col = _budget(e).cast("double")
    if group and group_total is not None:
        base = df.withColumn("_gt", group_total)
    elif group:
        totals = df.groupBy(*group).agg(F.sum(n_tok).cast("bigint").alias("_gt"))
        base = join_null_safe(df, totals, group)
    else:
        base = df.withColumn("_gt", total_tokens(df, n_tok))
    base = base.withColumn("_e", e_col).withColumn("_full", F.floor("_e").cast("int")) \
        .withColumn("_frac", F.col("_e") - F.floor("_e"))
    base = base.where(F.col("_e") > 0)
    copy_key = F.concat(F.col(key).cast("string"), F.lit(":"), F.col("_full").cast("string"))
    keyed = base.withColumn("_ck", copy_key)
    h = hash_order(seed, "_ck")
    keyed = keyed.withColumn("_h", h).withColumn("_hb", hash_bucket("_h", bits))
    ranked = running_total(keyed, F.col(n_tok), order=["_h", "_ck"], bucket=["_hb"],
                           before="_tb", group=group)
    in_part = (F.col("_frac") > 0) & (F.col("_tb") < F.col("_frac") * F.col("_gt"))
    copies = ranked.withColumn("_in_part", in_part).withColumn(
        "copy_no", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_e")).cast("int") - 1)))
    kept = copies.where((F.col("copy_no") < F.col("_full"))
                        | ((F.col("copy_no") == F.col("_full")) & F.col("_in_part")))
    return kept.drop("_e", "_full", "_frac", "_gt", "_ck", "_h", "_hb", "_tb", "_in_part")


def blend(df: DataFrame, n_tok: str, key: str, source: str, shares: Mapping[str, float],
          target_tokens, seed: int | str = 0, bits: int = DEFAULT_BITS) -> DataFrame:
    """A mix of ``target_tokens`` tokens where each source gets its
    share whatever its size: epochs_s = quota_s / size_s, then G4 per source.
    Shares are normalised over the listed sources that have tokens in the
    data, so an absent or token-less source leaves its quota to the others.
    The sizes of the listed sources come to the driver (one number each), so
    no row is joined on the (possibly very skewed) source key. Sources
    without a share are left out. ``df`` is read twice: pass a narrow table
    that is cheap to read (``materialize``)."""
    if sum(shares.values()) <= 0 or min(shares.values()) < 0:
        raise ValueError("shares must not be negative and must add up to a positive number")
    listed = df.where(F.col(source).isin(list(shares)))
    sizes = {r[source]: r["_s"] for r in listed.groupBy(source).agg(
        F.sum(n_tok).cast("bigint").alias("_s")).collect() if r["_s"]}
    total_share = float(sum(shares[k] for k in sizes))
    if not total_share:
        return df.limit(0).withColumn("copy_no", F.lit(0))
    weights = F.create_map(*[x for k in sizes for x in (F.lit(k), F.lit(float(shares[k]) / total_share))])
    size = F.element_at(F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))]), F.col(source))
    sized = listed.where(F.col(source).isin(list(sizes))).withColumn("_size", size)
    e = (_budget(target_tokens) * F.element_at(weights, F.col(source))) / F.col("_size")
    out = epochs(sized.withColumn("_es", e), n_tok, key, F.col("_es"), seed, group=[source],
                 bits=bits, group_total=F.col("_size"))
    return out.drop("_es", "_size")
