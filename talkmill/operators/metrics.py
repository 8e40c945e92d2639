"""Statistics over generated dialogues and their ratings
(keys F3-F10, F12, F13).

Every aggregate here is decomposable (sum / count / min / max) so Spark
combines map-side before the shuffle (exact percentiles by iterated
histograms); no group is collected, since one style or one rater may hold a
third of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill.functions.text import words
from talkmill.operators.prefix import materialize, running_total
from talkmill.operators.quantiles import quantiles


def _r(c: Column, digits: int = 6) -> Column:
    return F.round(c.cast("double"), digits)


def style_length(df: DataFrame, tokens: str = "conversation_tokens",
                 style: str = "prompt_style", longest: DataFrame | None = None,
                 approx_median: bool = False, percentiles: dict[str, float] | None = None) -> DataFrame:
    """mean / min / max dialogue tokens per style, plus a ``longest``
    row for the longest-per-context set when given. ``percentiles`` adds
    exact ones (column name: share), found without holding a style in one
    task (``operators.quantiles``); ``approx_median`` adds
    ``percentile_approx``, a bounded sketch for a single pass."""
    def stats(d: DataFrame, label: Column | None) -> DataFrame:
        d = d if label is None else d.withColumn(style, label)
        extra = [F.percentile_approx(tokens, 0.5, 10000).cast("bigint").alias("median_tokens")] \
            if approx_median else []
        out = d.groupBy(style).agg(F.count(F.lit(1)).cast("bigint").alias("n_dialogues"),
                                   _r(F.avg(tokens)).alias("avg_tokens"),
                                   F.min(tokens).cast("bigint").alias("min_tokens"),
                                   F.max(tokens).cast("bigint").alias("max_tokens"), *extra)
        if not percentiles:
            return out
        q = quantiles(d, style, tokens, percentiles).withColumnRenamed(style, "_style")
        return out.join(q, F.col(style).eqNullSafe(F.col("_style")), "left").select(
            *out.columns, *[_r(F.col(c)).alias(c) for c in percentiles])
    out = stats(df, None)
    if longest is not None:
        out = out.unionByName(stats(longest, F.lit("longest")))
    return out


def length_response(df: DataFrame, n_in: str = "context_tokens",
                    n_out: str = "conversation_tokens", style: str = "prompt_style",
                    bin_width: int = 100) -> DataFrame:
    """mean output tokens by input-length bin and style."""
    b = (F.floor(F.col(n_in) / F.lit(bin_width)) * bin_width).cast("bigint")
    return df.groupBy(style, b.alias("input_bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        _r(F.avg(n_out)).alias("avg_output_tokens"))


def corpus_tokens(raw: DataFrame, synthetic: DataFrame, source: str = "source",
                  raw_tok: str = "n_tokens", syn_tok: str = "conversation_tokens") -> DataFrame:
    """raw and generated tokens per source and the expansion ratio.
    Both sides are aggregated first; the join is between two small
    per-source tables."""
    r = raw.groupBy(source).agg(F.sum(raw_tok).cast("bigint").alias("raw_tokens"))
    s = synthetic.groupBy(source).agg(F.sum(syn_tok).cast("bigint").alias("synthetic_tokens"))
    out = r.join(s, on=source, how="full").fillna(0, ["raw_tokens", "synthetic_tokens"])
    return out.withColumn("expansion", _r(F.try_divide(F.col("synthetic_tokens"),
                                                       F.col("raw_tokens"))))


def score_filter(scores: DataFrame, threshold: float = 3.0, key: str = "conv_key",
                 metric: str = "metric", score: str = "score") -> DataFrame:
    """mean of the per-metric means per dialogue; ``kept`` when the
    mean reaches ``threshold``. Two partial aggregations, no skew risk."""
    per_metric = scores.groupBy(key, metric).agg(F.avg(score).alias("_m"))
    out = per_metric.groupBy(key).agg(F.avg("_m").alias("_mean"),
                                      F.count(F.lit(1)).cast("bigint").alias("n_metrics"))
    return out.select(key, _r(F.col("_mean")).alias("mean_score"), "n_metrics",
                      (F.col("_mean") >= F.lit(threshold)).alias("kept"))


def score_histogram(filtered: DataFrame, mean: str = "mean_score",
                    threshold: float = 3.0) -> DataFrame:
    """dialogues per rounded mean score and their share; the window
    runs over the histogram (a handful of rows), not over the data."""
    h = filtered.groupBy(F.round(F.col(mean)).cast("int").alias("score_bin")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    tot = Window.partitionBy()
    high = F.sum(F.when(F.col("score_bin") >= F.lit(threshold), F.col("n")).otherwise(0)).over(tot)
    return h.select("score_bin", "n", _r(F.col("n") / F.sum("n").over(tot)).alias("share"),
                    _r(high / F.sum("n").over(tot)).alias("share_high"))


def average_ranks(df: DataFrame, col: str, out: str) -> DataFrame:
    """Average-tie ranks (1-based) of a value-count table: (#smaller values)
    + (count + 1) / 2. ``df`` has one row per value with its count ``_cnt``;
    a range-partitioned sort orders the values, and the counts of its
    partitions give the offsets, so the number of tasks follows the data."""
    sorted_ = materialize(df.repartitionByRange(col).sortWithinPartitions(col).select(
        col, "_cnt", F.monotonically_increasing_id().alias("_at")))
    part = sorted_.withColumn("_part", F.shiftright("_at", 33))
    ranked = running_total(part, F.col("_cnt"), order=["_at"], bucket=["_part"], before="_lt")
    return ranked.select(col, (F.col("_lt") + (F.col("_cnt") + 1) / 2.0).alias(out))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """F8: Spearman correlation with average ranks for ties (Pearson on
    ranks; rows with a null on either side are left out). The ranks meet the
    counted pairs of values, not the rows, so a value that many rows share is
    a few rows here."""
    pairs = materialize(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(
        F.count(F.lit(1)).cast("bigint").alias("_w")))
    ranks = [average_ranks(pairs.groupBy(c).agg(F.sum("_w").cast("bigint").alias("_cnt")), c, r)
             for c, r in ((x, "_rx"), (y, "_ry"))]
    d = pairs.join(ranks[0], on=x).join(ranks[1], on=y)
    n, rx, ry, w = F.sum("_w"), F.col("_rx"), F.col("_ry"), F.col("_w")
    mean = (n + 1) / 2.0  # ranks are 1..n, ties share their mean
    sums = d.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("n"), mean.alias("m"),
                 F.sum(w * rx * ry).alias("xy"), F.sum(w * rx * rx).alias("xx"), F.sum(w * ry * ry).alias("yy"))
    square = F.col("n") * F.col("m") * F.col("m")
    corr = F.try_divide(F.col("xy") - square, F.sqrt((F.col("xx") - square) * (F.col("yy") - square)))
    return sums.select("n", _r(corr).alias("spearman"))


def word_numbers(col: str) -> Column:
    """The words of a text as 64-bit hashes (null text: none)."""
    return F.coalesce(F.transform(words(col), lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))


_PLACE = np.array([pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(64)], np.uint64)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    at = column.offsets.to_numpy()
    return column.flatten().to_numpy().view(np.uint64), at - at[0]


def _grams(flat: np.ndarray, at: np.ndarray, n: int, bits: int) -> np.ndarray:
    """A number of every n-gram of the lists: the list's in the high ``bits``
    bits, below it the gram's hash."""
    total = np.maximum(0, np.diff(at) - n + 1)
    row = np.repeat(np.arange(len(total)), total)
    start = at[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(total) - total, total)
    h = np.zeros(len(row), np.uint64)
    for k in range(n):
        h += flat[start + k] * _PLACE[k]
    h = (h ^ (h >> np.uint64(32))) * _PLACE[5]
    h = (h ^ (h >> np.uint64(29))) * _PLACE[7]
    return (row.astype(np.uint64) << np.uint64(64 - bits)) | (h >> np.uint64(bits))


def _overlaps(n_max: int):
    """Rows (group, words of hypothesis and reference) to sums per group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield of_batch(batch)

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        groups = pc.dictionary_encode(batch.column("g"), null_encoding="encode")
        group, n_groups = groups.indices.to_numpy(), len(groups.dictionary)
        (hyp, hyp_at), (ref, ref_at) = _lists(batch.column("h")), _lists(batch.column("r"))
        edges = ref_at.tolist()
        # rows of one fan-out follow each other with the same reference
        new = [i == 0 or not np.array_equal(ref[edges[i - 1]:edges[i]], ref[edges[i]:edges[i + 1]])
               for i in range(batch.num_rows)]
        ref_of, size = np.cumsum(new) - 1, np.diff(ref_at)
        own = np.flatnonzero(new)
        ref = ref[np.repeat(new, size)]
        own_at = np.concatenate([[0], np.cumsum(size[own])])
        bits = max(1, batch.num_rows.bit_length())
        shift = np.uint64(64 - bits)
        columns: list[list] = [[], [], []]
        for n in range(1, n_max + 1):
            known, times = np.unique(_grams(ref, own_at, n, bits), return_counts=True)
            gram, count = np.unique(_grams(hyp, hyp_at, n, bits), return_counts=True)
            row = (gram >> shift).astype(np.int64)
            wanted = (gram & ((np.uint64(1) << shift) - np.uint64(1))) | (ref_of[row].astype(np.uint64) << shift)
            place = np.minimum(np.searchsorted(known, wanted), max(0, len(known) - 1))
            met = np.minimum(count, np.where(known[place] == wanted, times[place], 0)) if len(known) else 0 * count
            for column, (of, values) in zip(columns, (
                    (group[row], met), (group, np.maximum(0, np.diff(hyp_at) - n + 1)), (group, np.maximum(0, size - n + 1)))):
                column.append(np.bincount(of, values, n_groups).astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([groups.dictionary] * n_max), pa.array(np.repeat(np.arange(1, n_max + 1), n_groups)),
             *[pa.array(np.concatenate(c)) for c in columns]],
            names=["g", "n", "m", "h", "r"])

    return run


def overlap_counts(df: DataFrame, hyp: str, ref: str, group: str, n_max: int = 4,
                   ref_words: str | None = None) -> DataFrame:
    """Clipped n-gram matches per (group, n): the sum over rows and grams of
    least(count in hypothesis, count in reference), with the hypothesis and
    reference n-gram totals of the rows.

    Every row is one (hypothesis, reference) pair, so two hypotheses of one
    group and context both count, and the groups are those of the data. The
    words go to Python as numbers and a batch's grams are counted at once by
    sorting; a reference that stands in consecutive rows (a fan-out) is
    counted once. Only sums per group are shuffled. ``ref_words`` names a
    column that holds ``word_numbers`` of the reference already, made before a
    fan-out."""
    both = df.select(F.col(group).cast("string").alias("g"), word_numbers(hyp).alias("h"),
                     (F.col(ref_words) if ref_words else word_numbers(ref)).alias("r"))
    sums = both.mapInArrow(_overlaps(n_max), "g string, n long, m long, h long, r long").groupBy("g", "n").agg(
        *[F.sum(c).cast("bigint").alias(name) for c, name in (("m", "matches"), ("h", "hyp_grams"), ("r", "ref_grams"))])
    return sums.select(F.col("g").alias(group), F.col("n").cast("int").alias("n"), "matches", "hyp_grams", "ref_grams")


def bleu(counts: DataFrame, group: str, n_max: int = 4) -> DataFrame:
    """corpus BLEU-n per group from ``overlap_counts``:
    BP * exp(mean ln p_n), BP = min(1, exp(1 - ref/hyp)); any p_n = 0 -> 0."""
    g = counts.groupBy(group).agg(
        *[F.sum(F.when(F.col("n") == k, F.col("matches"))).alias(f"m{k}") for k in range(1, n_max + 1)],
        *[F.sum(F.when(F.col("n") == k, F.col("hyp_grams"))).alias(f"h{k}") for k in range(1, n_max + 1)],
        F.sum(F.when(F.col("n") == 1, F.col("ref_grams"))).alias("ref_len"))
    logs = [F.log(F.try_divide(F.col(f"m{k}"), F.col(f"h{k}"))) for k in range(1, n_max + 1)]
    any_zero = F.lit(False)
    for k in range(1, n_max + 1):
        any_zero = any_zero | F.coalesce(F.col(f"m{k}") == 0, F.lit(True)) | \
            F.coalesce(F.col(f"h{k}") == 0, F.lit(True))
    mean_log = sum(logs[1:], logs[0]) / n_max
    bp = F.least(F.lit(1.0), F.exp(F.lit(1.0) - F.try_divide(F.col("ref_len"), F.col("h1"))))
    score = F.when(any_zero, F.lit(0.0)).otherwise(bp * F.exp(mean_log))
    return g.select(group, F.col("h1").cast("bigint").alias("hyp_len"),
                    F.col("ref_len").cast("bigint").alias("ref_len"),
                    _r(bp).alias("brevity_penalty"), _r(score).alias("bleu"))


def rouge_n(counts: DataFrame, group: str) -> DataFrame:
    """ROUGE-N precision / recall / F1 per (group, n)."""
    p = F.try_divide(F.col("matches").cast("double"), F.col("hyp_grams"))
    r = F.try_divide(F.col("matches").cast("double"), F.col("ref_grams"))
    f = F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return counts.select(group, "n", _r(p).alias("precision"), _r(r).alias("recall"),
                         _r(f).alias("f1"))


def scorecard(results: DataFrame, task_group: Column, baseline: str,
              dataset: str = "dataset", score: str = "score") -> DataFrame:
    """average score per (dataset, task group) and the gain over the
    baseline dataset. ``task_group`` is an expression over the result rows
    (``task_groups`` makes one from a dict); rows where it is null are in
    group ``other``. The baseline is a self-join of the small per-group
    table."""
    tagged = results.withColumn("task_group", F.coalesce(task_group, F.lit("other")))
    avg = tagged.groupBy(dataset, "task_group").agg(F.avg(score).alias("_avg"),
                                                    F.count(F.lit(1)).cast("bigint").alias("n_tasks"))
    base = avg.where(F.col(dataset) == F.lit(baseline)).select(
        "task_group", F.col("_avg").alias("_base"))
    out = avg.join(base, on="task_group", how="left")
    return out.select(dataset, "task_group", "n_tasks", _r(F.col("_avg")).alias("avg_score"),
                      _r(F.col("_avg") - F.col("_base")).alias("gain"))


def score_tree(results: DataFrame, tree: dict[str, Sequence[str] | dict[str, float]], baseline: str,
               task_group: Column | None = None, root: str | None = None, dataset: str = "dataset",
               task: str = "task", score: str = "score") -> DataFrame:
    """F12 over a hierarchy: averages of averages. ``tree`` gives the children
    of an inner node, as a list or with weights (default 1); a child is a task
    or another inner node, at any depth. With ``task_group`` tasks first have
    a group from their row (null: ``other``) and ``tree`` stands above the
    groups; ``root`` adds a node over all that have no parent.

    One row per dataset and inner node: ``level`` (1: over tasks only),
    ``n_children``, ``avg_score`` and the ``gain`` over the baseline dataset.
    A node's score is the weighted mean of the children that the dataset has;
    null scores are left out. Levels are worked from the leaves up, so a
    level is one aggregation over the small table of the levels below."""
    tree = {parent: dict.fromkeys(c, 1.0) if not isinstance(c, dict) else dict(c) for parent, c in tree.items()}
    parents: dict[str, str] = {}
    for parent, children in tree.items():
        if any(not w > 0 for w in children.values()):
            raise ValueError(f"the weights of {parent} must be positive")
        for child in children:
            if child in parents:
                raise ValueError(f"{child} has two parents")
            parents[child] = parent
    heights: dict[str, int] = {}

    def height(node: str, above: tuple[str, ...] = ()) -> int:
        if node in above:
            raise ValueError(f"{node} lies above itself")
        if node not in heights:
            low = 1 if task_group is not None else 0
            heights[node] = 1 + max(height(c, (*above, node)) for c in tree[node]) if node in tree else low
        return heights[node]

    top = max([height(n) for n in tree], default=1 if task_group is not None else 0)
    leaves = results.where(F.col(score).isNotNull())
    if task_group is not None:
        grouped = leaves.groupBy(dataset, F.coalesce(task_group, F.lit("other")).alias("node")).agg(
            F.avg(score).alias("_avg"), F.count(F.lit(1)).cast("bigint").alias("n_children"))
    else:
        grouped = leaves.groupBy(dataset, F.col(task).alias("node")).agg(
            F.avg(score).alias("_avg"), F.lit(0).cast("bigint").alias("n_children"))
    known = materialize(grouped.select(dataset, "node", F.lit(1 if task_group is not None else 0).alias("level"),
                                       "n_children", "_avg"))
    spark = results.sparkSession

    def averaged(edges: DataFrame, level: int) -> DataFrame:
        return known.join(F.broadcast(edges), "node").groupBy(dataset, "parent").agg(
            (F.sum(F.col("_avg") * F.col("w")) / F.sum("w")).alias("_avg"),
            F.count(F.lit(1)).cast("bigint").alias("n_children")).select(
                dataset, F.col("parent").alias("node"), F.lit(level).alias("level"), "n_children", "_avg")

    for level in range(1, top + 1):
        here = [(c, p, float(w)) for p, cs in tree.items() if heights[p] == level for c, w in cs.items()]
        if here:
            known = known.union(averaged(spark.createDataFrame(here, "node string, parent string, w double"), level))
    if root is not None:
        free = known.where(~F.col("node").isin(*parents)) if parents else known
        known = known.union(free.groupBy(dataset).agg(
            F.avg("_avg").alias("_avg"), F.count(F.lit(1)).cast("bigint").alias("n_children")).select(
                dataset, F.lit(root).alias("node"), F.lit(top + 1).alias("level"), "n_children", "_avg"))
    known = materialize(known.where("level > 0"))
    base = known.where(F.col(dataset) == F.lit(baseline)).select("node", F.col("_avg").alias("_base"))
    return known.join(base, "node", "left").select(
        dataset, "node", F.col("level").cast("int").alias("level"), "n_children", _r(F.col("_avg")).alias("avg_score"),
        _r(F.col("_avg") - F.col("_base")).alias("gain"))


def task_groups(groups: dict[str, Sequence[str]], task: str = "task") -> Column:
    """Group of a task from a dict of group names and their tasks."""
    pairs = [(t, g) for g, ts in groups.items() for t in ts]
    return F.element_at(F.create_map(*[x for t, g in pairs for x in (F.lit(t), F.lit(g))]), F.col(task))


def rank_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: ``n_pos``, ``n_neg`` and ``auc``, the share of (positive,
    negative) pairs in which the positive row (label 1) has the higher score,
    a tie counting half. From the sum of the positives' average ranks, which
    are made over the distinct scores (F8), so no pairs are formed; rows with
    a null on either side are left out, and without one of the classes the
    value is null."""
    values = materialize(scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(score).alias("v")).agg(F.count(F.lit(1)).alias("_cnt"),
                                     F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos")))
    ranks = average_ranks(values.select("v", "_cnt"), "v", "_rank")
    sums = values.join(ranks, "v").agg(F.coalesce(F.sum("_pos"), F.lit(0)).cast("bigint").alias("n_pos"),
                                       F.coalesce(F.sum(F.col("_cnt") - F.col("_pos")), F.lit(0)).cast("bigint")
                                       .alias("n_neg"), F.sum(F.col("_pos") * F.col("_rank")).alias("_sum"))
    pos, neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return sums.select("n_pos", "n_neg", _r(F.try_divide(F.col("_sum") - pos * (pos + 1) / 2, pos * neg)).alias("auc"))


def majority_answer(df: DataFrame, question: str, answer: str) -> DataFrame:
    """most frequent answer per question; ties go to the smallest
    answer. Votes are counted with a partial aggregation, then one more
    aggregation keeps min(struct(-votes, answer)) per question: no window,
    no collected group, whatever the number of answers."""
    votes = df.groupBy(question, answer).agg(F.count(F.lit(1)).cast("bigint").alias("votes"))
    best = votes.groupBy(question).agg(
        F.min(F.struct((-F.col("votes")).alias("nv"), F.col(answer).alias("a"))).alias("_b"),
        F.sum("votes").cast("bigint").alias("n_votes"))
    return best.select(question, F.col("_b.a").alias("majority"),
                       (-F.col("_b.nv")).cast("bigint").alias("votes"), "n_votes")
