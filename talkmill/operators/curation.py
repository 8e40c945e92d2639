"""Seed-corpus selection (keys L1, L2, L3, L4)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.functions.hashing import hash_order
from talkmill.functions.text import words
from talkmill.operators.blocks import look_up, number_items
from talkmill.operators.prefix import materialize

# ---------------------------------------------------------------------------
# Math signal — inline TeX ($...$), common TeX commands, and
# digit-operator-digit arithmetic.
MATH_PATTERN = (r"\$[^$\n]+\$"
                r"|\\(?:frac|sum|int|sqrt|alpha|beta|pi|cdot|times|leq|geq)"
                r"|[0-9]+ ?[-+*/=^] ?[0-9]+")
# ---------------------------------------------------------------------------


def quality_subset(docs: DataFrame, labels: DataFrame, key: str = "doc_id",
                   label: str = "quality") -> DataFrame:
    """L1: documents whose quality label is 1 (semi join: the label table is
    filtered first, documents are never duplicated)."""
    good = labels.where(F.col(label) == 1).select(key)
    return docs.join(good, on=key, how="left_semi")


def math_signal(docs: DataFrame, text: str = "text") -> DataFrame:
    """L4: count of math markers per document and a ``has_math`` flag."""
    n = F.size(F.regexp_extract_all(F.col(text), F.lit(MATH_PATTERN), F.lit(0)))
    return docs.withColumn("math_hits", F.coalesce(n, F.lit(0)).cast("bigint")) \
        .withColumn("has_math", F.col("math_hits") > 0)


def url_host(url: str = "url") -> F.Column:
    """Lower-case host of a URL without user and port; empty for what is no
    URL with a host."""
    return F.coalesce(F.lower(F.try_parse_url(F.col(url), F.lit("HOST"))), F.lit(""))


def domain_yield(pages: DataFrame, hit: F.Column, threshold: float = 0.10,
                 url: str = "url") -> DataFrame:
    """L3: per URL host: pages, hit pages, hit share, and ``selected`` when
    the share is above ``threshold``. One partial aggregation by host."""
    d = pages.select(url_host(url).alias("host"), hit.alias("_hit"))
    g = d.groupBy("host").agg(F.count(F.lit(1)).cast("bigint").alias("n_pages"),
                              F.sum(F.col("_hit").cast("int")).cast("bigint").alias("n_hits"))
    share = F.col("n_hits") / F.col("n_pages")
    return g.select("host", "n_pages", "n_hits", F.round(share, 6).alias("hit_share"),
                    (share > F.lit(threshold)).alias("selected"))


def domain_additions(pages: DataFrame, hit: F.Column, threshold: float = 0.10,
                     url: str = "url") -> DataFrame:
    """L3 second step: pages of selected hosts that were not hits yet."""
    sel = domain_yield(pages, hit, threshold, url).where("selected").select("host")
    p = pages.withColumn("host", url_host(url)).withColumn("_hit", hit)
    return p.where(~F.col("_hit")).join(sel, on="host", how="left_semi").drop("_hit")


def train_quality_model(labelled: DataFrame, text: str = "text", label: str = "quality",
                        num_features: int = 1 << 18, max_iter: int = 20):
    """L2: hashed bag of words + logistic regression (Spark ML, JVM side).
    Returns the fitted pipeline model; ``model.transform(docs)`` scores
    any corpus in parallel."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    tok = RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[\p{L}\p{N}]+",
                         gaps=False, toLowercase=True)
    tf = HashingTF(inputCol="_words", outputCol="_features", numFeatures=num_features)
    lr = LogisticRegression(featuresCol="_features", labelCol="_label", maxIter=max_iter,
                            regParam=0.01)
    data = labelled.withColumn("_label", F.col(label).cast("double"))
    return Pipeline(stages=[tok, tf, lr]).fit(data)


def score_quality(model, docs: DataFrame) -> DataFrame:
    """L2 scoring: probability of the positive class per document."""
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(docs)
    return scored.withColumn("quality_score", vector_to_array("probability")[1]).drop(
        "_words", "_features", "rawPrediction", "probability")


def fold_of(key, folds: int, seed: int = 0) -> F.Column:
    """Fold of a key, 0 to ``folds`` - 1, from its seeded hash."""
    return F.pmod(F.conv(F.substring(hash_order(seed, key), 1, 8), 16, 10).cast("bigint"), F.lit(folds)).cast("int")


def cross_fitted_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                        label: str = "quality", folds: int = 3, seed: int = 0) -> DataFrame:
    """L2 without a row judged by a model that has seen it: ``key``, ``fold``
    and ``log_odds`` (to 4 digits) of every document.

    The model of a fold is a word-count classifier (log ratio of the smoothed
    word shares of the two classes, plus that of the classes) fitted on the
    labelled documents of all other folds. One pass counts the words of every
    class and fold; a fold's model is the total less the fold's own counts,
    so ``folds`` models cost no more than one. The distinct words of blocks of
    documents meet the model (``operators.blocks``), not every occurrence; a
    document without words, or a null text, has the odds of the classes. Labels other than 0 and 1, and null ones,
    are not used; repeated documents are scored as one text, repeated words
    counted each time."""
    fold = fold_of(key, folds, seed)
    known = docs.select(key).distinct().join(labels.where(F.col(label).isin(0, 1)).select(key, label).distinct(), key) \
        .select(key, fold.alias("fold"), F.col(label).cast("int").alias("y"))
    known = materialize(known)
    counts = materialize(docs.select(key, text).join(known, key).select("fold", "y", F.explode(words(text)).alias("word"))
                         .groupBy("word", "fold", "y").agg(F.count(F.lit(1)).alias("n")))

    def sums(rows: DataFrame, n: F.Column) -> list[F.Column]:
        """Count of class y in all folds but f, for each y and f."""
        return [F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("fold") != f), n)), F.lit(0)).alias(f"c{y}_{f}")
                for y in (0, 1) for f in range(folds)]

    size = counts.agg(F.countDistinct("word").alias("v"), *sums(counts, F.col("n")))
    docs_of = known.agg(*sums(known, F.lit(1)))
    # one row each, of numbers that do not grow with the data
    total, given = size.first(), docs_of.first()

    def ratio(one: F.Column, zero: F.Column, f: int) -> F.Column:
        v = float(total["v"])
        return F.log((one + 1) / F.lit(total[f"c1_{f}"] + v)) - F.log((zero + 1) / F.lit(total[f"c0_{f}"] + v))

    def by_fold(values: list[F.Column]) -> F.Column:
        return F.element_at(F.array(*values), fold + 1)

    model = counts.groupBy("word").agg(*sums(counts, F.col("n"))).select(
        "word", F.array(*[ratio(F.col(f"c1_{f}"), F.col(f"c0_{f}"), f) for f in range(folds)]).alias("w"))
    unseen = F.array(*[ratio(F.lit(0.0), F.lit(0.0), f) if total["v"] else F.lit(0.0) for f in range(folds)])
    prior = by_fold([F.log(F.lit((given[f"c1_{f}"] + 1) / (given[f"c0_{f}"] + 1))) for f in range(folds)])

    def summed(rows: pa.Table, at: np.ndarray, codes: np.ndarray, weights: pa.Array) -> list:
        each = weights.flatten().to_numpy().reshape(-1, folds)
        own = np.repeat(rows.column("_fold").fill_null(0).to_numpy(), np.diff(at))
        upto = np.arange(len(at) - 1).repeat(np.diff(at))
        return [pa.array(np.bincount(upto, each[codes, own], len(at) - 1))]

    spoken = number_items(docs.select("*", fold.alias("_fold")), words(text), [key, "_fold"])
    met = look_up(spoken, model, "word", F.coalesce("w", unseen), summed, "s double").groupBy(key).agg(F.sum("s").alias("s"))
    return docs.select(key).distinct().join(met, key, "left").select(
        key, fold.alias("fold"), F.round(prior + F.coalesce("s", F.lit(0.0)), 4).alias("log_odds"))
