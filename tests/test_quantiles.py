import math
import random

import numpy as np
import pytest

from talkmill.operators.quantiles import quantiles

SHARES = {"q0": 0.0, "q10": 0.1, "median": 0.5, "p90": 0.9, "q1": 1.0}


def _check(spark, values):
    df = spark.createDataFrame([(g, v, "x") for g, vs in values.items() for v in vs], "g string, v double, n string")
    rows = {r["g"]: r for r in quantiles(df.repartition(4), "g", "v", SHARES).collect()}
    for g, vs in values.items():
        kept = sorted(v for v in vs if v is not None and not math.isnan(v))
        if not kept:
            assert g not in rows
            continue
        for name, p in SHARES.items():
            at = p * (len(kept) - 1)
            low, part = math.floor(at), at - math.floor(at)
            wanted = kept[low] if not part else kept[low] * (1 - part) + kept[low + 1] * part
            assert rows[g][name] == pytest.approx(wanted, rel=1e-12), (g, name)
    return rows


def test_exact_for_ties_gaps_and_a_hot_group(spark):
    rng = random.Random(4)
    _check(spark, {
        "hot": [float(rng.choice([1, 2, 2, 3, 500])) for _ in range(6000)],
        "wide": [rng.lognormvariate(0, 12) for _ in range(3000)],
        "close": [1e9 + rng.random() * 1e-3 for _ in range(2000)] + [-1e300, 1e300],
        None: [5.0, None, 1.0, float("nan")], "one": [7.25], "same": [3.0] * 50, "none": [None, float("nan")],
        "odd": [float("inf"), 1.0, 2.0, -float("inf"), 5e-324, 0.0],
    })


def test_integers_like_numpy(spark):
    values = np.random.default_rng(1).integers(0, 10 ** 6, 4001)
    df = spark.createDataFrame([("a", int(v)) for v in values], "g string, v long")
    row = quantiles(df, "g", "v", {"a": 0.25, "b": 0.333}).first()
    assert row["a"] == np.quantile(values, 0.25) and row["b"] == pytest.approx(np.quantile(values, 0.333))


def test_empty_table_and_bad_shares(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert quantiles(df, "g", "v", {"m": 0.5}).count() == 0
    with pytest.raises(ValueError):
        quantiles(df, "g", "v", {"m": 1.5})
