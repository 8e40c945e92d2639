"""Property tests (hypothesis): windows over random Unicode texts."""
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkmill.functions.text import tokenize
from talkmill.operators.chunking import ChunkConfig, chunk_windows

ALPHABET = st.sampled_from(list("ab Z9 \n\t.,!éß中　 -_()'\"\x0b"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=300), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=TEXTS, size=st.integers(1, 40), overlap_frac=st.floats(0, 0.95))
def test_window_properties(spark, values, size, overlap_frac):
    overlap = min(size - 1, int(size * overlap_frac))
    cfg = ChunkConfig(size, overlap)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id BIGINT, text STRING")
    toks = {r.id: r.t for r in df.select("id", tokenize("text").alias("t")).collect()}
    got: dict[int, list] = {}
    for r in chunk_windows(df, "text", cfg, keep=["id"]).collect():
        got.setdefault(r.id, []).append((r.chunk_index, r.context, r.context_tokens))
    for i, v in enumerate(values):
        t = toks[i]
        assert "".join(t) == v  # pieces rebuild the text
        parts = sorted(got.get(i, []))
        assert len(parts) == (math.ceil(len(t) / cfg.stride) if t else 0)
        for k, ctx, n in parts:
            window = t[k * cfg.stride: k * cfg.stride + size]
            assert ctx == "".join(window) and n == len(window)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=TEXTS)
def test_strip_and_count_match_python(spark, values):
    from talkmill.functions.text import count_tokens, py_strip
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id BIGINT, text STRING")
    rows = df.select("id", "text", py_strip("text").alias("s"), count_tokens("text").alias("n"),
                     F.size(tokenize("text")).alias("m")).collect()
    for r in rows:
        assert r.s == r.text.strip()
        assert r.n == r.m
