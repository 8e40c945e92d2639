"""Token windows (keys C1, C2, C3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.functions.text import tokenize


@dataclass(frozen=True)
class ChunkConfig:
    chunk_size: int = 500
    overlap: int = 50
    drop_redundant_tail: bool = False

    def __post_init__(self) -> None:
        if not 0 <= self.overlap < self.chunk_size:
            raise ValueError(f"a window of {self.chunk_size} tokens cannot share {self.overlap} with the next one")

    @property
    def stride(self) -> int:
        return self.chunk_size - self.overlap


def chunk_windows(df: DataFrame, text_col: str = "text", cfg: ChunkConfig | None = None,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per window: ``chunk_index INT, context STRING,
    context_tokens INT`` plus the ``keep`` columns of the input row.

    Windows start at 0, stride, 2*stride ... while the start is below the
    token count; the last window may be short; empty text yields none.
    Tokenising happens once per document; windows are built with array
    functions and exploded in the same stage (no shuffle, no Python)."""
    cfg = cfg or ChunkConfig()
    keep = list(keep) if keep is not None else [c for c in df.columns if c != text_col]
    size, stride = cfg.chunk_size, cfg.stride
    tok = df.select(*keep, tokenize(text_col).alias("_tok"))
    n = F.coalesce(F.size("_tok"), F.lit(0))
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(stride))).otherwise(
        F.array().cast("array<int>"))
    if cfg.drop_redundant_tail:
        # a window that lies wholly inside the previous one adds nothing
        starts = F.filter(starts, lambda s: (s == 0) | (n - s > F.lit(cfg.overlap)))
    windows = F.transform(starts, lambda s: F.struct(
        F.array_join(F.slice(F.col("_tok"), s + 1, size), "").alias("context"),
        F.least(F.lit(size), n - s).alias("context_tokens")))
    out = tok.select(*keep, F.posexplode(windows).alias("chunk_index", "_w"))
    return out.select(*keep, F.col("chunk_index").cast("int").alias("chunk_index"),
                      F.col("_w.context").alias("context"),
                      F.col("_w.context_tokens").cast("int").alias("context_tokens"))
