"""Inspection tables instead of console prints (keys A8, A9, A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from talkmill.functions.text import head_tail, tokenize
from talkmill.sources.corpus import SOURCE_FILE, SOURCE_ROW, corpus_target
from talkmill.sources.schemas import shard_schema


def _counts(df: DataFrame, fields: list) -> DataFrame:
    """One row: rows and non-null values of each field, as ``_rows`` and
    ``_nn<i>``."""
    return df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count(F.col(f"`{f.name}`")).alias(f"_nn{i}") for i, f in fields])


def _profile(one: DataFrame, fields: list) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                              F.lit(i).cast("int").alias("ordinal"),
                              F.lit(f.dataType.simpleString()).alias("spark_type"),
                              F.col(f"_nn{i}").cast("bigint").alias("n_nonnull"))
                     for i, f in fields])
    return one.select(F.col("_rows").cast("bigint").alias("n_rows"), F.inline(rows))


def corpus_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, position, type, row count and
    non-null count over every file, in one aggregation pass."""
    fields = list(enumerate(f for f in df.schema.fields if f.name not in (SOURCE_FILE, SOURCE_ROW)))
    return _profile(_counts(df, fields), fields)


def footer_profile(spark: SparkSession, path: str) -> DataFrame:
    """A8 over a whole corpus with the row count from the parquet footers: a
    session of its own reads parquet through the source that can push counts
    down, so counting rows reads no data. For a single file its non-null
    counts come from the footer too; over several files Spark looks a column
    up by its place, which may differ from shard to shard, so there, and for
    nested types, which have no such counts, the columns are counted in one
    pass."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    target = corpus_target(path)
    schema = shard_schema(own, target)
    df = (own.read.schema(schema) if schema is not None else own.read).parquet(target)
    fields = list(enumerate(df.schema.fields))
    scanned = [x for x in fields if schema is not None or isinstance(x[1].dataType, (ArrayType, MapType, StructType))]
    one = _counts(df, [x for x in fields if x not in scanned])
    if scanned:
        # sums are not pushed down; one row each
        one = one.crossJoin(df.agg(*[F.coalesce(F.sum(F.col(f"`{f.name}`").isNotNull().cast("long")), F.lit(0))
                                     .alias(f"_nn{i}") for i, f in scanned]))
    return _profile(one, fields)


def file_profile(df: DataFrame) -> DataFrame:
    """A8 per file: rows per parquet file (no single-file collect)."""
    return df.groupBy(F.col(SOURCE_FILE).alias("file")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def sample_preview(df: DataFrame, text: str = "text", n: int | None = None,
                   token_columns: tuple[str, ...] = ("tokens", "input_ids")) -> DataFrame:
    """Per row: file, position, text length, token count, first 50
    tokens and the text cut to 500 head + 500 tail characters when longer
    than 1000. What is previewed: a usable list in one of ``token_columns``,
    else the text, and in a table without a text column any list column
    named like a token or id column. ``n`` keeps the first
    ``n`` rows in file order (the preview feature)."""
    from talkmill.operators.vocab import pick_token_column, token_candidates
    has_text = text in df.columns
    text_col = F.col(text) if has_text else F.lit(None).cast("string")
    lists = token_candidates(df, token_columns)
    wanted = [c for c in lists if c in token_columns] if has_text else lists
    if wanted:
        others = [c for c in lists if c not in wanted]
        d = pick_token_column(df.drop(*others), wanted, text if has_text else None)
        toks = F.coalesce(F.col("token_ids").cast("array<string>"), tokenize(text_col))
        sep = F.when(F.col("token_ids").isNotNull(), F.lit(" ")).otherwise(F.lit(""))
        d = d.select(SOURCE_FILE, SOURCE_ROW, text_col.alias("_text"), toks.alias("_tok"),
                     sep.alias("_sep"))
    else:
        d = df.select(SOURCE_FILE, SOURCE_ROW, text_col.alias("_text"),
                      tokenize(text_col).alias("_tok"), F.lit("").alias("_sep"))
    out = d.select(F.col(SOURCE_FILE).alias("file"), F.col(SOURCE_ROW).alias("row"),
                   F.length("_text").cast("bigint").alias("text_length"),
                   F.size("_tok").cast("bigint").alias("token_count"),
                   F.expr("array_join(slice(_tok, 1, 50), _sep)").alias("first_tokens"),
                   head_tail(F.col("_text")).alias("text_view"))
    if n is not None:
        out = out.orderBy("file", "row").limit(n)
    return out


def column_report(df: DataFrame, key: str | None = None) -> DataFrame:
    """A10: for a table of unknown schema, one row per (row, column): type,
    length for lists/strings, and a preview (first 5 items or 100 chars)."""
    entries = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType):
            length = F.size(c)
            preview = F.slice(c, 1, 5).cast("string")
        elif isinstance(f.dataType, MapType):
            length = F.size(c)
            preview = F.substring(c.cast("string"), 1, 100)
        else:
            length = F.length(c.cast("string")) if isinstance(f.dataType, StringType) else F.lit(None)
            preview = F.substring(c.cast("string"), 1, 100)
        entries.append(F.struct(F.lit(f.name).alias("column_name"),
                                F.lit(f.dataType.simpleString()).alias("spark_type"),
                                length.cast("bigint").alias("length"),
                                preview.alias("preview")))
    keep = [key] if key else []
    return df.select(*keep, F.inline(F.array(*entries)))
