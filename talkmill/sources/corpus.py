"""Corpus scan and sample numbering (keys A1, A3, A4, A5, G7)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from talkmill.operators.prefix import materialize
from talkmill.sources.schemas import shard_schema

SOURCE_FILE = "source_file"
SOURCE_ROW = "source_row"
# Rows per numbering block: what one bitmap of kept rows holds.
DEFAULT_BLOCK_ROWS = 32768
# A block lists its missing rows if they are at most one in FEW.
FEW = 32
# Positions of a block that share one start in the list of missing rows.
GAP_SPAN = 4096
# Bytes of a table that are broadcast at once, and the most such groups.
BROADCAST_BYTES = 64 << 20
IN_PLACE_GROUPS = 64


def corpus_target(path: str) -> str:
    """What to read for a corpus path: a folder's own ``*.parquet`` files."""
    if not any(ch in path for ch in "*?[") and not path.endswith(".parquet"):
        return path.rstrip("/") + "/*.parquet"
    return path


def scan_corpus(spark: SparkSession, path: str, schema: StructType | None = None,
                with_position: bool = True) -> DataFrame:
    """A1: read ``*.parquet`` directly inside ``path`` (or a file / glob).

    Without ``schema`` the columns of all shards are read (``shard_schema``):
    types are widened, a column that a shard lacks is null in its rows, and
    types that do not go together are refused with the files' names. Column
    pruning and predicate pushdown are left to Catalyst; only the columns a
    later step uses are read. ``source_file``/``source_row`` give
    every row its stable position (file, row in file)."""
    target = corpus_target(path)
    try:
        schema = schema if schema is not None else shard_schema(spark, target)
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.parquet(target)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            raise FileNotFoundError(f"corpus folder {path} holds no parquet data") from exc
        raise
    if with_position:
        df = df.withColumn(SOURCE_FILE, F.col("_metadata.file_path")).withColumn(
            SOURCE_ROW, F.col("_metadata.row_index"))
    return df


def non_empty(col="text") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != F.lit(""))


def drop_empty_text(df: DataFrame, col: str = "text") -> DataFrame:
    """A5: skip null / empty text. Whitespace-only text is kept."""
    return df.where(non_empty(col))


def skipped_count(df: DataFrame, col: str = "text") -> Column:
    """Aggregate expression: number of rows A5 skips."""
    return F.sum(F.when(non_empty(col), 0).otherwise(1)).cast("bigint")


def _file_order(col: str = SOURCE_FILE) -> Column:
    """The file's plain name: the metadata column has it percent-encoded."""
    return F.expr(f"url_decode(replace({col}, '+', '%2B'))")


def spread_rows(df: DataFrame) -> DataFrame:
    """Deal the rows out by (file, row) when the scan has fewer partitions
    than the cluster has cores (a few files of one row group each); a larger
    scan is left as it is, so its text is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, SOURCE_FILE, SOURCE_ROW)


def _blocks(df: DataFrame, block_rows: int) -> DataFrame:
    """One row per block of ``block_rows`` rows of a file that keeps any row:
    ``n`` kept rows and how to count those before a position. ``gaps`` (the
    sorted missing positions, with ``starts``, the kept rows before each
    GAP_SPAN positions) if few are missing, a bitmap if many are, and neither
    if none is."""
    kept = df.groupBy(SOURCE_FILE, "_blk").agg(
        F.count(F.lit(1)).alias("n"), F.max("_pos").cast("int").alias("_last"),
        F.expr("bitmap_construct_agg(_pos)").alias("_bits"))
    # the bytes with a missing position, then the positions in them
    holes = F.expr("filter(sequence(0, _last div 8), b -> substring(_bits, cast(b as int) + 1, 1) != X'FF')")
    gaps = F.expr("flatten(transform(_holes, b -> filter(transform(sequence(0, 7), i -> 8 * b + i), p -> "
                  "p < _last and bit_count(cast(conv(hex(substring(_bits, cast(b as int) + 1, 1)), 16, 10) as int) "
                  "& shiftleft(1, cast(p % 8 as int))) = 0)))")
    missing = F.col("_last") + 1 - F.col("n")
    few = (missing > 0) & (missing <= block_rows // FEW)
    starts = F.transform(F.expr(f"sequence(0L, cast(_last div {GAP_SPAN} as bigint))"), lambda j: (
        j * GAP_SPAN - F.size(F.filter("_gaps", lambda g: g < j * GAP_SPAN))).cast("smallint"))
    return kept.withColumn("_holes", F.when(few, holes)).withColumn("_gaps", F.when(few, gaps)).select(
            SOURCE_FILE, "_blk", "n", F.col("_gaps").cast("array<smallint>").alias("gaps"),
            F.when(few, starts).alias("starts"),
            F.when((missing > 0) & ~few, F.expr("substring(_bits, 1, cast(_last div 8 as int) + 1)")).alias("bits"))


def _offsets(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(table, its bytes in memory). One row per file: ``off`` (kept rows of earlier files) and ``blocks``,
    an array by block number of the kept rows of the file before the block
    and its gaps. Two levels of running sums: over the blocks of a file, and
    over the totals of the files."""
    in_file = Window.partitionBy(SOURCE_FILE).orderBy("_blk")
    upto = F.coalesce(F.sum("n").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    skipped = F.col("_blk") - F.coalesce(F.lag("_blk").over(in_file), F.lit(-1)) - 1
    entry = F.struct(upto.alias("start"), "gaps", "starts", "bits")
    placed = blocks.select(SOURCE_FILE, "_blk", "n", entry.alias("e"), skipped.cast("int").alias("skipped"))
    listed = placed.select(SOURCE_FILE, "_blk", "n", F.concat(
        F.array_repeat(F.lit(None).cast(placed.schema["e"].dataType), F.col("skipped")), F.array("e")).alias("es"))
    size = F.expr("octet_length(source_file) + 64 + aggregate(blocks, 0L, (s, e) -> s + 48 + 2 * (coalesce("
                  "size(e.gaps), 0) + coalesce(size(e.starts), 0)) + coalesce(octet_length(e.bits), 0))")
    seen = Observation()
    files = materialize(listed.groupBy(SOURCE_FILE).agg(
        F.sum("n").alias("n"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_blk", "es"))), lambda x: x["es"])).alias("blocks"))
        .observe(seen, F.sum(size).alias("bytes")))
    before = Window.orderBy(_file_order()).rowsBetween(Window.unboundedPreceding, -1)
    totals = files.select(SOURCE_FILE, "n").select(
        SOURCE_FILE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    return files.join(totals, SOURCE_FILE).select(SOURCE_FILE, "off", "blocks"), seen.get["bytes"] or 0


def join_in_place(rows: DataFrame, table: DataFrame, keys: list[str], table_bytes: int,
                  most: int = BROADCAST_BYTES) -> DataFrame:
    """Inner join of corpus rows with a table keyed by file (and more) that
    leaves the rows where they are: the table is broadcast in groups of files
    of at most about ``most`` bytes, and each group's scan reads its own
    files only (the file name is a scan filter). From IN_PLACE_GROUPS groups
    on, a shuffle join costs less than so many scans and Spark plans it."""
    groups = max(1, -(-table_bytes // most))
    if groups == 1:
        return rows.join(F.broadcast(table), keys)
    if groups > IN_PLACE_GROUPS:
        return rows.join(table, keys)
    out = None
    for g in range(groups):
        own = F.pmod(F.xxhash64(SOURCE_FILE), F.lit(groups)) == g
        part = rows.where(own).join(F.broadcast(table.where(own)), keys)
        out = part if out is None else out.union(part)
    return out


def sample_index(df: DataFrame, name: str = "sample_index",
                 block_rows: int = DEFAULT_BLOCK_ROWS, limit: int | None = None) -> DataFrame:
    """A3: dense 0-based index over the rows of ``df`` in (file, row) order.

    No text is shuffled for it. From (file, row) alone, the kept rows of each
    block of ``block_rows`` rows of a file are counted and its missing rows
    (A5) listed; running sums over the blocks of a file and over the files
    give the offsets. They are written as one row per file (some 40 bytes a
    full block, 2 bytes more for a missing row, 4 KB for a block that misses
    many), and the rows meet them where they are (``join_in_place``). A row's
    index is the offset plus its position less the missing ones before it.

    With ``limit`` (A4) only rows with index < limit are returned; files
    that cannot hold one drop out in the join."""
    if not 1 <= block_rows <= DEFAULT_BLOCK_ROWS:
        raise ValueError(f"block_rows must be from 1 to {DEFAULT_BLOCK_ROWS}")
    if limit is not None and limit < 0:
        raise ValueError("limit must be non-negative.")
    row = F.coalesce(F.col(SOURCE_ROW), F.lit(0))
    keyed = df.withColumn(SOURCE_FILE, F.coalesce(F.col(SOURCE_FILE), F.lit("")))
    blocks = keyed.select(SOURCE_FILE, F.floor(row / block_rows).cast("bigint").alias("_blk"),
                          (row % block_rows).cast("bigint").alias("_pos"))
    offsets, table_bytes = _offsets(_blocks(blocks, block_rows))
    if limit is not None:
        offsets = offsets.where(F.col("off") < F.lit(limit))
    joined = join_in_place(keyed, offsets, [SOURCE_FILE], table_bytes)
    joined = joined.withColumn("_pos", (row % block_rows).cast("int")).withColumn(
        "_e", F.col("blocks")[F.floor(row / block_rows).cast("int")])
    span = F.expr(f"_pos div {GAP_SPAN}").cast("int")
    start = F.col("_e.starts")[span].cast("int")
    # missing rows before the span are the first of the sorted list
    here = F.slice("_e.gaps", span * GAP_SPAN - start + 1, GAP_SPAN)
    sparse = F.col("_pos") - (span * GAP_SPAN - start) - F.size(F.filter(here, lambda g: g < F.col("_pos")))
    whole = F.expr("bitmap_count(substring(_e.bits, 1, _pos div 8))")
    part = F.expr("bit_count(cast(conv(hex(substring(_e.bits, _pos div 8 + 1, 1)), 16, 10) as int) "
                  "& (shiftleft(1, _pos % 8) - 1))")
    before = F.when(F.col("_e.gaps").isNotNull(), sparse).when(F.col("_e.bits").isNotNull(), whole + part) \
        .otherwise(F.col("_pos"))
    out = joined.withColumn(name, (F.col("off") + F.col("_e.start") + before).cast("bigint"))
    if limit is not None:
        out = out.where(F.col(name) < F.lit(limit))
    return out.drop("_pos", "_e", "off", "blocks")


def samples(spark: SparkSession, path: str, text_col: str = "text",
            block_rows: int = DEFAULT_BLOCK_ROWS, limit: int | None = None) -> DataFrame:
    """A1 + A5 + A3 (+ A4 with ``limit``): the reference's sample stream as
    a table."""
    rows = spread_rows(scan_corpus(spark, path))
    return sample_index(drop_empty_text(rows, text_col), block_rows=block_rows, limit=limit)


def max_samples(df: DataFrame, n: int | None, index: str = "sample_index") -> DataFrame:
    """A4: keep the first ``n`` emitted samples (``None`` -> all, 0 -> none)."""
    if n is None:
        return df
    if n < 0:
        raise ValueError("max_samples must be non-negative.")
    return df.where(F.col(index) < F.lit(n))


def first_n(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows in file order (top-k: bounded per task)."""
    return df.orderBy(SOURCE_FILE, SOURCE_ROW).limit(n)
