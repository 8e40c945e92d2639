"""Sinks (keys A6, A7 write side).

Spark writes a directory of part files through its commit protocol: a
task that dies leaves no partial output, and a rerun of the job replaces
only what the failed attempt would have written.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path`` in whatever storage; any other
    error than its absence is raised."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def write_jsonl(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """One JSON object per line, UTF-8 as is, nulls written out.
    Refuses an existing path unless ``overwrite``; parent folders are made."""
    (df.write.mode("overwrite" if overwrite else "errorifexists")
     .option("ignoreNullFields", "false").json(path))


def write_requests(requests: DataFrame, path: str, overwrite: bool = False,
                   partition_by: str | None = "prompt_style") -> None:
    """Request payloads as JSON lines, partitioned by style so a later
    run can read one style's requests only (partition pruning)."""
    w = requests.select("request_id", "prompt_style", "payload").write.mode(
        "overwrite" if overwrite else "errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)


def write_records_with_stats(classified: DataFrame, path: str, overwrite: bool = False) -> dict:
    """A6 + F1 in one pass: the run counters are collected with an
    ``Observation`` while the kept records are written (no second job over
    the data). Returns the counters (one small dict)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from talkmill.operators.records import conversation_record, stat_columns

    obs = Observation("run_stats")
    watched = classified.observe(obs, *stat_columns())
    write_jsonl(conversation_record(watched.where(F.col("status") == "kept")), path, overwrite)
    return obs.get
