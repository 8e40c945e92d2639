"""Session helpers.

The library never creates a session on its own inside an operator; these
helpers are for jobs, tests and the bench. Written intermediate tables go to
the shared folder the cluster names in ``spark.checkpoint.dir``; tests and
the bench set that option themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "talkmill", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables: the context's
    checkpoint folder, else what ``spark.checkpoint.dir`` names, else
    ``talkmill-checkpoints`` in the warehouse, which executors share too."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/talkmill-checkpoints"
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


_WRITTEN: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A new path for a written intermediate table in the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def tables_written() -> int:
    """How many intermediate tables of this process are not released yet."""
    return len(_WRITTEN)


def release_tables(spark: SparkSession, first: int = 0, last: int | None = None) -> int:
    """Delete the intermediate tables that this process wrote; call it when
    no result that reads them is needed any more. ``first`` and ``last``
    (what ``tables_written`` said before and after a step) choose the tables
    of that step. Returns their number."""
    done, paths = 0, _WRITTEN[first:last]
    del _WRITTEN[first:last]
    for name in reversed(paths):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        done += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return done


def scale_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spark settings sized to the input and the cluster.

    * ``spark.sql.files.maxPartitionBytes``: 256 MiB splits of parquet
      text (one task ~ 100k documents; the window fan-out streams, so the
      task's memory does not grow with its rows).
    * ``spark.sql.shuffle.partitions``: enough partitions that each holds
      about ``target_partition_bytes`` of the largest shuffle (the corpus
      once, for the dense index) and at least three waves of tasks; AQE
      coalesces what turns out smaller and splits skewed partitions.
    """
    by_size = max(1, input_bytes // target_partition_bytes)
    partitions = max(3 * total_cores, int(by_size))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
