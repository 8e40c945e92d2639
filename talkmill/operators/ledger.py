"""Reply ledger: stored answers, bucketed by request (key D4).

A rerun has to find the requests that have no answer yet. The ledger is a
table of replies at a path of its own, written in buckets of ``request_id``,
so that finding them joins ids alone: the ledger side is read by bucket
without a shuffle, and the requests send nothing but their id and place. What
is open goes back to the corpus by place (``sources.corpus.join_in_place``),
and only then are payloads made.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.operators.generate import REPLY_SCHEMA
from talkmill.operators.records import pending_only
from talkmill.sources.sinks import path_exists

REPLY_COLUMNS = [c.split(" ")[0] for c in REPLY_SCHEMA.split(", ")]


class ReplyLedger:
    """Replies at ``path``: request_id, reply, status, attempts, error. The
    number of buckets is fixed when the ledger is made (``buckets``; at 100 TB
    take as many as shuffle partitions) and stands beside the files."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        notes = f"{self.path}/_ledger"
        if path_exists(spark, notes):
            buckets = spark.read.schema("buckets INT").json(notes).first()["buckets"]
        elif path_exists(spark, self.path):
            raise ValueError(f"{path} exists and is no reply ledger")
        else:
            spark.createDataFrame([(buckets,)], "buckets INT").coalesce(1).write.json(notes)
        self.buckets = buckets
        self.name = "talkmill_ledger_" + hashlib.md5(self.path.encode()).hexdigest()
        where = self.path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({REPLY_SCHEMA}) USING parquet CLUSTERED BY (request_id) "
                  f"INTO {buckets} BUCKETS LOCATION '{where}'")

    def replies(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, replies: DataFrame) -> None:
        """Add replies; each task writes one bucket."""
        replies.select(*REPLY_COLUMNS).repartition(self.buckets, "request_id").write.insertInto(self.name)

    def pending(self, requests: DataFrame) -> DataFrame:
        """The rows whose request has no stored answer (D4); failed and empty
        ones are open."""
        return pending_only(requests, self.replies().where(F.col("status") == "ok").select("request_id"))
