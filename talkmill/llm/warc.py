"""Content-addressed WARC archive (DataFrame functions only).

An archive folder holds two tables:

* ``payloads``: one row per distinct payload: ``digest`` (bare upper-case
  base32 SHA-1), ``check`` (SHA-256), ``payload``. Bytes are stored once.
* ``records``: one row per record with its exact header block (``header``),
  ``record_id``, ``digest`` and ``check``, in no particular order.

``read_records`` parses the stored header blocks and verifies each against
the payload store through joins: a payload whose recomputed digests or
length differ from what the header says is an error, as is a record whose
payload is missing. ``rebuild`` returns the original record bytes.

Payloads move once, by the unique record id, never by their digest, so a
payload that a third of all records share costs one stored row and narrow
header rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm.common import shared_path

CRLF = "\r\n"
#: Fixed value of the WARC 1.1 standard for revisits of an equal payload.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hexed: Column) -> Column:
    """Bare upper-case base32 of a 40-digit hex string: four groups of 40
    bits are eight base32 digits each."""
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def digest(payload: Column) -> Column:
    return base32(F.sha1(payload))


def _name(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(record_id.cast("string"), F.lit("none")), F.lit(">"))


def _utc(time: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def write_archive(records: DataFrame, path: str, record_id: str, uri: str | None, payload: Column,
                  min_shared_bytes: int = 0, date: Column | None = None) -> None:
    """Write one WARC record per row of ``records``, dated by the timestamp
    ``date`` (None, and where it is null: the time of writing).

    Of the records with equal payloads of at least ``min_shared_bytes``
    bytes the one with the largest ``record_id`` is the response and the
    others are revisits that refer to it; shorter payloads are responses
    each. Null payloads count as empty, a null uri as an empty one. Rows with
    a null id are records named ``none``: revisits where a record with an id
    has the payload, else responses. Rows that repeat an id
    with the same payload take the same role; the payload is still stored
    once. An empty table writes two empty tables."""
    now = F.current_timestamp()
    body = F.coalesce(payload, F.lit("").cast("binary"))
    rows = records.select(
        F.col(record_id).cast("long").alias("record_id"), _name(F.col(record_id).cast("long")).alias("name"),
        (F.coalesce(F.col(uri), F.lit("")) if uri else F.lit("")).alias("uri"),
        _utc(now if date is None else F.coalesce(date, now)).alias("date"),
        body.alias("payload")).select(
            "record_id", "name", "uri", "date", "payload", digest(F.col("payload")).alias("digest"),
            F.sha2("payload", 256).alias("check"),
            F.octet_length("payload").cast("long").alias("length"))
    narrow = rows.drop("payload")
    shared = F.col("length") >= min_shared_bytes
    first = narrow.groupBy("digest", "check", "length").agg(F.max("record_id").alias("response_id"))
    # one stored row per payload: the rows join on their unique id, and
    # what remains of repeated rows falls in the same partition
    stored = rows.select("name", "digest", "check", "payload").join(
        first.select(_name(F.col("response_id")).alias("name"), "digest", "check"),
        on=["name", "digest", "check"], how="left_semi") \
        .dropDuplicates(["name", "digest", "check"])
    stored.select("digest", "check", "payload").write.option("compression", "zstd") \
        .parquet(f"{path}/payloads")

    headers = narrow.join(first, on=["digest", "check", "length"], how="inner")
    is_revisit = shared & ~F.col("record_id").eqNullSafe(F.col("response_id"))
    clean = F.regexp_replace("uri", r"[\r\n]+", " ")
    header = F.concat(
        F.lit("WARC/1.1" + CRLF + "WARC-Type: "),
        F.when(is_revisit, "revisit").otherwise("response"), F.lit(CRLF),
        F.lit("WARC-Record-ID: "), F.col("name"), F.lit(CRLF),
        F.lit("WARC-Date: "), F.col("date"), F.lit(CRLF),
        F.lit("WARC-Target-URI: "), clean, F.lit(CRLF),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF),
        F.when(is_revisit, F.concat(
            F.lit("WARC-Refers-To: "), _name(F.col("response_id")), F.lit(CRLF),
            F.lit(f"WARC-Profile: {SAME_PAYLOAD}{CRLF}"))).otherwise(""),
        F.lit("Content-Type: application/octet-stream" + CRLF),
        F.lit("Content-Length: "), F.when(is_revisit, F.lit(0)).otherwise(F.col("length")).cast("string"),
        F.lit(CRLF + CRLF))
    headers.select("record_id", "digest", "check", header.alias("header")) \
        .write.option("compression", "zstd").parquet(f"{path}/records")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Parsed and verified records: record_id, record_type, uri, digest,
    length (of the full payload), refers_to, header, payload.

    Digests of the stored payloads are computed anew before the join; a
    mismatch or a missing payload raises."""
    records = spark.read.parquet(f"{path}/records")
    stored = spark.read.parquet(f"{path}/payloads").select(
        F.col("digest").alias("_digest"), F.col("check").alias("_check"), "payload",
        (digest(F.col("payload")) == F.col("digest")).alias("_same"),
        (F.sha2("payload", 256) == F.col("check")).alias("_same2"),
        F.octet_length("payload").cast("long").alias("_length"))
    field = lambda name: F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    parsed = records.select(
        "record_id", "digest", "check", "header", field("WARC-Type").alias("record_type"),
        field("WARC-Target-URI").alias("uri"),
        field("WARC-Payload-Digest").alias("_said"),
        field("WARC-Record-ID").alias("_name"),
        F.expr(r"try_cast(regexp_extract(header, '\r\nWARC-Refers-To: <urn:record:(-?[0-9]+)>', 1) AS BIGINT)")
        .alias("refers_to"),
        F.regexp_extract("header", r"\r\nContent-Length: (\d+)\r\n", 1).cast("long").alias("_content"))
    joined = parsed.join(stored, on=[parsed["digest"] == stored["_digest"],
                                     parsed["check"] == stored["_check"]], how="left")
    right = (F.col("_same") & F.col("_same2") & (F.col("_said") == F.concat(F.lit("sha1:"), F.col("digest")))
             & (F.col("_name") == _name(F.col("record_id")))
             & (F.col("_content") == F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("_length"))))
    length = F.when(F.coalesce(right, F.lit(False)), F.col("_length")).otherwise(
        F.raise_error(F.concat(F.lit("archive record does not verify: "),
                               _name(F.col("record_id")))).cast("long"))
    return joined.select("record_id", "record_type", "uri", "digest", length.alias("length"),
                         "refers_to", "header", "payload")


def rebuild(spark: SparkSession, path: str) -> DataFrame:
    """record_id and the record's exact bytes: its header block, its block
    (empty for a revisit) and the two closing line ends."""
    rows = read_records(spark, path)
    block = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return rows.select("record_id", F.concat(
        F.col("header").cast("binary"), block, F.lit(CRLF + CRLF).cast("binary")).alias("record"))


def archive_and_read(records: DataFrame, record_id: str, uri: str | None, payload: Column,
                     min_shared_bytes: int = 0) -> DataFrame:
    """Write ``records`` to a new archive in the shared folder and read it
    back."""
    path = shared_path(records.sparkSession, "warc")
    write_archive(records, path, record_id, uri, payload, min_shared_bytes)
    return read_records(records.sparkSession, path)
