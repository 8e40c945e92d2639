"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm import bpe, langid, pieces
from talkmill.llm.common import id_crc, utf8
from talkmill.llm.exact_topk import exact_topk
from talkmill.llm.lm import score
from talkmill.llm.minhash import near_duplicates
from talkmill.llm.packing import pack
from talkmill.llm.phrases import mine
from talkmill.llm.rabitq import build_index, search
from talkmill.llm.repeats import remove_repeats
from talkmill.llm.sharding import shard
from talkmill.llm.warc import archive_and_read
from talkmill.llm.whitening import whiten



def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to piece ids and decoded back."""
    model = pieces.PieceModel(vocabulary("piece_bpe_32k.model"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pieces.decode(pieces.encode(docs, "text", model), "ids", model)
    return out.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents at similarity 0.85."""
    return near_duplicates(_table(spark, sf_dir, "documents"), "doc_id", "text", percent=85)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes (law ``bytes``)."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(utf8()) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    out = shard(docs, 40, size=F.col("size"), group=F.col("text_crc32"), key="doc_id")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learnt from the labelled ones
    outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    held_out = id_crc() % 4 == 2
    network = langid.train(docs.where(~held_out), "doc_id", "text", "lang")
    out = langid.predict(docs.select("doc_id", "text"), network, "text")
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model and unigram scores of all documents; the model learns
    from those outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    out = score(docs, "doc_id", "text", id_crc() % 7 != 2, vocabulary("byte_bpe_50k.json"))
    return out.select("doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written and read back."""
    pages = _table(spark, sf_dir, "pages")
    out = archive_and_read(pages, "page_id", "url", F.col("html").cast("binary"), 0)
    return out.select(F.col("record_id").alias("page_id"), F.col("length").alias("payload_bytes"),
                      F.col("digest").alias("payload_digest"), "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes, body, sha1(body) AS hexed FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS response_id FROM d),
b AS (SELECT *, [CAST('0x' || substr(hexed, 1 + 10 * g, 10) AS BIGINT) for g in [0, 1, 2, 3]] AS w FROM r)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((w[1 + i // 8] >> (35 - 5 * (i % 8))) & 31) + 1 AS BIGINT), 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = response_id THEN NULL ELSE response_id END AS refers_to
FROM b
"""



def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest by inner product of every vector whose id is divisible by 20."""
    vectors = _table(spark, sf_dir, "embeddings")
    index = build_index(vectors, "vec_id", "embedding")
    return search(index, vectors.where(F.col("vec_id") % 20 == 0), 20, "vec_id", "embedding")


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of 100-byte strings that also start earlier, all documents."""
    out = remove_repeats(_table(spark, sf_dir, "documents"), "doc_id", "text", length=100)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 highest integer inner products of every vector whose id is
    divisible by 100."""
    vectors = _table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10, "vec_id", "embedding")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, every window of 64
    sequences at the sources' shares of all tokens."""
    return pack(_table(spark, sf_dir, "documents"), "doc_id", "text", "source",
                vocabulary("byte_bpe_50k.json"), end_id=0)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 most cohesive phrases of 2 to 3 words of every language."""
    return mine(_table(spark, sf_dir, "documents"), "text", "lang")


OP11_SQL = r"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
c1 AS (SELECT lang, x AS w1, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM p) GROUP BY ALL),
c2 AS (SELECT lang, x[1] AS w1, x[2] AS w2, count(*) AS f
       FROM (SELECT lang, unnest([w[i:i + 1] for i in range(1, len(w))]) AS x FROM p) GROUP BY ALL),
c3 AS (SELECT lang, x[1] AS w1, x[2] AS w2, x[3] AS w3, count(*) AS f
       FROM (SELECT lang, unnest([w[i:i + 2] for i in range(1, len(w) - 1)]) AS x FROM p) GROUP BY ALL
       HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c1 GROUP BY lang),
longer AS (SELECT lang, w1, w2, max(f) AS f FROM (
    SELECT lang, w1, w2, f FROM c3 UNION ALL SELECT lang, w2, w3, f FROM c3) GROUP BY ALL),
s3 AS (SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3 AS phrase, c3.f AS a,
         a1.f AS l1, b1.f AS r1, a2.f AS l2, b2.f AS r2,
         (CAST(1000000 AS HUGEINT) * c3.f * c3.f) // (CAST(a1.f AS HUGEINT) * b1.f) AS x1,
         (CAST(1000000 AS HUGEINT) * c3.f * c3.f) // (CAST(a2.f AS HUGEINT) * b2.f) AS x2
       FROM c3 JOIN c1 a1 ON a1.lang = c3.lang AND a1.w1 = c3.w1
       JOIN c2 b1 ON b1.lang = c3.lang AND b1.w1 = c3.w2 AND b1.w2 = c3.w3
       JOIN c2 a2 ON a2.lang = c3.lang AND a2.w1 = c3.w1 AND a2.w2 = c3.w2
       JOIN c1 b2 ON b2.lang = c3.lang AND b2.w1 = c3.w3),
s2 AS (SELECT c2.lang, c2.w1 || ' ' || c2.w2 AS phrase, c2.f AS a, a.f AS l, b.f AS r,
         (CAST(1000000 AS HUGEINT) * c2.f * c2.f) // (CAST(a.f AS HUGEINT) * b.f) AS score
       FROM c2 JOIN c1 a ON a.lang = c2.lang AND a.w1 = c2.w1 JOIN c1 b ON b.lang = c2.lang AND b.w1 = c2.w2
       LEFT JOIN longer g ON g.lang = c2.lang AND g.w1 = c2.w1 AND g.w2 = c2.w2
       WHERE c2.f >= 10 AND (g.f IS NULL OR 100 * g.f < 50 * c2.f)),
s AS (SELECT lang, phrase, a, CASE WHEN x2 < x1 THEN l2 ELSE l1 END AS l, CASE WHEN x2 < x1 THEN r2 ELSE r1 END AS r,
        CAST(least(x1, x2) AS BIGINT) AS score FROM s3
      UNION ALL SELECT lang, phrase, a, l, r, CAST(score AS BIGINT) FROM s2),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on their first 8 principal components."""
    out = whiten(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return out.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
                      "explained", "identity_error")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to byte-pair ids and decoded back."""
    model = bpe.BytePairs(vocabulary("byte_bpe_50k.json"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_and_decode(docs, "text", model)
    ids, decoded = F.coalesce("ids", F.lit(b"")), F.coalesce("decoded", F.lit(""))
    return out.select("doc_id", F.floor(F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
                      F.sha2(ids, 256).alias("ids_sha256"), F.sha2(decoded.cast("binary"), 256).alias("decoded_sha256"))


OP9_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) for x in embedding])),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_minhash": op2_minhash,
    "op3_sharding": op3_sharding,
    "op4_langid": op4_langid,
    "op5_lm": op5_lm,
    "op6_warc": op6_warc,
    "op7_ann": op7_ann,
    "op8_suffix": op8_suffix,
    "op9_topk": op9_topk,
    "op10_packing": op10_packing,
    "op11_phrases": op11_phrases,
    "op12_whitening": op12_whitening,
    "op13_bpe": op13_bpe,
}
SQL: dict[str, str] = {
    "op6_warc": OP6_SQL,
    "op9_topk": OP9_SQL,
    "op11_phrases": OP11_SQL,
}
