"""Registered queries, part 2: post-generation tables, budgets, metrics,
dialogue structure, vocabulary, inspection, generation hook, sinks,
curation and streaming. See ``queries.py`` for the conventions."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from talkmill.functions.text import count_tokens
from talkmill.operators import budget as B
from talkmill.operators import metrics as M
from talkmill.operators.curation import (MATH_PATTERN, cross_fitted_scores, domain_additions, domain_yield,
                                         math_signal, quality_subset)
from talkmill.operators.dialogue import (ADDRESS, HEADER, OFTEN_NO_SPEAKERS, TAG, assemble_dialogue, split_turns,
                                         turn_stats)
from talkmill.operators.fanout import build_requests, prompt_fanout
from talkmill.operators.generate import resolve_attempts
from talkmill.operators.ledger import ReplyLedger
from talkmill.operators.records import attach_replies, pair_context
from talkmill.operators.prefix import materialize
from talkmill.operators.select import (all_conversations, combine_corpora, concat_context,
                                       longest_conversation, sample_k, training_mix)
from talkmill.operators.vocab import (build_vocabulary, decode_ids, encode_ids, piece_blocks,
                                      normalize_tokens, pick_token_column)
from talkmill.plans import oracle as o
from talkmill.plans.generation import chunk_table, dry_run_chunks, pending_requests
from talkmill.plans.queries import CFG, _request_sql, register
from talkmill.plans.tables import (attempt_ledger, corpus, dialogue_table, documents_path,
                                   judge_scores, kept_dialogues, table)
from talkmill.session import checkpoint_dir
from talkmill.sources.corpus import SOURCE_FILE, SOURCE_ROW, first_n
from talkmill.sources.inspect import column_report, file_profile, footer_profile, sample_preview
from talkmill.sources.sinks import write_jsonl

CTX = ("sample_index", "chunk_index")
SEED = 7


def _docs_tok(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", "lang", "source", count_tokens("text").cast("bigint").alias("n_tok"))


def _hash(expr: str) -> str:
    return f"md5('{SEED}:' || {expr})"


def _before(part: str, order: str) -> str:
    return (f"coalesce(sum(n_tok) OVER ({part} ORDER BY {order} "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")


# --------------------------------------------------------------------------- G / H

@register("g1_longest_conversation",
          o.with_("kept") + "SELECT sample_index, chunk_index, prompt_style, conversation_tokens FROM "
          "(SELECT *, row_number() OVER (PARTITION BY sample_index, chunk_index ORDER BY "
          "conversation_tokens DESC, prompt_ord) AS rn FROM kept) WHERE rn = 1")
def g1(spark, sf):
    return longest_conversation(kept_dialogues(spark, sf)).select(
        *CTX, "prompt_style", "conversation_tokens")


@register("h1_all_conversations",
          o.with_("kept") + "SELECT sample_index, chunk_index, prompt_style, conversation_tokens FROM kept")
def h1(spark, sf):
    """Dialogues as they are stored after generation (one partition folder per
    style), read once: the styles are those of the folders."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/by-style-{uuid.uuid4().hex}"
    (kept_dialogues(spark, sf).select(*CTX, "prompt_style", "conversation_tokens")
     .write.partitionBy("prompt_style").parquet(base))
    return all_conversations([spark.read.parquet(base)]).select(*CTX, "prompt_style", "conversation_tokens")


@register("h2_concat_context",
          o.with_("kept") + "SELECT sample_index, chunk_index, any_value(context) || chr(10) || chr(10) || "
          "string_agg(conversation, chr(10) || chr(10) ORDER BY prompt_ord) AS text, "
          "CAST(count(*) AS BIGINT) AS n_dialogues FROM kept GROUP BY sample_index, chunk_index")
def h2(spark, sf):
    return concat_context(kept_dialogues(spark, sf))


@register("h3_combine_corpora",
          o.with_("kept") + "SELECT 'a' AS origin, sample_index, chunk_index, prompt_style FROM kept "
          "WHERE lang = 'en' AND prompt_style <> 'two_students' UNION ALL "
          "SELECT 'b', sample_index, chunk_index, prompt_style FROM kept "
          "WHERE lang <> 'en' AND prompt_style = 'two_students'")
def h3(spark, sf):
    k = kept_dialogues(spark, sf).select(*CTX, "prompt_style", "lang")
    out = combine_corpora(k.where(F.col("lang") == "en"), k.where(F.col("lang") != "en"),
                          "two_students")
    return out.select("origin", *CTX, "prompt_style")


@register("h4_training_mix",
          o.with_("kept") + "SELECT 'synthetic' AS origin, CAST(sample_index AS VARCHAR) || ':' || "
          "CAST(chunk_index AS VARCHAR) || ':' || CAST(prompt_ord AS VARCHAR) AS doc_key, "
          "conversation AS text FROM kept UNION ALL "
          "SELECT 'raw', CAST(doc_id AS VARCHAR), text FROM documents")
def h4(spark, sf):
    k = kept_dialogues(spark, sf)
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in (*CTX, "prompt_ord")])
    return training_mix(k, table(spark, sf, "documents"), key_s=key, key_r=F.col("doc_id"))


@register("g2_token_subset",
          f"WITH d AS (SELECT doc_id, CAST({o.ntok('text')} AS BIGINT) AS n_tok FROM documents), "
          f"r AS (SELECT *, {_before('', _hash('CAST(doc_id AS VARCHAR)') + ', CAST(doc_id AS VARCHAR)')} "
          "AS tokens_before FROM d) SELECT doc_id, n_tok, CAST(tokens_before AS BIGINT) AS tokens_before "
          "FROM r WHERE tokens_before < CAST(0.3 AS DOUBLE) * (SELECT sum(n_tok) FROM d)")
def g2(spark, sf):
    d = materialize(_docs_tok(spark, sf).select("doc_id", "n_tok"))
    out = B.token_subset(d, "n_tok", "doc_id", F.lit(0.3) * B.total_tokens(d, "n_tok"), SEED)
    return out.select("doc_id", "n_tok", F.col("tokens_before").cast("bigint"))


def _g3_sql() -> str:
    k = ("CAST(sample_index AS VARCHAR) || ':' || CAST(chunk_index AS VARCHAR) || ':' || "
         "CAST(prompt_ord AS VARCHAR)")
    order = _hash("doc_key") + ", doc_key"
    return (o.with_("kept", extra={
        "a": f"SELECT CAST(doc_id AS VARCHAR) AS doc_key, CAST({o.ntok('text')} AS BIGINT) AS n_tok FROM documents",
        "b": f"SELECT {k} AS doc_key, CAST(conversation_tokens AS BIGINT) AS n_tok FROM kept",
        "bud": "SELECT least((SELECT sum(n_tok) FROM a), (SELECT sum(n_tok) FROM b)) AS v",
        "ra": f"SELECT *, {_before('', order)} AS tb FROM a",
        "rb": f"SELECT *, {_before('', order)} AS tb FROM b"}) +
        "SELECT 'a' AS origin, doc_key, n_tok FROM ra WHERE tb < (SELECT v FROM bud) UNION ALL "
        "SELECT 'b', doc_key, n_tok FROM rb WHERE tb < (SELECT v FROM bud)")


@register("g3_balance_1to1", _g3_sql())
def g3(spark, sf):
    a = materialize(_docs_tok(spark, sf).select(F.col("doc_id").cast("string").alias("doc_key"),
                                                "n_tok"))
    k = kept_dialogues(spark, sf)
    b = materialize(k.select(F.concat_ws(":", *[F.col(c).cast("string") for c in (*CTX, "prompt_ord")])
                             .alias("doc_key"), F.col("conversation_tokens").cast("bigint").alias("n_tok")))
    return B.balance_1to1(a, b, "n_tok", "doc_key", "doc_key", SEED).select("origin", "doc_key",
                                                                            "n_tok")


E_EPOCHS = 2.46


def _g4_sql() -> str:
    ck = "CAST(doc_id AS VARCHAR) || ':' || CAST(copy_no AS VARCHAR)"
    full = int(E_EPOCHS // 1)
    return (f"WITH d AS (SELECT doc_id, CAST({o.ntok('text')} AS BIGINT) AS n_tok FROM documents), "
            f"c AS (SELECT *, unnest(range(0, {full + 1})) AS copy_no FROM d), "
            f"p AS (SELECT *, {_before('', _hash(ck) + ', ' + ck)} AS tb FROM c WHERE copy_no = {full}) "
            f"SELECT doc_id, CAST(copy_no AS INTEGER) AS copy_no, n_tok FROM c WHERE copy_no < {full} "
            f"UNION ALL SELECT doc_id, CAST(copy_no AS INTEGER), n_tok FROM p WHERE tb < "
            f"(CAST({E_EPOCHS!r} AS DOUBLE) - floor(CAST({E_EPOCHS!r} AS DOUBLE))) * "
            "(SELECT sum(n_tok) FROM d)")


@register("g4_epochs", _g4_sql())
def g4(spark, sf):
    d = materialize(_docs_tok(spark, sf).select("doc_id", "n_tok"))
    return B.epochs(d, "n_tok", "doc_id", E_EPOCHS, SEED).select(
        "doc_id", F.col("copy_no").cast("int"), "n_tok")


def _g5_sql() -> str:
    ck = "CAST(doc_id AS VARCHAR) || ':' || CAST(copy_no AS VARCHAR)"
    return (f"WITH a AS (SELECT doc_id, lang, CAST({o.ntok('text')} AS BIGINT) AS n_tok FROM documents), "
            "d AS (SELECT * FROM a WHERE lang IN (SELECT lang FROM a GROUP BY lang HAVING sum(n_tok) > 0)), "
            "w AS (SELECT lang, CAST(1 AS DOUBLE) / CAST(count(*) OVER () AS DOUBLE) AS w "
            "FROM (SELECT DISTINCT lang FROM d)), "
            "s AS (SELECT lang, sum(n_tok) AS size FROM d GROUP BY lang), "
            "e AS (SELECT s.lang, s.size, (CAST((SELECT sum(n_tok) FROM a) AS DOUBLE) * w.w) / "
            "CAST(s.size AS DOUBLE) AS e FROM s JOIN w ON s.lang = w.lang), "
            "c AS (SELECT d.*, e.e, e.size, unnest(range(0, CAST(ceil(e.e) AS BIGINT))) AS copy_no "
            "FROM d JOIN e ON d.lang = e.lang), "
            f"p AS (SELECT *, {_before('PARTITION BY lang, copy_no', _hash(ck) + ', ' + ck)} AS tb "
            "FROM c WHERE copy_no = floor(e)) "
            "SELECT lang, doc_id, CAST(copy_no AS INTEGER) AS copy_no, n_tok FROM c WHERE copy_no < floor(e) "
            "UNION ALL SELECT lang, doc_id, CAST(copy_no AS INTEGER), n_tok FROM p "
            "WHERE tb < (e - floor(e)) * size")


@register("g5_blend", _g5_sql())
def g5(spark, sf):
    d = materialize(_docs_tok(spark, sf).select("doc_id", "lang", "n_tok"))
    equal = {r["lang"]: 1.0 for r in d.select("lang").distinct().collect() if r["lang"] is not None}
    out = B.blend(d, "n_tok", "doc_id", "lang", equal, B.total_tokens(d, "n_tok"), SEED)
    return out.select("lang", "doc_id", F.col("copy_no").cast("int"), "n_tok")


@register("g6_sample_k",
          f"SELECT doc_id, lang FROM documents ORDER BY {_hash('CAST(doc_id AS VARCHAR)')}, doc_id LIMIT 20")
def g6(spark, sf):
    return sample_k(table(spark, sf, "documents").select("doc_id", "lang"), 20, "doc_id", SEED)


@register("g7_first_n", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10")
def g7(spark, sf):
    return first_n(corpus(spark, sf), 10).select("doc_id", "text")


# --------------------------------------------------------------------------- F: metrics

def _style_stats(src: str, label: str | None) -> str:
    style = "prompt_style" if label is None else f"'{label}'"
    return (f"SELECT {style} AS prompt_style, CAST(count(*) AS BIGINT) AS n_dialogues, "
            "round(avg(conversation_tokens), 6) AS avg_tokens, "
            "CAST(min(conversation_tokens) AS BIGINT) AS min_tokens, "
            "CAST(max(conversation_tokens) AS BIGINT) AS max_tokens, "
            "round(quantile_cont(CAST(conversation_tokens AS DOUBLE), 0.5), 6) AS median_tokens, "
            f"round(quantile_cont(CAST(conversation_tokens AS DOUBLE), 0.9), 6) AS p90_tokens FROM {src}"
            + (" GROUP BY prompt_style" if label is None else ""))


@register("f3_style_length",
          o.with_("kept", extra={"lg": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "
                                       "sample_index, chunk_index ORDER BY conversation_tokens DESC, "
                                       "prompt_ord) AS rn FROM kept) WHERE rn = 1"}) +
          _style_stats("kept", None) + " UNION ALL " + _style_stats("lg", "longest"))
def f3(spark, sf):
    k = materialize(kept_dialogues(spark, sf).select(*CTX, "prompt_ord", "prompt_style",
                                                     "conversation_tokens"))
    return M.style_length(k, longest=materialize(longest_conversation(k)),
                          percentiles={"median_tokens": 0.5, "p90_tokens": 0.9})


@register("f4_length_response",
          o.with_("classified") + "SELECT prompt_style, CAST(floor(context_tokens / 100) * 100 AS BIGINT) "
          "AS input_bin, CAST(count(*) AS BIGINT) AS n, round(avg(conversation_tokens), 6) AS "
          "avg_output_tokens FROM classified GROUP BY ALL")
def f4(spark, sf):
    return M.length_response(dialogue_table(spark, sf))


@register("f5_corpus_tokens",
          o.with_("kept", extra={
              "r": f"SELECT source, CAST(sum({o.ntok('text')}) AS BIGINT) AS raw_tokens FROM documents "
                   "GROUP BY source",
              "s": "SELECT source, CAST(sum(conversation_tokens) AS BIGINT) AS synthetic_tokens FROM kept "
                   "GROUP BY source"}) +
          "SELECT coalesce(r.source, s.source) AS source, coalesce(raw_tokens, 0) AS raw_tokens, "
          "coalesce(synthetic_tokens, 0) AS synthetic_tokens, "
          "round(coalesce(synthetic_tokens, 0) / coalesce(raw_tokens, 0), 6) AS expansion "
          "FROM r FULL JOIN s ON r.source = s.source")
def f5(spark, sf):
    raw = table(spark, sf, "documents").withColumn("n_tokens", count_tokens("text"))
    return M.corpus_tokens(raw, kept_dialogues(spark, sf))


SCORES_SQL = ("SELECT 'conv-' || CAST(user_id AS VARCHAR) AS conv_key, event_type AS rater, "
              "['accuracy', 'coherence', 'faithfulness', 'fluency'][event_id % 4 + 1] AS metric, "
              "CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS INTEGER) AS score FROM events")
F6_SQL = ("SELECT conv_key, round(avg(m), 6) AS mean_score, CAST(count(*) AS BIGINT) AS n_metrics, "
          "avg(m) >= 3.0 AS kept FROM (SELECT conv_key, metric, avg(score) AS m FROM sc "
          "GROUP BY conv_key, metric) GROUP BY conv_key")


@register("f6_score_filter", f"WITH sc AS ({SCORES_SQL}) {F6_SQL}")
def f6(spark, sf):
    return M.score_filter(judge_scores(spark, sf))


@register("f7_score_histogram",
          f"WITH sc AS ({SCORES_SQL}), f AS ({F6_SQL}), "
          "h AS (SELECT CAST(round(mean_score) AS INTEGER) AS score_bin, CAST(count(*) AS BIGINT) AS n "
          "FROM f GROUP BY 1) SELECT score_bin, n, round(n / sum(n) OVER (), 6) AS share, "
          "round(sum(CASE WHEN score_bin >= 3.0 THEN n ELSE 0 END) OVER () / sum(n) OVER (), 6) "
          "AS share_high FROM h")
def f7(spark, sf):
    return M.score_histogram(M.score_filter(judge_scores(spark, sf)))


@register("f8_rater_agreement",
          "WITH j AS (SELECT l.quality AS x, d.n_chars AS y FROM labels l JOIN documents d "
          "ON l.doc_id = d.doc_id WHERE l.quality IS NOT NULL AND d.n_chars IS NOT NULL), "
          "r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, "
          "rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM j) "
          "SELECT CAST(count(*) AS BIGINT) AS n, round(corr(rx, ry), 6) AS spearman FROM r")
def f8(spark, sf):
    j = table(spark, sf, "labels").join(table(spark, sf, "documents"), on="doc_id", how="inner")
    xy = materialize(j.select(F.col("quality").alias("x"), F.col("n_chars").alias("y")))
    return M.spearman(xy, "x", "y")


def _grams(src: str, keys: str, text: str) -> str:
    return (f"SELECT {keys}, n, array_to_string(w[i : i + n - 1], ' ') AS gram FROM "
            f"(SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM "
            f"(SELECT *, unnest([1, 2, 3, 4]) AS n FROM (SELECT {keys}, {o.words(text)} AS w FROM {src})))")


OVERLAP = {
    "hg": _grams("kept", "sample_index, chunk_index, prompt_style", "conversation"),
    "hc": "SELECT sample_index, chunk_index, prompt_style, n, gram, count(*) AS c_hyp FROM hg GROUP BY ALL",
    "rs": "SELECT DISTINCT sample_index, chunk_index, context FROM kept",
    "rg": _grams("rs", "sample_index, chunk_index", "context"),
    "rc": "SELECT sample_index, chunk_index, n, gram, count(*) AS c_ref FROM rg GROUP BY ALL",
    "m": ("SELECT hc.prompt_style, hc.n, hc.c_hyp, least(hc.c_hyp, coalesce(rc.c_ref, 0)) AS c_match "
          "FROM hc LEFT JOIN rc ON hc.sample_index = rc.sample_index AND hc.chunk_index = rc.chunk_index "
          "AND hc.n = rc.n AND hc.gram = rc.gram"),
    "ht": "SELECT prompt_style, n, sum(c_match) AS matches, sum(c_hyp) AS hyp_grams FROM m GROUP BY ALL",
    "pairs": "SELECT DISTINCT sample_index, chunk_index, prompt_style FROM kept",
    "rl": "SELECT sample_index, chunk_index, n, sum(c_ref) AS rl FROM rc GROUP BY ALL",
    "rt": ("SELECT prompt_style, n, sum(rl) AS ref_grams FROM pairs JOIN rl ON "
           "pairs.sample_index = rl.sample_index AND pairs.chunk_index = rl.chunk_index GROUP BY ALL"),
    "counts": ("SELECT coalesce(ht.prompt_style, rt.prompt_style) AS prompt_style, "
               "CAST(coalesce(ht.n, rt.n) AS INTEGER) AS n, CAST(coalesce(matches, 0) AS BIGINT) AS matches, "
               "CAST(coalesce(hyp_grams, 0) AS BIGINT) AS hyp_grams, "
               "CAST(coalesce(ref_grams, 0) AS BIGINT) AS ref_grams "
               "FROM ht FULL JOIN rt ON ht.prompt_style = rt.prompt_style AND ht.n = rt.n"),
}


def _bleu_sql() -> str:
    m = {k: f"coalesce(sum(matches) FILTER (WHERE n = {k}), 0)" for k in range(1, 5)}
    h = {k: f"coalesce(sum(hyp_grams) FILTER (WHERE n = {k}), 0)" for k in range(1, 5)}
    inner = ("SELECT prompt_style, " + ", ".join(f"{m[k]} AS m{k}, {h[k]} AS h{k}" for k in range(1, 5))
             + ", sum(ref_grams) FILTER (WHERE n = 1) AS ref_len FROM counts GROUP BY prompt_style")
    zero = " OR ".join(f"m{k} = 0 OR h{k} = 0" for k in range(1, 5))
    logs = " + ".join(f"ln(m{k} / h{k})" for k in range(1, 5))
    bp = "least(1.0, exp(1.0 - ref_len / h1))"
    return (o.with_("kept", extra=OVERLAP) +
            f"SELECT prompt_style, CAST(h1 AS BIGINT) AS hyp_len, CAST(ref_len AS BIGINT) AS ref_len, "
            f"round({bp}, 6) AS brevity_penalty, round(CASE WHEN {zero} THEN 0.0 ELSE "
            f"{bp} * exp(({logs}) / 4) END, 6) AS bleu FROM ({inner})")


def _counts(spark, sf):
    """The contexts' words are made once, before the fan-out."""
    chunks = chunk_table(spark, documents_path(sf), CFG).withColumn("ref_words", M.word_numbers("context"))
    kept = dry_run_chunks(chunks, CFG).where(F.col("status") == "kept")
    return M.overlap_counts(kept, "conversation", "context", "prompt_style", ref_words="ref_words")


@register("f9_bleu", _bleu_sql())
def f9(spark, sf):
    return M.bleu(_counts(spark, sf), "prompt_style")


@register("f10_rouge_n",
          o.with_("kept", extra=OVERLAP) +
          "SELECT prompt_style, n, round(p, 6) AS precision, round(r, 6) AS recall, "
          "round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM "
          "(SELECT prompt_style, n, CAST(matches AS DOUBLE) / hyp_grams AS p, "
          "CAST(matches AS DOUBLE) / ref_grams AS r FROM counts)")
def f10(spark, sf):
    return M.rouge_n(_counts(spark, sf), "prompt_style")


@register("f12_scorecard",
          "WITH res AS (SELECT event_type AS dataset, 'k' || json_extract_string(props, '$.k') AS task, "
          "avg(value) AS score FROM events GROUP BY ALL), "
          "t AS (SELECT *, coalesce('g' || CAST(CAST(floor(TRY_CAST(substr(task, 2) AS DOUBLE) / 25) AS BIGINT) "
          "AS VARCHAR), 'other') AS task_group FROM res), "
          "a AS (SELECT dataset, task_group, avg(score) AS av, CAST(count(*) AS BIGINT) AS n_tasks "
          "FROM t GROUP BY ALL), b AS (SELECT task_group, av AS base FROM a WHERE dataset = 'view') "
          "SELECT a.dataset, a.task_group, a.n_tasks, round(a.av, 6) AS avg_score, "
          "round(a.av - b.base, 6) AS gain FROM a LEFT JOIN b ON a.task_group = b.task_group")
def f12(spark, sf):
    e = table(spark, sf, "events")
    res = e.groupBy(F.col("event_type").alias("dataset"),
                    F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("task")).agg(
        F.avg("value").alias("score"))
    number = F.substring("task", 2, 1 << 30).try_cast("double")
    return M.scorecard(res, F.concat(F.lit("g"), F.floor(number / 25).cast("string")), baseline="view")


F12_TREE = {"low": {"g0": 2.0, "g1": 1.0}}


@register("f12_score_tree",
          "WITH res AS (SELECT event_type AS dataset, 'k' || json_extract_string(props, '$.k') AS task, "
          "avg(value) AS score FROM events GROUP BY ALL), "
          "t AS (SELECT *, coalesce('g' || CAST(CAST(floor(TRY_CAST(substr(task, 2) AS DOUBLE) / 25) AS BIGINT) "
          "AS VARCHAR), 'other') AS node FROM res), "
          "a AS (SELECT dataset, node, 1 AS level, count(*) AS n, avg(score) AS av FROM t GROUP BY dataset, node), "
          "b AS (SELECT dataset, 'low' AS node, 2 AS level, count(*) AS n, sum(av * CASE node WHEN 'g0' THEN 2.0 ELSE "
          "1.0 END) / sum(CASE node WHEN 'g0' THEN 2.0 ELSE 1.0 END) AS av FROM a WHERE node IN ('g0', 'g1') "
          "GROUP BY dataset), c AS (SELECT dataset, 'all' AS node, 3 AS level, count(*) AS n, avg(av) AS av FROM "
          "(SELECT * FROM a WHERE node NOT IN ('g0', 'g1') UNION ALL SELECT * FROM b) GROUP BY dataset), "
          "u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) "
          "SELECT u.dataset, u.node, CAST(u.level AS INTEGER) AS level, CAST(u.n AS BIGINT) AS n_children, "
          "round(u.av, 6) AS avg_score, round(u.av - x.av, 6) AS gain FROM u LEFT JOIN u x ON x.dataset = 'view' "
          "AND x.node = u.node")
def f12_tree(spark, sf):
    """Groups of tasks, a weighted mean of two groups, and the mean over all."""
    e = table(spark, sf, "events")
    res = e.groupBy(F.col("event_type").alias("dataset"),
                    F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("task")).agg(
        F.avg("value").alias("score"))
    number = F.substring("task", 2, 1 << 30).try_cast("double")
    return M.score_tree(res, F12_TREE, "view", F.concat(F.lit("g"), F.floor(number / 25).cast("string")), root="all")


@register("f13_majority_answer",
          "WITH v AS (SELECT user_id, event_type, count(*) AS votes FROM events GROUP BY ALL), "
          "r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, event_type) AS rn, "
          "sum(votes) OVER (PARTITION BY user_id) AS n_votes FROM v) "
          "SELECT user_id, event_type AS majority, CAST(votes AS BIGINT) AS votes, "
          "CAST(n_votes AS BIGINT) AS n_votes FROM r WHERE rn = 1")
def f13(spark, sf):
    return M.majority_answer(table(spark, sf, "events"), "user_id", "event_type")


LEDGER_SQL = ("SELECT 'req-' || CAST(event_id // 4 AS VARCHAR) AS request_id, "
              "CAST(event_id % 4 + 1 AS INTEGER) AS attempt, event_type <> 'error' AS ok, "
              "CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN '  ' "
              "ELSE props END AS reply, CASE WHEN event_type = 'error' THEN 'call failed at event ' "
              "|| CAST(event_id AS VARCHAR) END AS error FROM events")


@register("e4_resolve_attempts",
          f"WITH l AS ({LEDGER_SQL}), w AS (SELECT * FROM l WHERE attempt <= 3), "
          "g AS (SELECT request_id, "
          f"min(attempt) FILTER (WHERE ok AND reply IS NOT NULL AND {o.strip('reply')} <> '') AS first_ok, "
          f"arg_min({o.strip('reply')}, attempt) FILTER (WHERE ok AND reply IS NOT NULL AND "
          f"{o.strip('reply')} <> '') AS ok_reply, arg_max_null(coalesce(error, CASE WHEN ok AND "
          f"(reply IS NULL OR {o.strip('reply')} = '') THEN 'empty reply' END), attempt) AS last_error, "
          "max(attempt) AS n FROM w GROUP BY request_id) "
          "SELECT request_id, ok_reply AS reply, CASE WHEN first_ok IS NOT NULL THEN 'ok' ELSE 'failed' END "
          "AS status, CAST(coalesce(first_ok, n) AS INTEGER) AS attempts, "
          "CASE WHEN first_ok IS NULL THEN last_error END AS error FROM g")
def e4(spark, sf):
    return resolve_attempts(attempt_ledger(spark, sf), 3)


# --------------------------------------------------------------------------- I: dialogue

ASSEMBLE_SQL = ("SELECT conv_id, string_agg(upper(substr(role, 1, 1)) || lower(substr(role, 2)) || ': ' "
                "|| text, chr(10) ORDER BY turn) AS dialogue, CAST(count(*) AS BIGINT) AS n_turns "
                "FROM conversations GROUP BY conv_id")


@register("i2_assemble_dialogue", ASSEMBLE_SQL)
def i2(spark, sf):
    return assemble_dialogue(table(spark, sf, "conversations"))


def _split_sql(dialogues: str) -> str:
    name = (f"coalesce(nullif(regexp_extract(line, '^{TAG}', 1), ''), regexp_extract(line, '^{TAG}', 2))")
    often = ", ".join(f"'{x}'" for x in OFTEN_NO_SPEAKERS)
    return (f"WITH d AS ({dialogues}), "
            "l AS (SELECT conv_id, generate_subscripts(string_split(dialogue, chr(10)), 1) AS i, "
            "unnest(string_split(dialogue, chr(10))) AS line FROM d), "
            f"h AS (SELECT *, regexp_full_match(line, '{HEADER}') AS is_header, "
            f"NOT regexp_full_match(line, '{HEADER}') AND regexp_matches(line, '^{TAG}') "
            f"AND NOT regexp_matches(line, '^{ADDRESS}') AS is_label FROM l), "
            f"b AS (SELECT *, CASE WHEN is_label THEN lower({name}) END AS label, "
            f"regexp_extract(line, '^{TAG}', 1) <> '' AS bold FROM h), "
            "n AS (SELECT conv_id, i, count(*) OVER (PARTITION BY conv_id, label) AS times, "
            "lag(label) OVER w AS prev, lead(label) OVER w AS next, row_number() OVER w AS k, label, bold, "
            f"label NOT IN ({often}) AS plain "
            "FROM b WHERE is_label WINDOW w AS (PARTITION BY conv_id ORDER BY i)), "
            "g0 AS (SELECT n.conv_id, max(times) AS most, count(*) AS labels, bool_or(plain) AS others, NOT EXISTS (SELECT 1 FROM b WHERE "
            "b.conv_id = n.conv_id AND b.i < min(n.i) AND NOT b.is_header AND regexp_matches(b.line, '[^ \\t\\n]')) "
            "AS opens FROM n GROUP BY n.conv_id), "
            "sp AS (SELECT n.conv_id, n.i FROM n JOIN g0 ON n.conv_id = g0.conv_id WHERE CASE WHEN most > 1 THEN "
            "times > 1 OR coalesce(prev = next, false) OR (plain AND (bold OR (opens AND k = 1))) "
            "ELSE plain OR (NOT others AND labels >= 2) END), "
            "m AS (SELECT b.*, sp.i IS NOT NULL AS is_tag FROM b LEFT JOIN sp ON b.conv_id = sp.conv_id AND b.i = sp.i), "
            "t AS (SELECT *, sum(CASE WHEN is_tag THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY i) "
            "AS turn_no, sum(CASE WHEN is_header THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY i) "
            "AS hn FROM m), "
            "g AS (SELECT conv_id, CAST(turn_no AS INTEGER) AS turn_no, "
            "CAST(coalesce(max(CASE WHEN is_tag THEN hn END), 0) AS INTEGER) AS header_no, "
            f"max(CASE WHEN is_tag THEN {name} END) AS speaker, "
            f"string_agg(CASE WHEN is_tag THEN regexp_replace(line, '^{TAG}', '') ELSE line END, chr(10) "
            "ORDER BY i) FILTER (WHERE NOT is_header) AS text "
            "FROM t GROUP BY conv_id, turn_no) "
            "SELECT conv_id, turn_no, CASE WHEN turn_no = 0 THEN 0 ELSE header_no END AS header_no, "
            "speaker, coalesce(text, '') AS text FROM g WHERE NOT (turn_no = 0 AND coalesce(text, '') = '')")


@register("i1_split_turns", _split_sql(ASSEMBLE_SQL))
def i1(spark, sf):
    return split_turns(assemble_dialogue(table(spark, sf, "conversations")))


@register("i1_split_bold_turns",
          _split_sql("SELECT conv_id, string_agg('**Turn ' || turn || '**' || chr(10) || '**Dr. ' || role || ':** ' "
                     "|| text, chr(10) ORDER BY turn) AS dialogue FROM conversations GROUP BY conv_id"))
def i1_bold(spark, sf):
    """Dialogues with bold tags and turn headers."""
    c = table(spark, sf, "conversations")
    line = F.concat(F.lit("**Turn "), F.col("turn").cast("string"), F.lit("**\n**Dr. "), "role", F.lit(":** "), "text")
    parts = F.array_sort(F.collect_list(F.struct("turn", line.alias("x"))))
    d = c.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["x"]), "\n").alias("dialogue"))
    return split_turns(d)


@register("i3_turn_stats",
          "WITH p AS (SELECT conv_id, role, CAST(count(*) AS BIGINT) AS speaker_turns, "
          f"CAST(sum({o.ntok('text')}) AS BIGINT) AS speaker_tokens FROM conversations GROUP BY ALL) "
          "SELECT *, CAST(sum(speaker_turns) OVER (PARTITION BY conv_id) AS BIGINT) AS n_turns, "
          "CAST(count(*) OVER (PARTITION BY conv_id) AS BIGINT) AS n_speakers FROM p")
def i3(spark, sf):
    return turn_stats(table(spark, sf, "conversations"))


# --------------------------------------------------------------------------- C / B: vocabulary

VOCAB_SQL = ("SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token) - 1 AS BIGINT) AS id, "
             "CAST(cnt AS BIGINT) AS n_occurrences FROM (SELECT token, count(*) AS cnt FROM "
             f"(SELECT unnest({o.tok('text')}) AS token FROM documents) GROUP BY token)")


def _vocab(spark, sf, pieces=None):
    v = build_vocabulary(table(spark, sf, "documents"), pieces=pieces)
    return v.withColumnRenamed("count", "n_occurrences")


@register("c6_build_vocabulary", VOCAB_SQL)
def c6(spark, sf):
    return _vocab(spark, sf).select("token", "id", "n_occurrences")


@register("c7_encode_ids",
          f"WITH v AS ({VOCAB_SQL}), p AS (SELECT doc_id, generate_subscripts(tk, 1) AS pos, "
          f"unnest(tk) AS token FROM (SELECT doc_id, {o.tok('text')} AS tk FROM documents)) "
          "SELECT d.doc_id, CAST(count(pos) AS INTEGER) AS n_ids, coalesce(string_agg(CAST(v.id AS VARCHAR), ' ' "
          "ORDER BY pos), '') AS ids_text FROM documents d LEFT JOIN p ON d.doc_id = p.doc_id "
          "LEFT JOIN v ON p.token = v.token GROUP BY d.doc_id")
def c7(spark, sf):
    docs = table(spark, sf, "documents")
    pieces = piece_blocks(docs, keep=["doc_id"])
    enc = encode_ids(docs, _vocab(spark, sf, pieces), "doc_id", pieces=pieces)
    return enc.select("doc_id", F.size("ids").cast("int").alias("n_ids"),
                      F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids_text"))


@register("c8_decode_ids",
          "SELECT doc_id, coalesce(text, '') AS text, text IS NOT NULL AS rebuilds_text FROM documents")
def c8(spark, sf):
    """All documents; a null text has no ids and comes back empty. A document
    carries the SHA-256 of its text, to which the rebuilt text is compared."""
    digest = F.sha2("text", 256)
    docs = table(spark, sf, "documents").select("doc_id", "text", digest.alias("_digest"))
    pieces = piece_blocks(docs, keep=["doc_id", "_digest"])
    v = _vocab(spark, sf, pieces)
    ids = encode_ids(docs, v, "doc_id", keep=["_digest"], pieces=pieces)
    dec = decode_ids(ids, v, "doc_id", keep=["_digest"])
    return dec.select("doc_id", "text", digest.eqNullSafe(F.col("_digest")).alias("rebuilds_text"))


NORM_SQL = ("CASE WHEN len(embedding) > 0 AND NOT list_bool_or(list_transform(embedding, "
            "lambda x: TRY_CAST(trunc(x) AS BIGINT) IS NULL)) THEN array_to_string(list_transform("
            "embedding, lambda x: CAST(trunc(x) AS BIGINT)), ' ') END")


@register("b2_normalize_tokens",
          f"SELECT vec_id, {NORM_SQL} AS ids_text FROM embeddings")
def b2(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.array_join(normalize_tokens("embedding").cast("array<string>"), " ")
                    .alias("ids_text"))


B1_SQL = ("SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN [CAST(trunc(x) AS BIGINT) for x in embedding] END AS tokens, "
          "CASE WHEN vec_id % 3 = 1 THEN [CAST(label AS BIGINT), vec_id] WHEN vec_id % 3 = 2 THEN [] END AS input_ids, "
          "CASE WHEN vec_id % 2 = 0 THEN 'row ' || vec_id ELSE ' ' END AS text FROM embeddings")


@register("b1_pick_token_column",
          f"WITH c AS ({B1_SQL}) SELECT vec_id, CASE WHEN len(tokens) > 0 THEN 'tokens' WHEN len(input_ids) > 0 "
          "THEN 'input_ids' WHEN trim(text) <> '' THEN 'text' END AS token_source, "
          "array_to_string(CASE WHEN len(tokens) > 0 THEN tokens WHEN len(input_ids) > 0 THEN input_ids END, ' ') "
          "AS ids_text FROM c")
def b1(spark, sf):
    """Two token columns, null or empty in some rows, and a text column."""
    e = table(spark, sf, "embeddings")
    third = F.col("vec_id") % 3
    rows = e.select(
        "vec_id", F.when(third == 0, F.col("embedding")).alias("tokens"),
        F.when(third == 1, F.array(F.col("label").cast("long"), F.col("vec_id")))
        .when(third == 2, F.array().cast("array<bigint>")).alias("input_ids"),
        F.when(F.col("vec_id") % 2 == 0, F.concat(F.lit("row "), F.col("vec_id").cast("string")))
        .otherwise(F.lit(" ")).alias("text"))
    out = pick_token_column(rows)
    return out.select("vec_id", "token_source",
                      F.array_join(F.col("token_ids").cast("array<string>"), " ").alias("ids_text"))


# --------------------------------------------------------------------------- A: inspection

def _profile_sql() -> str:
    cols = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    parts = [f"SELECT CAST(count(*) AS BIGINT) AS n_rows, '{c}' AS column_name, CAST({i} AS INTEGER) AS "
             f"ordinal, '{kind}' AS spark_type, CAST(count({c}) AS BIGINT) AS n_nonnull FROM documents"
             for i, (c, kind) in enumerate(cols.items())]
    return " UNION ALL ".join(parts)


@register("a8_corpus_profile", _profile_sql())
def a8(spark, sf):
    return footer_profile(spark, documents_path(sf))


@register("a8_file_profile", "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS n_profiles FROM "
          "(SELECT count(*) AS n FROM documents)")
def a8_files(spark, sf):
    """Rows of every file; summed, since file names differ by machine."""
    files = file_profile(corpus(spark, sf))
    return files.agg(F.sum("n_rows").cast("bigint").alias("n_rows"),
                     F.countDistinct(F.col("n_rows") > 0).cast("bigint").alias("n_profiles"))


@register("a9_sample_preview",
          f"SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row, "
          "CAST(length(text) AS BIGINT) AS text_length, "
          f"CAST({o.ntok('text')} AS BIGINT) AS token_count, "
          f"array_to_string({o.tok('text')}[1:50], '') AS first_tokens, "
          "CASE WHEN length(text) > 1000 THEN substr(text, 1, 500) || ' [+' || "
          "CAST(length(text) - 1000 AS VARCHAR) || '] ' || right(text, 500) ELSE text END AS text_view FROM documents")
def a9(spark, sf):
    return sample_preview(corpus(spark, sf)).drop("file")


def _report_sql() -> str:
    parts = []
    for c, kind in (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                    ("n_chars", "bigint")):
        length = f"CAST(length({c}) AS BIGINT)" if kind == "string" else "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT doc_id, '{c}' AS column_name, '{kind}' AS spark_type, {length} AS length, "
                     f"substr(CAST({c} AS VARCHAR), 1, 100) AS preview FROM documents")
    return " UNION ALL ".join(parts)


@register("a10_column_report", _report_sql())
def a10(spark, sf):
    return column_report(table(spark, sf, "documents"), key="doc_id")


# --------------------------------------------------------------------------- D / E / A6

@register("d2_attach_replies",
          "WITH q AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS request_id "
          "FROM conversations WHERE role = 'user'), "
          "a AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn - 1 AS VARCHAR) AS request_id, "
          "text FROM conversations WHERE role = 'assistant') "
          "SELECT q.request_id, coalesce(CASE WHEN a.request_id IS NOT NULL THEN 'ok' END, 'missing') "
          f"AS status, CAST({o.ntok('a.text')} AS INTEGER) AS reply_tokens "
          "FROM q LEFT JOIN a ON q.request_id = a.request_id")
def d2(spark, sf):
    c = table(spark, sf, "conversations")
    req = c.where(F.col("role") == "user").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("request_id"))
    rep = c.where(F.col("role") == "assistant").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
        .alias("request_id"), F.col("text").alias("reply"), F.lit("ok").alias("status"),
        F.lit(1).alias("attempts"), F.lit(None).cast("string").alias("error"))
    out = attach_replies(req, rep)
    return out.select("request_id", "status",
                      count_tokens("conversation").cast("int").alias("reply_tokens"))


@register("d3_pair_context",
          o.with_("kept") + "SELECT sample_index, chunk_index, prompt_style, context_tokens, "
          "conversation_tokens FROM kept")
def d3(spark, sf):
    k = kept_dialogues(spark, sf).select(*CTX, "prompt_style", "conversation_tokens")
    ch = chunk_table(spark, documents_path(sf), CFG)
    p = pair_context(k, ch, cols=("context_tokens",))
    return p.select(*CTX, "prompt_style", "context_tokens", "conversation_tokens")


D4_ANSWERED = 10


@register("d4_pending_only",
          f"SELECT * FROM ({_request_sql()}) WHERE CAST('0x' || substr(request_id, 1, 3) AS BIGINT) % {D4_ANSWERED} = 0")
def d4(spark, sf):
    """A rerun over a ledger that holds an answer for nine of ten requests."""
    placed = replace(CFG, carry=(SOURCE_FILE, SOURCE_ROW))
    chunks = chunk_table(spark, documents_path(sf), placed)
    keys = ("sample_index", "chunk_index", "prompt_ord", "prompt_style")
    every = build_requests(prompt_fanout(chunks, CFG.styles()), CFG.request, keys)
    number = F.conv(F.substring("request_id", 1, 3), 16, 10).cast("bigint")
    ledger = ReplyLedger(spark, f"{checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}")
    ledger.append(every.where(number % D4_ANSWERED != 0).select(
        "request_id", F.lit("Speaker: yes").alias("reply"), F.lit("ok").alias("status"), F.lit(1).alias("attempts"),
        F.lit(None).cast("string").alias("error")))
    return pending_requests(chunks, CFG.styles(), CFG.request, ledger, keys).select("request_id", "prompt_style", "payload")


@register("a6_jsonl_sink",
          o.with_("kept") + "SELECT sample_index, chunk_index, prompt_style, context, conversation FROM kept")
def a6(spark, sf):
    from talkmill.plans.generation import kept_conversations
    from talkmill.operators.records import RECORD_COLUMNS
    out = f"{checkpoint_dir(spark).rstrip('/')}/jsonl-{uuid.uuid4().hex}"
    write_jsonl(kept_conversations(dialogue_table(spark, sf)), out)
    schema = ("sample_index BIGINT, chunk_index INT, prompt_style STRING, context STRING, "
              "conversation STRING, created_at STRING")
    back = spark.read.schema(schema).json(out)
    assert tuple(back.columns) == RECORD_COLUMNS
    return back.drop("created_at")


# --------------------------------------------------------------------------- L: curation

@register("l1_quality_subset",
          "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def l1(spark, sf):
    return quality_subset(table(spark, sf, "documents"), table(spark, sf, "labels")).select(
        "doc_id", "lang")


FOLDS = 3
_FOLD = f"CAST(CAST('0x' || substr({_hash('CAST(doc_id AS VARCHAR)')}, 1, 8) AS BIGINT) % {FOLDS} AS INTEGER)"
SCORES_L2 = (
    f"WITH k AS (SELECT doc_id, {_FOLD} AS fold, text FROM documents), "
    f"t AS (SELECT doc_id, fold, word, count(*) AS n FROM (SELECT doc_id, fold, unnest({o.words('text')}) AS word FROM k) "
    "GROUP BY ALL), "
    "y AS (SELECT DISTINCT k.doc_id, k.fold, l.quality AS y FROM k JOIN labels l ON k.doc_id = l.doc_id "
    "WHERE l.quality IN (0, 1)), "
    "c AS (SELECT t.word, t.fold, y.y, sum(t.n) AS n FROM t JOIN y ON t.doc_id = y.doc_id GROUP BY ALL), "
    f"f AS (SELECT unnest(range(0, {FOLDS})) AS fold), "
    "s AS (SELECT f.fold, (SELECT count(DISTINCT word) FROM c) AS v, "
    "coalesce(sum(c.n) FILTER (WHERE c.y = 1), 0) AS n1, coalesce(sum(c.n) FILTER (WHERE c.y = 0), 0) AS n0 "
    "FROM f LEFT JOIN c ON c.fold <> f.fold GROUP BY f.fold), "
    "p AS (SELECT f.fold, ln((count(*) FILTER (WHERE y.y = 1) + 1) / (count(*) FILTER (WHERE y.y = 0) + 1)) AS prior "
    "FROM f LEFT JOIN y ON y.fold <> f.fold GROUP BY f.fold), "
    "m AS (SELECT c.word, f.fold, coalesce(sum(c.n) FILTER (WHERE c.y = 1 AND c.fold <> f.fold), 0) AS a1, "
    "coalesce(sum(c.n) FILTER (WHERE c.y = 0 AND c.fold <> f.fold), 0) AS a0 FROM c CROSS JOIN f GROUP BY c.word, f.fold), "
    "w AS (SELECT t.doc_id, sum(t.n * (ln((coalesce(m.a1, 0) + 1) / (s.n1 + s.v)) "
    "- ln((coalesce(m.a0, 0) + 1) / (s.n0 + s.v)))) AS x FROM t JOIN s ON t.fold = s.fold "
    "LEFT JOIN m ON m.word = t.word AND m.fold = t.fold GROUP BY t.doc_id), "
    "q AS (SELECT k.doc_id, k.fold, round(p.prior + coalesce(w.x, 0), 4) AS log_odds FROM k "
    "JOIN p ON k.fold = p.fold LEFT JOIN w ON k.doc_id = w.doc_id) ")


def _cross_fitted(spark, sf):
    return cross_fitted_scores(table(spark, sf, "documents"), table(spark, sf, "labels"), folds=FOLDS, seed=SEED)


@register("l2_train_quality_model", SCORES_L2 + "SELECT doc_id, fold, log_odds FROM q")
def l2(spark, sf):
    """Every document scored by the model that was fitted without its fold."""
    return _cross_fitted(spark, sf).select("doc_id", "fold", "log_odds")


@register("l2_quality_auc",
          SCORES_L2 + ", j AS (SELECT q.log_odds AS x, l.quality AS y FROM q JOIN labels l ON q.doc_id = l.doc_id "
          "WHERE l.quality IS NOT NULL), r AS (SELECT y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) "
          "/ 2.0 AS rx FROM j) SELECT CAST(sum(y) AS BIGINT) AS n_pos, CAST(count(*) - sum(y) AS BIGINT) AS n_neg, "
          "round((sum(CASE WHEN y = 1 THEN rx ELSE 0 END) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2) "
          "/ (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))), 6) AS auc FROM r")
def l2_auc(spark, sf):
    """Rank-sum AUC of the out-of-fold scores."""
    scored = _cross_fitted(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return M.rank_auc(scored, "log_odds", "quality")


HOST_SQL = ("coalesce(lower(nullif(regexp_extract(regexp_replace(regexp_extract(url, "
            "'^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), '^(\\[[^\\]]*\\]|[^:]*)', 1), '')), '')")
HITS_SQL = (f"SELECT *, {HOST_SQL} AS host, regexp_matches(html, '{MATH_PATTERN}') AS hit FROM pages")


@register("l3_domain_yield",
          "SELECT host, CAST(count(*) AS BIGINT) AS n_pages, CAST(sum(CAST(hit AS INTEGER)) AS BIGINT) AS "
          "n_hits, round(sum(CAST(hit AS INTEGER)) / count(*), 6) AS hit_share, "
          f"sum(CAST(hit AS INTEGER)) / count(*) > 0.1 AS selected FROM ({HITS_SQL}) GROUP BY host")
def l3(spark, sf):
    p = table(spark, sf, "pages")
    return domain_yield(p, F.col("html").rlike(MATH_PATTERN))


@register("l3_domain_additions",
          f"WITH h AS ({HITS_SQL}) SELECT page_id, host FROM h WHERE NOT hit AND host IN (SELECT host FROM h "
          "GROUP BY host HAVING sum(CAST(hit AS INTEGER)) / count(*) > 0.1)")
def l3_additions(spark, sf):
    p = table(spark, sf, "pages")
    return domain_additions(p, F.col("html").rlike(MATH_PATTERN)).select("page_id", "host")


@register("l4_math_signal",
          f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{MATH_PATTERN}', 0)) AS BIGINT) AS math_hits, "
          f"len(regexp_extract_all(text, '{MATH_PATTERN}', 0)) > 0 AS has_math FROM documents")
def l4(spark, sf):
    return math_signal(table(spark, sf, "documents")).select("doc_id", "math_hits", "has_math")

