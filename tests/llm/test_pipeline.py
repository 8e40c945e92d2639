import random
from functools import partial

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from talkmill.llm import minhash
from talkmill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory, vocabularies):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiourstlnmd") for _ in range(rng.randint(2, 8)))
    passage = " ".join(word() for _ in range(60))
    texts = [" ".join(word() for _ in range(rng.randint(30, 120))) for _ in range(60)]
    docs = [(i, t, rng.choice(["en", "de"]), f"s{i % 3}") for i, t in enumerate(texts)]
    docs += [(100, texts[0], "en", "s0"), (101, texts[1] + " extra", "en", "s1"),
             (102, passage + " " + texts[2][::-1], "en", "s0"), (103, texts[3][::-1] + " " + passage, None, None),
             (104, None, "en", "s0"), (105, "", "en", "s0"), (106, "123 -- 456", "en", "s1"), (107, texts[4], "en", "s2"),
             (107, texts[4], "en", "s2")]
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in docs]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .coalesce(2).write.parquet(f"{folder}/documents.parquet")
    return str(folder), passage, texts


def test_stages_take_effect(spark, corpus):
    folder, passage, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == before.columns
        rows = {r["doc_id"]: r for r in docs.collect()}
        if name == "language_id":
            assert set(rows) == set(range(60)) | {100, 101, 102, 103, 107}
        if name == "near_dedup":
            assert set(rows) == set(range(60)) | {102, 103} and docs.count() == 62
    assert passage in rows[102]["text"] and passage[5:-5] not in rows[103]["text"]
    assert rows[103]["n_chars"] == len(rows[103]["text"])
    assert all(rows[i]["text"] == t for i, t in enumerate(texts))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in pieces} == set(rows)
    assert sum(r["length"] for r in pieces) == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values())


def test_near_dedup_of_a_large_group_takes_few_passes(spark, monkeypatch):
    merges, merge = [], minhash._merge
    monkeypatch.setattr(minhash, "_merge", lambda *a: merges.append(1) or merge(*a))
    monkeypatch.setattr(corpus_pipeline, "near_duplicates", partial(minhash.near_duplicates, bucket_rows=6))
    rng, base, words = random.Random(1), [f"w{i}" for i in range(200)], []
    for n in [0, 1, *range(2, 62)]:  # the first two are alike, the others far from each other and from those
        words.append(base[:])
        for k in range(n if n < 2 else 7):
            words[-1][rng.randrange(200)] = f"edit{n}x{k}"
    docs = [(i, " ".join(w), "en", "s0", 9) for i, w in enumerate(words)]
    out = corpus_pipeline.drop_near_duplicates(
        spark, spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), "")
    left = {r["doc_id"] for r in out.collect()}
    sets = [{tuple(w[i:i + 5]) for i in range(196)} for w in words]
    near = [{j for j in range(62) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])} for i in range(62)]
    least = list(range(62))
    for _ in range(62):
        least = [min(least[j] for j in near[i]) for i in range(62)]
    assert left == {i for i in range(62) if least[i] == i} and 5 < len(left) < 62
    assert len(merges) <= 3


def test_texts_of_kept_documents_are_not_shuffled(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the ids to drop were many
    try:
        plan = corpus_pipeline.not_among(docs, corpus_pipeline.written(docs.select("doc_id").limit(1), "test-gone"),
                                         "doc_id")._jdf.queryExecution().executedPlan().toString()
        out = corpus_pipeline.drop_near_duplicates(spark, docs, corpus[0])._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    stay, join = plan[plan.index("Union"):].split("SortMergeJoin")
    assert "hashpartitioning(doc_id" not in stay and "LeftAnti" in join
    assert "getbit" in out.split("LeftAnti")[0]


def test_language_fills_missing_labels_and_needs_none(spark, corpus):
    parts = {"en": "the of and ing tion er", "de": "der die sch ung keit ich"}
    rng = random.Random(7)
    text = lambda lang: " ".join(rng.choice(parts[lang].split()) + rng.choice(parts[lang].split())
                                 for _ in range(40))
    rows = [(i, text(lang), lang if i < 80 else None, lang) for i in range(100) for lang in [("en", "de")[i % 2]]]
    docs = spark.createDataFrame(rows + [(100, "12 -- 3", None, None), (101, None, None, None)],
                                 "doc_id long, text string, lang string, want string")
    got = corpus_pipeline.identify_language(spark, docs, corpus[0])
    assert got.columns == docs.columns
    assert {(r["doc_id"], r["lang"]) for r in got.collect()} == {(i, want) for i, _, _, want in rows}
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.identify_language(spark, bare, corpus[0]).collect()
    assert sorted(r["doc_id"] for r in left) == list(range(100)) and {r["lang"] for r in left} == {None}


def test_run_gives_the_last_stage(spark, corpus):
    assert corpus_pipeline.run(spark, corpus[0]).where("doc_id = 102").count() >= 1


def test_stages_on_an_empty_table(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus[0]).count() == 0


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(__spark_entry__.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ("op6_warc", "op7_ann", "op9_topk", "op11_phrases", "op12_whitening")))
def test_queries_return_the_promised_columns(spark, corpus, name):
    promised = {
        "op2": ["doc_id", "n_shingles", "component_id", "kept"],
        "op3": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op4": ["doc_id", "held_out", "lang_pred", "score"],
        "op5": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op8": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        "op13": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op10": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    }
    out = QUERIES[name](spark, corpus[0])
    assert set(promised.get(name.split("_")[0], ["doc_id"])) <= set(out.columns)
    assert out.select("doc_id").distinct().count() == 68
