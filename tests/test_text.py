from pyspark.sql import functions as F

from talkmill.functions.text import STRIP_CHARS, count_tokens, py_strip, tokenize


def test_strip_chars_equal_python_whitespace():
    assert sorted(STRIP_CHARS) == sorted(c for c in map(chr, range(0x110000)) if c.isspace())


def test_py_strip_matches_python(texts):
    values = ["　 x  ", "  \n", "", "abc", " a b  ", "\x1c\x1dq\x85", "é　", " x "]
    rows = texts(values).select("text", py_strip("text").alias("s")).collect()
    for r in rows:
        assert r.s == r.text.strip()


def test_tokens_rebuild_text_non_ascii(texts):
    values = ["Café naïve über", "中文测试 \U0001f600 emoji",
              "a　b c", "tab\tand\nnew\x0bline\x0c", "12345 678 9.5%", "<|endoftext|> stays"]
    rows = texts(values).select("text", F.array_join(tokenize("text"), "").alias("r"),
                                count_tokens("text").alias("n")).collect()
    for r in rows:
        assert r.r == r.text
        assert r.n > 0


def test_special_token_text_is_plain(texts):
    r = texts(["x <|endoftext|> y"]).select(tokenize("text").alias("t")).first()
    assert "".join(r.t) == "x <|endoftext|> y"
    assert " <|" in r.t


def test_count_tokens_null_is_zero(spark):
    df = spark.createDataFrame([(None,)], "text STRING")
    assert df.select(count_tokens("text").alias("n")).first().n == 0


def test_possessive_patterns_equal_plain(spark):
    from talkmill.functions.text import LEXER, LEXER_JVM, WORD, WORD_JVM
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    extra = spark.createDataFrame([(" 1234 ab  ,, x\x0b y 9",), ("　a b c",)], "text STRING")
    d = docs.unionByName(extra)
    same = d.select(F.min(
        ((F.regexp_extract_all("text", F.lit(LEXER), F.lit(0))
          == F.regexp_extract_all("text", F.lit(LEXER_JVM), F.lit(0)))
         & (F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
            == F.regexp_extract_all("text", F.lit(WORD_JVM), F.lit(0)))).cast("int")).alias("ok"))
    assert same.first().ok == 1
