from talkmill.operators.dialogue import assemble_dialogue, split_turns, turn_stats


def test_round_trip(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "What is 2+2?\nAnd why?"),
            (1, 2, "assistant", "It is 4.\nBecause addition."), (2, 0, "user", "hi")]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    d = assemble_dialogue(turns)
    text = {r.conv_id: r.dialogue for r in d.collect()}
    assert text[1] == "System: Be brief.\nUser: What is 2+2?\nAnd why?\nAssistant: It is 4.\nBecause addition."
    back = sorted((r.conv_id, r.turn_no, r.speaker, r.text) for r in split_turns(d).collect())
    assert back == [(1, 1, "System", "Be brief."), (1, 2, "User", "What is 2+2?\nAnd why?"),
                    (1, 3, "Assistant", "It is 4.\nBecause addition."), (2, 1, "User", "hi")]


def test_bold_tags_and_preamble(spark):
    text = "Here is the talk:\n**Professor A:** First point.\n**Professor B**: Reply\nmore"
    df = spark.createDataFrame([(7, text)], "conv_id BIGINT, dialogue STRING")
    got = sorted((r.turn_no, r.speaker, r.text) for r in split_turns(df).collect())
    assert got == [(0, None, "Here is the talk:"), (1, "Professor A", "First point."),
                   (2, "Professor B", "Reply\nmore")]


def test_turn_stats(spark):
    rows = [(1, 0, "user", "a b"), (1, 1, "assistant", "c"), (1, 2, "user", "d")]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    got = {r.role: (r.speaker_turns, r.n_turns, r.n_speakers) for r in turn_stats(turns).collect()}
    assert got == {"user": (2, 3, 2), "assistant": (1, 3, 2)}


def test_turn_headers(spark):
    text = ("Intro line\n**Turn 1**\nTeacher: Start.\nStudent: Ok\nmore\n"
            "**Turn 2**\nTeacher: Next.\nTurn 3:\nStudent: End.")
    df = spark.createDataFrame([(3, text)], "conv_id BIGINT, dialogue STRING")
    got = sorted((r.turn_no, r.header_no, r.speaker, r.text) for r in split_turns(df).collect())
    assert got == [(0, 0, None, "Intro line"), (1, 1, "Teacher", "Start."),
                   (2, 1, "Student", "Ok\nmore"), (3, 2, "Teacher", "Next."),
                   (4, 3, "Student", "End.")]


def test_split_sql_and_spark_agree_with_headers(spark):
    import duckdb

    from talkmill.plans.queries_tables import _split_sql
    dialogues = [(1, "Intro\n**Turn 1**\nA: x\nmore\n**Turn 2**\nB: y"),
                 (2, "**Turn 1**\n**Bob:** hi\nTurn 2:\nAmy: yo\n\nlast"),
                 (3, "no tags at all\nsecond line"), (4, "Zed: only")]
    sql = _split_sql("SELECT * FROM fixture")
    con = duckdb.connect()
    con.execute("CREATE TABLE fixture (conv_id BIGINT, dialogue VARCHAR)")
    con.executemany("INSERT INTO fixture VALUES (?, ?)", dialogues)
    want = sorted(con.execute(sql).fetchall(), key=str)
    df = spark.createDataFrame(dialogues, "conv_id BIGINT, dialogue STRING")
    got = sorted([(r.conv_id, r.turn_no, r.header_no, r.speaker, r.text)
                  for r in split_turns(df).collect()], key=str)
    assert got == [tuple(w) for w in want]


def _turns(spark, text):
    df = spark.createDataFrame([(1, text)], "conv_id BIGINT, dialogue STRING")
    return sorted((r.turn_no, r.speaker, r.text) for r in split_turns(df).collect())


def test_speakers_of_many_shapes(spark):
    text = ("老师：今天我们学什么？\n学生:算术。\n**王老师：**很好\nDr. Smith: Good.\n**Dr. Jane Q. Smith**: Yes\n"
            "jgens: hello\nThe Head of the Department of Mathematics: Welcome\nSpeaker 12: ok\nd'Arc is no tag\n"
            "Note: not a speaker\nhttps://example.com\nthis is prose: still prose\nÉlodie: oui")
    assert _turns(spark, text) == [
        (1, "老师", "今天我们学什么？"), (2, "学生", "算术。"), (3, "王老师", "很好"), (4, "Dr. Smith", "Good."),
        (5, "Dr. Jane Q. Smith", "Yes"), (6, "jgens", "hello"),
        (7, "The Head of the Department of Mathematics", "Welcome"),
        (8, "Speaker 12", "ok\nd'Arc is no tag\nNote: not a speaker\nhttps://example.com\nthis is prose: still prose"),
        (9, "Élodie", "oui")]


def test_empty_and_null_dialogues(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "A:"), (4, "**Turn 1**")], "conv_id BIGINT, dialogue STRING")
    got = sorted((r.conv_id, r.turn_no, r.speaker, r.text) for r in split_turns(df).collect())
    assert got == [(3, 1, "A", "")]


def test_speakers_by_the_evidence_of_the_dialogue(spark):
    qa = "Question: a?\nAnswer: b\nQuestion: c?\nAnswer: d\nNote: e"
    assert _turns(spark, qa) == [(1, "Question", "a?"), (2, "Answer", "b"), (3, "Question", "c?"),
                                 (4, "Answer", "d\nNote: e")]
    assert _turns(spark, "Question: a?\nAnswer: b") == [(1, "Question", "a?"), (2, "Answer", "b")]
    assert _turns(spark, "Note: a") == [(0, None, "Note: a")]
    # a label that answers, a bold one, an opening one, addresses, a stray label
    text = ("System: go\nUser: a\nhttps://x.y\nUser: b\nhttps://x.z\nSummary: s\nAmy: c\nRemark: r\n"
            "**Guest:** d\nUser: e")
    assert _turns(spark, text) == [
        (1, "System", "go"), (2, "User", "a\nhttps://x.y"), (3, "User", "b\nhttps://x.z\nSummary: s\nAmy: c\nRemark: r"),
        (4, "Guest", "d"), (5, "User", "e")]
    assert _turns(spark, "User: a\nBot: b\nuser: c") == [(1, "User", "a"), (2, "Bot", "b"), (3, "user", "c")]


def test_sql_and_spark_agree_on_speakers(spark):
    import random

    import duckdb

    from talkmill.plans.queries_tables import _split_sql
    rng = random.Random(2)
    pieces = ["A: x", "B: y", "a: z", "Note: n", "Answer: q", "**C:** w", "**Turn 2**", "plain", "", "http://u.v", "D: v"]
    dialogues = [(i, "\n".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))) for i in range(150)]
    con = duckdb.connect()
    con.execute("CREATE TABLE fixture (conv_id BIGINT, dialogue VARCHAR)")
    con.executemany("INSERT INTO fixture VALUES (?, ?)", dialogues)
    want = sorted(con.execute(_split_sql("SELECT * FROM fixture")).fetchall(), key=str)
    df = spark.createDataFrame(dialogues, "conv_id BIGINT, dialogue STRING")
    got = sorted([(r.conv_id, r.turn_no, r.header_no, r.speaker, r.text) for r in split_turns(df).collect()], key=str)
    assert got == [tuple(w) for w in want]


def test_long_dialogues_take_time_in_proportion(spark):
    import time

    def seconds(n):
        text = "\n".join(f"{'A' if i % 2 else 'B'}: line {i}" for i in range(n))
        df = spark.createDataFrame([(1, text)], "conv_id BIGINT, dialogue STRING")
        begun = time.monotonic()
        assert split_turns(df).count() == n
        return time.monotonic() - begun
    seconds(10)
    small, large = min(seconds(4000) for _ in range(2)), seconds(32000)
    assert large < 16 * small + 5
