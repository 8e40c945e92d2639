"""Dialogue structure: turns <-> tagged text (keys I1, I2, I3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmill.functions.text import count_tokens

# ---------------------------------------------------------------------------
# A speaker tag at the start of a line. Either bold, "**Any
# name:**" or "**Any name**:", or plain: capitalised words (initials, scripts
# without case, numbers and small linking words included), or one lower-case
# word; then a plain or full-width colon and at most one space. Groups 1 and 2
# are the bold and the plain name.
_WORD = r"[\p{Lu}\p{Lt}\p{Lo}][\p{L}\p{M}\p{N}_.’-]*"
_NEXT = r"(?: (?:" + _WORD + r"|\p{N}+|of|the|and|de|la|van|von))*"
TAG = (r"(?:\*\*([^*:：]+)(?:\*\*)?[:：](?:\*\*)?"
       r"|(" + _WORD + _NEXT + r"|\p{Ll}[\p{L}\p{M}\p{N}_-]*)[:：])[ ]?")
# Labels that often stand before a colon without naming a speaker; they count
# only where a dialogue gives no evidence of its own.
OFTEN_NO_SPEAKERS = ("answer", "conclusion", "context", "definition", "example", "examples", "hint", "input", "note",
                     "notes", "output", "question", "result", "solution", "step", "summary", "tip", "warning")
# The start of an address, which is no tag.
ADDRESS = r"[A-Za-z][A-Za-z0-9+.-]*://"
# A turn header line: "**Turn 3**", "Turn 3:", optionally bold, nothing else.
HEADER = r"(?:\*\*)?Turn [0-9]+(?:\*\*)?:?(?:\*\*)?[ ]*"
# ---------------------------------------------------------------------------


def speaker_label(role) -> F.Column:
    """``user`` -> ``User``: first letter upper, rest lower."""
    r = F.col(role) if isinstance(role, str) else role
    return F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))


def assemble_dialogue(turns: DataFrame, key: str = "conv_id", turn: str = "turn",
                      role: str = "role", text: str = "text") -> DataFrame:
    """Turn rows -> one ``Speaker: text`` dialogue per key, in turn
    order. A group is one dialogue's turns (the dialogue is one output
    value by definition)."""
    parts = F.array_sort(F.collect_list(F.struct(
        F.col(turn).alias("t"), speaker_label(role).alias("s"), F.col(text).alias("x"))))
    g = turns.groupBy(key).agg(parts.alias("_p"), F.count(F.lit(1)).cast("bigint").alias("n_turns"))
    line = F.transform("_p", lambda p: F.concat(p["s"], F.lit(": "), p["x"]))
    return g.select(key, F.array_join(line, "\n").alias("dialogue"), "n_turns")


def split_turns(dialogues: DataFrame, key: str = "conv_id", text: str = "dialogue") -> DataFrame:
    """Tagged dialogue text -> ``(key, turn_no, header_no, speaker, text)``.

    A turn starts at every line that begins with a speaker's tag and runs to
    the next one; lines before the first tag form turn 0 (no speaker, kept
    only when not empty). Header lines (``**Turn k**``) are not part of any
    turn's text; ``header_no`` counts the headers above a turn's tag line.

    Whether a label before a colon names a speaker is decided by the dialogue
    itself (labels are compared without case). Where some label recurs, the
    speakers are the labels that recur and those that answer (the tags before
    and after are one label); a label that opens the dialogue or is bold is
    one too unless it is in OFTEN_NO_SPEAKERS. Where none recurs there is no
    such evidence, and all labels but those are speakers, or all if there are
    two or more and no others. So a dialogue of ``Question:`` and ``Answer:``
    has two speakers, and one ``Note:`` inside starts no turn.

    Control characters (taken out of the text first) mark headers and
    possible tags; the text is split at the tags, tags that name no speaker
    lose their mark, and it is split again. Every step is linear in the text
    and inside the row: no shuffle and no window."""
    start, header, number = "\u0001", "\u0002", "\u0003"
    tag = "^" + TAG

    def name_of(line: F.Column) -> F.Column:
        return F.concat(F.regexp_extract(line, tag, 1), F.regexp_extract(line, tag, 2))

    lines = F.split(F.translate(text, start + header + number, ""), "\n")
    marked = F.concat(F.array_join(F.transform(lines, lambda line: F.when(
        line.rlike("^" + HEADER + "$"), F.lit(header)).when(
        line.rlike(tag) & ~line.rlike("^" + ADDRESS), F.concat(F.lit(start), line)).otherwise(line)), "\n"), F.lit("\n"))
    # every tag with the number of headers above it; the header lines go
    numbered = F.array_join(F.transform(F.split(marked, header + "\n"), lambda part, i: F.replace(
        part, F.lit(start), F.concat(F.lit(start), i.cast("string"), F.lit(number)))), "")
    # a line break before every line, none after the last
    whole = F.concat(F.lit("\n"), F.regexp_replace(numbered, "\n\\z", ""))
    d = dialogues.select(key, F.split(whole, "\n" + start).alias("_parts"))
    body = lambda part: F.substring_index(part, number, -1)
    d = d.withColumn("_labels", F.transform("_parts", lambda p, i: F.when(i > 0, F.lower(name_of(body(p))))))
    d = d.withColumn("_sorted", F.array_sort(F.filter("_labels", lambda x: x.isNotNull())))
    again = F.filter("_sorted", lambda x, i: (i > 0) & (F.get("_sorted", i - 1) == x))
    d = d.withColumn("_again", F.array_distinct(again)).withColumn("_opens", ~F.col("_parts")[0].rlike("[^ \\t\\n]"))

    d = d.withColumn("_others", F.exists("_sorted", lambda x: ~x.isin(*OFTEN_NO_SPEAKERS)))

    def speaks(part: F.Column, i: F.Column) -> F.Column:
        label, before, after = (F.get("_labels", i + k) for k in (0, -1, 1))
        plain = ~label.isin(*OFTEN_NO_SPEAKERS)
        bold = F.regexp_extract(body(part), tag, 1) != ""
        evident = F.array_contains("_again", label) | F.coalesce(before == after, F.lit(False)) | \
            (plain & (bold | (F.col("_opens") & (i == 1))))
        return F.when(F.size("_again") > 0, evident).otherwise(plain | (~F.col("_others") & (F.size("_labels") > 2)))

    kept = F.transform("_parts", lambda p, i: F.when(i == 0, p).when(
        speaks(p, i), F.concat(F.lit(start), p)).otherwise(body(p)))
    d = d.select(key, F.posexplode(F.split(F.array_join(kept, "\n"), "\n" + start)).alias("turn_no", "_p"))
    tagged = F.col("turn_no") > 0
    d = d.select(key, F.col("turn_no").cast("int").alias("turn_no"), F.when(tagged, F.substring_index("_p", number, 1))
                 .otherwise("0").cast("int").alias("header_no"), body(F.col("_p")).alias("_text"))
    out = d.select(key, "turn_no", "header_no", F.when(tagged, name_of(F.col("_text"))).alias("speaker"),
                   F.when(tagged, F.regexp_replace("_text", tag, "")).otherwise(F.substring("_text", 2, 1 << 30)).alias("text"))
    return out.where(tagged | (F.col("text") != ""))


def turn_stats(turns: DataFrame, key: str = "conv_id", speaker: str = "role",
               text: str = "text") -> DataFrame:
    """Per dialogue and speaker: turns and tokens; per dialogue: all
    turns and distinct speakers (window over the few speakers of one
    dialogue, after aggregation)."""
    per = turns.groupBy(key, speaker).agg(
        F.count(F.lit(1)).cast("bigint").alias("speaker_turns"),
        F.sum(count_tokens(text)).cast("bigint").alias("speaker_tokens"))
    w = Window.partitionBy(key)
    return per.select(key, speaker, "speaker_turns", "speaker_tokens",
                      F.sum("speaker_turns").over(w).cast("bigint").alias("n_turns"),
                      F.count(F.lit(1)).over(w).cast("bigint").alias("n_speakers"))
