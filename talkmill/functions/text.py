"""Text column expressions that stay inside the JVM (whole-stage codegen).

Tokens are lexer pieces: ``array_join(tokens, '')`` rebuilds the text
exactly, so a window of tokens decodes by concatenation and no vocabulary
is needed to chunk or count. ``talkmill.operators.vocab`` gives the pieces
of a corpus integer ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (shared with the SQL oracle; do not edit one side only).
# LEXER: optional single space + letters/marks, optional space + up to three
# digits, optional space + run of other symbols, or a run of whitespace.
# Only explicit classes are used so Java regex and RE2 agree.
LEXER = (
    r"[ ]?[\p{L}\p{M}]+"
    r"|[ ]?\p{N}{1,3}"
    r"|[ ]?[^\t\n\x0B\f\r \p{L}\p{M}\p{N}]+"
    r"|[\t\n\x0B\f\r ]+"
)
# The characters Python's str.strip() removes by default.
STRIP_CLASS = (
    r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
STRIP_PATTERN = "^" + STRIP_CLASS + "+|" + STRIP_CLASS + "+$"
# The same characters as a plain set (for btrim, which scans only the ends).
STRIP_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
               "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")
# Words for overlap metrics (BLEU / ROUGE): runs of letters or digits.
WORD = r"[\p{L}\p{N}]+"
# ---------------------------------------------------------------------------

# The same two patterns with possessive repeats for the JVM (about 20%
# faster). Each repeat ends its alternative, so giving up backtracking
# cannot change a match; the SQL oracle (RE2, no possessive syntax) runs
# the plain forms above, which doubles as a check.
LEXER_JVM = LEXER.replace("]+", "]++").replace("{1,3}", "{1,3}+")
WORD_JVM = WORD.replace("]+", "]++")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokenize(col) -> Column:
    """Text -> ARRAY<STRING> of lexer pieces (null text -> null)."""
    return F.regexp_extract_all(_c(col), F.lit(LEXER_JVM), F.lit(0))


def count_tokens(col) -> Column:
    """Number of lexer tokens of a text column (null -> 0)."""
    return F.coalesce(F.size(tokenize(col)), F.lit(0))


def py_strip(col) -> Column:
    """Unicode whitespace strip identical to Python's ``str.strip()``.
    ``btrim`` with an explicit set touches only the leading and trailing
    characters (a regex would scan the whole text)."""
    return F.btrim(_c(col), F.lit(STRIP_CHARS))


def words(col) -> Column:
    """Lower-cased word list used by the overlap metrics."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(WORD_JVM), F.lit(0))


def first_line(col) -> Column:
    """Text up to (not including) the first newline (stops at the first
    newline instead of splitting the whole text)."""
    return F.substring_index(_c(col), "\n", 1)


def head_tail(col, head: int = 500, tail: int = 500) -> Column:
    """Long text cut to ``head`` leading and ``tail`` trailing characters."""
    c = _c(col)
    limit = head + tail
    return F.when(F.length(c) > limit,
                  F.concat(F.substring(c, 1, head), F.lit(" [+"),
                           (F.length(c) - limit).cast("string"), F.lit("] "),
                           F.substring(c, -tail, tail))
                  ).otherwise(c)
