"""Column expressions (JVM-side, codegen friendly)."""

from talkmill.functions.text import (LEXER, LEXER_JVM, STRIP_CHARS, STRIP_CLASS, WORD,  # noqa: F401
                                     WORD_JVM, count_tokens, first_line,
                                     head_tail, py_strip, tokenize, words)
from talkmill.functions.styles import (STYLE_NAMES, Style, select_styles,  # noqa: F401
                                       styles_column)
from talkmill.functions.hashing import hash_bucket, hash_order  # noqa: F401
