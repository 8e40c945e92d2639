"""Reusable SQL fragments for the DuckDB oracle.

The oracle re-derives every registered query from the raw views with
plain SQL (windows over the whole table where Spark uses bucketed
prefix sums, etc.). It shares only *fixed values* with the Spark code:
the lexer and strip patterns, the style table and the dry-run layout.
"""

from __future__ import annotations

from talkmill.functions.styles import (CLOSING_RULE, CONTEXT_CLOSE, CONTEXT_OPEN,
                                       DRY_RUN_INSTRUCTION_CHARS, DRY_RUN_SNIPPET_CHARS,
                                       DRY_RUN_SNIPPET_SEP, DRY_RUN_TAG, INSTRUCTIONS,
                                       STYLE_NAMES, SYSTEM_PROMPT)
from talkmill.functions.text import LEXER, STRIP_PATTERN, WORD


def lit(s: str) -> str:
    """SQL string literal; newlines spelled with chr(10)."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(quoted) if len(parts) > 1 else quoted[0]


def tok(x: str) -> str:
    return f"regexp_extract_all({x}, '{LEXER}', 0)"


def ntok(x: str) -> str:
    return f"coalesce(len({tok(x)}), 0)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP_PATTERN}', '', 'g')"


def words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD}', 0)"


def styles_values() -> str:
    rows = ", ".join(f"({i}, {lit(n)}, {lit(INSTRUCTIONS[n])})" for i, n in enumerate(STYLE_NAMES))
    return f"SELECT * FROM (VALUES {rows}) v(prompt_ord, prompt_style, instruction)"


def dry_reply(instruction: str = "instruction", context: str = "context") -> str:
    return (f"{lit(DRY_RUN_TAG)} || substr({instruction}, 1, {DRY_RUN_INSTRUCTION_CHARS}) || "
            f"{lit(DRY_RUN_SNIPPET_SEP)} || substr(split_part({strip(context)}, chr(10), 1), 1, "
            f"{DRY_RUN_SNIPPET_CHARS})")


def user_msg(instruction: str = "instruction", context: str = "context") -> str:
    return (f"{instruction} || chr(10) || chr(10) || {lit(CONTEXT_OPEN)} || {strip(context)} || "
            f"{lit(CONTEXT_CLOSE + CLOSING_RULE)}")


SIZE, STRIDE = 500, 450

CTES: dict[str, str] = {
    "samples": ("SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS sample_index, "
                "doc_id, lang, source, text FROM documents "
                "WHERE text IS NOT NULL AND text <> ''"),
    "chunks": (f"SELECT sample_index, doc_id, lang, source, CAST(st // {STRIDE} AS INTEGER) AS chunk_index, "
               f"array_to_string(tk[st + 1 : st + {SIZE}], '') AS context, "
               f"CAST(least({SIZE}, len(tk) - st) AS INTEGER) AS context_tokens "
               f"FROM (SELECT *, unnest(range(0, len(tk), {STRIDE})) AS st "
               f"FROM (SELECT *, {tok('text')} AS tk FROM samples))"),
    "styles": styles_values(),
    "fanout": ("SELECT c.*, s.prompt_ord, s.prompt_style, s.instruction "
               "FROM chunks c CROSS JOIN styles s"),
    "dry": f"SELECT *, {dry_reply()} AS conversation FROM fanout",
    "classified": (f"SELECT *, CASE WHEN conversation IS NULL OR {strip('conversation')} = '' THEN 'empty' "
                   f"WHEN conversation_tokens >= 50 THEN 'kept' ELSE 'filtered' END AS status "
                   f"FROM (SELECT *, CAST({ntok('conversation')} AS INTEGER) AS conversation_tokens FROM dry)"),
    "kept": "SELECT * FROM classified WHERE status = 'kept'",
}
ORDER = list(CTES)
DEPS = {"samples": [], "chunks": ["samples"], "styles": [], "fanout": ["chunks", "styles"],
        "dry": ["fanout"], "classified": ["dry"], "kept": ["classified"]}


def with_(*names: str, extra: dict[str, str] | None = None,
          override: dict[str, str] | None = None, first: dict[str, str] | None = None) -> str:
    """WITH clause holding the named CTEs and their dependencies.
    ``override`` replaces a CTE body, ``first`` adds CTEs before them and
    ``extra`` after them."""
    need: set[str] = set()

    def add(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for d in DEPS.get(n, []):
            add(d)
    for n in names:
        add(n)
    body = {**CTES, **(override or {})}
    parts = [f"{k} AS ({v})" for k, v in (first or {}).items()]
    parts += [f"{n} AS ({body[n]})" for n in ORDER if n in need]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


SYSTEM = lit(SYSTEM_PROMPT)
