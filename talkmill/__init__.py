"""talkmill — build synthetic dialogue corpora from raw text with Spark.

Every public function takes and returns DataFrames (or Columns); none
holds a global session. The pieces:

* ``talkmill.functions`` — column expressions: lexer tokens, Python-style
  strip, hash order, the style table.
* ``talkmill.sources``   — corpus scan, dense sample index, inspection
  tables, JSONL / request sinks.
* ``talkmill.operators`` — chunk windows, style fan-out, generation,
  filters and records, vocabulary, selection, token budgets, metrics,
  dialogue turns, corpus curation.
* ``talkmill.plans``     — the end-to-end generation plan and the tables
  the post-generation operators run on.
* ``talkmill.streaming`` — the incremental (file-stream) form of the plan.
"""

from talkmill.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
