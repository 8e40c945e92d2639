"""Command-line job: corpus folder -> conversation records (JSON lines).

    python -m talkmill.plans.job --dataset-dir DIR --output OUT [--dry-run]
        [--prompt-style NAME ...] [--max-samples N] [--chunk-size 500]
        [--chunk-overlap 50] [--min-conversation-tokens 50] [--overwrite]
        [--client module:factory] [--model NAME] [--temperature 1.0]
        [--top-p 0.9] [--max-output-tokens 2048] [--max-attempts 3]
        [--in-flight 10] [--timeout 120] [--partitions N]

Everything is validated before any output is touched. The run counters
are printed as one JSON line. With ``--client``, ``factory()`` must return
``f(request_dict) -> reply``; replies go to ``OUT_replies`` first so a
rerun only calls the model for requests without an answer. Existing output
is refused before any work starts.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from talkmill.functions.styles import select_styles
from talkmill.operators.chunking import ChunkConfig
from talkmill.operators.fanout import RequestConfig


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="talkmill-job", description=__doc__.splitlines()[0])
    ap.add_argument("--dataset-dir", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--overwrite", action="store_true")
    ap.add_argument("--prompt-style", action="append", dest="styles")
    ap.add_argument("--max-samples", type=int)
    ap.add_argument("--chunk-size", type=int, default=500)
    ap.add_argument("--chunk-overlap", type=int, default=50)
    ap.add_argument("--min-conversation-tokens", type=int, default=50)
    ap.add_argument("--text-column", default="text")
    ap.add_argument("--dry-run", action="store_true")
    ap.add_argument("--client", help="module:factory returning f(request_dict) -> reply")
    ap.add_argument("--model", default=RequestConfig.model)
    ap.add_argument("--temperature", type=float, default=1.0)
    ap.add_argument("--top-p", type=float, default=0.9)
    ap.add_argument("--max-output-tokens", type=int, default=2048)
    ap.add_argument("--max-attempts", type=int, default=3)
    ap.add_argument("--in-flight", type=int, default=10)
    ap.add_argument("--timeout", type=float, default=120.0, help="seconds a model call may take")
    ap.add_argument("--partitions", type=int)
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    return ap.parse_args(argv)


def load_factory(spec: str):
    mod, _, name = spec.partition(":")
    if not mod or not name:
        raise ValueError("--client must look like module:factory")
    return getattr(importlib.import_module(mod), name)


def run(argv: list[str]) -> dict:
    a = parse(argv)
    # validate everything before touching output
    chunk = ChunkConfig(a.chunk_size, a.chunk_overlap)
    select_styles(a.styles)
    request = RequestConfig(model=a.model, temperature=a.temperature, top_p=a.top_p,
                            max_output_tokens=a.max_output_tokens)
    if not a.dry_run and not a.client:
        raise ValueError("either --dry-run or --client must be given")
    factory = load_factory(a.client) if a.client else None
    if a.max_samples is not None and a.max_samples < 0:
        raise ValueError("--max-samples must be non-negative")

    from pyspark.sql import SparkSession

    from talkmill.plans.generation import GenerationConfig, dry_run_table, model_run
    from talkmill.session import get_session, release_tables
    from talkmill.sources.sinks import path_exists, write_records_with_stats
    spark = get_session(a.master) if a.master else SparkSession.builder.getOrCreate()
    if not a.overwrite and path_exists(spark, a.output):
        raise FileExistsError(f"there is output in {a.output} already; --overwrite replaces it")
    cfg = GenerationConfig(chunk=chunk, request=request,
                           min_conversation_tokens=a.min_conversation_tokens,
                           style_names=tuple(a.styles) if a.styles else None,
                           max_samples=a.max_samples, text_col=a.text_column)
    if a.dry_run:
        classified = dry_run_table(spark, a.dataset_dir, cfg)
    else:
        classified = model_run(spark, a.dataset_dir, a.output.rstrip("/") + "_replies", factory,
                               cfg, partitions=a.partitions, max_attempts=a.max_attempts,
                               in_flight=a.in_flight, timeout_seconds=a.timeout)
    stats = write_records_with_stats(classified, a.output, overwrite=a.overwrite)
    release_tables(spark)
    return stats


def main() -> None:
    print(json.dumps(run(sys.argv[1:])))


if __name__ == "__main__":
    main()
