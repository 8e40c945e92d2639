"""Replies: dry-run generator, model-client hook, attempt ledgers
(keys E1, E2, E4, E5)."""

from __future__ import annotations

import json
import random
import time
from collections import deque
from itertools import count
from queue import Empty, Queue, SimpleQueue
from threading import Thread
from typing import Any, Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.functions.styles import (DRY_RUN_INSTRUCTION_CHARS, DRY_RUN_SNIPPET_CHARS,
                                       DRY_RUN_SNIPPET_SEP, DRY_RUN_TAG)
from talkmill.functions.text import first_line, py_strip

REPLY_SCHEMA = "request_id STRING, reply STRING, status STRING, attempts INT, error STRING"


def dry_run_snippet(context="context"):
    """First line of the stripped context, cut to 200 characters."""
    return F.substring(first_line(py_strip(F.col(context))), 1, DRY_RUN_SNIPPET_CHARS)


def dry_run_prefix(instruction: str) -> str:
    """Reply text before the snippet, for one instruction."""
    return DRY_RUN_TAG + instruction[:DRY_RUN_INSTRUCTION_CHARS] + DRY_RUN_SNIPPET_SEP


def dry_run_reply(instruction="instruction", context="context"):
    """Placeholder reply built from the instruction head and the first
    line of the stripped context (JVM expression, no model call)."""
    return F.concat(F.lit(DRY_RUN_TAG),
                    F.substring(F.col(instruction), 1, DRY_RUN_INSTRUCTION_CHARS),
                    F.lit(DRY_RUN_SNIPPET_SEP), dry_run_snippet(context))


def dry_run_fanout(chunks: DataFrame, styles, context: str = "context") -> DataFrame:
    """E1 fused with the D1 fan-out: the snippet and its token count are
    computed once per chunk, before the x-styles fan-out; each style adds
    its literal prefix and the prefix's token count (folded at planning).

    The counts add up exactly: every prefix ends with ':' followed by one
    space, and the lexer never joins a symbol run with the space after it,
    so tokens(prefix + snippet) = tokens(prefix minus the space) +
    tokens(' ' + snippet)."""
    from talkmill.functions.text import count_tokens
    per_chunk = chunks.withColumn("_snip", dry_run_snippet(context)).withColumn(
        "_snip_tok", count_tokens(F.concat(F.lit(" "), F.col("_snip"))))
    entries = []
    for i, s in enumerate(styles):
        head = dry_run_prefix(s.instruction)
        assert head.endswith(": "), "dry-run prefix must end with ': '"
        entries.append(F.struct(
            F.lit(i).alias("prompt_ord"), F.lit(s.name).alias("prompt_style"),
            F.lit(s.instruction).alias("instruction"), F.lit(head).alias("_head"),
            count_tokens(F.lit(head[:-1])).alias("_head_tok")))
    fan = per_chunk.select("*", F.inline(F.array(*entries)))
    return (fan.withColumn("conversation", F.concat(F.col("_head"), F.col("_snip")))
            .withColumn("_reply_tok", F.col("_head_tok") + F.col("_snip_tok"))
            .drop("_head", "_snip", "_head_tok", "_snip_tok"))


class CallPool:
    """Calls of one task: at most ``in_flight`` are open at any time, and the
    next request is asked as soon as one ends, so a slow call holds up no
    other. A call that outlasts ``timeout`` seconds is a failed attempt; it
    keeps its place until it really ends. Should calls that outlast the
    timeout hold all places for as long again, what is left fails unasked."""

    def __init__(self, client: Callable[[dict], str], in_flight: int, max_attempts: int,
                 wait: Callable[[int], None], timeout: float | None) -> None:
        self.client, self.in_flight, self.max_attempts = client, in_flight, max_attempts
        self.wait, self.timeout = wait, timeout
        self.jobs: SimpleQueue = SimpleQueue()
        self.ended: Queue = Queue()
        self.started: dict[int, float] = {}

    def _work(self) -> None:
        while (job := self.jobs.get()) is not None:
            call, attempt, request = job
            reply, error = None, None
            try:
                if attempt > 1:
                    self.wait(attempt - 1)
                self.started[call] = time.monotonic()
                reply = str(self.client(request) or "").strip()
            except Exception as exc:  # noqa: BLE001 - becomes the ledger's error, E5
                error = f"{type(exc).__name__}: {exc}"
            self.ended.put((call, reply, error))

    def run(self, requests: Iterator[tuple[Any, dict]]) -> Iterator[tuple[Any, tuple]]:
        """(key, (reply, status, attempts, error)) of every (key, request), in
        the order in which they settle. An answer settles a request; a blank
        one and a failure are asked again up to ``max_attempts`` times, and
        the last of them gives the status (``empty`` or ``failed``)."""
        for _ in range(self.in_flight):
            Thread(target=self._work, daemon=True).start()
        requests, again, calls = iter(requests), deque(), count()
        open_: dict[int, tuple] = {}
        overdue: set[int] = set()
        more, stuck_since = True, None
        try:
            while True:
                while len(open_) + len(overdue) < self.in_flight:
                    if again:
                        key, request, attempt = again.popleft()
                    elif more:
                        item = next(requests, None)
                        if item is None:
                            more = False
                            continue
                        (key, request), attempt = item, 1
                    else:
                        break
                    call = next(calls)
                    open_[call] = (key, request, attempt)
                    self.jobs.put((call, attempt, request))
                if not open_ and not again and not more:
                    return
                for call, reply, error in self._next(open_):
                    if call in overdue:
                        overdue.discard(call)
                        continue
                    key, request, attempt = open_.pop(call)
                    if reply:
                        yield key, (reply, "ok", attempt, None)
                    elif attempt < self.max_attempts:
                        again.append((key, request, attempt + 1))
                    else:
                        yield key, (reply, "failed" if reply is None else "empty", attempt, error or "empty reply")
                    if error == self._late():
                        overdue.add(call)
                stuck_since = None if open_ or len(overdue) < self.in_flight else stuck_since or time.monotonic()
                if stuck_since is not None and time.monotonic() - stuck_since > self.timeout:
                    lost = "no free call: all outlast the timeout"
                    for key, _, attempt in again:
                        yield key, (None, "failed", attempt - 1, lost)
                    for key, _ in requests:
                        yield key, (None, "failed", 0, lost)
                    return
        finally:
            for _ in range(self.in_flight):
                self.jobs.put(None)

    def _late(self) -> str:
        return f"no answer within {self.timeout} s"

    def _next(self, open_: dict[int, tuple]) -> list[tuple[int, str | None, str | None]]:
        """What ended or became overdue, after waiting for it a little."""
        try:
            return [self.ended.get(timeout=None if self.timeout is None else min(0.05, self.timeout / 4))]
        except Empty:
            now = time.monotonic()
            return [(c, None, self._late()) for c in list(open_) if now - self.started.get(c, now) > self.timeout]


def generate_replies(requests: DataFrame, client_factory: Callable[[], Callable[[dict], str]],
                     max_attempts: int = 3, backoff_seconds: float = 2.0,
                     in_flight: int = 10, partitions: int | None = None,
                     sleep: Callable[[float], None] = time.sleep,
                     jitter: Callable[[], float] = random.random,
                     carry: Sequence[str] = (), timeout_seconds: float | None = 120.0) -> DataFrame:
    """E2 + E5: call a user-supplied chat client inside Spark tasks.

    ``client_factory()`` runs once per task (no client object travels from
    the driver) and returns ``f(request_dict) -> reply``; ``request_dict``
    is the decoded ``payload`` of A7. A task keeps ``in_flight`` requests open,
    asks the next when one ends (``CallPool``) and hands rows on as they
    settle; with ``partitions`` set, at most ``partitions * in_flight`` calls
    are open in the whole job, otherwise in_flight times the cores. A call
    that takes longer than ``timeout_seconds`` counts as failed. A request
    without an answer, or with a blank one, is asked up to ``max_attempts``
    times and then becomes a ``failed`` or ``empty`` row with its last error,
    so one bad item never stops the job.
    Only ``request_id``, ``payload`` and the small ``carry`` columns cross
    into Python. Results are non-deterministic: write them out (A6) before
    any second use."""
    if max_attempts < 1 or in_flight < 1:
        raise ValueError("max_attempts and in_flight must be positive")
    carry = list(carry)
    slim = requests.select("request_id", "payload", *carry)
    schema = REPLY_SCHEMA + "".join(
        f", {f.name} {f.dataType.simpleString()}" for f in slim.schema.fields if f.name in carry)
    if partitions:
        slim = slim.repartition(partitions, "request_id")

    def run(batches: Iterator):
        import pandas as pd
        names = ["request_id", "reply", "status", "attempts", "error", *carry]
        rows = (row for pdf in batches for row in pdf.itertuples(index=False, name=None))
        pool = CallPool(client_factory(), in_flight, max_attempts,
                        lambda n: sleep(backoff_seconds * n + jitter()), timeout_seconds)
        done: list[tuple] = []

        def table() -> pd.DataFrame:
            out = pd.DataFrame(done, columns=names)
            done.clear()
            return out.astype({"attempts": "int32"})

        for row, outcome in pool.run((row, json.loads(row[1])) for row in rows):
            done.append((row[0], *outcome, *row[2:]))
            if len(done) >= in_flight:
                yield table()
        if done:
            yield table()

    return slim.mapInPandas(run, schema)


def resolve_attempts(ledger: DataFrame, max_attempts: int = 3) -> DataFrame:
    """From an attempt ledger ``(request_id, attempt, ok, reply, error)``
    pick the first successful non-empty reply within ``max_attempts``; else
    the request failed with the error of its last counted attempt (an empty
    reply counts as the error ``empty reply``, as a retry cause). One hash
    aggregation with map-side partial aggregation (hot requests are fine)."""
    within = ledger.where(F.col("attempt") <= F.lit(max_attempts))
    stripped = py_strip(F.col("reply"))
    good = F.col("ok") & stripped.isNotNull() & (stripped != F.lit(""))
    err = F.coalesce(F.col("error"), F.when(F.col("ok") & ~good, F.lit("empty reply")))
    agg = within.groupBy("request_id").agg(
        F.min(F.when(good, F.struct(F.col("attempt"), stripped.alias("reply")))).alias("_ok"),
        F.max(F.struct(F.col("attempt"), err.alias("error"))).alias("_last"),
        F.max("attempt").alias("_n"))
    done = F.col("_ok").isNotNull()
    return agg.select(
        "request_id",
        F.col("_ok.reply").alias("reply"),
        F.when(done, F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
        F.coalesce(F.col("_ok.attempt"), F.col("_n")).cast("int").alias("attempts"),
        F.when(done, F.lit(None).cast("string")).otherwise(F.col("_last.error")).alias("error"))
