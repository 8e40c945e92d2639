"""A deterministic stand-in for a chat endpoint, used by the tests. It answers every request with a two-turn
dialogue about the size of the user message and fails (every attempt)
when that size is a multiple of seven, so the retry and dead-letter paths
run on real data."""

from __future__ import annotations


def echo_reply(user_content: str) -> str:
    n = len(user_content)
    if n % 7 == 0:
        raise RuntimeError("simulated endpoint outage")
    return f"Teacher: I received {n} characters.\nStudent: Thank you."


def echo_client_factory():
    def call(request: dict) -> str:
        return echo_reply(request["messages"][1]["content"])
    return call


def no_wait(_seconds: float) -> None:
    return None


def no_jitter() -> float:
    return 0.0
