import json
import sys
import threading

from pyspark import cloudpickle

from talkmill.operators.generate import generate_replies, resolve_attempts

cloudpickle.register_pickle_by_value(sys.modules[__name__])



def scripted_factory():
    """Client whose behaviour per request is scripted in the user text:
    'ok' -> reply; 'empty' -> empty reply; 'fail' -> exception;
    'flaky' -> fails twice then replies."""
    calls = {}
    lock = threading.Lock()

    def call(req):
        text = req["messages"][0]["content"]
        with lock:
            calls[text] = calls.get(text, 0) + 1
            n = calls[text]
        if text.startswith("ok"):
            return "  Speaker: fine  "
        if text.startswith("empty"):
            return "   "
        if text.startswith("flaky") and n >= 3:
            return "Speaker: at last"
        raise RuntimeError("boom")
    return call


def test_client_retries_and_dead_letters(spark):
    payloads = [(f"r{i}", json.dumps({"messages": [{"role": "user", "content": t}]}))
                for i, t in enumerate(["ok-1", "empty-1", "fail-1", "flaky-1"])]
    req = spark.createDataFrame(payloads, "request_id STRING, payload STRING")
    waits = []
    out = generate_replies(req, scripted_factory, max_attempts=3, backoff_seconds=2.0,
                           sleep=waits.append, jitter=lambda: 0.0, partitions=2)
    got = {r.request_id: r for r in out.collect()}
    assert got["r0"].status == "ok" and got["r0"].reply == "Speaker: fine" and got["r0"].attempts == 1
    assert got["r1"].status == "empty" and got["r1"].attempts == 3 and got["r1"].error == "empty reply"
    assert got["r2"].status == "failed" and "boom" in got["r2"].error
    assert got["r3"].status == "ok" and got["r3"].attempts == 3 and got["r3"].reply == "Speaker: at last"


def test_resolve_attempts_ledger(spark):
    rows = [("a", 1, False, None, "e1"), ("a", 2, True, " ", None), ("a", 3, True, "hi", None),
            ("b", 1, False, None, "x1"), ("b", 2, False, None, "x2"), ("b", 3, False, None, "x3"),
            ("c", 1, True, "ok", None), ("c", 2, True, "late", None),
            ("d", 4, True, "too late", None), ("d", 1, False, None, "d1")]
    led = spark.createDataFrame(rows, "request_id STRING, attempt INT, ok BOOLEAN, reply STRING, error STRING")
    got = {r.request_id: r for r in resolve_attempts(led, 3).collect()}
    assert (got["a"].status, got["a"].attempts, got["a"].reply) == ("ok", 3, "hi")
    assert (got["b"].status, got["b"].attempts, got["b"].error) == ("failed", 3, "x3")
    assert (got["c"].status, got["c"].attempts, got["c"].reply) == ("ok", 1, "ok")
    assert (got["d"].status, got["d"].error) == ("failed", "d1")


def test_a_hanging_call_counts_as_failed(spark):
    payloads = [("a", json.dumps({"messages": [{"role": "user", "content": "hang"}]})),
                ("b", json.dumps({"messages": [{"role": "user", "content": "quick"}]}))]

    def factory():
        def call(req):
            if req["messages"][0]["content"] == "hang":
                import time
                time.sleep(30)
            return "Speaker: yes"
        return call

    req = spark.createDataFrame(payloads, "request_id STRING, payload STRING").coalesce(1)
    out = generate_replies(req, factory, max_attempts=1, timeout_seconds=0.5)
    got = {r.request_id: r for r in out.collect()}
    assert got["a"].status == "failed" and "no answer" in got["a"].error and got["b"].status == "ok"


def _pool(client, in_flight=3, attempts=2, timeout=None):
    from talkmill.operators.generate import CallPool
    return CallPool(client, in_flight, attempts, lambda n: None, timeout)


def test_a_blank_answer_is_asked_for_again(spark):
    answers = {"late": ["", "  ", "Speaker: now"], "never": ["", "", ""], "mixed": ["", RuntimeError("down"), ""]}

    def client(request):
        a = answers[request["n"]].pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    out = dict(_pool(client, attempts=3).run((n, {"n": n}) for n in list(answers)))
    assert out == {"late": ("Speaker: now", "ok", 3, None), "never": ("", "empty", 3, "empty reply"),
                   "mixed": ("", "empty", 3, "empty reply")}


def test_a_slow_call_holds_up_no_other():
    import time
    release, peak, now, lock = threading.Event(), [0], [0], threading.Lock()

    def client(request):
        with lock:
            now[0] += 1
            peak[0] = max(peak[0], now[0])
        if request["n"] == 0:
            release.wait(20)
        with lock:
            now[0] -= 1
        return "x"

    begun, seen = time.monotonic(), []
    for n, outcome in _pool(client, in_flight=3).run((n, {"n": n}) for n in range(40)):
        seen.append(n)
        if len(seen) == 39:
            release.set()
    assert seen[-1] == 0 and sorted(seen) == list(range(40))
    assert peak[0] <= 3 and time.monotonic() - begun < 15


def test_calls_that_never_end_keep_their_places():
    import time
    peak, now, lock = [0], [0], threading.Lock()

    def client(request):
        with lock:
            now[0] += 1
            peak[0] = max(peak[0], now[0])
        time.sleep(0.6 if request["n"] < 2 else 0)
        with lock:
            now[0] -= 1
        return "x"

    out = dict(_pool(client, in_flight=2, attempts=1, timeout=0.4).run((n, {"n": n}) for n in range(6)))
    assert [out[n][1] for n in range(6)] == ["failed"] * 2 + ["ok"] * 4 and peak[0] == 2
    hang = threading.Event()
    out = dict(_pool(lambda r: hang.wait(30), in_flight=2, attempts=2, timeout=0.2).run((n, {"n": n}) for n in range(5)))
    assert len(out) == 5 and {o[1] for o in out.values()} == {"failed"}
    hang.set()
