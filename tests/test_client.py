"""The model client against a small local service."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from agorascope import config
from agorascope.plans import client, labeling

SERVERS: list = []


@pytest.fixture
def service():
    asked, failures, times = [], [], []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, self.headers["Authorization"], body))
            times.append(time.monotonic())
            code = failures.pop(0) if failures else 200
            code, after = code if isinstance(code, tuple) else (code, None)
            out = json.dumps({"choices": [{"message": {"content": f" re: {body['messages'][1]['content']} "}}]}).encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(out)))
            if after:
                self.send_header("Retry-After", after)
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    server.times = times
    SERVERS.append(server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1/", asked, failures
    server.shutdown()


def test_content():
    said = lambda c: {"choices": [{"message": {"content": c}}]}
    assert client.content(said(" a ")) == "a" and client.content(said([{"type": "text", "text": "a "}, "b", {"type": "image_url", "image_url": {}}, {"text": None}])) == "a b"
    for odd in ({}, {"choices": []}, said(None), {"choices": [{}]}, {"choices": [None]}, {"choices": {}}, None, [], "x", said(7)):
        assert client.content(odd) == ""


def test_calls_and_retries(service):
    url, asked, failures = service
    model = client.from_settings({"model": {"url": url, "name": "m", "api_key": "file", "wait": 0.0, "temperature": 0}}, environment={"MODEL_API_KEY": "env"})
    assert model("x") == "re: x"
    path, key, body = asked[0]
    assert (path, key, body["model"], body["temperature"], body["max_tokens"]) == ("/v1/chat/completions", "Bearer env", "m", 0, 512)
    failures += [503, 429]
    assert model("y") == "re: y" and len(asked) == 4
    failures += [400]
    assert labeling.answered(model, "z", tries=1)[1].startswith("HTTPError") and len(asked) == 5
    failures += [500] * 3
    assert labeling.answered(model, "z", tries=1)[0] == "" and len(asked) == 8


def test_no_key():
    with pytest.raises(ValueError):
        client.from_settings({"model": {"url": "u", "name": "m"}}, environment={})


def test_asked_by_workers(spark, service):
    rows = spark.createDataFrame([("a",), ("b",)], "prompt string")
    got = labeling.ask(rows, client.chat_model(service[0], "m", "k")).collect()
    assert {r.reply for r in got} == {"re: a", "re: b"} and not any(r.reply_error for r in got)


def test_retry_after():
    assert client.retry_after("7", 0) == 7 and client.retry_after("0.5", 0) == 0.5 and client.retry_after("-1", 0) == 0
    assert client.retry_after("Thu, 01 Jan 1970 00:01:00 GMT", 20) == 40 and client.retry_after("Thu, 01 Jan 1970 00:01:00 GMT", 90) == 0
    assert client.retry_after(None, 0) is None and client.retry_after("soon", 0) is None


def test_pace_by_a_clock():
    """Tasks of one rate together keep it, whatever their calls take, and nothing is saved up while a service is busy."""
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    began = []
    for task in range(4):
        now[0] = 0.0
        pace = config.Pace(8, 4, task, lambda: now[0], sleep)
        for turn in range(6):
            pace.wait()
            began.append(now[0])
            now[0] += 0.9 if turn == 2 else 0.01  # one call takes long
    began.sort()
    assert len(began) == 24 and all(sum(t <= x < t + 1 for x in began) <= 8 for t in began)
    now[0] = 0.0
    pace = config.Pace(8, 1, 0, lambda: now[0], sleep)
    pace.wait()
    pace.hold(5)
    pace.wait()
    first = now[0]
    pace.wait()
    assert first == 5 and now[0] == pytest.approx(5.125)


def test_answered_waits_as_long_as_asked():
    calls = []

    def model(prompt):
        calls.append(time.monotonic())
        if len(calls) < 3:
            raise config.Busy("busy", 0.15)
        return "yes"

    assert labeling.answered(model, "p") == ("yes", None)
    assert calls[1] - calls[0] >= 0.15 and calls[2] - calls[1] >= 0.15
    calls.clear()
    reply, error = labeling.answered(model, "p", tries=2, pace=config.Pace(1000, 1, 0))
    assert reply == "" and error == "Busy: busy" and calls[1] - calls[0] >= 0.15


def test_workers_keep_one_rate(spark, service):
    """Four workers, with retries that the service asks for: no second sees more calls than the rate."""
    url, asked, failures = service
    failures += [(429, "1")] * 2
    rows = spark.range(40).selectExpr("concat('p', id) as prompt").repartition(8)
    got = labeling.ask(rows, client.chat_model(url, "m", "k", retries=0), rate=16, workers=4).collect()
    assert {r.reply for r in got} == {f"re: p{i}" for i in range(40)} and not any(r.reply_error for r in got)
    times = sorted(SERVERS[-1].times)
    assert len(times) == 42 and times[-1] - times[0] >= 2
    # Calls take a few milliseconds to arrive, so one beside the rate may fall into a second.
    assert max(sum(t <= x < t + 1 for x in times) for t in times) <= 16 + 1
