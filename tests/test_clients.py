"""Providers over HTTP against a local server, and the progress of runs."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from rankloom.operators import clients, providers
from rankloom.plans import progress


class Service(BaseHTTPRequestHandler):
    keys: set = set()

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.keys.add(self.headers.get("Authorization"))
        if "input" in body:
            if "poison" in body["input"]:
                self.send_response(400)
                self.end_headers()
                self.wfile.write(b"bad text")
                return
            items = [{"index": i, "embedding": [float(len(t)), 1.0 if body.get("input_type") == "query" else 0.0]} for i, t in enumerate(body["input"])]
            reply = {"data": items[::-1]}
        else:
            reply = {"choices": [{"message": {"content": " / ".join(m["content"] for m in body["messages"])}}]}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(reply).encode())

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def url():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1/"
    server.shutdown()


def test_endpoints():
    env = {"E_URL": " http://a ", "E_KEY": "k", "E_KEY_2": "k2", "E_URL_4": "http://b"}
    assert clients.endpoints("E", env) == [clients.Endpoint("http://a", "k"), clients.Endpoint("http://a", "k2"), clients.Endpoint("http://b", "")]
    assert "k2" not in repr(clients.endpoints("E", env))
    with pytest.raises(LookupError):
        clients.endpoints("F", env)
    with pytest.raises(LookupError):
        clients.embedder("E", env)


def test_embedder_in_tasks(spark, url):
    """Vectors come back in the order of the texts, tasks use all keys, and a text that is refused has no row."""
    Service.keys.clear()
    make = clients.embedder("E", {"E_URL": url, "E_MODEL": "m", "E_KEY": "one", "E_KEY_2": "two"}, extra={"input_type": "query"})
    rows = spark.createDataFrame([(i, "x" * (i + 1) if i != 7 else "poison") for i in range(20)], "i long, doc_content string")
    none = spark.createDataFrame([], "i long, model string")
    got = {r["i"]: r["vec"] for r in providers.embed_missing(rows, none, make, ["i"], batch=3, workers=4, tries=2, sleep=lambda _: None).collect()}
    assert got == {i: [i + 1.0, 1.0] for i in range(20) if i != 7}
    assert Service.keys == {"Bearer one", "Bearer two"}


def test_generator_in_tasks(spark, url):
    make = clients.generator("G", {"G_URL": url, "G_MODEL": "m"}, system="be brief")
    rows = spark.createDataFrame([("a",), ("b",)], "p string")
    assert {(r["p"], r["response"]) for r in providers.complete(rows, make, "p").collect()} == {("a", "be brief / a"), ("b", "be brief / b")}


def test_run_stats():
    assert progress.run_stats(30, 90, 15.0) == {"done": 30, "total": 90, "share": 1 / 3, "rate": 2.0, "eta": 30.0}
    assert progress.run_stats(0, 5, 1.0)["eta"] is None and progress.run_stats(0, 0, 0.0) == {"done": 0, "total": 0, "share": 1.0, "rate": 0.0, "eta": 0.0}
    assert [progress.duration(x) for x in (45.2, 185, 7290)] == ["45s", "3m 05s", "2h 01m"]


def test_watched(spark):
    told = []
    with progress.watched(spark, "count", 0.05, told.append):
        spark.range(100).count()
        time.sleep(0.2)
    assert told and told[0].startswith("count: ")
