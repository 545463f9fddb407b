"""Providers over HTTP: embedders and generators of any service that speaks the common JSON form.

Embeddings: {"model", "input": [text, ...]} gives {"data": [{"index", "embedding"}, ...]}.  Answers: {"model", "messages"}
gives {"choices": [{"message": {"content"}}]}.  Where a service lies and what its key is come from the environment of the
driver: <PREFIX>_URL, <PREFIX>_MODEL, <PREFIX>_KEY, and _URL_2, _KEY_2 and so on for further ones of the same model.  A task
draws one of them by its number, so tasks spread over all keys.  Waits and repeats are with_retry()'s.
"""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark import TaskContext

#: Numbered endpoints that are looked for.
MOST_ENDPOINTS = 99


@dataclass(frozen=True)
class Endpoint:
    url: str
    key: str = field(default="", repr=False)


class Refused(RuntimeError):
    """The service answered with an error."""


def endpoints(prefix: str, env: Mapping[str, str] | None = None) -> list[Endpoint]:
    """The endpoints that env names; a numbered one without a URL of its own takes the first one's."""
    env = os.environ if env is None else env
    get = lambda name: env.get(name, "").strip()
    first = get(f"{prefix}_URL")
    if not first:
        raise LookupError(f"{prefix}_URL names no service")
    found = [Endpoint(first, get(f"{prefix}_KEY"))]
    for i in range(2, MOST_ENDPOINTS + 1):
        url, key = get(f"{prefix}_URL_{i}"), get(f"{prefix}_KEY_{i}")
        if url or key:
            found.append(Endpoint(url or first, key))
    return found


def _own(many: list[Endpoint]) -> Endpoint:
    """The endpoint of the task that this runs in; the first one on the driver."""
    task = TaskContext.get()
    return many[task.partitionId() % len(many) if task else 0]


def post(to: Endpoint, path: str, body: dict, timeout: float) -> dict:
    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {to.key}"} if to.key else {})
    ask = urllib.request.Request(to.url.rstrip("/") + path, json.dumps(body).encode(), head)
    try:
        with urllib.request.urlopen(ask, timeout=timeout) as reply:
            return json.load(reply)
    except urllib.error.HTTPError as e:
        raise Refused(f"{e.code}: {e.read(500).decode('utf-8', 'replace')}") from None


class HttpEmbedder:
    """Vectors of texts.  extra: fields that a service wants beside these, such as whether texts are queries or documents."""

    def __init__(self, model: str, many: list[Endpoint], extra: dict | None = None, timeout: float = 60.0):
        self.model, self.to, self.extra, self.timeout = model, _own(many), extra or {}, timeout

    def embed(self, texts: list[str]) -> list[list[float]]:
        got = post(self.to, "/embeddings", {"model": self.model, "input": texts, **self.extra}, self.timeout)["data"]
        out: list[list[float] | None] = [None] * len(texts)
        for at, item in enumerate(got):
            out[item.get("index", at)] = item["embedding"]
        if len(got) != len(texts) or None in out:
            raise Refused(f"{len(got)} vectors for {len(texts)} texts")
        return out


class HttpGenerator:
    """Answers to prompts, a call each."""

    def __init__(self, model: str, many: list[Endpoint], system: str = "", extra: dict | None = None, timeout: float = 120.0):
        self.model, self.to, self.system, self.extra, self.timeout = model, _own(many), system, extra or {}, timeout

    def complete(self, prompts: list[str]) -> list[str]:
        return [self._one(p) for p in prompts]

    def _one(self, prompt: str) -> str:
        told = [{"role": "system", "content": self.system}] if self.system else []
        body = {"model": self.model, "messages": [*told, {"role": "user", "content": prompt}], **self.extra}
        return post(self.to, "/chat/completions", body, self.timeout)["choices"][0]["message"]["content"]


def embedder(prefix: str = "EMBEDDER", env: Mapping[str, str] | None = None, **more) -> Callable[[], HttpEmbedder]:
    """A factory for tasks; the environment is read here, on the driver, once."""
    many, model = endpoints(prefix, env), (os.environ if env is None else env).get(f"{prefix}_MODEL", "")
    if not model:
        raise LookupError(f"{prefix}_MODEL names no model")
    return lambda: HttpEmbedder(model, many, **more)


def generator(prefix: str = "GENERATOR", env: Mapping[str, str] | None = None, **more) -> Callable[[], HttpGenerator]:
    many, model = endpoints(prefix, env), (os.environ if env is None else env).get(f"{prefix}_MODEL", "")
    if not model:
        raise LookupError(f"{prefix}_MODEL names no model")
    return lambda: HttpGenerator(model, many, **more)
