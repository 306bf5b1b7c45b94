"""Language-model calls as a map over partitions, with bounded fan-out, retries and mapped errors.

Calls are costly and never the same twice, so their raw answers are written
once to the shared folder and read back: later stages, retried or not, do not
call again. Speculation should be off for this stage. ``spread`` makes no more
partitions than calls are allowed at once, and each gets its part of them, so
``max_concurrent_llm_calls`` bounds the whole job.
"""

from __future__ import annotations

import http.client
import json
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.config import Settings
from foliospark.errors import CallFailure, LLMConnection, LLMMalformedResponse, LLMRateLimit, LLMTimeout
from foliospark.operators.records import extract_json
from foliospark.registry import adapters, register_adapter

#: (url, body or None for GET, timeout) -> (status, body). Replaced by a fake in tests.
Transport = Callable[[str, bytes | None, float], tuple[int, bytes]]
CONNECT_SECONDS = 10.0


class Adapter(Protocol):
    def generate(self, prompt: str, system: str = "", temperature: float = 0.7, max_tokens: int | None = None) -> str: ...

    def health_check(self) -> bool: ...


class Http:
    """Connections kept open, one for each thread and host, until ``close``.

    Connecting may take ``CONNECT_SECONDS``, an answer the call's own timeout. A
    kept connection that the server has closed is opened anew once.
    """

    def __init__(self) -> None:
        self.local, self.opened, self.lock = threading.local(), [], threading.Lock()

    def __reduce__(self):
        return Http, ()  # connections stay where they are

    def __call__(self, url: str, body: bytes | None, timeout: float) -> tuple[int, bytes]:
        at = urlsplit(url)
        known = self.local.__dict__.setdefault("by_host", {})
        for fresh in (False, True):
            kept = known.get(at[:2])
            if kept is None:
                made = (http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection)(at.hostname, at.port, timeout=min(CONNECT_SECONDS, timeout))
                made.connect()
                with self.lock:
                    self.opened.append(made)
                known[at[:2]] = made
            link = known[at[:2]]
            link.sock.settimeout(timeout)
            try:
                link.request("GET" if body is None else "POST", (at.path or "/") + (f"?{at.query}" if at.query else ""), body, {"Content-Type": "application/json"})
                answer = link.getresponse()
                got = answer.status, answer.read()
                if link.sock is None:  # the server wants it closed
                    del known[at[:2]]
                return got
            except (http.client.RemoteDisconnected, ConnectionResetError, BrokenPipeError):
                link.close()
                del known[at[:2]]
                if kept is None or fresh:
                    raise
            except BaseException:
                link.close()
                del known[at[:2]]
                raise
        raise AssertionError("unreachable")

    def close(self) -> None:
        with self.lock:
            while self.opened:
                self.opened.pop().close()


@dataclass(frozen=True)
class Endpoint:
    """What both adapters share: one call, its errors mapped."""

    base_url: str
    model: str
    timeout: float = 120.0
    transport: Transport = field(default_factory=Http)

    @classmethod
    def of(cls, settings: Settings, transport: Transport | None = None):
        return cls(settings.llm_base_url.rstrip("/"), settings.model_name, settings.llm_timeout_seconds, transport or Http())

    def call(self, path: str, payload: dict | None) -> dict:
        try:
            status, body = self.transport(self.base_url + path, None if payload is None else json.dumps(payload).encode(), self.timeout)
        except TimeoutError as e:
            raise LLMTimeout(f"no answer within {self.timeout} s") from e
        except (OSError, http.client.HTTPException) as e:
            raise LLMConnection(str(e)) from e
        if status == 429:
            raise LLMRateLimit("HTTP 429")
        if status >= 400:
            raise LLMConnection(f"HTTP {status}: {body[:500].decode('utf-8', 'replace')}")
        try:
            return json.loads(body)
        except ValueError as e:
            raise LLMMalformedResponse(body[:200].decode("utf-8", "replace")) from e

    def close(self) -> None:
        """Close what the transport keeps open."""
        getattr(self.transport, "close", lambda: None)()

    def generate(self, prompt: str, system: str = "", temperature: float = 0.7, max_tokens: int | None = None) -> str:
        raise NotImplementedError

    def generate_structured(self, prompt: str, system: str = "", temperature: float = 0.3, max_tokens: int | None = None) -> dict:
        """A cooler answer, parsed as JSON."""
        raw = self.generate(prompt, system, temperature, max_tokens)
        try:
            return extract_json(raw)
        except ValueError as e:
            raise LLMMalformedResponse(raw[:300]) from e


@register_adapter("ollama")
class OllamaAdapter(Endpoint):
    def generate(self, prompt: str, system: str = "", temperature: float = 0.7, max_tokens: int | None = None) -> str:
        options = {"temperature": temperature} | ({"num_predict": max_tokens} if max_tokens else {})
        payload = {"model": self.model, "prompt": prompt, "stream": False, "options": options} | ({"system": system} if system else {})
        return self.call("/api/generate", payload).get("response", "")

    def health_check(self) -> bool:
        try:
            return isinstance(self.call("/api/tags", None), dict)
        except CallFailure:
            return False


@register_adapter("openai")
class ChatAdapter(Endpoint):
    def generate(self, prompt: str, system: str = "", temperature: float = 0.7, max_tokens: int | None = None) -> str:
        messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": prompt}]
        payload = {"model": self.model, "messages": messages, "temperature": temperature, "stream": False} | ({"max_tokens": max_tokens} if max_tokens else {})
        answer = self.call("/chat/completions", payload)
        try:
            return answer["choices"][0]["message"]["content"]
        except (KeyError, IndexError, TypeError) as e:
            raise LLMMalformedResponse(str(answer)[:300]) from e

    def health_check(self) -> bool:
        """A list of models, or else a completion of one token."""
        for probe in (lambda: self.call("/models", None), lambda: self.generate("ping", max_tokens=1)):
            try:
                probe()
                return True
            except CallFailure:
                continue
        return False


def adapter_of(settings: Settings, transport: Transport | None = None):
    made = adapters.get(settings.llm_backend)
    if made is None:
        raise ValueError(f"unknown backend {settings.llm_backend!r}; known: {', '.join(adapters.keys())}")
    return made.of(settings, transport)


def with_retries(call: Callable[[], str], attempts: int, base: float, sleep: Callable[[float], None] = time.sleep) -> tuple[str, int]:
    """(answer, attempts used). Only timeouts and rate limits are tried again, after ``base ** k`` seconds."""
    for k in range(attempts):
        try:
            return call(), k + 1
        except CallFailure as e:
            if not e.passing or k + 1 == attempts:
                raise
            sleep(base**k)
    raise ValueError("attempts must be at least 1")


def answers(df: DataFrame, adapter: Adapter, settings: Settings, prompt: str = "prompt", sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """The columns of ``df`` and ``raw, attempts, error_class, error_msg``; a null prompt is not sent. Lazy: see ``answered``."""
    calls = max(1, settings.max_concurrent_llm_calls // _partitions(df.sparkSession, settings))
    names = df.columns
    at = names.index(prompt)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", raw string, attempts int, error_class string, error_msg string"

    def ask(text: str | None) -> tuple[str | None, int, str | None, str | None]:
        if text is None:
            return None, 0, None, None
        used = 0

        def once() -> str:
            nonlocal used
            used += 1
            return adapter.generate(text, settings.system_prompt)

        try:
            raw, _ = with_retries(once, settings.llm_max_retries, settings.llm_retry_backoff_base, sleep)
            return raw, used, None, None
        except CallFailure as e:
            return None, used, type(e).__name__, str(e)[:500]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            with ThreadPoolExecutor(calls) as pool:
                for b in batches:
                    got = list(pool.map(ask, b.column(at).to_pylist()))
                    cols = [pa.array(c, t) for c, t in zip(zip(*got) if got else [[]] * 4, (pa.string(), pa.int32(), pa.string(), pa.string()))]
                    yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*names, "raw", "attempts", "error_class", "error_msg"])
        finally:
            getattr(adapter, "close", lambda: None)()

    return df.mapInArrow(run, schema)


def _partitions(spark: SparkSession, settings: Settings) -> int:
    return max(1, min(spark.sparkContext.defaultParallelism, settings.max_concurrent_llm_calls))


def spread(df: DataFrame, settings: Settings, prompt: str = "prompt") -> DataFrame:
    """Prompts evenly over the partitions that may call at once; by hash, so that a task that is run again gets the same rows."""
    return df.repartition(_partitions(df.sparkSession, settings), F.xxhash64(prompt))
