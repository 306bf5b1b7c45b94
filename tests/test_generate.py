"""Model calls over a fake transport, answers, records, sinks."""

import http.client
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from foliospark.config import Settings
from foliospark.errors import LLMConnection, LLMMalformedResponse, LLMRateLimit, LLMTimeout
from foliospark.operators import records as R
from foliospark.operators.generate import ChatAdapter, Http, OllamaAdapter, adapter_of, answers, spread, with_retries
from foliospark.sinks.writers import output_folder, split_valid, write_jsonl, write_parquet

FAST = Settings(llm_retry_backoff_base=0.0)


class Transport:
    def __init__(self, *replies):
        self.replies, self.seen = list(replies), []

    def __call__(self, url, body, timeout):
        self.seen.append((url, body and json.loads(body)))
        reply = self.replies.pop(0)
        if isinstance(reply, Exception):
            raise reply
        return reply


def reply(value, status=200):
    return status, json.dumps(value).encode()


def test_ollama():
    t = Transport(reply({"response": "hi"}), reply({}), reply({"models": []}), (500, b""))
    a = OllamaAdapter("http://h", "m", 1.0, t)
    assert a.generate("p", "s", 0.1, 5) == "hi"
    assert t.seen[0] == ("http://h/api/generate", {"model": "m", "prompt": "p", "stream": False, "options": {"temperature": 0.1, "num_predict": 5}, "system": "s"})
    assert a.generate("p") == "" and a.health_check() and not a.health_check()


def test_chat():
    t = Transport(reply({"choices": [{"message": {"content": "hi"}}]}), reply({"choices": []}), (404, b""), reply({"choices": [{"message": {"content": "x"}}]}), (404, b""), (404, b""))
    a = ChatAdapter("http://h", "m", 1.0, t)
    assert a.generate("p", "s") == "hi" and t.seen[0][1]["messages"] == [{"role": "system", "content": "s"}, {"role": "user", "content": "p"}]
    with pytest.raises(LLMMalformedResponse):
        a.generate("p")
    assert a.health_check() and not a.health_check()


@pytest.mark.parametrize(
    ("got", "error"),
    [(TimeoutError(), LLMTimeout), (http.client.RemoteDisconnected(), LLMConnection), (OSError("no"), LLMConnection), (ConnectionResetError(), LLMConnection), ((429, b""), LLMRateLimit), ((500, b"x"), LLMConnection), ((200, b"no json"), LLMMalformedResponse)],
)
def test_errors(got, error):
    with pytest.raises(error):
        OllamaAdapter("http://h", "m", 1.0, Transport(got)).generate("p")


def test_structured():
    a = OllamaAdapter("http://h", "m", 1.0, Transport(reply({"response": '```json\n{"a": 1}\n```'}), reply({"response": "none"})))
    assert a.generate_structured("p") == {"a": 1}
    with pytest.raises(LLMMalformedResponse):
        a.generate_structured("p")


def test_retries():
    waits, seen = [], []

    def call(*errors):
        left = list(errors)

        def one():
            seen.append(1)
            if left:
                raise left.pop(0)
            return "ok"

        return one

    assert with_retries(call(LLMTimeout(), LLMRateLimit()), 3, 2.0, waits.append) == ("ok", 3) and waits == [1.0, 2.0]
    with pytest.raises(LLMTimeout):
        with_retries(call(*[LLMTimeout()] * 3), 3, 2.0, waits.append)
    seen.clear()
    with pytest.raises(LLMConnection):
        with_retries(call(LLMConnection()), 3, 2.0, waits.append)
    assert len(seen) == 1
    with pytest.raises(ValueError):
        Settings(llm_max_retries=0)


class Echo:
    def generate(self, prompt, system="", temperature=0.7, max_tokens=None):
        if prompt == "slow":
            raise LLMTimeout("t")
        if prompt == "down":
            raise LLMConnection("c")
        return prompt.upper()


def test_map(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "slow", "down", None, "b"])], "id int, prompt string")
    got = {r["id"]: (r["raw"], r["attempts"], r["error_class"]) for r in answers(df, Echo(), FAST).collect()}
    assert got == {0: ("A", 1, None), 1: (None, 3, "LLMTimeout"), 2: (None, 1, "LLMConnection"), 3: (None, 0, None), 4: ("B", 1, None)}
    assert answers(df.limit(0), Echo(), FAST).count() == 0
    few = FAST.with_(max_concurrent_llm_calls=2)
    assert spread(df, few).rdd.getNumPartitions() == 2 and answers(spread(df, few), Echo(), few).count() == 5
    assert adapter_of(Settings(llm_backend="openai")).model == Settings().model_name
    with pytest.raises(ValueError):
        adapter_of(Settings(llm_backend="none"))


ANSWERS = [
    ('{"instruction":"i","input":"","output":"o","more":1}', ("i", "", "o", None)),
    ('Sure! {"instruction":"i","output":"o"} bye', ("i", None, "o", None)),
    ('```json\n{"instruction":"i","input":"","output":"`"}\n```', ("i", "", "`", None)),
    ("hello", ("", "", "hello", None)),
    ("{broken", ("", "", "{broken", None)),
    ("[1]", (None, None, None, "LLMMalformedResponse")),
    ("3", (None, None, None, "LLMMalformedResponse")),
    (None, (None, None, None, "LLMMalformedResponse")),
    ('{"output": {"a": [1]}}', (None, None, '{"a": [1]}', None)),
]


def test_answers(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(ANSWERS)], "id int, raw string")
    got = df.select("id", R.parse_answers(F.col("raw")).alias("a")).orderBy("id").select("a.instruction", "a.input", "a.output", "a.error_class").collect()
    assert [tuple(r) for r in got] == [w for _, w in ANSWERS]


class Server(BaseHTTPRequestHandler):
    """Answers with the number of connections and requests it has seen; every third answer closes the connection."""

    protocol_version = "HTTP/1.1"
    links, asked, drop = set(), 0, False

    def do_POST(self):
        type(self).asked += 1
        self.rfile.read(int(self.headers["Content-Length"]))
        Server.links.add(self.client_address)
        body = json.dumps({"response": f"{len(Server.links)} {Server.asked}"}).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        if Server.drop:
            self.send_header("Connection", "close")
            self.close_connection = True
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


def test_connections_are_kept_and_opened_anew():
    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        a = OllamaAdapter(f"http://127.0.0.1:{server.server_port}", "m", 5.0, Http())
        assert [a.generate("p") for _ in range(3)] == ["1 1", "1 2", "1 3"]
        Server.drop = True
        assert [a.generate("p") for _ in range(2)] == ["1 4", "2 5"]
        a.close()
    finally:
        server.shutdown()
        server.server_close()
    with pytest.raises(LLMConnection):
        a.generate("p")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(f"i{n}", None if n % 2 else "é", "o") for n in range(25)], "instruction string, input string, output string")
    s = Settings(rows_per_shard=10)
    out = write_jsonl(df.coalesce(1), str(tmp_path / "j"), s)
    assert out.records == 25
    files = sorted((tmp_path / "j").glob("*.json"))
    lines = [json.loads(x) for f in files for x in f.read_text().splitlines()]
    assert len(files) == 3 and len(lines) == 25 and all(set(x) == {"instruction", "input", "output"} for x in lines) and "é" in files[0].read_text()
    write_jsonl(df, str(tmp_path / "j"), s)
    assert spark.read.json(str(tmp_path / "j")).count() == 50
    assert write_parquet(df.coalesce(1), str(tmp_path / "t.jsonl"), s).records == 25 and len(list((tmp_path / "t").glob("*.parquet"))) == 3
    assert [output_folder(p) for p in ("a/b.jsonl", "b", "s3://x/y.z/t.jsonl")] == ["a/b", "b", "s3://x/y.z/t"]
    ok, bad = split_valid(df.withColumn("instruction", F.when(F.col("instruction") != "i3", F.col("instruction"))), "alpaca")
    assert (ok.count(), bad.count()) == (24, 1) and split_valid(df, "sharegpt")[0].count() == 0
    with pytest.raises(ValueError):
        split_valid(df, "other")
