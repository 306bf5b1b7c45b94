"""The log of states against a dictionary, and settings."""

import random

import pytest

from foliospark.config import Settings
from foliospark.logs import setup_logging
from foliospark.operators.state import StateLog, latest, stats


def test_latest_and_sticky_like_an_upsert(spark):
    rng = random.Random(3)
    rows, plain, upsert = [], {}, {}
    for seq in range(200):
        f, ok = f"f{rng.randrange(12)}", rng.random() < 0.5
        row = (f, "complete", seq, seq + 1, str(seq), None) if ok else (f, "failed", None, None, str(seq), f"e{seq}" if seq % 3 else None)
        rows.append((*row, seq))
        plain[f] = row
        old = upsert.get(f, (f, None, None, None, None, None))
        upsert[f] = (f, "complete", seq, seq + 1, str(seq), old[5]) if ok else (f, "failed", old[2], old[3], str(seq), row[5])
    log = spark.createDataFrame(rows, "file_path string, status string, num_chunks int, num_records int, finished_at string, error_msg string, seq long")
    assert {tuple(r) for r in latest(log).collect()} == set(plain.values())
    assert {tuple(r) for r in latest(log, sticky=True).collect()} == set(upsert.values())
    assert tuple(stats(latest(log)).first()) == (len(plain), sum(r[1] == "complete" for r in plain.values()), sum(r[1] == "failed" for r in plain.values()))


def test_log(spark, tmp_path):
    log = StateLog(spark, "file://" + str(tmp_path / "s"))
    assert log.states().count() == 0 and log.get("k") is None
    log.mark_complete(spark.createDataFrame([("a", 2, 1), ("b", 3, 3)], "file_path string, num_chunks int, num_records int"), "t1")
    log.mark_failed(spark.createDataFrame([("a", "late"), ("c", "bad")], "file_path string, error_msg string"), "t2")
    assert {(r["file_path"], r["status"], r["num_chunks"], r["error_msg"]) for r in log.states().collect()} == {("a", "failed", None, "late"), ("b", "complete", 3, None), ("c", "failed", None, "bad")}
    assert log.is_complete("b") and not log.is_complete("a") and log.is_failed("c") and not log.is_failed("none")
    log.mark_complete(spark.createDataFrame([("c", 1, 1)], "file_path string, num_chunks int, num_records int"), "t3")
    assert log.is_complete("c")
    log.put("k", "1")
    log.put("k", None)
    assert log.get("k") is None
    log.put("k", "2")
    assert log.get("k") == "2"
    log.reset()
    assert log.states().count() == 0 and log.get("k") is None


def test_compaction_changes_no_view(spark, tmp_path):
    log = StateLog(spark, "file://" + str(tmp_path / "s"))
    done = "file_path string, num_chunks int, num_records int"
    log.mark_failed(spark.createDataFrame([("a", "old"), ("b", "bad"), ("d", None)], "file_path string, error_msg string"), "t1")
    log.mark_complete(spark.createDataFrame([("a", 2, 1), ("c", 3, 3), ("n", None, None)], done), "t2")
    log.mark_failed(spark.createDataFrame([("c", "late")], "file_path string, error_msg string"), "t3")
    views = lambda: [sorted(map(tuple, log.states(sticky).collect()), key=str) for sticky in (False, True)]
    before = views()
    assert ("a", "complete", 2, 1, "t2", "old") in before[1] and ("c", "failed", 3, 3, "t3", "late") in before[1] and ("a", "complete", 2, 1, "t2", None) in before[0]
    for n in (1, 2, 3):
        log.compact()
        assert views() == before and log.generation() == n and log.log().count() == 5
    log.mark_complete(spark.createDataFrame([("c", 4, 4)], done), "t4")
    log.compact()
    assert ("c", "complete", 4, 4, "t4", "late") in views()[1] and ("c", "complete", 4, 4, "t4", None) in views()[0]
    assert sorted(x.name for x in (tmp_path / "s" / "checkpoints").iterdir() if not x.name.startswith(".")) == ["3", "3.ready", "4", "4.ready"]


def test_compaction_that_dies_loses_nothing(spark, tmp_path, monkeypatch):
    log = StateLog(spark, "file://" + str(tmp_path / "s"))
    log.mark_failed(spark.createDataFrame([("a", "old")], "file_path string, error_msg string"), "t1")
    before = log.states(True).collect()

    def dies(self, path):
        if path.endswith(".ready"):
            raise RuntimeError("killed")
        return fs(self, path)

    fs = StateLog._fs
    monkeypatch.setattr(StateLog, "_fs", dies)
    with pytest.raises(RuntimeError):
        log.compact()
    monkeypatch.undo()
    assert log.generation() == 0 and log.states(True).collect() == before
    log.mark_failed(spark.createDataFrame([("b", "x")], "file_path string, error_msg string"), "t2")
    log.compact()
    assert log.generation() == 1 and log.states().count() == 2


def test_settings(monkeypatch):
    monkeypatch.setenv("FOLIO_MAX_CONTEXT_TOKENS", "2048")
    monkeypatch.setenv("FOLIO_ALLOWED_EXTENSIONS", ".txt, .md")
    s = Settings()
    assert s.chunk_budget == 1536 and s.allowed_extensions == (".txt", ".md")
    assert Settings.from_rows({"chunk_overlap_tokens": "96", "run_label": "x", "jsonl_schema": None}).chunk_overlap_tokens == 96
    with pytest.raises(ValueError):
        Settings(max_context_tokens=512)
    with pytest.raises(ValueError):
        Settings(jsonl_schema="other")
    assert s.with_(max_context_tokens=4096).chunk_budget == 3584


def test_logging(capsys):
    setup_logging("DEBUG", json_output=True)
    import logging

    logging.getLogger("x").info("hé")
    assert '"event": "hé"' in capsys.readouterr().err
    setup_logging("WARNING")
