"""Readers over real files, the guards, and whole runs with resume."""

import base64
import io
import json
import os
import zipfile

import pytest

from foliospark.config import Settings
from foliospark.errors import CorruptedFile, EncodingDetection, FileTooLarge, LLMTimeout, PathTraversal
from foliospark.operators.state import StateLog
from foliospark.plans.pipeline import Pipeline
from foliospark.registry import Registry, readers
from foliospark.sources import files as S
from foliospark.functions.render import item_text
from foliospark.sources.readers import csv_sections, decoded, json_sections, pdf_reader, read_all
from foliospark.storage import shared_dir
from foliospark.streaming.ingest import chunk_stream

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx():
    p = lambda t, s="": f"<w:p>{f'<w:pPr><w:pStyle w:val=\"{s}\"/></w:pPr>' if s else ''}<w:r><w:t>{t}</w:t></w:r></w:p>"
    cell = lambda t: f"<w:tc>{p(t)}</w:tc>"
    body = p("Title", "H1") + p(" ") + p("Body") + f"<w:tbl><w:tr>{cell('a ')}{cell('b')}</w:tr><w:tr>{cell('c')}{cell('d')}</w:tr></w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", f'<w:styles {W}><w:style w:styleId="H1"><w:name w:val="Heading 1"/></w:style></w:styles>')
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    (d / "sub").mkdir(parents=True)
    (d / "lines.txt").write_text("".join(f"line {i}\n" for i in range(450)))
    (d / "sub" / "cp1252.TXT").write_bytes("Prix : 5 € – été\r\nfin".encode("cp1252"))
    (d / "empty.txt").write_bytes(b"")
    (d / "blank.txt").write_text(" \n \n")
    (d / "doc.md").write_text("# Head\n\nC# x and [l](u)\n\n\n> quote\n\n`gone`\n")
    (d / "rows.csv").write_text('a,b\n1,"x\ny"\n,\nonly\n1,2,3\n')
    (d / "array.json").write_text('[{"k":1,"n":{"z":[1,"é"],"t":true,"f":1.0}},5," "]')
    (d / "broken.json").write_text('{"a": ')
    (d / "page.htm").write_text("<title>T</title><nav>n</nav><p>One</p>\n\n<p>Two</p>")
    (d / "doc.docx").write_bytes(docx())
    (d / "bad.docx").write_bytes(b"no zip")
    (d / "skip.xyz").write_text("x")
    return d


def read(spark, d, **more):
    s = Settings(input_dir=str(d), **more)
    got = {}
    for r in read_all(S.guarded(S.listed(spark, s), s)[0], s).collect():
        got.setdefault(os.path.basename(r["file_path"]), []).append(r)
    return {k: sorted(v, key=lambda r: (r["section"] or "").zfill(9)) for k, v in got.items()}


def test_readers(spark, folder):
    got = read(spark, folder)
    texts = lambda name: [(r["section"], r["text"]) for r in got[name]]
    assert [s for s, _ in texts("lines.txt")] == ["0", "1", "2"] and texts("lines.txt")[2][1].endswith("line 449\n")
    assert texts("cp1252.TXT") == [("0", "Prix : 5 € – été\nfin")]
    assert "empty.txt" not in got and texts("blank.txt") == [("0", " \n \n")]
    assert texts("doc.md") == [("0", "Head"), ("1", "Cx and l"), ("2", "quote")]
    assert texts("rows.csv") == [("0", "a: 1 | b: x\ny"), ("2", "a: only"), ("3", "a: 1 | b: 2 | None: ['3']")]
    assert json.loads(got["rows.csv"][0]["extra"]["columns"]) == ["a", "b"]
    assert texts("array.json") == [("0", 'k: 1\nn.z: [1, "é"]\nn.t: True\nn.f: 1.0'), ("1", "5")]
    assert got["broken.json"][0]["error_class"] == "CorruptedFile" and got["bad.docx"][0]["error_class"] == "CorruptedFile"
    assert texts("page.htm") == [("0", "T\nOne"), ("1", "Two")] and got["page.htm"][0]["extra"] == {"title": "T"}
    assert {r["section"]: (r["text"], r["extra"]) for r in got["doc.docx"]} == {"0": ("Title", {"style": "Heading 1"}), "2": ("Body", {"style": "Normal"}), "table-0": ("a | b\nc | d", None)}
    assert "skip.xyz" not in got


def test_pdf_by_an_extractor(spark, tmp_path):
    (tmp_path / "p.pdf").write_bytes(b"%PDF")
    s = Settings(input_dir=str(tmp_path))
    pages = lambda raw: iter(["a long page of more than twenty characters", "short", "", None])
    f = S.listed(spark, s)
    assert [(r["section"], r["text"]) for r in pdf_reader(pages)(f, s).collect()] == [("1", "a long page of more than twenty characters"), ("2", "short")]
    ocr = pdf_reader(pages, lambda raw, n: f"scanned {n}")(f, s).collect()
    assert [(r["section"], r["text"], r["extra"]["handler"]) for r in ocr][1:] == [("2", "scanned 2", "pdf+ocr"), ("3", "scanned 3", "pdf+ocr"), ("4", "scanned 4", "pdf+ocr")]

    def fails(raw, n):
        raise RuntimeError

    assert [r["text"] for r in pdf_reader(pages, fails)(f, s).collect()][1:] == ["short"]


def test_discovery_and_guards(spark, folder, tmp_path):
    s = Settings(input_dir=str(folder), max_file_bytes=6)
    files = S.listed(spark, s)
    names = [os.path.basename(r["path"]) for r in S.in_order(files).collect()]
    assert names == sorted(names[:-1]) + ["cp1252.TXT"] and "skip.xyz" not in names and files.columns == ["path", "length", "outside"]
    ok, over = S.guarded(files, s)
    assert {os.path.basename(r["path"]) for r in ok.collect()} == {"empty.txt", "blank.txt", "bad.docx", "broken.json"} and over.count() == len(names) - 4
    with pytest.raises(FileTooLarge):
        S.validate_path(str(folder / "lines.txt"), s)
    assert S.validate_path(str(folder / "broken.json"), s)
    outside = tmp_path / "out.txt"
    outside.write_text("x")
    (folder / "link.txt").symlink_to(outside)
    with pytest.raises(PathTraversal):
        S.validate_path(str(folder / "link.txt"), s)
    (folder / "inner.txt").symlink_to(folder / "blank.txt")
    ok, refused = S.guarded(S.listed(spark, s), s)
    assert {os.path.basename(r["file_path"]) for r in refused.where("error_class = 'PathTraversal'").collect()} == {"link.txt"}
    assert "inner.txt" in {os.path.basename(r["path"]) for r in ok.collect()}
    with pytest.raises(PathTraversal):
        S.safe_resolve("../out.txt", s)
    assert S.safe_resolve("doc.md", s).endswith("doc.md")
    with pytest.raises(NotADirectoryError):
        S.listed(spark, Settings(input_dir=str(tmp_path / "none")))
    with pytest.raises(EncodingDetection):
        decoded(b"\xff", ("utf-8",))
    assert decoded("﻿a\r\nb\rc".encode(), ("utf-8",)) == "a\nb\nc"
    assert list(S.line_stream(str(folder / "sub" / "cp1252.TXT"), s)) == ["Prix : 5 € – été", "fin"]
    assert b"".join(S.binary_chunks(str(folder / "lines.txt"), 100)) == (folder / "lines.txt").read_bytes()


class Fake:
    """An adapter that fails for some texts the first time round."""

    def __init__(self, fail="", answer=None):
        self.fail, self.answer = fail, answer

    def generate(self, prompt, system="", temperature=0.7, max_tokens=None):
        if self.fail and self.fail in prompt:
            raise LLMTimeout("never")
        return self.answer or json.dumps({"instruction": "i", "input": "", "output": prompt[-12:]})


def run(spark, folder, out, adapter, **more):
    s = Settings(input_dir=str(folder), output_path=str(out / "train.jsonl"), checkpoint_dir="file://" + str(out / "state"), llm_retry_backoff_base=0.0, **more)
    return Pipeline(spark, s, adapter).run("2024-01-01T00:00:00+00:00"), s


def test_run_resume_and_new_files(spark, folder, tmp_path):
    first, s = run(spark, folder, tmp_path, Fake())
    assert first.failed_files == 4  # empty, blank, two broken
    assert first.completed_files == 7 and first.records == spark.read.json(s.output_path).count() > 10
    states = {os.path.basename(r["file_path"]): r for r in StateLog(spark, s.checkpoint_dir).states().collect()}
    assert states["empty.txt"]["error_msg"] == "No content extracted" and states["blank.txt"]["error_msg"] == "Empty after normalisation"
    assert states["lines.txt"]["num_chunks"] == 3 and states["broken.json"]["error_msg"].startswith("CorruptedFile")
    again, _ = run(spark, folder, tmp_path, Fake())
    assert (again.records, again.completed_files, again.failed_files) == (0, 0, 4)
    (folder / "new [1] {x}?.md").write_text("One more.")
    third, _ = run(spark, folder, tmp_path, Fake())
    assert (third.records, third.completed_files) == (1, 1)


def test_links_out_of_the_folder_are_not_read(spark, folder, tmp_path):
    (tmp_path / "secret.txt").write_text("secret")
    (folder / "link.txt").symlink_to(tmp_path / "secret.txt")
    (folder / "away").symlink_to(tmp_path)
    got, s = run(spark, folder, tmp_path, Fake())
    states = {os.path.basename(r["file_path"]): r["error_msg"] for r in StateLog(spark, s.checkpoint_dir).states().collect()}
    assert states["link.txt"].startswith("PathTraversal") and "secret.txt" not in states and (got.completed_files, got.failed_files) == (7, 5)
    assert not any("secret" in x.read_text() for x in (tmp_path / "train.jsonl").glob("*.json"))


def test_many_files_in_folders(spark, tmp_path):
    """Names are listed by level in tasks; more than one batch of them comes from a folder."""
    for d in range(3):
        (tmp_path / "in" / f"d{d}" / "e").mkdir(parents=True)
    for i in range(12_000):
        (tmp_path / "in" / "d1" / f"{i}.txt").touch()
    (tmp_path / "in" / "d2" / "e" / "x.TXT").write_text("x")
    s = Settings(input_dir=str(tmp_path / "in"))
    files = S.listed(spark, s)
    assert files.count() == 12_001 and files.where("length = 1").count() == 1


def test_scratch_is_gone_after_a_run(spark, folder, tmp_path):
    own = f"{shared_dir(spark)}/foliospark-{spark.sparkContext.applicationId}".removeprefix("file://")
    there = lambda: set(os.listdir(own)) if os.path.isdir(own) else set()
    before = there()
    run(spark, folder, tmp_path, Fake())
    assert there() == before


def test_writer_and_tokenizer_are_taken(spark, folder, tmp_path):
    kept = []

    def writer(df, path, settings):
        kept.extend(r["output"] for r in df.collect())
        return type("Out", (), {"records": len(kept)})

    vocabulary = tmp_path / "bytes.tiktoken"
    vocabulary.write_text("".join(f"{base64.b64encode(bytes([b])).decode()} {b}\n" for b in range(256)))
    s = Settings(input_dir=str(folder), output_path=str(tmp_path / "x"), checkpoint_dir="file://" + str(tmp_path / "state"), max_context_tokens=1_000, prompt_budget_tokens=500, chunk_overlap_tokens=0, tokenizer_name="bytes", tokenizer_files=str(tmp_path))
    got = Pipeline(spark, s, Fake(), writer=writer).run("t")
    assert got.records == len(kept) > 12  # a bucket of 200 lines has more than 500 bytes
    with pytest.raises(FileNotFoundError):
        Pipeline(spark, s.with_(tokenizer_name="none", checkpoint_dir="file://" + str(tmp_path / "other")), Fake()).run("t")


def test_json_in_a_window(spark, tmp_path):
    """Items across windows of any size; broken files give nothing but their error."""
    items = [{"a": "é" * 50, "n": i} for i in range(40)] + [12345678, 1.5e3, "x y", None, [1, [2]], True, {"b": "z" * 9_000}]
    for block in (1, 7, 64, 8_192):
        s = Settings(stream_chunk_bytes=block)
        got = [t for _, t, _ in json_sections(io.BytesIO(json.dumps(items, indent=1).encode()), s)]
        assert got == [item_text(x) for x in items]
        assert [t for _, t, _ in json_sections(io.BytesIO(b"  12345 "), s)] == ["12345"] and not [*json_sections(io.BytesIO(b" [ ] "), s)]
        for bad in (b"", b"[1,2", b"[1 2]", b"[1,]", b"[1] x", b"{", b"[1,2]]", b"nul", b"[\xff]"):
            with pytest.raises(CorruptedFile):
                list(json_sections(io.BytesIO(bad), s))


def test_text_in_blocks(tmp_path):
    (tmp_path / "x").write_bytes(("é,b\r\n" + "é,\"q\r\nr\"\n" * 5_000).encode("cp1252"))
    s = Settings()
    with S.open_binary(str(tmp_path / "x"), 64) as f:
        rows = list(csv_sections(f, s))
    assert len(rows) == 5_000 and rows[0][1] == "é: é | b: q\nr"


def test_failed_calls_and_malformed_answers(spark, folder, tmp_path):
    got, s = run(spark, folder, tmp_path, Fake(fail="quote"), output_format="parquet", jsonl_schema="sharegpt")
    states = {os.path.basename(r["file_path"]): r for r in StateLog(spark, s.checkpoint_dir).states().collect()}
    assert (states["doc.md"]["num_chunks"], states["doc.md"]["num_records"], states["doc.md"]["status"]) == (3, 2, "complete")
    out = spark.read.parquet(str(tmp_path / "train"))
    assert out.count() == got.records and [t["from"] for t in out.first()["conversations"]] == ["human", "gpt"]
    got, _ = run(spark, folder, tmp_path / "b", Fake(answer="[1]"))
    assert got.records == 0 and got.rejects > 0


def test_stream(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    s = Settings(input_dir=str(d), checkpoint_dir="file://" + str(tmp_path / "state"), max_file_bytes=1_000)
    go = lambda: chunk_stream(spark, s, str(tmp_path / "out"), str(tmp_path / "ck"), "t").awaitTermination()
    (d / "a.md").write_text("One.\n\nTwo.")
    go()
    (d / "b.md").write_text("Three.")
    (d / "c.md").write_text("`x`")
    (d / "D.JSON").write_text("{")
    (d / "e.txt").write_text("x" * 2_000)
    go()
    go()
    assert sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["One.", "Three.", "Two."]
    states = {os.path.basename(r["file_path"]): (r["status"], r["error_msg"] and r["error_msg"].split(":")[0]) for r in StateLog(spark, s.checkpoint_dir).states().collect()}
    assert states == {"a.md": ("complete", None), "b.md": ("complete", None), "c.md": ("failed", "No content extracted"), "D.JSON": ("failed", "CorruptedFile"), "e.txt": ("failed", "FileTooLarge")}


def test_registry(caplog):
    r = Registry("thing")
    r.register(".A")(1)
    r.register(".a")(2)
    assert r.get(".A") == 2 and r.keys() == [".a"] and ".A" in r and "replaced" in caplog.text
    assert {".txt", ".md", ".csv", ".json", ".html", ".htm", ".docx", ".pdf"} <= set(readers.keys())
