"""Readers: files of one format -> rows of ``schema.READ``.

A reader takes a frame of paths, which it opens in its tasks, or of paths with
``content``, and the settings. One that can be said with built-in functions
(text, Markdown) decodes natively and only sends files that are not UTF-8
through Python; the others parse streams in Arrow batches and hand on their
rows in blocks. A file that fails gives one row with its error and never fails
the job; what a reader had found before the error is kept.
"""

from __future__ import annotations

import codecs
import csv
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from typing import BinaryIO
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from foliospark.config import Settings
from foliospark.errors import CorruptedFile, EncodingDetection, ReadFailure
from foliospark.functions import html as H
from foliospark.functions import render
from foliospark.functions import text as T
from foliospark.registry import readers, register_reader
from foliospark.schema import READ
from foliospark.sources.files import contents, extension, open_binary

Section = tuple[str, str, dict[str, str] | None]
_FIELDS = READ.fieldNames()


def decoded(raw: bytes, chain: tuple[str, ...]) -> str:
    """The first encoding of the chain that takes the whole content; line ends as line feeds, no byte order mark."""
    for name in chain:
        try:
            text = raw.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
        return text.removeprefix("﻿").replace("\r\n", "\n").replace("\r", "\n")
    raise EncodingDetection(f"none of {', '.join(chain)}")


def encoding_of(f: BinaryIO, settings: Settings) -> str:
    """The first encoding of the chain that takes the whole stream, read a block at a time."""
    for name in settings.encoding_fallback_chain:
        try:
            decoder = codecs.getincrementaldecoder(name)()
            f.seek(0)
            while block := f.read(max(settings.stream_chunk_bytes, 1)):
                decoder.decode(block)
            decoder.decode(b"", True)
            return name
        except (UnicodeDecodeError, LookupError):
            continue
    raise EncodingDetection(f"none of {', '.join(settings.encoding_fallback_chain)}")


def text_stream(f: BinaryIO, settings: Settings) -> io.TextIOWrapper:
    """The stream as text: what ``decoded`` gives, without holding it."""
    name = encoding_of(f, settings)
    f.seek(0)
    return io.TextIOWrapper(f, "utf-8-sig" if name.lower().replace("_", "-") in ("utf-8", "utf8") else name, newline=None)


def decoded_column(content: Column, chain: tuple[str, ...]) -> Column:
    """The same on a column: UTF-8 stays in the JVM."""

    def slow(raws: pd.Series) -> pd.Series:
        def one(raw: bytes) -> str | None:
            try:
                return decoded(raw, chain)
            except EncodingDetection:
                return None

        return raws.map(one, na_action="ignore")

    as_text = content.cast("string")
    fast = F.regexp_replace(F.regexp_replace(as_text, "\\A\ufeff", ""), "\r\n?", "\n")
    if chain and chain[0].lower().replace("_", "-") in ("utf-8", "utf8", "utf-8-sig"):
        valid = F.is_valid_utf8(as_text)
        return F.when(valid, fast).otherwise(F.pandas_udf(slow, StringType())(F.when(~valid, content)))
    return F.pandas_udf(slow, StringType())(content)


def _sections(files: DataFrame, settings: Settings, made: Callable[[Column], Column], title: Column | None = None) -> DataFrame:
    """Rows from the section texts that ``made`` gives of a file's text; a file that could not be read or decoded gives its error."""
    if "content" not in files.columns:
        files = contents(files, settings)
    failed = F.col("error_class") if "error_class" in files.columns else F.lit(None).cast("string")
    why = F.col("error_msg") if "error_msg" in files.columns else F.lit(None).cast("string")
    # A projection for the decoded text, and one for what is made of it: each is used more than once.
    base = files.select("path", decoded_column(F.col("content"), settings.encoding_fallback_chain).alias("_text"), failed.alias("_failed"), why.alias("_why"))
    base = base.select("path", "_failed", "_why", F.col("_text").isNull().alias("_bad"), made(F.col("_text")).alias("_made"))
    extra = F.create_map(F.lit("title"), F.coalesce(title, F.lit(""))) if title is not None else F.lit(None).cast("map<string,string>")
    parts = F.col("_made.paragraphs") if title is not None else F.col("_made")
    found = base.select("path", "_bad", "_failed", "_why", extra.alias("extra"), F.posexplode_outer(parts).alias("section", "text"))
    keep = found.where(F.col("text").isNotNull() | F.col("_bad"))
    return keep.select(
        F.col("path").alias("file_path"),
        F.when(~F.col("_bad"), F.col("section").cast("string")).alias("section"),
        "text",
        F.when(~F.col("_bad"), F.col("extra")).alias("extra"),
        F.when(F.col("_bad"), F.coalesce("_failed", F.lit(EncodingDetection.__name__))).alias("error_class"),
        F.when(F.col("_bad"), F.coalesce("_why", F.lit("no encoding of the chain fits"))).alias("error_msg"),
    )


@register_reader(".txt")
def read_txt(files: DataFrame, settings: Settings) -> DataFrame:
    """A fragment for every 200 lines, as they stand; blank ones too."""
    return _sections(files, settings, lambda text: T.line_buckets(text, 200))


@register_reader(".md")
def read_markdown(files: DataFrame, settings: Settings) -> DataFrame:
    """A fragment for every paragraph without its Markdown."""
    return _sections(files, settings, lambda text: T.paragraphs(T.strip_markdown(text)))


@register_reader(".html", ".htm")
def read_html(files: DataFrame, settings: Settings) -> DataFrame:
    """A fragment for every paragraph of the page's text; its title in ``extra``."""
    return _sections(files, settings, H.html_page, F.col("_made.title"))


#: Rows and characters after which a reader hands on what it has.
BLOCK_ROWS, BLOCK_CHARS = 2_000, 4_000_000


def parsed(parse: Callable[[BinaryIO, Settings], Iterator[Section]]) -> Callable[[DataFrame, Settings], DataFrame]:
    """A reader from a parser of one file's stream into (section, text, extra)."""

    def read(files: DataFrame, settings: Settings) -> DataFrame:
        given = "content" in files.columns

        def rows(path: str, raw: bytes | None) -> Iterator[dict]:
            try:
                with io.BytesIO(raw or b"") if given else open_binary(path, settings.stream_chunk_bytes) as f:
                    for section, text, extra in parse(f, settings):
                        yield {"file_path": path, "section": section, "text": text, "extra": list(extra.items()) if extra else None}
            except Exception as e:  # a broken file must not fail the job
                name = type(e).__name__ if isinstance(e, ReadFailure) else CorruptedFile.__name__
                yield {"file_path": path, "error_class": name, "error_msg": str(e)[:500]}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block: list[dict] = []
            chars = 0
            for batch in batches:
                raws = batch.column(1) if given else [None] * batch.num_rows
                for path, raw in zip(batch.column(0).to_pylist(), raws):
                    for row in rows(path, raw.as_py() if given else None):
                        block.append(row)
                        chars += len(row.get("text") or "")
                        if len(block) >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                            yield _block(block)
                            block, chars = [], 0
            if block:
                yield _block(block)

        return files.select("path", *["content"] * given).mapInArrow(run, READ)

    return read


def _block(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{f: r.get(f) for f in _FIELDS} for r in rows], schema=_ARROW)


_ARROW = pa.schema([("file_path", pa.string()), ("section", pa.string()), ("text", pa.string()), ("extra", pa.map_(pa.string(), pa.string())), ("error_class", pa.string()), ("error_msg", pa.string())])
CSV_FIELD_LIMIT = 10 * 1024 * 1024


def csv_sections(f: BinaryIO, settings: Settings) -> Iterator[Section]:
    """A fragment per row; surplus cells come under ``None`` as a list, empty values are left out, rows without a value skipped but counted."""
    csv.field_size_limit(CSV_FIELD_LIMIT)
    for i, row in enumerate(csv.DictReader(text_stream(f, settings))):
        text = " | ".join(f"{k}: {v}" for k, v in row.items() if v)
        if text.strip():
            yield str(i), text, {"columns": json.dumps([str(k) for k in row], ensure_ascii=False)}


_BLANK = re.compile(r"[ \t\r\n]*")


class _JsonStream:
    """The top-level items of a JSON text, decoded one at a time from a window that holds one item."""

    def __init__(self, f: BinaryIO, block: int) -> None:
        self.f, self.size = f, max(block, 4_096)
        self.decoder = codecs.getincrementaldecoder("utf-8-sig")()
        self.text, self.at, self.done = "", 0, False

    def more(self) -> None:
        """Drop what is used and read on; what is read doubles while one item does not fit."""
        raw = self.f.read(max(self.size, len(self.text) - self.at))
        self.done = not raw
        self.text = self.text[self.at :] + self.decoder.decode(raw, self.done)
        self.at = 0

    def sign(self) -> str:
        """The next character that is not blank; empty at the end."""
        while True:
            self.at = _BLANK.match(self.text, self.at).end()
            if self.at < len(self.text) or self.done:
                return self.text[self.at : self.at + 1]
            self.more()

    def value(self):
        """The value here. One that ends where the window ends may go on."""
        self.sign()
        while True:
            try:
                value, stop = json.JSONDecoder().raw_decode(self.text, self.at)
                if stop < len(self.text) or self.done:
                    self.at = stop
                    return value
            except ValueError:
                if self.done:
                    raise
            self.more()

    def items(self) -> Iterator:
        if self.sign() != "[":
            yield self.value()
        else:
            self.at += 1
            while self.sign() != "]":
                yield self.value()
                if self.sign() == ",":
                    self.at += 1
                    if self.sign() == "]":
                        raise ValueError("a comma before the end of the array")
                elif self.sign() != "]":
                    raise ValueError("no comma between items")
            self.at += 1
        if self.sign():
            raise ValueError("text behind the value")


def json_sections(f: BinaryIO, settings: Settings) -> Iterator[Section]:
    """A fragment per item of a top-level array, else one; UTF-8 only.

    Read twice, an item at a time: a file that is broken anywhere gives its
    error and no fragments, and a file of any size needs memory for one item.
    """
    try:
        for _ in _JsonStream(f, settings.stream_chunk_bytes).items():
            pass
    except ValueError as e:
        raise CorruptedFile(f"no JSON: {e}") from e
    f.seek(0)
    for i, item in enumerate(_JsonStream(f, settings.stream_chunk_bytes).items()):
        text = render.item_text(item)
        if text.strip():
            yield str(i), text, None


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx_text(paragraph: ElementTree.Element) -> str:
    signs = {f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n", f"{_W}noBreakHyphen": "-"}
    return "".join((e.text or "") if e.tag == f"{_W}t" else signs.get(e.tag, "") for e in paragraph.iter())


def docx_sections(f: BinaryIO, settings: Settings) -> Iterator[Section]:
    """Body paragraphs by their position, blank ones counted, with their style; then the tables as ``table-N``."""
    try:
        with zipfile.ZipFile(f) as z:
            body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
            styles = {}
            if "word/styles.xml" in z.namelist():
                for s in ElementTree.fromstring(z.read("word/styles.xml")).iter(f"{_W}style"):
                    name = s.find(f"{_W}name")
                    styles[s.get(f"{_W}styleId")] = name.get(f"{_W}val") if name is not None else s.get(f"{_W}styleId")
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as e:
        raise CorruptedFile(f"no DOCX: {e}") from e
    if body is None:
        return
    for i, p in enumerate(body.findall(f"{_W}p")):
        text = _docx_text(p).strip()
        if text:
            style = p.find(f"{_W}pPr/{_W}pStyle")
            key = style.get(f"{_W}val") if style is not None else "Normal"
            yield str(i), text, {"style": styles.get(key, key)}
    for i, t in enumerate(body.findall(f"{_W}tbl")):
        rows = [" | ".join("\n".join(_docx_text(p) for p in c.findall(f"{_W}p")).strip() for c in r.findall(f"{_W}tc")) for r in t.findall(f"{_W}tr")]
        if rows:
            yield f"table-{i}", "\n".join(rows), None


def is_sparse(page: str) -> bool:
    """So little text that the page may be a picture."""
    return len(page.strip()) < OCR_BELOW


def sparse(c: Column) -> Column:
    return F.length(T.strip(c)) < OCR_BELOW


PageExtractor = Callable[[bytes], Iterator[str]]
PageOcr = Callable[[bytes, int], str]
OCR_BELOW = 20


def pdf_reader(extract: PageExtractor | None = None, ocr: PageOcr | None = None) -> Callable[[DataFrame, Settings], DataFrame]:
    """A reader of PDF pages, numbered from 1, by an extractor of page texts that the executors can import.

    A page of fewer than 20 characters goes to ``ocr``, if there is one; where
    that fails or is missing, its sparse text is kept. ``extract`` defaults to
    pdfplumber, if it is installed.
    """

    def pages(f: BinaryIO, settings: Settings) -> Iterator[Section]:
        raw = f.read()
        for n, page in enumerate((extract or _pdfplumber)(raw), 1):
            text, handler = (page or "").strip(), "pdf"
            if is_sparse(text) and ocr is not None:
                try:
                    text, handler = ocr(raw, n).strip() or text, "pdf+ocr"
                except Exception:  # the page's own text stands
                    pass
            if text:
                yield str(n), text, {"handler": handler}

    return parsed(pages)


def _pdfplumber(raw: bytes) -> Iterator[str]:
    try:
        import pdfplumber
    except ImportError as e:
        raise ReadFailure("no PDF extractor is installed or given") from e
    with pdfplumber.open(io.BytesIO(raw)) as pdf:
        for page in pdf.pages:
            yield page.extract_text() or ""


read_csv, read_json, read_docx = register_reader(".csv")(parsed(csv_sections)), register_reader(".json")(parsed(json_sections)), register_reader(".docx")(parsed(docx_sections))
read_pdf = register_reader(".pdf")(pdf_reader())


def read_all(files: DataFrame, settings: Settings) -> DataFrame:
    """All formats: the files of each allowed extension by its reader, in one union."""
    known = [e for e in sorted({e.lower() for e in settings.allowed_extensions}) if e in readers]
    return reduce(DataFrame.unionByName, [readers.get(e)(files.where(extension(F.col("path")) == e), settings) for e in known])


def as_fragments(read: DataFrame, run_timestamp: str) -> DataFrame:
    """Rows of ``schema.FRAGMENT`` from what readers found; one timestamp for the run makes it repeatable."""
    found = read.where("error_class IS NULL")
    meta = F.struct(F.col("file_path").alias("source_path"), F.col("section").alias("page_or_section"), F.lit(run_timestamp).alias("timestamp"), "extra")
    return found.select("text", meta.alias("metadata"), F.lit(None).cast("int").alias("chunk_index"))

