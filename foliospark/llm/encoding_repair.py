"""Problem 1: text garbled by a wrong character decoding.

The distinct words of the corpus that hold a character beyond ASCII are counted
once. Every clean one is garbled under all encoding chains below; the forms are
hash-joined with the corpus words, each meeting is verified, and what remains
is a table *garbled word -> original*. Fragments join it by their words.

Garbling works character by character and leaves ASCII alone, so besides whole
words the maximal runs beyond ASCII are treated as words too: ``Ã©`` is found and
restored in a word whose clean form the corpus does not hold.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from foliospark.storage import small_enough, table, written

#: How bytes were misread as single-byte text; what a table lacks becomes the control of that number, U+FFFD or nothing.
READ_UTF8_AS = ("latin-1", "cp1252", "cp1251", "mac_roman", "cp437", "cp850", "cp1250", "iso8859_2", "koi8_r", "cp866", "cp1254")
#: Single-byte text misread as UTF-8.
READ_AS_UTF8 = ("cp1252", "cp1251", "cp1250", "iso8859_2", "koi8_r", "cp866", "mac_roman", "cp850")
#: (written in, read as) of single-byte tables that take each other's place.
SWAPPED = (
    *((a, b) for a in ("cp1251", "koi8_r", "cp866") for b in ("latin-1", "cp1252")), ("koi8_r", "cp1251"), ("cp1251", "koi8_r"), ("cp866", "cp1251"), ("cp1251", "cp866"),
    *((a, b) for a in ("cp437", "cp850", "mac_roman", "cp852") for b in ("latin-1", "cp1252")), *((a, b) for a in ("cp1252",) for b in ("cp437", "cp850", "mac_roman", "cp1251", "cp1250")),
    *((a, b) for a in ("cp1250", "iso8859_2", "cp852") for b in ("latin-1", "cp1252")), ("iso8859_2", "cp1250"), ("cp1250", "iso8859_2"),
)
MODES = ("control", "replace", "ignore")
#: Read wrongly twice, by any two tables; what was read wrongly more often is undone step by step (``undone``).
TWICE = tuple((a, b) for a in READ_UTF8_AS for b in READ_UTF8_AS)
#: Signs that clean texts may lack and garbled ones hold: byte order mark, no-break space.
SIGNS = ("﻿", " ")
#: Most rows of the repair table that are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 300_000

_APART = rb"\x00-\x20!-/:-@\[-`{-~"
_WORDS = re.compile(rb"[^" + _APART + rb"]+")
_RUN = re.compile(r"[^\x00-\x7f]+")


def _read(raw: bytes, table_name: str, mode: str) -> str:
    if mode != "control":
        return raw.decode(table_name, mode)
    try:
        return raw.decode(table_name)
    except UnicodeDecodeError:
        return "".join(chr(b) if (c := bytes([b]).decode(table_name, "ignore")) == "" else c for b in raw)


def garbled_forms(word: str) -> dict[str, int]:
    """Form -> kind of its chain: 1 UTF-8 misread (once or twice), 2 misread as UTF-8, 3 single-byte tables swapped."""
    out: dict[str, int] = {}

    def add(form: str, kind: int) -> None:
        if form and form != word and not form.isascii():
            out.setdefault(form, kind)

    raw = word.encode("utf-8", "ignore")
    for t in READ_UTF8_AS:
        for mode in MODES:
            add(_read(raw, t, mode), 1)
    once = {a: _read(raw, a, "control").encode("utf-8") for a in READ_UTF8_AS}
    for a, b in TWICE:
        try:
            add(once[a].decode(b), 1)  # nothing lost: all modes agree
        except UnicodeDecodeError:
            for mode in MODES:
                add(_read(once[a], b, mode), 1)
    for t in READ_AS_UTF8:
        for lost in ("strict", "ignore"):
            try:
                add(word.encode(t, lost).decode("utf-8", "replace"), 2)
                break
            except UnicodeEncodeError:
                continue
    for a, b in SWAPPED:
        try:
            coded = word.encode(a)
        except UnicodeEncodeError:
            continue
        for mode in MODES:
            add(_read(coded, b, mode), 3)
    return out


def _unread(word: str, table_name: str) -> str | None:
    """The word whose UTF-8 read by this table gives ``word``, lacking bytes as controls; None if there is none."""
    try:
        raw = word.encode(table_name)
    except UnicodeEncodeError:
        if not any("\x80" <= c <= "\x9f" for c in word):
            return None
        try:
            raw = b"".join(bytes([ord(c)]) if "\x80" <= c <= "\x9f" else c.encode(table_name) for c in word)
        except UnicodeEncodeError:
            return None
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return None


def undone(word: str) -> set[str]:
    """All words that ``word`` can come from by UTF-8 being misread any number of times without loss; each step is shorter."""
    out: set[str] = set()
    layer = {word}
    while layer:
        layer = {u for w in layer if not w.isascii() for t in READ_UTF8_AS if (u := _unread(w, t)) and not u.isascii()} - out - {word}
        out |= layer
    return out


_TYPICAL = set("’‘“”„«»‹›–—…°€£§%¡¿·•")


def oddity(word: str) -> int:
    """How unlike a word: controls, lost characters, signs, scripts mixed, capitals after small letters."""
    odd, script, small = 0, "", False
    for c in word:
        kind = unicodedata.category(c)
        if kind[0] == "L":
            own = "c" if "Ѐ" <= c <= "ӿ" else "l" if c < "ɐ" else "o"
            odd += (own != script and script != "") + (small and kind == "Lu")
            script, small = own, kind == "Ll"
        elif c == "�" or kind == "Cc":
            odd += 3
        elif not c.isascii() and c not in _TYPICAL:
            odd += 1
    return odd


_REFERENCE = re.compile(rb"&#(1[2-9]\d|[2-9]\d\d|\d{4,6});")


def unreferenced(text: bytes) -> bytes:
    """Numeric character references beyond ASCII as the characters they name: garbled text may have been escaped after."""

    def char(m: re.Match[bytes]) -> bytes:
        n = int(m[1])
        return chr(n).encode() if 127 < n < 0x110000 and not 0xD800 <= n < 0xE000 else m[0]

    return _REFERENCE.sub(char, text)


def words_of(text: bytes) -> set[str]:
    """The distinct words beyond ASCII of a text, their runs, and their parts about apostrophes.

    Words end at ASCII white space and signs only: the others may be garbled letters.
    Most of a text is ASCII, so it is cut and sifted as bytes, without a regular
    expression at each character (which took five times the CPU in the JVM).
    """
    out = set()
    if b"&#" in text:
        text = unreferenced(text)
    for part in {p for p in text.split() if not p.isascii()}:
        for word in _WORDS.findall(part):
            if not word.isascii():
                w = word.decode("utf-8", "replace")
                out.add(w)
                out.update(_RUN.findall(w))
                if "’" in w:  # what an article is joined to; some tables lack the sign
                    out.update(x for x in w.split("’") if not x.isascii())
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the texts each word is in: one row per word and some thousand texts."""
    seen: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
        seen.clear()
        return out

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            seen.update(words_of(text))
        if len(seen) > 200_000:
            yield flush()
    yield flush()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [words_of(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        ids = batch.column(0).take(pa.array([i for i, ws in enumerate(found) for _ in ws], pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, pa.array([w for ws in found for w in ws], pa.string())], names=["fragment_id", "word"])


def _garble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: list[list] = [[] for _ in range(5)]
        for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if "�" in word or any("\x7f" <= c <= "\x9f" for c in word):
                continue
            odd = oddity(word)
            for form, kind in garbled_forms(word).items():
                if word in SIGNS and kind != 1:
                    continue
                for c, v in zip(cols, (form, word, n, kind, odd)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32())], names=["word", "original", "n_original", "kind", "odd_original"])


def _undo(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word with what it can come from, as far as that may be clean."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        rows = [(w, u, oddity(u)) for w in words for u in undone(w) if "\ufffd" not in u and not any("\x7f" <= c <= "\x9f" for c in u)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int32())], names=["word", "original", "odd_original"])


@F.pandas_udf(IntegerType())
def _oddity(words: pd.Series) -> pd.Series:
    return words.map(oddity)


def repair_table(fragments: DataFrame) -> DataFrame:
    """``word, original``: the garbled words of the corpus; ``original`` is null where several clean words may stand behind one.

    Verified: a form has to look less like a word than its original or be at
    least three times rarer. Forms of swapped tables, which can look sound, have
    to be rarer *and*, if they look sound, have four letters or more. What
    may as well be the clean word of a garbled one has to be both. An
    original that is itself found garbled is followed to its own.
    """
    texts = fragments.select("text").where("text IS NOT NULL AND (length(text) <> octet_length(text) OR contains(text, '&#'))")
    counts = written(texts.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    signs = fragments.sparkSession.createDataFrame([(s, 1 << 40) for s in SIGNS], "word string, n long")
    # Words are few bytes and much work each: spread by a number that is not coalesced.
    tasks = 2 * fragments.sparkSession.sparkContext.defaultParallelism
    forms = counts.unionByName(signs).repartition(tasks, "word").mapInArrow(_garble, "word string, original string, n_original long, kind int, odd_original int")
    known = counts.unionByName(signs).groupBy("word").agg(F.max("n").alias("n_original")).withColumnRenamed("word", "original")
    undoings = counts.select("word").repartition(tasks, "word").mapInArrow(_undo, "word string, original string, odd_original int").join(known, "original").withColumn("kind", F.lit(1))
    met = counts.join(forms.unionByName(undoings), "word").withColumn("odd", _oddity("word"))
    rarer = F.col("n_original") >= 3 * F.col("n")
    odder = F.col("odd") > F.col("odd_original")
    # Without lost characters, what is misread as UTF-8 is the undoing of the opposite chain: mostly the clean word.
    undoing = (F.col("kind") == 2) & ~F.contains("word", F.lit("\ufffd"))
    sound = undoing & odder & rarer | ~undoing & (F.col("kind") < 3) & (odder | rarer) | (F.col("kind") == 3) & rarer & (odder | (F.char_length("word") >= 4) & (F.col("odd") == F.col("odd_original")))
    met = written(met.where(sound & ((F.col("kind") < 3) | (F.char_length("word") > 1))), "met")
    # Of two words that meet each other the odder is the garbled one, or else the rarer.
    mutual = met.select(F.col("original").alias("word"), F.col("word").alias("original"), F.lit(True).alias("mutual")).distinct()
    met = met.join(mutual, ["word", "original"], "left").where("mutual IS NULL OR odd > odd_original OR odd = odd_original AND (n < n_original OR n = n_original AND word > original)")
    met = written(met.drop("mutual"), "settled")
    clean = met.join(met.select(F.col("word").alias("original")).distinct(), "original", "left_anti").select("word", "original", "n_original")
    # An original that is garbled itself stands for its own originals; the words left become fewer with each step.
    resolved, left = clean, met.where("odd > odd_original").join(clean, "word", "left_anti").select("word", F.col("original").alias("step"))
    while True:
        found = left.join(resolved.withColumnRenamed("word", "step"), "step").where("word <> original").groupBy("word", "original").agg(F.max("n_original").alias("n_original"))
        found = written(found, "followed")
        if not found.head(1):
            break
        resolved = resolved.unionByName(found)
        left = left.join(found, "word", "left_anti")
    best = resolved.groupBy("word", "original").agg(F.max("n_original").alias("n")).groupBy("word").agg(F.max_by("original", "n").alias("original"), F.max("n").alias("most"), F.sum("n").alias("all"))
    # Several originals: the commonest stands if twenty times as common as the rest. Lost characters alone tell nothing.
    return best.select("word", F.when((F.col("most") * 21 >= F.col("all") * 20) & F.col("word").rlike("[^\ufffd]"), F.col("original")).alias("original"))


def garbled_words(fragments: DataFrame) -> DataFrame:
    """``fragment_id, word, original``: each garbled word of each fragment, once.

    Null and ASCII texts have none; a text of any length is read whole; repeated
    rows are found as often as they occur; other columns are not read.
    """
    repairs = written(repair_table(fragments), "repairs")
    if small_enough(repairs, BROADCAST_ROWS):
        repairs = F.broadcast(repairs)
    rows = fragments.select("fragment_id", "text").where("text IS NOT NULL AND (length(text) <> octet_length(text) OR contains(text, '&#'))")
    return rows.mapInArrow(_listed, "fragment_id long, word string").join(repairs, "word").select("fragment_id", "word", "original")


_WORD = re.compile("[^" + _APART.decode() + "]*[^\x00-\x7f][^" + _APART.decode() + "]*")


def restore(text: str, repairs: dict[str, str]) -> str:
    """References undone, then whole words first; a word without a repair of its own gets those of its runs."""
    text = unreferenced(text.encode()).decode() if "&#" in text else text
    return _WORD.sub(lambda m: repairs.get(m[0]) or _RUN.sub(lambda r: repairs.get(r[0], r[0]), m[0]), text)


def restored(fragments: DataFrame) -> DataFrame:
    """``fragment_id, text, n_garbled, n_restored`` of each garbled fragment; a byte order mark that comes out is dropped."""
    per = garbled_words(fragments).groupBy("fragment_id").agg(F.collect_list(F.struct("word", "original")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, found = b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist()
            maps = [{x["word"]: x["original"] for x in f if x["original"] is not None} for f in found]
            out = [restore(t, m).lstrip("﻿") for t, m in zip(texts, maps)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.string()), pa.array(map(len, found), pa.int32()), pa.array(map(len, maps), pa.int32())], names=["fragment_id", "text", "n_garbled", "n_restored"])

    return fragments.select("fragment_id", "text").join(per, "fragment_id").mapInArrow(run, "fragment_id long, text string, n_garbled int, n_restored int")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled_words(table(spark, sf_dir, "fragments", ["fragment_id", "text"])).select("fragment_id").distinct()


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored(table(spark, sf_dir, "fragments", ["fragment_id", "text"]))


QUERIES = {"p1_found": p1_found, "p1_restored": p1_restored}
SQL: dict[str, str] = {}
