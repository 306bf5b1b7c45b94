"""Problem 5: broken prompt and response pairs.

Rules in a fixed order, each on its own, so that a record shows every defect it
has; ``ORDER`` decides which comes first. Two of them ask the corpus. The rule
of abrupt endings: an answer that stops without a closing mark is whole if its
last words end closed sentences or items elsewhere; those last words are joined
with the endings of all records. The rule of languages: texts that the table of
common words tells are counted into profiles of letter triples, one for each
language of the table, and the profiles tell all texts. Texts in other scripts
than the instruction's need no profile.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.storage import small_enough, table, written

#: Most endings that are asked about and broadcast; beyond, they are joined.
BROADCAST_TAILS = 300_000

ORDER = ("empty", "refusal", "copy", "language", "truncated")
#: Shown beside those: the answer begins with the whole instruction or input and then goes on.
ECHO = "echo"

# Words that only label or stand in for an answer.
LABEL = r"(?:output|answer|response|reply|assistant|model|result|question|instruction|input|task|prompt|note|q|a|antwort|frage|ausgabe|aufgabe|réponse|question|sortie|respuesta|pregunta|salida|odpowiedź|pytanie|wynik|ответ|вопрос|результат)"
PLACEHOLDER = frozenset("n/a na nan null none nil undefined todo tbd empty blank placeholder nothing missing unknown xxx".split()) | {"no output", "no answer", "not available", "insert answer here", "your answer here", "answer here", "lorem ipsum"}

_TAG = re.compile(r"<[^<>]*>|&nbsp;|```\w*|\[(?: |x)?\]")
_LABELS = re.compile(rf"^(?:[\W_]*{LABEL}\s*[:：>]\s*)+", re.I)
_WORD = re.compile(r"[^\W_]+")
_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿]")


def unlabelled(text: str) -> str:
    return _LABELS.sub("", text.strip().lstrip("#>*\"'“«„ \n\t⚠️")).strip()


def is_empty(output: str | None) -> bool:
    """Null, blank, or nothing left without markup, marks, labels and placeholders."""
    if output is None:
        return True
    bare = _TAG.sub(" ", _INVISIBLE.sub("", output))
    words = _LABELS.sub("", bare.strip() + " ").strip().lower().strip("[](){}<>*_-–—.…:;,!?\"'`“”«»|#/\\ \n\t=~^")
    if not _WORD.search(words) or words in PLACEHOLDER:
        return True
    return bool(re.fullmatch(rf"{LABEL}", words, re.I)) and bool(re.search(r"[:：>]\W*$", bare.strip()))


# How an assistant declines, by language.
REFUSAL = re.compile(
    "|".join(
        (
            # English
            r"\bi(?:'m| am)? (?:(?:really|just|simply|unfortunately|regretfully) )?(?:can't|cannot|can not|won't(?: be able to)?|will not(?: be able to)?|couldn't|could not|not able to|unable to|not allowed to|not permitted to|not in a position to|must decline(?: to)?|have to decline(?: to)?|decline to|refuse to|would rather not|prefer not to)\b[^.!?;]{0,30}\b(?:help|assist|answer|provide|discuss|reply|respond|comment|go into|give|share|say|talk|speak|offer|fulfil|fulfill|comply|do (?:that|this))",
            r"\bi'd (?:rather|prefer) not(?: to)?\b", r"\bi (?:have to|must|will|need to) (?:pass on|decline|refuse|skip) ?(?:this|that|here|it)?", r"\bno (?:answer|response|reply|information) (?:can|may|will) be (?:given|provided|offered)\b",
            r"\bnot something i(?:'m| am)? ?(?:can|able to|may|allowed to|could|will)\b", r"\bsomething i(?:'m| am) (?:unable|not able|not allowed) to\b", r"\bas an? (?:ai|(?:large )?language) (?:model|assistant)\b", r"\b(?:against|violates?) my (?:guidelines|policy|policies)\b", r"\boutside (?:of )?(?:my|what i) (?:scope|can)\b", r"\bi must decline\b",
            # German
            r"\b(?:kann|darf|möchte|werde|will|könnte) (?:ich|mich) [^.!?]{0,45}(?:nicht|keine|leider)[^.!?]{0,40}(?:helfen|beantworten|äußern|auskunft|eingehen|geben|sagen|antworten|unterstützen|sprechen|weiterhelfen)", r"\bich (?:leider )?(?:kann|darf|möchte|werde|will) [^.!?]{0,45}(?:nicht|keine)[^.!?]{0,40}(?:helfen|beantworten|äußern|auskunft|eingehen|geben|sagen|antworten|unterstützen|sprechen|weiterhelfen)", r"\b(?:kann|darf) ich (?:leider )?nicht (?:beantworten|helfen|sagen)", r"\bantwort ist mir (?:leider )?nicht (?:erlaubt|gestattet|möglich)", r"\bals (?:ki-)?sprachmodell\b", r"\bmuss ich (?:leider )?(?:passen|ablehnen)", r"\bich muss (?:leider )?(?:passen|ablehnen)",
            # French
            r"\bje (?:ne )?(?:peux|puis|suis|pourrai|saurais|souhaite) (?:malheureusement )?pas[^.!?]{0,40}(?:répondre|aider|fournir|donner|discuter|parler|en mesure)", r"\bje (?:préfère|préférerais) ne pas\b", r"\bje dois (?:passer mon tour|refuser|décliner|m'abstenir)", r"\bm'est impossible de\b", r"\baucune réponse ne peut\b", r"\b(?:sujet|thème) m'est interdit\b", r"\ben tant que (?:modèle de langue|modèle de langage|ia)\b",
            # Spanish
            r"\bno (?:puedo|podré|podría|debo|me es posible|me está permitido|estoy en condiciones de|soy capaz de|voy a)\b[^.!?]{0,40}(?:responder|ayudar|ofrecer|contestar|hablar|proporcionar|dar|comentar)", r"\bprefiero no\b", r"\bdebo (?:abstenerme|declinar|negarme)", r"\btema me está (?:vedado|prohibido)", r"\bno se puede dar (?:una )?respuesta", r"\bcomo (?:modelo de lenguaje|ia)\b",
            # Polish
            r"\bnie (?:mogę|jestem w stanie|wolno mi|udzielę|będę|potrafię|chcę|zamierzam)\b[^.!?]{0,40}(?:pomóc|poda|odpowie|odpowiada|mówić|udzieli|rozmawia|komentowa)", r"\bwolę nie\b", r"\bmuszę odmówić\b", r"\bpoza moim zakresem\b", r"\bjako (?:model językowy|sztuczna inteligencja)\b",
            # Russian
            r"\bне (?:могу|смогу|буду|имею права|в состоянии|стану)\b[^.!?]{0,40}(?:отве|помо|предостав|обсужд|говорить|дать|комментир)", r"\bпредпочт[уё][а-яё]* не\b", r"\bвынужден[а-яё]* (?:отказать|воздержать|отклонить)", r"\bответа (?:здесь|тут) не будет\b", r"\bтема для меня закрыта\b", r"\bмне (?:нельзя|не разрешено|запрещено)\b", r"\bкак (?:языковая модель|искусственный интеллект|ии)\b",
        )
    ),
    re.I,
)
# One of these is in whatever the pattern matches, and is looked for first.
REFUSAL_STEMS = tuple(
    "can't|cannot|can not|won't|will not|couldn't|could not|able to|allowed|permitted|position|declin|refus|rather not|prefer|pass on|skip|no answer|no response|no reply|no information|something|as a|guidelines|polic|outside"
    "|nicht|keine|leider|sprachmodell|passen|ablehnen|pas|préf|dois|impossible|aucune|interdit|en tant que|no |abstenerme|declinar|negarme|vedado|prohibido|como "
    "|nie |odmówić|zakresem|jako |не|вынужден|отве|тема|мне|как ".split("|")
)
ASKED_TO_REFUSE = re.compile(r"\b(?:declin|refus|reject(?:ing|ion) (?:letter|note|sentence)|absage|ablehnung|rechazo|negativa|odmow|odmaw|отказ)", re.I)
_SENTENCES = re.compile(r"(?<=[.!?…])\s+|\n+")


def is_refusal(instruction: str, output: str) -> bool:
    """The answer opens with the model declining, in its first two sentences."""
    if ASKED_TO_REFUSE.search(instruction):
        return False
    opening = " ".join([s for s in _SENTENCES.split(unlabelled(output), 4) if s.strip()][:2]).replace("’", "'").replace("`", "'")
    low = opening.lower()
    return any(x in low for x in REFUSAL_STEMS) and bool(REFUSAL.search(opening))


_COPY_TASK = re.compile(r"\b(?:copy|repeat|quote|recopie|copie|répète|cite|copia|repite|gib|wiederhole|zitiere|schreibe? .* ab|przepisz|powtórz|zacytuj|выпиши|перепиши|повтори|процитируй)\b", re.I)


def _bare(text: str | None) -> str:
    return " ".join(_WORD.findall((text or "").lower()))


def _first(text: str | None) -> str:
    found = _WORD.search(text or "")
    return found[0].lower() if found else ""


def copied(instruction: str, given: str | None, output: str) -> str | None:
    """``copy``: nothing but the instruction, the whole input or both, whatever the case, the marks and the label, once or repeated.

    ``echo``: the whole instruction or input, and then something else. Whole
    texts are compared, but only where their first words agree.
    """
    answer = unlabelled(output)
    begins = {_first(instruction), _first(given)} - {""}
    if not begins & {_first(output), _first(answer)}:
        return None
    ask, text = _bare(instruction), _bare(given)
    echo = None
    for o in {_bare(output), _bare(answer)} - {""}:
        if ask and (o == ask or len(o) > len(ask) and o == " ".join([ask] * ((len(o) + 1) // (len(ask) + 1)))):
            return "copy"
        if text and ask and o in (f"{ask} {text}", f"{text} {ask}"):
            return "copy"
        if text and o == text:
            # Asked for the first sentence of a text of one sentence, the whole text is the answer.
            return None if _COPY_TASK.search(instruction) and len([s for s in _SENTENCES.split((given or "").strip()) if s.strip()]) == 1 else "copy"
        if text and len(o) > len(text) and o == " ".join([text] * ((len(o) + 1) // (len(text) + 1))):
            return "copy"
        if any(x.count(" ") > 2 and o.startswith(x + " ") for x in (ask, text)):
            echo = ECHO
    return echo


_TRANSLATION = re.compile(r"\b(?:translat|übersetz|tradui[st]|traduire|traduc|traduz|przetłumacz|tłumacz|перевед|перевест|переклад)|\b(?:in|into|auf|ins|en|na język|на) (?:english|german|french|spanish|polish|russian|englisch|deutsch|französisch|spanisch|polnisch|russisch|anglais|allemand|français|espagnol|polonais|russe|inglés|alemán|francés|español|polaco|ruso)\b", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
#: First code points of scripts and of what lies between; letters below belong to the entry before.
_SCRIPTS = ((0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x900, "indic"), (0xE00, "thai"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "latin"), (0x3040, "kana"), (0x3400, "han"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "arabic"), (0xFF00, "latin"), (0x20000, "han"))
_BEYOND_LATIN = re.compile("[\u0370-\u1dff\u1f00-\U0010ffff]")
_SCRIPT_STARTS = [a for a, _ in _SCRIPTS]
#: Nats by which a language has to be likelier than the next to be the instruction's, and than the instruction's to be the answer's; and by letter triple, for long texts.
CLEAR, OTHER, OTHER_PER_TRIPLE = 3.0, 4.0, 0.12
#: Triples rarer than one in so many are left out of the profiles, so there can be no more than this many for each language.
MOST_TRIPLES = 100_000
CACHED_WORDS = 300_000


_ROWS = re.compile(r"^[ \t]*\|.*$", re.M)


def words_in(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def script(words: list[str]) -> str | None:
    """The script of two thirds of the letters at least."""
    text = "".join(words)
    if not _BEYOND_LATIN.search(text):
        return "latin" if text else None
    seen: Counter[str] = Counter()
    for c, n in Counter(text).items():
        seen[_SCRIPTS[bisect_right(_SCRIPT_STARTS, ord(c)) - 1][1]] += n
    name, n = seen.most_common(1)[0]
    # Japanese is written in both.
    n += seen["kana"] if name == "han" else 0
    return name if 3 * n >= 2 * len(text) else None


def triples(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[k : k + 3] for k in range(len(padded) - 2)]


class Profiles:
    """Letter triples by language: how much likelier a text is in one language than in another."""

    def __init__(self, counts: dict[str, dict[str, int]]) -> None:
        self.languages = sorted(counts)
        every = {t for c in counts.values() for t in c}
        self.logs = {t: [0.0] * len(self.languages) for t in every}
        for k, lang in enumerate(self.languages):
            whole = sum(counts[lang].values()) + 0.5 * len(every)
            for t in every:
                self.logs[t][k] = math.log((counts[lang].get(t, 0) + 0.5) / whole)
        self.asked: dict[str, tuple[str | None, int | None]] = {}
        self.at: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.languages) + 1))

    def _add(self, word: str) -> int:
        if len(self.at) >= CACHED_WORDS:
            self.at.clear()
        k = self.at[word] = len(self.at)
        if k >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        known = [v for t in triples(word) if (v := self.logs.get(t)) is not None]
        self.table[k, :-1] = np.sum(known, axis=0) if known else 0.0
        self.table[k, -1] = len(known)
        return k

    def language_of(self, instruction: str) -> tuple[str | None, int | None]:
        """(script, number of the language) of an instruction, as far as they are clear; the same ones come again and again."""
        got = self.asked.get(instruction)
        if got is None:
            words, k = words_in(instruction), None
            if words and len(self.languages) > 1:
                ask, _ = self.scores(words)
                best = int(ask.argmax())
                k = best if ask[best] - np.partition(ask, -2)[-2] >= CLEAR else None
            got = script(words), k
            if len(self.asked) >= CACHED_WORDS // 10:
                self.asked.clear()
            self.asked[instruction] = got
        return got

    def scores(self, words: list[str]) -> tuple[np.ndarray, int]:
        """(log likelihood in each language, triples known)."""
        at = self.at
        if len(at) + len(words) > CACHED_WORDS:
            at.clear()
        rows = [k if (k := at.get(w)) is not None else self._add(w) for w in words]
        total = np.add.reduce(self.table.take(rows, 0), 0)
        return total[:-1], int(total[-1])


def is_other_language(instruction: str, output: str, profiles: Profiles) -> bool:
    """The answer is in another script or language than the instruction, and no translation is asked for."""
    answer = unlabelled(output)
    if not _CLOSED.search(answer):
        answer = answer.rpartition(" ")[0]  # the last word may be cut
    # Cells of a table are names, too few and too short to tell a language.
    got = words_in(_ROWS.sub(" ", answer) if "|" in answer else answer)
    if not got:
        return False
    ours, k = profiles.language_of(instruction)
    theirs = script(got)
    if ours and theirs and ours != theirs:
        return sum(map(len, got)) > 3 and not _TRANSLATION.search(instruction)
    if k is None:
        return False  # the instruction's language is not clear
    answered, n = profiles.scores(got)
    return bool(answered.max() - answered[k] > max(OTHER, OTHER_PER_TRIPLE * n)) and not _TRANSLATION.search(instruction)


def profile_counts(records: DataFrame, telling: dict[str, int], languages: list[str]) -> dict[str, dict[str, int]]:
    """Letter triples of the instructions and answers that common words tell: twice as many of one language as of any other, two at least.

    A short text that they do not tell counts for the language of the other half of
    its pair: most pairs are of one language, and the odd ones weigh little. Words are counted in batches and cut into triples once for each batch and
    word; what comes to the driver is bounded by ``MOST_TRIPLES``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in languages]

        def flush() -> pa.RecordBatch:
            rows = []
            for k, words in enumerate(seen):
                grams: Counter = Counter()
                for w, n in words.items():
                    for t in triples(w):
                        grams[t] += n
                rows += [(k, t, n) for t, n in grams.items()]
                words.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.int32(), pa.string(), pa.int64()))], names=["lang", "triple", "n"])

        def told(words: list[str]) -> int | None:
            votes = Counter([lang for w in words if (lang := telling.get(w)) is not None]).most_common(2)
            return votes[0][0] if votes and votes[0][1] > 1 and (len(votes) < 2 or votes[0][1] >= 2 * votes[1][1]) else None

        for b in batches:
            known: dict[str, tuple[list[str], int | None]] = {}
            for instruction, output in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ask, first = known.get(instruction or "") or known.setdefault(instruction or "", (w := words_in(instruction or ""), told(w)))
                answer = words_in(output or "")
                second = told(answer)
                for words, lang in ((ask, second if first is None else first), (answer, first if second is None else second)):
                    if lang is not None:
                        seen[lang].update(words)
            if sum(map(len, seen)) > 100_000:
                yield flush()
        yield flush()

    counted = written(records.select("instruction", "output").mapInArrow(run, "lang int, triple string, n long").groupBy("lang", "triple").agg(F.sum("n").alias("n")), "triples")
    least = counted.groupBy("lang").agg(F.greatest(F.lit(2), F.ceil(F.sum("n") / MOST_TRIPLES)).alias("least"))  # a row for each language
    out: dict[str, dict[str, int]] = {}
    for r in counted.join(F.broadcast(least), "lang").where("n >= least").select("lang", "triple", "n").collect():
        out.setdefault(languages[r["lang"]], {})[r["triple"]] = r["n"]
    return out


_CLOSED = re.compile(r"[.!?…。！？][\"'»”“’)\]*_`]*$")
_ITEM = re.compile(r"^\s*(?:[-*•–·]|\d{1,3}[.)])(?:\s+|$)")
_NUMBER = re.compile(r"[\W\d_]*\d[\d.,\s%€$°C]*[\W_]*$")
_PAD = "^ ^ "


def _tail(segment: str) -> str:
    segment = " ".join(segment.rsplit(None, 6)[-6:])
    return " ".join((_PAD + " ".join(w.lower() for w in re.findall(r"[^\W_]+|[%€$°]", segment))).split()[-3:])


def endings(text: str | None) -> list[str]:
    """The last three words of each closed sentence and of each list item that another line follows."""
    if not text:
        return []
    out = []
    lines = text.split("\n")
    for i, line in enumerate(lines):
        item = _ITEM.match(line)
        body = line[item.end() :] if item else line
        parts = re.split(r"(?<=[.!?…])[\"'»”’)]*\s+", body)
        for k, s in enumerate(parts):
            if k + 1 < len(parts) or _CLOSED.search(s.rstrip()) or item and i + 1 < len(lines) and lines[i + 1].strip():
                t = _tail(s)
                if not t.endswith("^"):
                    out.append(t)
    return out


def broken_off(output: str) -> tuple[bool, str | None]:
    """(whether the answer certainly breaks off, the last words that the corpus has to vouch for)."""
    text = output.rstrip()
    if text.count("```") % 2:
        return True, None
    lines = [x for x in text.split("\n") if x.strip()]
    last = lines[-1]
    if text.endswith("```"):
        return False, None
    if last.lstrip().startswith("|") and len(lines) > 1 and lines[-2].lstrip().startswith("|"):
        return not last.rstrip().endswith("|") or last.count("|") < lines[-2].count("|"), None
    if any(text.count(a) > text.count(b) for a, b in ("()", "[]", "{}", "«»")) and not re.search(r"[:;]-?\($", text):
        return True, None
    item = _ITEM.match(last)
    if item and not last[item.end() :].strip():
        return True, None
    if _CLOSED.search(text):
        return False, None
    if re.search(r"[,;:(\[{«„“–—\-/&]$", text):
        return True, None
    body = last[item.end() :] if item else last
    segment = re.split(r"(?<=[.!?…])[\"'»”’)]*\s+", body)[-1]
    if not item and len(lines) == 1 and segment == body and (len(_WORD.findall(body)) < 3 or _NUMBER.fullmatch(body)):
        return False, None  # a word or a number is an answer
    return False, _tail(segment)


def judge(instruction: str | None, given: str | None, output: str | None, profiles: Profiles) -> tuple[list[str], str | None]:
    """(defects that the record shows by itself, last words to be looked up)."""
    if instruction is None or not instruction.strip():
        return [], None  # a raw model reply answers nothing
    if is_empty(output):
        return ["empty"], None
    found = []
    if is_refusal(instruction, output):
        found.append("refusal")
    repeats = copied(instruction, given, output)
    if repeats == "copy":
        found.append("copy")
    if is_other_language(instruction, output, profiles):
        found.append("language")
    cut, tail = broken_off(output)
    if cut:
        found.append("truncated")
    return found + [ECHO] * (repeats == ECHO), tail


def pair_defects(records: DataFrame, common_words: DataFrame) -> DataFrame:
    """``record_id, defects``: every record with at least one defect, its defects in order.

    Records whose instruction is null or blank are none, whatever else they hold;
    a null output is empty, a null input is no input; repeated records are judged
    each; empty tables give no rows; without common words only scripts tell
    languages apart. The table of common words is one of
    settings: more than 100,000 rows are refused.
    """
    rows = common_words.select("lang", "word").where("lang IS NOT NULL AND word IS NOT NULL").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("common_words is not a table of settings")
    languages = sorted({r["lang"] for r in rows})
    pairs = {(r["word"].lower(), r["lang"]) for r in rows}
    held = Counter(w for w, _ in pairs)
    telling = {w: languages.index(lang) for w, lang in pairs if held[w] == 1}
    columns = records.select("record_id", "instruction", "input", "output")
    shared = records.sparkSession.sparkContext.broadcast(profile_counts(columns, telling, languages))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = _profiles(shared)
        for b in batches:
            got = [judge(i, n, o, profiles) for i, n, o in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([d for d, _ in got], pa.list_(pa.string())), pa.array([t for _, t in got], pa.string())], names=["record_id", "defects", "tail"])

    # Kept, for it is read twice; most records show nothing and are gone here.
    found = written(columns.mapInArrow(judged, "record_id long, defects array<string>, tail string").where("size(defects) > 0 OR tail IS NOT NULL"), "judged")
    asked = found.where("tail IS NOT NULL").select("record_id", "defects", "tail")
    tails = written(asked.select("tail").distinct(), "tails")
    few = {r["tail"] for r in tails.collect()} if small_enough(tails, BROADCAST_TAILS) else None
    wanted = records.sparkSession.sparkContext.broadcast(few)

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = {t for k in (0, 1) for text in b.column(k).to_pylist() for t in endings(text)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(seen if wanted.value is None else seen & wanted.value), pa.string())], names=["tail"])

    # Of the endings of the corpus those that some answer asks about, once each; the last words of many answers may be the same.
    known = columns.select("input", "output").mapInArrow(ended, "tail string").distinct().join(tails, "tail", "left_semi")
    known = written(known, "endings").withColumn("known", F.lit(True))
    known = F.broadcast(known) if few is not None else known
    cut = F.concat(F.filter("defects", lambda d: d != ECHO), F.array(F.lit("truncated")), F.filter("defects", lambda d: d == ECHO))
    looked_up = asked.join(known, "tail", "left").select("record_id", F.when(F.col("known") | F.array_contains("defects", "truncated"), F.col("defects")).otherwise(cut).alias("defects"))
    return found.where("tail IS NULL").select("record_id", "defects").unionByName(looked_up).where(F.size("defects") > 0)


_MADE: list = []


def _profiles(shared) -> Profiles:
    """One for each Python worker, made again for another broadcast."""
    counts = shared.value
    if not _MADE or _MADE[0] is not counts:
        _MADE[:] = [counts, Profiles(counts)]
    return _MADE[1]


def _defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_defects(table(spark, sf_dir, "alpaca_records", ["record_id", "instruction", "input", "output"]), table(spark, sf_dir, "common_words"))


def p5_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _defects(spark, sf_dir).select("record_id", F.explode("defects").alias("defect"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first defect of each broken record; an echo alone is none."""
    return _defects(spark, sf_dir).select("record_id", F.col("defects")[0].alias("defect")).where(F.col("defect") != ECHO)


QUERIES = {"p5_found": p5_found, "p5_defects": p5_defects}
SQL: dict[str, str] = {}
