"""Problem 6: the noise of scanned pages.

A page is taken apart into lines; page numbers and running headers go; the rest
is one stream of characters from which line ends are taken out and stay only as
marks, like the blanks. A lattice over the characters decides the words: its
edges are the words of the corpus, spelled as they stand or through confusions
of look-alike signs, across any number of blanks, line ends and hyphens, and
ending with or without a blank after them. So splits, merges, confusions and
hyphens are weighed together, and there is no limit on how many of them a word
may have. Words cost by their frequency in the corpus, every repair costs
extra, so a rare sound word is not bent into a common one without reason. A
second dynamic programme over the lines puts the paragraph boundaries.

Most of a page is sound. Words start at a position only where an edge other
than the token as it stands can begin there: at tokens that are unknown or
better read otherwise, at hyphens, at tokens that together make a word, and at
tokens before those from which a word can lead up to them (its beginning is
looked up).
Of the edges those are left out whose least possible cost is no less than what
the stream costs as it stands up to where they could end. Neither leaves out an
edge of the best path.

The word frequencies are counted over all fragments. Only words of at least
``total / MOST_WORDS`` occurrences are used, so there can be no more than
``MOST_WORDS`` of them, and they are broadcast; with what rarer words cost they
stand as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.storage import small_enough, table, written

MOST_WORDS = 300_000
LEAST_COUNT = 3
#: Most pages with returning headers whose keys are broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 300_000
#: Costs in nats: a confusion, a gap inside a word, one between single letters, words run together (the first in a token and each after).
CONFUSED, SPLIT, SPACED, MERGED, MERGED_AGAIN = 5.0, 6.0, 2.0, 9.0, 3.0
#: Of a part of run-together words that has one letter, or two.
SHORT_PART = {1: 12.0, 2: 4.0}
#: Of an unknown word: a letter, a sign that no word has; at least so much if it was hyphenated; of a hyphen that stays at its line's end.
LETTER, ODD, HYPHENATED, HYPHEN_KEPT = 1.25, 5.0, 6.0, 4.0
CACHED_WORDS = 200_000

# What scanning makes of letters, as read -> as printed.
CONFUSIONS = (
    ("c", "e"), ("@", "a"), ("¡", "i"), ("0", "o"), ("†", "t"), ("1", "l"), ("1", "i"), ("cl", "d"), ("9", "g"), ("vv", "w"), ("rn", "m"), ("m", "rn"), ("l", "i"), ("i", "l"), ("li", "h"), ("h", "li"), ("ii", "u"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"),
    ("5", "s"), ("$", "s"), ("8", "b"), ("6", "b"), ("3", "e"), ("|", "l"), ("!", "l"), ("e", "c"), ("d", "cl"), ("nn", "m"), ("f", "t"), ("€", "e"), ("q", "g"),
    ("0", "о"), ("п", "н"), ("н", "и"), ("л", "п"), ("4", "ч"), ("6", "б"), ("3", "з"), (">к", "ж"), ("lo", "ю"), ("ьl", "ы"), ("ьi", "ы"), ("и", "н"), ("ш", "щ"), ("o", "о"), ("a", "а"), ("e", "е"), ("c", "с"), ("p", "р"), ("x", "х"),
)

_WORD = re.compile(r"[^\W\d_]+(?:[’'\-][^\W\d_]+)*")
_CODE = re.compile(r"[^\W\d_]{2}-\w*\d\w*$|[^\w]*[\d.,:/%€$°-]+[^\w]*$")
_ODD = re.compile(r"[^\W_a-zа-яёß-ɏ]|[^\w’'\-]|_|[ﬀ-ﬄ]")
_SIGNS = ".,;:!?…“”„«»()[]\"'‚‘—–"
_HYPHEN = "-‐‑¬­"
_ROMAN = re.compile(r"[ivxl]{1,6}$")
_NUMERAL = re.compile(r"(c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$")
_ROMAN_VALUES = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
_PAGE_WORD = r"(?:page|seite|página|pagina|strona|страница|стр|pag|p|s|с|str|pg)"
#: Digits as scanned: 1 as l, I or |; 0 as O or o.
_D = r"[\dlIOo|]"
_PAGE_LABELLED = re.compile(rf"[^\w]*{_PAGE_WORD}\.?\s+{_D}{{1,5}}(?:\s*(?:/|of|von|de|sur|z|из)\s*{_D}{{1,5}})?[^\w]*$", re.I)
_PAGE_SET = re.compile(r"(?:\[\s*\d{1,5}\s*\]|([-–—•·*~])\s*\d{1,5}\s*\1|\d{1,5}\s*/\s*\d{1,5})$")
_PAGE_CODE = re.compile(rf"(?:{_D}{{1,5}}\s+\|\s+[^\W\d_]{{2}}-\w*\d\w*|[^\W\d_]{{2}}-\w*\d\w*\s+\|\s+{_D}{{1,5}})$")
_HEADER = re.compile(r"(?:\d{1,5}\s{1,4})?[^\W\d_][^.!?:;]{0,60}?\s[/|·–]\s[^.!?:;]{1,60}?\s[^\W_]{2}-\w{0,5}\d\w{0,5}(?:\s{2,}\d{1,5})?$")
_NUMBERED = re.compile(r"\d{1,3}(?:\.\d{1,3})*[.)]\s")
_ENDED = re.compile(r"[.!?…:][\"'»”’)\]]*$")


def counted_words(text: str | None) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)] if text else []


def header_key(line: str) -> str:
    """A line without page numbers at its ends, case and spacing: the same on each page."""
    return " ".join(re.sub(r"^\d{1,5}\s+(?=\D)|\s{2,}\d{1,5}$", "", line.strip()).lower().split())


def header_candidates(text: str | None) -> list[str]:
    """Keys of lines that could be running headers: short, no sentence end, a capital first, nothing that flows on.

    Within a page, where headings stand too, the line has to be at a page break:
    beside a page number, or in the middle of a sentence.
    """
    if not text:
        return []
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    n = len(lines)
    width, out = max(map(len, lines), default=0), []
    for i, line in enumerate(lines):
        if n < 3:
            break
        if not line[0].isalnum() or _ENDED.search(line) or line[-1] in _HYPHEN + "," or _NUMBERED.match(line):
            continue
        words = _WORD.findall(line)
        if len(words) < 2 or not words[0][0].isupper():
            continue
        if 2 <= i < n - 2:
            numbered = any(is_page_number(lines[k], True) for k in (i - 1, i + 1))
            # The first word below would have had room here, so no wrapping ended this line.
            if len(line) + 1 + len(lines[i + 1].split()[0]) > width or not (numbered or _runs_on(lines[i - 1], lines[i + 1], width)):
                continue
        else:
            if i + 1 < n and not lines[i + 1][0].isupper():
                continue
            if i and not (_ENDED.search(lines[i - 1]) or is_page_number(lines[i - 1], True)) and not line.isupper():
                continue
        out.append(header_key(line))
    return out


def _runs_on(before: str, after: str, width: int) -> bool:
    """A sentence goes on from the one line to the other: it is open, and the first line is full or ends in a hyphen."""
    if _ENDED.search(before) or _row(before) or _row(after) or len(before.split()) < 2:
        return False
    # Lines of few words may be cells.
    return before[-1] in _HYPHEN or (len(before.split()) > 3 or len(before) > 30) and len(before) + 1 + len(after.split()[0]) > width


def number_value(line: str) -> int | None:
    """Of a line that is only a number of up to five digits or a Roman numeral."""
    if line.isdecimal() and len(line) < 6:
        return int(line)
    low = line.lower()
    if not line or line not in (low, low.upper()) or not _NUMERAL.match(low):
        return None
    values = [_ROMAN_VALUES[c] for c in low]
    return sum(-v if v < w else v for v, w in zip(values, [*values[1:], 0]))


def inner_page_numbers(lines: list[str], page: str | None, repeated: frozenset[str]) -> set[int]:
    """Indices of the bare numbers within ``lines`` (stripped, none blank) that are page numbers, as their surroundings tell.

    Wrapping leaves a number alone only if the next word has no room beside it.
    Other bare numbers are page numbers where a sentence runs on over them, or
    where they follow a closed sentence and go with the page's own number; an
    enumeration whose numbers stand alone is none.
    """
    values = {i: v for i, x in enumerate(lines) if 2 <= i < len(lines) - 2 and (v := number_value(x)) is not None}
    if not values:
        return set()
    noise = {i for i, x in enumerate(lines) if i in values or is_page_number(x, False) or is_header(x, repeated)}
    text = [x for i, x in enumerate(lines) if i not in noise]
    width = max(map(len, text), default=0)
    own = int(page) if page and page.strip().isdecimal() else None
    out, closed = set(), []
    for i, value in values.items():
        if i - 1 in values or i + 1 in values:  # a column of figures
            continue
        before = next((lines[k] for k in range(i - 1, -1, -1) if k not in noise), None)
        after = next((lines[k] for k in range(i + 1, len(lines)) if k not in noise), None)
        if before is None or after is None or len(lines[i]) + 1 + len(after.split()[0]) > width:
            continue
        fits = own is not None and 0 <= value - own <= 1 + len(out) + len(closed)
        # An open sentence in a line that is nearly full: words differ in length, and scanning changes them.
        is_open = not _ENDED.search(before) and not _row(before) and len(before.split()) > 3
        if _runs_on(before, after, width) or is_open and (len(before) > 0.72 * width) + fits + after[0].islower() > 1:
            out.add(i)
        elif _ENDED.search(before) and (fits or own is None and len(after) > 0.72 * width and not after[0].islower()):
            closed.append(i)
    found = [values[i] for i in closed]
    every = [v for x in lines if (v := number_value(x)) is not None]
    enumerated = len(every) > 2 and every == list(range(1, 1 + len(every)))
    if not enumerated and (len(found) == 1 or found and found[0] > 1 and found == list(range(found[0], found[0] + len(found)))):
        # Numbers of an enumeration that are not next to the page's own are in ``values`` too.
        if sum(bool(_ENDED.search(lines[i - 1])) for i in values) == len(found):
            out.update(closed)
    return out


def is_page_number(line: str, edge: bool) -> bool:
    s = line.strip()
    if not s:
        return False
    if _PAGE_LABELLED.match(s) or _PAGE_SET.match(s) or _PAGE_CODE.match(s):
        return True
    return edge and (s.isdigit() and len(s) < 6 or bool(_ROMAN.match(s)))


def is_header(line: str, repeated: frozenset[str]) -> bool:
    s = line.strip()
    if not s or _NUMBERED.match(s):
        return False
    return bool(_HEADER.match(s)) or bool(repeated) and header_key(s) in repeated


_BY_SIGN: dict[str, list[tuple[str, str]]] = {}
for _read, _printed in CONFUSIONS:
    _BY_SIGN.setdefault(_read[0], []).append((_read, _printed))

Edge = tuple[int, str, tuple[str, ...]]  # (where it begins, what is printed, the repairs)


class Decoder:
    """Word costs and the lattice. ``counts`` has lower-case words; ``total`` all occurrences."""

    def __init__(self, counts: dict[str, int], total: int) -> None:
        self.logs = math.log(max(total, 2))
        self.cost = {w: self.logs - math.log(n) for w, n in counts.items()}
        # Of each beginning of a word the least cost of a word that begins so, and the most letters it can still have.
        self.low: dict[str, float] = {}
        self.more: dict[str, int] = {}
        self.least = min(self.cost.values(), default=0.0)
        self.longest = max(map(len, self.cost), default=0)
        for w, c in self.cost.items():
            n = len(w)
            for k in range(1, n + 1):
                p = w[:k]
                if c < self.low.get(p, math.inf):
                    self.low[p] = c
                if n - k > self.more.get(p, -1):
                    self.more[p] = n - k
        self.known: dict[str, tuple[float, str, tuple[str, ...], bool]] = {}
        self.seen: dict[str, tuple] = {}

    def price(self, word: str) -> float:
        """Of a lower-case word as it stands; letters of an unknown one cost, signs that no word has cost more."""
        got = self.cost.get(word)
        return got if got is not None else self.logs + LETTER * len(word) + ODD * len(_ODD.findall(word))

    def alone(self, core: str) -> tuple[float, str, tuple[str, ...], bool]:
        """(cost, what is printed, repairs, whether it is a sound word) of the best path through one token without its signs."""
        got = self.known.get(core)
        if got is not None:
            return got
        low = _lower(core)
        known = low in self.cost
        if known and (len(core) < 3 or self.cost[low] <= CONFUSED + self.least):
            out = (self.cost[low], core, (), True)
        elif not _lettered(core) or len(core) < 2 or len(core) < 3 and _WORD.fullmatch(low):
            out = (self.price(low), core, (), known or not _lettered(core))
        else:
            total, back = self._lattice(core, low, {}, [0, len(core)], [self.price(low)], {0})
            words, kinds = _path(back, len(core))
            out = (total, " ".join(w for w, _ in words), kinds, known and not kinds)
        if len(self.known) >= CACHED_WORDS:
            self.known.clear()
        self.known[core] = out
        return out

    def _lattice(self, source: str, low: str, gaps: dict[int, str], ends: list[int], prices: list[float], active: set[int], printed: list[Edge] | None = None) -> tuple[float, list[Edge]]:
        """Cost of the best path over ``low`` and its edges by where they end.

        ``gaps`` has what stood at a position in the source: a blank, a line feed
        or the hyphen of a line's end. ``ends`` are the tokens' bounds, ``prices``
        what each costs by itself and ``printed`` how that is printed; words are
        looked for at the ``active`` bounds and wherever a word has ended.
        """
        n = len(low)
        total = [math.inf] * (n + 1)
        total[0] = 0.0
        back: list[Edge] = [(0, "", ())] * (n + 1)
        # What the stream costs as it stands up to each bound; at other positions, up to the next.
        stands, bound_at, sums = [0.0] * (n + 1), [0] * (n + 1), 0.0
        for k, c in enumerate(prices):
            sums += c + (HYPHEN_KEPT if gaps.get(ends[k + 1], " ") in _HYPHEN else 0.0)
            for at in range(ends[k] + 1, ends[k + 1] + 1):
                stands[at], bound_at[at] = sums, ends[k + 1]
        token_at = {e: k for k, e in enumerate(ends)}
        cost, least_of, more = self.cost, self.low, self.more
        for i in range(n):
            here = total[i]
            if here == math.inf:
                continue
            k = token_at.get(i)
            if k is not None:
                stop = ends[k + 1]
                hyphen = gaps.get(stop, "")
                kept = hyphen != "" and hyphen in _HYPHEN
                c = here + prices[k] + (HYPHEN_KEPT if kept else 0.0)
                if c < total[stop]:
                    _, text, kinds = printed[k] if printed else (i, source[i:stop], ())
                    total[stop], back[stop] = c, (i, text + (hyphen if kept and hyphen in "-‐‑" else ""), kinds)
                if kept and k + 2 < len(ends):
                    # An unknown word may be hyphenated too.
                    after = ends[k + 2]
                    if (hyphen != "-" or source[stop].islower()) and gaps.get(after, " ") not in _HYPHEN:
                        c = here + min(self.price(low[i:after]), self.logs + HYPHENATED)
                        if c < total[after]:
                            total[after], back[after] = c, (i, source[i:after], ("hyphen",))
                if i not in active:
                    continue
            # Words that begin here: (position, letters so far, extra cost, repairs).
            heap: list[tuple[int, str, float, tuple[str, ...]]] = [(i, "", here, ())]
            while heap:
                at, word, spent, kinds = heap.pop()
                gap = gaps.get(at) if at > i else None
                if word and (c := cost.get(word)) is not None:
                    whole = spent + c
                    extra = kinds
                    if at < n and gap is None:
                        # Run together with what follows; a second cut in the same token is likelier than the first.
                        cut_before = i not in token_at
                        whole += (MERGED_AGAIN if cut_before else MERGED) + SHORT_PART.get(at - i, 0.0)
                        extra = (*kinds, "misread")
                    elif gap is not None and gap in _HYPHEN:
                        whole += HYPHEN_KEPT
                    if i not in token_at and (at == n or gap is not None):
                        whole += SHORT_PART.get(at - i, 0.0)
                    if whole < total[at]:
                        text = _cased(word, source[i:at]) if kinds else source[i:at]
                        if gap is not None and gap in "-‐‑":
                            text += gap
                        total[at], back[at] = whole, (i, text, extra)
                if at == n:
                    continue
                if gap is not None:
                    if gap not in _HYPHEN:
                        spent += SPACED if at - 1 in token_at and at + 1 in token_at else SPLIT
                        kinds = kinds if "split" in kinds else (*kinds, "split")
                    elif gap == "-" and not source[at].islower():
                        continue
                    else:
                        kinds = (*kinds, "hyphen")
                steps = [(low[at], low[at], 0.0, kinds)]
                for read, to in _BY_SIGN.get(low[at], ()):
                    if low.startswith(read, at):
                        misread = kinds if "misread" in kinds else (*kinds, "misread")
                        within = [gaps[x] for x in range(at + 1, at + len(read)) if x in gaps] if len(read) > 1 else ()
                        # A gap within the signs that were misread is one within the word.
                        steps.append((read, to, CONFUSED + SPLIT * sum(g not in _HYPHEN for g in within), (*misread, *("hyphen" if g in _HYPHEN else "split" for g in within))))
                for read, to, more_cost, found in steps:
                    longer = word + to
                    least = least_of.get(longer)
                    if least is None:
                        continue
                    reached = at + len(read)
                    # As far as the word can reach, signs read as two letters counted: no use if it costs what stands there.
                    far = min(n, reached + 2 * more[longer])
                    if spent + more_cost + least >= stands[far] or spent + more_cost + least >= total[bound_at[far]]:
                        continue
                    heap.append((reached, longer, spent + more_cost, found))
        return total[n], back

    def decode(self, tokens: list[str], glued: list[str]) -> tuple[list[tuple[str, int]], Counter]:
        """Best path over ``tokens``.

        ``glued[i]`` is what stood between token i and the next: a space, a line
        feed, or the hyphen at the end of a line. Gives (text, index of the
        first token) of every word, and the repairs by kind.
        """
        n = len(tokens)
        seen = self.seen
        parts = [seen.get(t) or self._seen(t) for t in tokens]
        alone = [p[4] for p in parts]
        # Whether the word may go on from a token into the next: both of letters, and no sign between.
        joins = [p[5] and q[6] for p, q in zip(parts, parts[1:])] + [False]
        active = self._active(parts, alone, joins, glued)
        out: list[tuple[str, int]] = []
        kinds: Counter = Counter()
        a = 0
        while a < n:
            b = a + 1
            while joins[b - 1]:
                b += 1
            if any(active[a:b]):
                self._stretch(a, b, parts, alone, glued, active, out, kinds)
            else:
                for i in range(a, b):
                    pre, _, post = parts[i][:3]
                    out.append((pre + alone[i][1] + (glued[i] if glued[i] in "-‐‑" else "") + post, i))
                    kinds.update(alone[i][2])
            a = b
        return out, kinds

    def _seen(self, token: str) -> tuple:
        """(signs before, core, signs after, the core in lower case, its best path alone, whether a word may go on after it, and lead into it)."""
        pre, core, post = _parts(token)
        lettered = bool(core) and _lettered(core)
        got = (pre, core, post, _lower(core), self.alone(core) if core else (0.0, "", (), True), lettered and not post, lettered and not pre)
        if len(self.seen) >= CACHED_WORDS:
            self.seen.clear()
        self.seen[token] = got
        return got

    def _active(self, parts: list, alone: list, joins: list[bool], glued: list[str]) -> list[bool]:
        n = len(parts)
        active = [False] * n
        low = self.low
        for i in range(n):
            if not joins[i]:
                if not (i and joins[i - 1]) or alone[i][3]:
                    continue
            elif not alone[i][3] or not alone[i + 1][3] or glued[i] in _HYPHEN:
                active[i] = True
            elif (word := parts[i][3] + parts[i + 1][3]) in low:
                # Sound tokens that together make a word.
                k, apart = i + 1, alone[i][0] + alone[i + 1][0]
                while True:
                    c = self.cost.get(word)
                    if c is not None and c + (SPACED if len(word) == k - i + 1 else SPLIT) * (k - i) < apart:
                        active[i] = True
                        break
                    if not joins[k] or (word := word + parts[k + 1][3]) not in low:
                        break
                    k += 1
                    apart += alone[k][0]
            if active[i] or i and joins[i - 1] and not alone[i][3]:
                # Tokens before from which a word can lead up to here.
                k, before = i - 1, ""
                while k >= 0 and joins[k] and len(before) <= self.longest:
                    before = parts[k][3] + before
                    if before in self.low:
                        active[k] = True
                    k -= 1
        return active

    def _stretch(self, a: int, b: int, parts: list, alone: list, glued: list[str], active: list[bool], out: list, kinds: Counter) -> None:
        """Decode the tokens from a to b, between which words may go on."""
        source = "".join(parts[i][1] for i in range(a, b))
        low = _lower(source)
        ends, gaps = [0], {}
        for i in range(a, b):
            ends.append(ends[-1] + len(parts[i][1]))
            gaps[ends[-1]] = glued[i]
        last = gaps.pop(ends[-1])
        if last in _HYPHEN:
            gaps[ends[-1]] = last  # it stays
        total, back = self._lattice(source, low, gaps, ends, [alone[i][0] for i in range(a, b)], {ends[i - a] for i in range(a, b) if active[i]}, [(0, alone[i][1], alone[i][2]) for i in range(a, b)])
        words, found = _path(back, len(source))
        kinds.update(found)
        at_end = {e: a + k - 1 for k, e in enumerate(ends) if k}
        first = {e: a + k for k, e in enumerate(ends[:-1])}
        token = a
        for (text, i), stop in zip(words, [*[i for _, i in words[1:]], len(source)]):
            token = first.get(i, token)
            pre = parts[first[i]][0] if i in first else ""
            post = parts[at_end[stop]][2] if stop in at_end else ""
            if i in first or not out:
                out.append((pre + text + post, token))
            else:
                out.append((text + post, -1))  # parted from the word before within its token


def _path(back: list[Edge], n: int) -> tuple[list[tuple[str, int]], tuple[str, ...]]:
    """((text, where it begins) of each word, all repairs) of the best path."""
    words: list[tuple[str, int]] = []
    kinds: list[str] = []
    at = n
    while at:
        i, text, found = back[at]
        words.append((text, i))
        kinds += found
        at = i
    return words[::-1], tuple(kinds[::-1])


def _lower(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x) == 1 else c for c in text for x in (c.lower(),))


def _cased(word: str, like: str) -> str:
    letters = [c for c in like if c.isalpha()]
    if len(letters) > 1 and sum(c.isupper() for c in letters) > 0.6 * len(letters):
        return word.upper()
    return word[:1].upper() + word[1:] if like[:1].isupper() else word


def _lettered(core: str) -> bool:
    """Holds a letter and is no code or figure."""
    return core.isalpha() or any(c.isalpha() for c in core) and not _CODE.match(core)


def _parts(token: str) -> tuple[str, str, str]:
    core = token.lstrip(_SIGNS)
    pre = token[: len(token) - len(core)]
    bare = core.rstrip(_SIGNS)
    return pre, bare, core[len(bare) :]


def _row(line: str) -> bool:
    return line.count(" | ") > 1


def paragraph_starts(lines: list[str], blank_before: list[bool]) -> list[int]:
    """Indices of the lines that begin a paragraph, by dynamic programming over the lines.

    A boundary costs more the less speaks for it: a sentence closed before it,
    a capital after it, a line short of the width, a blank line. Running on
    costs more the more speaks against it. Short paragraphs cost a little.
    """
    n = len(lines)
    if not n:
        return []
    width = sorted(map(len, lines))[int(0.9 * (n - 1))] or 1
    cut, run = [0.0] * n, [0.0] * n
    for i in range(1, n):
        closed, capital = bool(_ENDED.search(lines[i - 1])), not lines[i][:1].islower()
        short = len(lines[i - 1]) < 0.72 * width
        cut[i] = 2.5 + (0.0 if closed else 3.0) + (0.0 if capital else 3.0) - (1.5 if short and closed else 0.0) - (6.0 if blank_before[i] else 0.0)
        run[i] = (5.0 if blank_before[i] else 0.0) + (2.5 if short and closed else 0.8 if short else 0.0)
        if _row(lines[i]) or _row(lines[i - 1]):
            cut[i] -= 12.0
        if _NUMBERED.match(lines[i]) or _NUMBERED.match(lines[i - 1]) and len(lines[i - 1]) < 0.8 * width and not closed:
            cut[i] -= 4.0
    # The best way up to line i if it begins a paragraph, and if it goes on with one; a paragraph of one line costs a little.
    begun, going, goes_back = [0.0] * n, [math.inf] * n, [False] * n
    for i in range(1, n):
        ended = min(begun[i - 1] + 0.5, going[i - 1])
        goes_back[i] = begun[i - 1] + 0.5 <= going[i - 1]  # the paragraph that ends before a beginning at i has one line
        begun[i] = ended + cut[i]
        going[i] = min(begun[i - 1], going[i - 1]) + run[i]
    starts, i, begins = [], n - 1, begun[n - 1] + 0.5 <= going[n - 1]
    while True:
        if begins:
            starts.append(i)
            if not i:
                return starts[::-1]
            begins = goes_back[i]
        else:
            begins = begun[i - 1] <= going[i - 1]
        i -= 1


def repair(text: str, decoder: Decoder, repeated: frozenset[str], page: str | None = None) -> tuple[str, Counter]:
    """(continuous text, repairs by kind: page, header, hyphen, split, misread). ``page``: the page's own number, if it is known."""
    kinds: Counter = Counter()
    raw = text.split("\n")
    filled = [i for i, x in enumerate(raw) if x.strip()]
    edges = {*filled[:2], *filled[-2:]} if len(filled) > 1 else set()
    inner = {filled[k] for k in inner_page_numbers([raw[i].strip() for i in filled], page, repeated)}
    lines: list[str] = []
    blank: list[bool] = []
    gap = False
    for i, x in enumerate(raw):
        s = x.strip(" \t\r\f\v ")
        if not s:
            gap = True
        elif i in inner or is_page_number(s, i in edges):
            kinds["page"] += 1
        elif len(filled) > 1 and is_header(s, repeated):
            kinds["header"] += 1
        else:
            lines.append(s)
            blank.append(gap and bool(lines))
            gap = False
    tokens: list[str] = []
    glued: list[str] = []
    first: list[int] = []
    for line in lines:
        first.append(len(tokens))
        words = line.split()
        last = words[-1]
        glue = "\n"
        if len(last) > 1 and last[-1] in _HYPHEN and last[-2].isalpha():
            glue, words[-1] = last[-1], last[:-1]
        tokens += words
        glued += [" "] * (len(words) - 1) + [glue]
    if not tokens:
        return "", kinds
    decoded, found = decoder.decode(tokens, glued)
    kinds.update(found)
    starts = {first[k]: "\n" if k and _row(lines[k]) and _row(lines[k - 1]) else "\n\n" for k in paragraph_starts(lines, blank)}
    out: list[str] = []
    for word, at in decoded:
        if at in starts and out:
            out.append(starts[at])
        elif out and (at < 0 or out[-1][-1:] not in "-‐‑" or glued[at - 1] not in _HYPHEN):
            out.append(" ")
        out.append(word)
    return "".join(out), kinds


def word_counts(fragments: DataFrame) -> tuple[dict[str, int], int]:
    """Frequent words of all fragments with their counts, at most ``MOST_WORDS``, and the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])
            seen.clear()
            return out

        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(counted_words(text))
            if len(seen) > 200_000:
                yield flush()
        yield flush()

    counts = written(fragments.select("text").where("text IS NOT NULL").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_COUNT, -(-total // MOST_WORDS))
    return {r["word"]: r["n"] for r in counts.where(F.col("n") >= least).collect()}, total


def repaired_pages(fragments: DataFrame) -> DataFrame:
    """``fragment_id, text, pages, headers, hyphens, splits, misread`` of every fragment of a PDF file: its text repaired, its repairs by kind.

    Null texts and paths give no row; a text of noise only comes out empty; a
    text of any length is read whole; repeated deliveries are repaired each; a
    running header seen on one page only is known by its form, others by their
    return on pages of the same file.
    """
    spark = fragments.sparkSession
    pages = fragments.select("fragment_id", F.col("metadata.source_path").alias("path"), F.col("metadata.page_or_section").alias("page"), "text").where("lower(metadata.source_path) LIKE '%.pdf' AND text IS NOT NULL")
    counts, total = word_counts(fragments)
    shared = spark.sparkContext.broadcast((counts, total))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(set(header_candidates(t))) for t in b.column(3).to_pylist()]
            at = pa.array([i for i, ks in enumerate(found) for _ in ks], pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(at) for k in (0, 1, 2)], pa.array([k for ks in found for k in ks], pa.string())], names=["fragment_id", "path", "page", "key"])

    seen = written(pages.mapInArrow(candidates, "fragment_id long, path string, page string, key string"), "headers")
    # Two pages at least; deliveries of one page count once.
    keys = seen.select("path", "page", "key").distinct().groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1")
    # The keys of a page are lines of it, so a file of any number of pages brings no large row.
    per_page = written(seen.join(keys, ["path", "key"]).groupBy("fragment_id").agg(F.collect_set("key").alias("keys")), "returning")
    per_page = F.broadcast(per_page) if small_enough(per_page, BROADCAST_ROWS) else per_page

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(shared)
        for b in batches:
            made = [repair(t, decoder, frozenset(ks or ()), page) for t, ks, page in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([t for t, _ in made], pa.string()), *[pa.array([k[x] for _, k in made], pa.int32()) for x in ("page", "header", "hyphen", "split", "misread")]],
                names=["fragment_id", "text", "pages", "headers", "hyphens", "splits", "misread"],
            )

    rows = pages.join(per_page, "fragment_id", "left").select("fragment_id", "text", "keys", "page")
    return rows.mapInArrow(run, "fragment_id long, text string, pages int, headers int, hyphens int, splits int, misread int")


_MADE: list = []


def _decoder(shared) -> Decoder:
    """One for each Python worker, made again for another broadcast."""
    counts, total = shared.value
    if not _MADE or _MADE[0] is not counts:
        _MADE[:] = [counts, Decoder(counts, total)]
    return _MADE[1]


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_pages(table(spark, sf_dir, "fragments", ["fragment_id", "text", "metadata"]))


def p6_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fragments in which the operator repaired anything; joining wrapped lines is no repair."""
    return _repaired(spark, sf_dir).where("pages + headers + hyphens + splits + misread > 0").select("fragment_id")


QUERIES = {"p6_found": p6_found, "p6_repaired": p6_repaired}
SQL: dict[str, str] = {}
