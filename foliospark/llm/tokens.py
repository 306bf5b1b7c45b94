"""Token counts under public tokenizer files, whose path is a parameter.

Both counters work on segments cut before every space that follows a non-space.
The pre-tokenizer below cuts there too, so a text's count is the sum over its
segments, and segments repeat so much that a bounded cache answers most of them.
"""

from __future__ import annotations

import base64
import math
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache

#: Stands in for the run's ``cl100k_base``, whose file the machine lacks: byte-level BPE for many languages.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pre-tokenizer of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_SEGMENTS = 500_000
#: Rank offset of the unigram costs ``log(rank + offset)``: a vocabulary's ranks follow frequency, and frequency a power of the rank.
OFFSET = 200

_UNEVEN = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def segments(text: str) -> list[str]:
    """``text`` in pieces, each but the first beginning with a space; joined they give the text."""
    if _UNEVEN.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + w for w in rest]]


class _Counts(dict):
    """Segment -> tokens; emptied when full, so memory is bounded on any input."""

    def __init__(self, count: Callable[[str], int]) -> None:
        self.count = count

    def __missing__(self, segment: str) -> int:
        n = self.count(segment)
        if len(self) >= CACHED_SEGMENTS:
            self.clear()
        if len(segment) < 200:
            self[segment] = n
        return n


def counter(count: Callable[[str], int]) -> Callable[[Iterable[str | None]], list[int]]:
    """Counts of many texts; a null or empty text has none."""
    known = _Counts(count)

    def run(texts: Iterable[str | None]) -> list[int]:
        return [sum([known[s] for s in segments(t)]) if t else 0 for t in texts]

    return run


@lru_cache(maxsize=4)
def exact_counter(path: str = VOCABULARY) -> Callable[[Iterable[str | None]], list[int]]:
    """Exact counts; one tokenizer for each Python worker."""
    import tiktoken

    code = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    return counter(lambda s: len(code.encode_ordinary(s)))


class Trie:
    """A double-array trie of byte strings with a cost each.

    From state ``s`` byte ``b`` leads to ``base[s] + b``, if that slot's ``check``
    is ``s``; ``cost`` is infinite where no string ends.
    """

    def __init__(self, base: array, check: array, cost: array) -> None:
        self.base, self.check, self.cost = base, check, cost

    @classmethod
    def build(cls, costs: dict[bytes, float]) -> Trie:
        children: list[dict[int, int]] = [{}]
        ends = [math.inf]
        for word, value in costs.items():
            node = 0
            for b in word:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    ends.append(math.inf)
                node = nxt
            ends[node] = value
        size = 1024
        base, check, cost = array("i", [0]) * size, array("i", [-1]) * size, array("d", [math.inf]) * size
        check[0] = 0
        slot_of, first_free, from_here = {0: 0}, 1, 1
        queue = [0]
        for node in queue:
            keys = children[node]
            if not keys:
                continue
            slot, low = slot_of[node], min(keys)
            while first_free < size and check[first_free] >= 0:
                first_free += 1
            # A single child takes the first free slot; several search on from where the ground was last found dense.
            began = at = max(first_free if len(keys) == 1 else max(first_free, from_here), low + 1)
            taken = 0
            while True:
                if at + 256 >= size:
                    base.extend([0] * size), check.extend([-1] * size), cost.extend([math.inf] * size)
                    size = len(check)
                if check[at] >= 0:
                    taken += 1
                elif all(check[at - low + b] < 0 for b in keys):
                    break
                at += 1
            if len(keys) > 1 and at - began > 64 and taken >= 0.9 * (at - began):
                from_here = at
            elif at - began > 512:
                from_here = max(from_here, at - 256)
            base[slot] = at - low
            for b, child in keys.items():
                check[at - low + b] = slot
                slot_of[child] = at - low + b
                cost[at - low + b] = ends[child]
                queue.append(child)
        return cls(base, check, cost)

    def best_path_length(self, raw: bytes) -> int:
        """Strings on the cheapest segmentation of ``raw``; a byte that is no string counts one at a cost above all."""
        n = len(raw)
        base, check, cost, size = self.base, self.check, self.cost, len(self.check)
        total, count = [0.0] + [math.inf] * n, [0] * (n + 1)
        for i in range(n):
            here, more, state = total[i], count[i] + 1, 0
            for j in range(i, n):
                nxt = base[state] + raw[j]
                if nxt >= size or check[nxt] != state or not nxt:
                    break
                state = nxt
                if here + cost[state] < total[j + 1]:
                    total[j + 1], count[j + 1] = here + cost[state], more
            if total[i + 1] == math.inf:
                total[i + 1], count[i + 1] = here + 1e6, more
        return count[n]


@lru_cache(maxsize=4)
def trie_of(path: str = VOCABULARY) -> Trie:
    """The trie of a vocabulary of ranks, with unigram costs that follow Zipf's law."""
    return Trie.build({word: math.log(rank + OFFSET) for word, rank in read_ranks(path).items()})


#: How segments are normalised before they are looked up: a letter counts alike however it is composed. Compatibility forms would count what a byte-level tokenizer never sees (garbled text came out 13 % too long).
FORM = "NFC"


@lru_cache(maxsize=4)
def viterbi_counter(path: str = VOCABULARY, form: str | None = FORM) -> Callable[[Iterable[str | None]], list[int]]:
    """Estimated counts: best path lengths of normalised segments, computed once for each distinct run of letters, digits or signs."""
    import regex

    trie, runs = trie_of(path), regex.compile(PATTERN)
    known = _Counts(lambda run: trie.best_path_length(run.encode("utf-8", "surrogatepass")))
    normal = (lambda s: s) if form is None else (lambda s: s if s.isascii() else unicodedata.normalize(form, s))
    return counter(lambda s: sum([known[run] for run in runs.findall(normal(s))]))
