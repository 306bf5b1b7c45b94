import math
from collections import Counter

import pytest

from foliospark.llm import scan_repair as S

SOUND = "The night operator measures the delivery note. The shift lead updates the shared calendar. The supplier’s quotation is with the front desk. Der Empfang prüft den Vertrag. Ночной оператор хранит запасной набор."
COUNTS = Counter(S.counted_words(SOUND * 400))
D = S.Decoder(COUNTS, sum(COUNTS.values()) * 5)


def fixed(text, repeated=()):
    out, kinds = S.repair(text, D, frozenset(repeated))
    return out, dict(kinds)


@pytest.mark.parametrize(
    ("text", "want", "kind"),
    [
        ("The night opera-\ntor measures the note.", "The night operator measures the note.", "hyphen"),
        ("The night opera¬\ntor measures.", "The night operator measures.", "hyphen"),
        ("The sup­\nplier’s quotation.", "The supplier’s quotation.", "hyphen"),
        ("the shared calen‐ \ndar", "the shared calendar", "hyphen"),
        ("The nlght 0perator mcasures the n0te.", "The night operator measures the note.", "misread"),
        ("The shif† le@d upclates the calenclar.", "The shift lead updates the calendar.", "misread"),
        ("DELlVERY with Vertra9.", "DELIVERY with Vertrag.", "misread"),
        ("Ночной опера†ор", "Ночной опера†ор", None),
        ("Ночной 0ператор храпит", "Ночной оператор хранит", "misread"),
        ("the deli very note", "the delivery note", "split"),
        ("the d e l i v e r y note.", "the delivery note.", "split"),
        ("the quo ta tion", "the quotation", "split"),
        ("nightoperator", "night operator", "misread"),
        ("the no te and", "the note and", "split"),
        ("qu ot at ion", "quotation", "split"),
        ("nightoperatorcalendarquotation", "night operator calendar quotation", "misread"),
        ("the qu0†ati0n and sha/ed", "the quotation and sha/ed", "misread"),
        ("up cla tes", "updates", None),
        ("the opera-\nt0r", "the operator", None),
        ("nightope rator", "night operator", None),
        ("d e l\ni v e r y", "delivery", "split"),
        ("the shared calenc-\nlar", "the shared calendar", None),
    ],
)
def test_repairs(text, want, kind):
    out, kinds = fixed(text)
    assert out == want and (set(kinds) == {kind} if kind else bool(kinds) == (want != text))


@pytest.mark.parametrize("text", [SOUND, "The night operator\nmeasures the delivery\nnote.", "FZ-5417 and 10 of 300, €40, 21 °C, p1 Vârn", "The note is ¡ya! Åsbro–Ñandú: †‡ • …", "3. Crate / meter RN-7506\nThe night operator measures the note.", "the is a to", "In 9 cases | a note"])
def test_sound_pages(text):
    out, kinds = fixed(text)
    assert not kinds and out.split() == text.split()


@pytest.mark.parametrize("line", ["3", "Page 3", "Seite 12 / 40", "p. 7", "[12]", "— 4 —", "• 5 •", "iv", "2 | MT-1727", "Page l2", "Страница 3", "s. 4"])
def test_page_numbers(line):
    body = "The night operator measures the note."
    for text in (f"{line}\n{body}", f"{body}\n{line}"):
        assert fixed(text) == (body, {"page": 1})


@pytest.mark.parametrize("number", ["1", "23", "vi", "XII"])
def test_page_numbers_within_a_page(number):
    sentence = "The night operator measures the\ndelivery note. The shift lead updates\n{}the shared calendar. The supplier’s\nquotation is with the front desk."
    want = " ".join(sentence.format("").split())
    assert fixed(sentence.format(number + "\n")) == (want, {"page": 1})
    header = f"{number}\nBEACON / FUNNEL GG-1107\n"
    assert fixed(sentence.format(header)) == (want, {"page": 1, "header": 1})
    assert fixed("The night operator measures the note.\nThe shift opera-\n" + number + "\ntor measures the delivery note.\nThe shift lead.")[1] == {"page": 1, "hyphen": 1}


def test_page_numbers_between_sentences():
    text = "The shift lead updates the calendar.\nThe night operator measures the note.\n{}\nThe shift lead updates the note.\nThe front desk measures the note."
    for number, page, n in (("4", "4", 1), ("v", "4", 1), ("40", "4", 0), ("4", None, 1)):
        assert S.repair(text.format(number), D, frozenset(), page)[1]["page"] == n


def test_numbers_that_are_no_page_numbers():
    wrapped = "The night operator measures\nthe delivery note. It is at\n21\nquotationdeliverycalendarsxy\nby the night operator."
    cells = "Night operator\nnote\n21\nDelivery note\n3\nShift lead\nFront desk"
    column = "The night operator measures the\nnote\n3\n4\n5\nthe delivery note.\nThe shift lead."
    listed = "Head note.\n1\nThe night operator measures the note.\n2\nThe shift lead updates the note.\n3\nThe front desk measures the note.\nThe note."
    for text in (wrapped, cells, column, listed):
        for page in (None, "1", "3"):
            assert not S.inner_page_numbers(text.split("\n"), page, frozenset())


def test_header_keys_within_a_page():
    text = "The night operator measures the\ndelivery note. The shift lead updates\n{}the shared calendar. The supplier’s\nquotation is with the front desk."
    assert S.header_candidates(text.format("Annual Report\n")) == ["annual report"]
    assert S.header_candidates(text.format("12\nAnnual Report\n")) == ["annual report"]
    assert S.header_candidates(text.format("")) == []
    assert S.header_candidates("The night operator is here.\nThe note.\nSafety Notes\nThe shift lead updates the note.\nThe note.\nThe desk.") == []


def test_headers():
    body = "The night operator measures\nthe delivery note."
    for line in ("Beacon / funnel GG-1107", "2  COUPLING / SPLICE FR-8780", "Gauge / crate GD-4444    6"):
        assert fixed(f"{line}\n{body}")[1] == {"header": 1}
    text = "The night opera-\nBEACON / FUNNEL GG-1107\ntor measures the note."
    assert fixed(text) == ("The night operator measures the note.", {"header": 1, "hyphen": 1})
    pages = [f"Annual Report\n{body}" for _ in range(3)]
    assert all(S.header_candidates(p) == ["annual report"] for p in pages)
    assert fixed(pages[0], ["annual report"])[1] == {"header": 1} and not fixed(pages[0])[1]
    assert S.header_candidates("The night operator\nmeasures the\nnote.") == []


def test_paragraphs():
    lines = ["The night operator measures the note.", "The shift lead updates the calendar and", "the front desk.", "", "The supplier’s quotation is with the", "front desk."]
    out, kinds = fixed("\n".join(lines))
    assert out.split("\n\n") == [" ".join(lines[:3]), " ".join(lines[4:])] and not kinds
    assert fixed("a | b | c\nd | e | f")[0] == "a | b | c\nd | e | f"


def test_paragraph_starts_like_brute_force():
    """The dynamic programme against all ways to cut."""
    from itertools import product

    cases = [["The a b c d e.", "the f g", "H i j.", "K l m n o p"], ["1. Head", "Text goes on and", "on and on.", "End"], ["x", "y", "z"]]
    for lines in cases:
        blank = [False, True, False, True][: len(lines)]
        costs = {}
        for cut in product((0, 1), repeat=len(lines) - 1):
            starts = [0] + [i + 1 for i, c in enumerate(cut) if c]
            costs[tuple(starts)] = _cost(lines, blank, starts)
        best = min(costs.values())
        assert math.isclose(costs[tuple(S.paragraph_starts(lines, blank))], best)


def test_a_paragraph_of_any_number_of_lines():
    lines = ["The night operator measures the delivery"] + ["note of the day and updates the calendar"] * 3_000
    assert S.paragraph_starts(lines, [False] * len(lines)) == [0]
    assert len(S.paragraph_starts(lines, [i % 100 == 99 for i in range(len(lines))])) == 31


def _every_reading(text, decoder):
    """Cheapest cost of all ways to read a few letters with gaps, by trying them all."""
    low = text.replace(" ", "").replace("\n", "")
    gaps, tokens = set(), text.split()
    for t in tokens:
        gaps.add(sum(map(len, tokens[: tokens.index(t)])))
    ends = [0]
    for t in tokens:
        ends.append(ends[-1] + len(t))

    def spelled(part, at):
        """(word, extra) of all confusions of a part."""
        if not part:
            yield "", 0.0
            return
        for rest, c in spelled(part[1:], at + 1):
            yield part[0] + rest, c
        for read, printed in S.CONFUSIONS:
            if part.startswith(read):
                for rest, c in spelled(part[len(read) :], at + len(read)):
                    yield printed + rest, c + S.CONFUSED

    best = [0.0] + [math.inf] * len(low)
    for i in range(len(low)):
        for j in range(i + 1, len(low) + 1):
            inside = sum(i < e < j for e in ends)
            spaced = sum(i < e < j and e - 1 in ends and e + 1 in ends for e in ends)
            if i in ends and j in ends and not inside:
                best[j] = min(best[j], best[i] + decoder.price(low[i:j]))
            extra = S.SPLIT * (inside - spaced) + S.SPACED * spaced
            if j not in ends:
                extra += S.MERGED_AGAIN if i not in ends else S.MERGED
            if i not in ends or j not in ends:
                extra += S.SHORT_PART.get(j - i, 0)
            for word, c in spelled(low[i:j], i):
                if word in decoder.cost:
                    best[j] = min(best[j], best[i] + decoder.cost[word] + c + extra)
    return best[-1]


@pytest.mark.parametrize("text", ["the no te", "opera tor", "nlght", "th e nigh t", "nightdesk", "clesk", "vith der", "the1ist", "sh ift lea d", "0perat0r", "updat esthe", "mea sur es", "qu0 tat ion", "front clesk", "xyzzy no te", "le ad the", "upc lates", "d e l i v e r y", "anight"])
def test_lattice_like_brute_force(text):
    """What is left out of the lattice is on no best path."""
    tokens = text.split()
    alone = [D.alone(t) for t in tokens]
    out, kinds = D.decode(tokens, [" "] * (len(tokens) - 1) + ["\n"])
    ends = [0]
    for t in tokens:
        ends.append(ends[-1] + len(t))
    every = D._lattice("".join(tokens), "".join(tokens), {e: " " for e in ends[1:-1]}, ends, [D.price(t) for t in tokens], set(ends[:-1]))[0]
    assert math.isclose(every, _every_reading(text, D), abs_tol=1e-6)
    found = D._lattice("".join(tokens), "".join(tokens), {e: " " for e in ends[1:-1]}, ends, [a[0] for a in alone], {e for e, x in zip(ends, D._active([("", t, "", t) for t in tokens], alone, [True] * (len(tokens) - 1) + [False], [" "] * len(tokens))) if x})[0]
    assert math.isclose(found, every, abs_tol=1e-6)


def _cost(lines, blank, starts):
    width = sorted(map(len, lines))[int(0.9 * (len(lines) - 1))] or 1
    total = 0.0
    for i in range(1, len(lines)):
        closed, capital = bool(S._ENDED.search(lines[i - 1])), not lines[i][:1].islower()
        short = len(lines[i - 1]) < 0.72 * width
        if i in starts:
            total += 2.5 + (0 if closed else 3) + (0 if capital else 3) - (1.5 if short and closed else 0) - (6 if blank[i] else 0)
            if S._NUMBERED.match(lines[i]) or S._NUMBERED.match(lines[i - 1]) and len(lines[i - 1]) < 0.8 * width and not closed:
                total -= 4
        else:
            total += (5 if blank[i] else 0) + (2.5 if short and closed else 0.8 if short else 0)
    return total + 0.5 * sum(b - a == 1 for a, b in zip(starts, [*starts[1:], len(lines)]))


def test_frame(spark):
    meta = "struct<source_path:string,page_or_section:string,timestamp:string,extra:map<string,string>>"
    rows = [(i, SOUND, ("x.txt", "1", "t", None)) for i in range(30)]
    rows += [(100, "The night opera-\ntor measures the note.", ("/a/p.PDF", "1", "t", None)), (101, "The night opera-\ntor measures the note.", ("/a/p.txt", "1", "t", None)), (102, None, ("/a/p.pdf", "1", "t", None)), (103, "x", (None, "1", "t", None)), (104, "", ("/a/p.pdf", None, None, None)), (105, "q" * 50_000 + " note", ("/b.pdf", "1", "t", None))]
    rows += [(200 + i, "Yearly Notes\nThe night operator measures the note.\nThe shift lead.", ("/c.pdf", str(i), "t", None)) for i in range(2)]
    rows += [(300 + i, "Weekly Notes\nThe night operator measures the note.\nThe shift lead.", ("/d.pdf", "1", str(i), None)) for i in range(2)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], f"fragment_id long, text string, metadata {meta}, path string")
    got = {r["fragment_id"]: r for r in S.repaired_pages(df).collect()}
    assert set(got) == {100, 104, 105, 200, 201, 300, 301}
    assert got[100]["text"] == "The night operator measures the note." and got[100]["hyphens"] == 1
    assert got[200]["headers"] == got[201]["headers"] == 1
    assert got[300]["headers"] == 0  # the same page delivered twice is no return
    assert got[104]["text"] == ""


def test_frame_knows_pages(spark):
    meta = "struct<source_path:string,page_or_section:string,timestamp:string,extra:map<string,string>>"
    between = "The shift lead.\nThe night operator measures the note.\n{}\nThe shift lead.\nThe front desk."
    rows = [(1, between.format(7), ("/e.pdf", "7", "t", None)), (2, between.format(70), ("/e.pdf", "7", "t", None))]
    got = {r["fragment_id"]: r["pages"] for r in S.repaired_pages(spark.createDataFrame(rows, f"fragment_id long, text string, metadata {meta}")).collect()}
    assert got == {1: 1, 2: 0}
