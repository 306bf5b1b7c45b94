import random

import pytest

from foliospark.llm import split as S


def made(rng, n):
    return "".join(f"w{i}" + rng.choice([" "] * 12 + [". ", ", ", "\n", "\n\n", ".\n\n", " \t "]) for i in range(n))


@pytest.mark.parametrize(("limit", "overlap"), [(26, 0), (26, 6), (130, 13), (1024, 96)])
def test_pieces(limit, overlap):
    rng = random.Random(limit)
    for n in (0, 1, 19, 20, 21, 300, 2000):
        text = "  " + made(rng, n)
        got = S.pieces(text, limit, overlap)
        assert "".join(text[s:e] for _, s, e in got) == text.strip()
        sizes = [len(text[b:e].split()) for b, _, e in got]
        assert all(13 * k // 10 <= limit for k in sizes)
        if 13 * n // 10 <= limit:
            assert len(got) == (n > 0)
        for (b, s, _), (_, s0, _) in zip(got[1:], got):
            assert len(text[b:s].split()) == min(S.max_words(overlap), len(text[s0:s].split()) + len(text[:s0].split()))


def test_max_words():
    for t in range(2000):
        k = S.max_words(t)
        assert 13 * k // 10 <= t < 13 * (k + 1) // 10


def test_natural_boundaries_first():
    paragraph = " ".join(["w"] * 14) + "."
    text = "\n\n".join([paragraph] * 6)
    assert all(text[s - 2 : s] == "\n\n" for _, s, _ in S.pieces(text, 26, 0)[1:])
    text = " ".join(["w"] * 9 + ["end."]) + " " + " ".join(["W"] * 12)
    assert text[: S.pieces(text, 26, 0)[0][2]].rstrip().endswith("end.")


def test_merges_like_brute_force():
    """The heap against a loop that looks at all pairs each time."""

    def brute(text, limit, overlap):
        spans = [m.span() for m in S.WORD.finditer(text)]
        own = S.max_words(limit) - S.max_words(overlap)
        atoms = [[i, i + 1] for i in range(len(spans))]
        power = lambda i: S._boundary(text[spans[i - 1][0] : spans[i - 1][1]], text[spans[i - 1][1] : spans[i][0]])
        while True:
            pairs = [(power(b[0]), b[1] - a[0], b[0], k) for k, (a, b) in enumerate(zip(atoms, atoms[1:])) if b[1] - a[0] <= own]
            if not pairs:
                return [a[0] for a in atoms]
            *_, k = min(pairs)
            atoms[k : k + 2] = [[atoms[k][0], atoms[k + 1][1]]]

    rng = random.Random(9)
    for _ in range(25):
        text = made(rng, rng.randint(21, 120))
        starts = {m.start(): i for i, m in enumerate(S.WORD.finditer(text))}
        assert [starts[s] for _, s, _ in S.pieces(text, 26, 5)] == brute(text, 26, 5)


def test_frame(spark):
    long = made(random.Random(2), 900)
    df = spark.createDataFrame([(1, long, "c"), (2, None, "c"), (3, "short", None), (4, long, "c"), (5, "x" * 300_000, "c"), (6, " \n ", "c")], "fragment_id long, text string, `key` string")
    got = S.split_oversized(df, 1024, 96).collect()
    assert {r["fragment_id"] for r in got} == {1, 4} and all(r["n_tokens"] <= 1024 and r["n_pieces"] > 1 for r in got)
    assert S.split_oversized(df.limit(0), 1024, 96).count() == 0
    with pytest.raises(ValueError):
        S.pieces(long, 20, 20)
