"""The chunker against a plain loop."""

import random
import re

import pytest

from foliospark.functions import tokens as K
from foliospark.operators.chunk import chunked


def tokens(t):
    return int(len(t.split()) * 1.3)


def model(text, budget, overlap):
    if tokens(text) <= budget:
        return [text]
    out, cur = [], []
    for s in [x.strip() for x in re.split(r"(?<=[.!?])\s+(?=[A-Z])", text) if x.strip()]:
        if tokens(s) > budget:
            out += [" ".join(cur)] if cur else []
            cur, w = [], s.split()
            out += [" ".join(w[i : i + budget]) for i in range(0, len(w), budget)]
            continue
        if sum(map(tokens, cur)) + tokens(s) > budget:
            out.append(" ".join(cur))
            while cur and sum(map(tokens, cur)) > overlap:
                cur = cur[1:]
        cur.append(s)
    return out + ([" ".join(cur)] if cur else [])


def texts():
    rng = random.Random(5)
    made = ["", "  ", "one", "A. B. C."]
    for _ in range(60):
        made.append("".join(" ".join("Word" if i == 0 else "w" for i in range(rng.choice([1, 2, 5, 9, 30, 70]))) + rng.choice([". ", "! ", "\n", "? "]) for _ in range(rng.randint(1, 40))))
    return made


@pytest.mark.parametrize(("budget", "overlap"), [(10, 0), (10, 3), (25, 24), (40, 100), (3584, 128)])
def test_like_a_plain_loop(spark, budget, overlap):
    df = spark.createDataFrame(list(enumerate(texts())), "id int, text string")
    got = {}
    for r in chunked(df, budget, overlap).orderBy("id", "chunk_index").collect():
        got.setdefault(r["id"], []).append(r["text"])
        assert r["chunk_index"] == len(got[r["id"]]) - 1
    assert got == {i: m for i, t in enumerate(texts()) if (m := model(t, budget, overlap))}


def test_strict_budget(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "id int, text string")
    plain = chunked(df, 25, 24).collect()
    strict = chunked(df, 25, 24, strict=True).collect()
    worst = lambda rows: max(sum(tokens(s) for s in re.split(r"(?<=[.!?])\s+(?=[A-Z])", r["text"])) for r in rows)
    assert worst(strict) <= 25 < worst(plain)


def test_nulls_columns_and_bad_budget(spark):
    df = spark.createDataFrame([(1, None, 7, "x"), (2, "a b", 9, "y")], "`text id` int, text string, chunk_index int, `a.b` string")
    assert [tuple(r) for r in chunked(df, 5, 1).collect()] == [(2, "y", 0, "a b")]
    with pytest.raises(ValueError):
        chunked(df, 0, 1)
    assert chunked(df.limit(0), 5, 1).count() == 0


def test_exact_sizes_like_a_plain_loop(spark, tmp_path):
    """Sizes from a vocabulary; words of long sentences by their own sizes."""
    path = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
    size = K.sizer(path)

    def exact_model(text, budget, overlap):
        if size(text) <= budget:
            return [text]
        out, cur = [], []
        for s in [x.strip() for x in re.split(r"(?<=[.!?])\s+(?=[A-Z])", text) if x.strip()]:
            if size(s) > budget:
                out += [" ".join(cur)] if cur else []
                cur, part, n = [], [], 0
                for w in s.split():
                    if part and n + size(w) > budget:
                        out.append(" ".join(part))
                        part, n = [], 0
                    part.append(w)
                    n += size(w)
                out.append(" ".join(part))
                continue
            if sum(map(size, cur)) + size(s) > budget:
                out.append(" ".join(cur))
                while cur and sum(map(size, cur)) > overlap:
                    cur = cur[1:]
            cur.append(s)
        return out + ([" ".join(cur)] if cur else [])

    df = spark.createDataFrame([*enumerate(texts()), (99, "unbreakable" * 40 + ". Word next.")], "id int, text string")
    got = {}
    for r in chunked(df, 30, 10, tokenizer=path).orderBy("id", "chunk_index").collect():
        got.setdefault(r["id"], []).append(r["text"])
    assert got == {r["id"]: m for r in df.collect() if (m := exact_model(r["text"], 30, 10))}
