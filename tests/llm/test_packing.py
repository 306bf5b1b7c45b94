import random

import pytest

from foliospark.llm import packing as P
from foliospark.llm.tokens import exact_counter


def test_best_fit():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randint(0, 60) for _ in range(rng.randint(0, 80))]
        bins = P.best_fit(sizes, [0] * len(sizes), 60)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 60 for b in bins)
        # Best fit never leaves two bins that would go into one, but for the last.
        load = sorted(sum(sizes[i] for i in b) for b in bins)
        assert len(load) < 2 or load[0] + load[1] > 60 or not load[0]


def check(got, texts, capacity):
    count = dict(enumerate(exact_counter()(texts)))
    per, bins = {}, {}
    for r in got:
        per.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["container_id"], []).append(r["tokens"])
    assert set(per) == set(count)
    for d, rows in per.items():
        rows.sort(key=lambda r: r["piece"])
        assert sum(r["tokens"] for r in rows) == count[d] and [r["token_start"] for r in rows] == [capacity * i for i in range(len(rows))]
        assert len(rows) == 1 or count[d] > capacity and all(r["tokens"] == capacity for r in rows[:-1])
    assert all(sum(b) <= capacity for b in bins.values())
    return sum(count.values()), len(bins)


@pytest.mark.parametrize("partitions", [1, 9])
def test_frame(spark, partitions, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(["word"] * int(min(900, rng.paretovariate(0.9) * 4))) for _ in range(700)] + ["", None, "same text", "same text"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, tokens int").repartition(partitions)
    got = P.pack(df, [(1, 64), (2, 512)]).collect()
    for spec, capacity in ((1, 64), (2, 512)):
        total, bins = check([r for r in got if r["spec_id"] == spec], texts, capacity)
        assert bins <= -(-total // capacity) + 2


def test_many_rounds_of_small_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_ROWS", 40)
    texts = [" ".join(["word"] * (i % 50 + 30)) for i in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12)
    check(P.pack(df, [(1, 64)]).collect(), texts, 64)


def test_only_members_without_tokens_are_bounded(monkeypatch):
    monkeypatch.setattr(P, "MOST_EMPTY", 5)
    bins = P.best_fit([0] * 23, [1] * 23, 10)
    assert max(map(len, bins)) <= 5 and sum(map(len, bins)) == 23
    assert len(P.best_fit([1] * 60, [0] * 60, 60)) == 1  # as many as the capacity takes
    assert sorted(map(len, P.best_fit([7, 3] + [0] * 7, [0, 0] + [1] * 7, 10))) == [2, 7]


def test_bad_capacity(spark):
    with pytest.raises(ValueError):
        P.pack(spark.createDataFrame([(1, "x")], "doc_id long, text string"), [(1, 0)])
