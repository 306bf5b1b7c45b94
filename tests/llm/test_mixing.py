import random
from collections import Counter

import pytest

from foliospark.llm import mixing as M


def test_flight_keeps_both_totals_and_every_chance():
    rng = random.Random(2)
    size = [rng.randint(1, 400) for _ in range(60)]
    hits = Counter()
    for run in range(400):
        p = [0.3] * 60
        open_ = M.fly(p, size, random.Random(run))
        assert len(open_) <= 2 and abs(sum(p) - 18) < 1e-6 and abs(sum(a * b for a, b in zip(p, size)) - 0.3 * sum(size)) < 1e-4
        assert all(x in (0.0, 1.0) or i in open_ for i, x in enumerate(p))
        hits.update(dict(enumerate(p)))
    assert all(85 < hits[i] < 155 for i in range(60))  # 120 expected


def test_flight_edges():
    for p in ([], [0.5], [0.5, 0.5], [0.0, 1.0, 1.0], [0.5] * 5):
        q = list(p)
        M.fly(q, [7] * len(q), random.Random(0))
        assert abs(sum(q) - sum(p)) < 1e-9


def test_landing_exchanges_one():
    p, size = [1.0, 1.0, 0.0, 0.0, 0.5], [50, 30, 51, 5, 40]
    M.land(p, size, [4])
    assert set(p) <= {0.0, 1.0} and abs(sum(x * s for x, s in zip(p, size)) - 100) <= 1


TARGETS = [("m", "a", 0.5, 1), ("m", "b", 0.3, 3), ("m", "c", 0.2, 2), ("gap", "a", 0.6, 1), ("gap", "none", 0.4, 5), ("void", "none", 1.0, 2), ("m", "z", 0.0, 2), ("same", "b", 1.0, 2)]


def frames(spark, n=1500):
    rng = random.Random(8)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c"]), " ".join(["word"] * rng.randint(0, 90)), 9) for i in range(n)] + [(n, None, "no source", 9), (n + 1, "a", None, 9), (n + 2, "c", "", 9)]
    d = spark.createDataFrame(docs, "doc_id long, source string, text string, tokens int")
    return docs, d, spark.createDataFrame([*TARGETS, ("m", None, 0.1, 1), (None, "a", 0.1, 1)], "mix_name string, source string, target_share double, max_repeats int")


@pytest.mark.parametrize("bucket", [10_000, 60])
def test_frame(spark, monkeypatch, bucket):
    monkeypatch.setattr(M, "BUCKET_ROWS", bucket)
    docs, d, t = frames(spark)
    got = M.mixed(d, t).collect()
    most = {(m, s): r for m, s, _, r in TARGETS}
    assert all(1 <= r["copies"] <= most[r["mix_name"], r["source"]] for r in got)
    assert max(Counter((r["mix_name"], r["doc_id"]) for r in got).values()) == 1
    tokens = Counter()
    for r in got:
        tokens[r["mix_name"], r["source"]] += r["copies"] * r["tokens"]
    whole = sum(v for (m, _), v in tokens.items() if m == "m")
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(tokens["m", s] / whole - share) < (0.002 if bucket > 60 else 0.01)
    rows = {(r["mix_name"], r["source"]): r for r in M.shares(M.mixed(d, t), t).collect()}
    assert rows["gap", "a"]["actual_share"] == 1.0 and rows["gap", "none"]["copies"] == 0 and rows["void", "none"]["actual_share"] == 0.0 and rows["m", "z"]["copies"] == 0
    # The largest mix that the repeats allow: some source is used to the last copy.
    assert any(abs(tokens["m", s] / (r * sum(len((x[2] or "").split()) for x in docs if x[1] == s)) - 1) < 0.02 for s, r in (("a", 1), ("b", 3), ("c", 2)))
    assert all(r["copies"] == 2 for r in got if r["mix_name"] == "same")


def test_same_again(spark):
    _, d, t = frames(spark, 300)
    a, b = (sorted(map(tuple, M.mixed(x, t).collect())) for x in (d, d.repartition(7)))
    assert a == b
