import random
import re

from foliospark.llm import site_lines as L

META = "struct<source_path:string,page_or_section:string,timestamp:string,extra:map<string,string>>"


def brute(rows, files):
    site = dict(files)
    norm = lambda s: re.sub(r"\d+", "0", " ".join(s.split())).casefold()
    held, where = {}, {}
    for _, text, path in rows:
        if path is None or site.get(path) is None:
            continue
        held.setdefault(site[path], set()).add(path)
        for line in (text or "").split("\n"):
            if norm(line):
                where.setdefault((site[path], norm(line)), set()).add(path)
    good = {k for k, v in where.items() if len(v) >= 4 and 5 * len(v) >= len(held[k[0]])}
    return {(i, n) for i, text, path in rows if path is not None and text is not None for n, line in enumerate(text.split("\n")) if (site.get(path), norm(line)) in good}


def data():
    rng = random.Random(11)
    files = [(f"f{i}", rng.choice(["a", "b", "c"]) if i else "big") for i in range(120)] + [("nowhere", None)]
    rows = []
    for i in range(900):
        path = "f0" if i % 3 == 0 else rng.choice([f for f, _ in files] + [None, "unknown"])
        lines = [rng.choice(["Share  Page 12 | Print", "SHARE page 7 | print ", "straße 5", "STRASSE 66", "", "  ", f"own {rng.random()}", "rare " + "x" * rng.randint(1, 9)]) for _ in range(rng.randint(0, 6))]
        rows.append((i, rng.choice([None] + ["\n".join(lines)] * 9), path))
    return rows, files


def frames(spark, rows, files):
    f = spark.createDataFrame([(i, t, (p, "1", "t", None), "clash") for i, t, p in rows], f"fragment_id long, text string, metadata {META}, line string")
    return f, spark.createDataFrame([(p, s, "clash") for p, s in files], "file_path string, site string, h string")


def test_like_brute_force(spark):
    rows, files = data()
    f, s = frames(spark, rows, files)
    want = brute(rows, files)
    got = {(r["fragment_id"], r["line_no"]) for r in L.repeated_lines(f, s)[1].collect()}
    assert got == want and len(want) > 200
    cleaned = {r["fragment_id"]: (r["text"], r["removed"]) for r in L.without_lines(f, L.repeated_lines(f, s)[1]).collect()}
    for i, text, _ in rows:
        gone = {n for k, n in want if k == i}
        assert cleaned[i] == (None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone), len(gone))


def test_sliced_summaries_miss_nothing(spark, monkeypatch):
    """Summaries of few entries, so that each site is cut into many slices."""
    monkeypatch.setattr(L, "ITEMS", 48)
    monkeypatch.setattr(L, "SEEN_PER_THRESHOLD", 64 / 3.5 / 4)
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    rows = [(i, f"notice {i}\nonly {i * 7919 % 997} {chr(97 + i % 26)}{chr(97 + i // 26)}", f"f{i}") for i in range(400)]
    rows += [(1000 + i, f"second notice\nother {chr(97 + i % 26)}{i}", f"f{i}") for i in range(85)]
    files = [(f"f{i}", "a") for i in range(400)]
    f, s = frames(spark, rows, files)
    assert {(r["fragment_id"], r["line_no"]) for r in L.repeated_lines(f, s)[1].collect()} == brute(rows, files)


def test_thresholds(spark):
    """Exactly four files, exactly a fifth, one less of either."""
    rows = [(i, "four" if i < 4 else "x", f"a{i}") for i in range(20)] + [(100 + i, "three", f"b{i}") for i in range(3)] + [(200 + i, "five" if i < 5 else f"y{chr(97 + i)}", f"c{i}") for i in range(26)]
    files = [(p, p[0]) for _, _, p in rows]
    f, s = frames(spark, rows, files)
    got = {r["fragment_id"] for r in L.repeated_lines(f, s)[1].collect()}
    assert got == {i for i, _ in brute(rows, files)} and {0, 1, 2, 3} <= got and not got & {100, 200}


def test_a_long_line(spark):
    rows = [(i, "z" * 200_000 + "\n" + "q" * i, f"a{i}") for i in range(5)]
    f, s = frames(spark, rows, [(f"a{i}", "a") for i in range(5)])
    assert {(r["fragment_id"], r["line_no"]) for r in L.repeated_lines(f, s)[1].collect()} == {(i, 0) for i in range(5)}
