import random

import pyarrow.parquet as pq

from foliospark.llm import token_budget as B
from foliospark.llm import tokens as K
from tests.conftest import SMALL


def test_trie_like_a_dictionary():
    rng = random.Random(4)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))): rng.random() for _ in range(300)}
    trie = K.Trie.build(words)

    def brute(raw):
        best = [(0.0, 0)] + [(1e18, 0)] * len(raw)
        for j in range(1, len(raw) + 1):
            for i in range(j):
                if raw[i:j] in words:
                    best[j] = min(best[j], (best[i][0] + words[raw[i:j]], best[i][1] + 1))
        return best[-1]

    seen = 0
    for _ in range(300):
        raw = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
        cost, n = brute(raw)
        if cost < 1e18:
            seen += 1
            assert trie.best_path_length(raw) == n
    assert seen > 100 and trie.best_path_length(b"zz") == 2 and trie.best_path_length(b"") == 0


def test_exact_counts_by_segments():
    import tiktoken

    code = tiktoken.Encoding("own", pat_str=K.PATTERN, mergeable_ranks=K.read_ranks(K.VOCABULARY), special_tokens={})
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "the", " ", "  ", "\n", "\n\n ", " x", "12", "é", "  ", "'s", "!?", "\t"]) for _ in range(30)) for _ in range(300)]
    assert all("".join(K.segments(t)) == t for t in texts)
    assert K.exact_counter()([*texts, None, ""]) == [*[len(code.encode_ordinary(t)) for t in texts], 0, 0]


def test_estimate_is_near():
    texts = pq.read_table(f"{SMALL}/fragments.parquet")["text"].to_pylist()
    a, b = K.exact_counter()(texts), K.viterbi_counter()(texts)
    assert abs(sum(b) / sum(a) - 1) < 0.02 and sum(abs(x - y) for x, y in zip(a, b)) / sum(a) < 0.03


def test_totals_and_labels(spark):
    meta = "struct<source_path:string,page_or_section:string,timestamp:string,extra:map<string,string>>"
    rows = [("one two", ("a", "1", "t", None), None), ("one two", ("a", "1", "later", None), None), ("one two", ("a", "2", "t", None), None), (None, ("b", "1", "t", None), None), ("x", (None, "1", "t", None), 3), ("y", ("gone", None, None, None), None)]
    fragments = spark.createDataFrame(rows, f"text string, metadata {meta}, chunk_index int")
    files = spark.createDataFrame([("a", "s", "EN", "d"), ("b", "s", "fra", None), ("c", "s", "de", "d")], "file_path string, site string, lang string, domain string")
    got = {(r["site"], r["lang"], r["domain"]): tuple(r[3:]) for r in B.token_budget(fragments, files).collect()}
    assert got == {("s", "en", "d"): (1, 3, 6, 2, 4), ("s", "fr", "unknown"): (1, 1, 0, 1, 0), ("unknown", "und", "unknown"): (1, 2, 2, 2, 2)}
    labels = ["EN", "de_DE", "fra", "ger", " pl-PL ", "xyz", "", None, "english"]
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    assert [r[0] for r in df.select(B.clean_language(df.x)).collect()] == ["en", "de", "fr", "de", "pl", "und", "und", "und", "und"]


def test_whole_tables_against_plain_sums(spark):
    f = pq.read_table(f"{SMALL}/fragments.parquet").to_pylist()
    got = B.p3_token_budget(spark, SMALL).collect()
    assert sum(r["fragments"] for r in got) == len(f)
    assert sum(r["tokens"] for r in got) == sum(K.viterbi_counter()([r["text"] for r in f]))
    once = {(r["metadata"]["source_path"], r["metadata"]["page_or_section"], r["chunk_index"], r["text"]) for r in f}
    assert sum(r["unique_fragments"] for r in got) == len(once)
