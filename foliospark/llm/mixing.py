"""Problem 8: a selection in which every source has its share, by balanced (cube) sampling.

The size of a mix is the largest at which every source that has documents can
give its share within its repeats. A document's expected copies are then the
same within a source: a whole number for certain, and a fraction that the cube
method turns into none or one copy. Its flight phase moves the fractions of
three documents at a time along the one direction that changes neither their
total of documents nor of tokens, until one of them is decided. Buckets fly by
themselves, at most two documents of each stay open, those fly together again,
and the last two of a source are landed on the nearest total.
"""

from __future__ import annotations

import random
from bisect import bisect_left
from collections.abc import Iterator
from itertools import product

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.tokens import VOCABULARY, exact_counter
from foliospark.storage import table, written

BUCKET_ROWS = 10_000
#: Most rows of the table of targets, which is read on the driver.
MOST_TARGETS = 100_000
_EPS = 1e-9


def fly(p: list[float], size: list[int], rng: random.Random) -> list[int]:
    """Move the chances ``p`` in place until at most two are neither 0 nor 1; gives the open ones' indices.

    Sums of ``p`` and of ``p * size`` stay as they are, each step as likely up as
    down in weight, so every document keeps its expected copies.
    """
    window: list[int] = []
    for i in range(len(p)):
        if not _EPS < p[i] < 1 - _EPS:
            p[i] = float(round(p[i]))
            continue
        window.append(i)
        if len(window) < 3:
            continue
        a, b, c = window
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if not any(u):
            u = (1, -1, 0)
        up = min((1 - p[k]) / x if x > 0 else p[k] / -x for k, x in zip(window, u) if x)
        down = min(p[k] / x if x > 0 else (1 - p[k]) / -x for k, x in zip(window, u) if x)
        step = up if rng.random() * (up + down) < down else -down
        for k, x in zip(window, u):
            p[k] += step * x
            if p[k] < _EPS or p[k] > 1 - _EPS:
                p[k] = float(round(p[k]))
        window = [k for k in window if 0 < p[k] < 1]
    return window


def land(p: list[float], size: list[int], open_: list[int]) -> None:
    """Decide the open ones so that the tokens come nearest to what was expected, then the documents.

    What is still missing or too much is made good by one exchange, if there is
    one: a document in, one of another size out, so that their number stays.
    """
    want, n = sum(p[k] * size[k] for k in open_), sum(p[k] for k in open_)
    best = min(product((0.0, 1.0), repeat=len(open_)), key=lambda s: (abs(sum(x * size[k] for x, k in zip(s, open_)) - want), abs(sum(s) - n)))
    for k, x in zip(open_, best):
        p[k] = x
    over = sum(x * size[k] for x, k in zip(best, open_)) - want
    inside = [k for k in range(len(p)) if p[k] == 1.0]
    outside = sorted((size[k], k) for k in range(len(p)) if p[k] == 0.0)
    least, swap = abs(over), None
    for k in inside if outside else ():
        at = bisect_left(outside, (size[k] - over, -1))
        for size_in, j in outside[max(0, at - 1) : at + 1]:
            if (left := abs(over - size[k] + size_in)) < least - _EPS:
                least, swap = left, (k, j)
    if swap:
        p[swap[0]], p[swap[1]] = 0.0, 1.0


def _flight(last: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id", ignore_index=True)
        p, size = group["p"].tolist(), group["tokens"].tolist()
        rng = random.Random(f"{group['mix_name'].iloc[0]}/{group['source'].iloc[0]}/{group['bucket'].iloc[0]}")
        order = list(range(len(p)))
        rng.shuffle(order)
        q, s = [p[i] for i in order], [size[i] for i in order]
        open_ = fly(q, s, rng)
        if last or group["buckets"].iloc[0] == 1:
            land(q, s, open_)
        for k, i in enumerate(order):
            p[i] = q[k]
        return group.assign(p=p)

    return run


def token_sizes(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source, tokens`` of the documents with a source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = exact_counter(vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(count(b.column(2).to_pylist()), pa.int64())], names=["doc_id", "source", "tokens"])

    return documents.select("doc_id", "source", "text").where("source IS NOT NULL").mapInArrow(run, "doc_id long, source string, tokens long")


def plan(targets: list, totals: dict[str, tuple[int, int]]) -> list[tuple]:
    """(mix, source, target, whole copies, chance of one more, documents, size of the mix) per target that has documents with tokens.

    Sources without any leave their share to the others in proportion, so that
    those keep theirs among themselves.
    """
    out = []
    for mix in sorted({t["mix_name"] for t in targets}):
        rows = [t for t in targets if t["mix_name"] == mix and (t["target_share"] or 0) > 0 and (t["max_repeats"] or 0) > 0 and totals.get(t["source"], (0, 0))[1] > 0]
        if not rows:
            continue
        there = sum(t["target_share"] for t in rows)
        whole = min(totals[t["source"]][1] * t["max_repeats"] * there / t["target_share"] for t in rows)
        for t in rows:
            n, tokens = totals[t["source"]]
            each = min(whole * t["target_share"] / there / tokens, float(t["max_repeats"]))
            base = int(each + _EPS)
            out.append((mix, t["source"], float(t["target_share"]), base, max(0.0, each - base) if base < t["max_repeats"] else 0.0, n, float(whole)))
    return out


def mixed(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``mix_name, source, doc_id, tokens, copies`` of every document chosen at least once.

    Documents without a source are in no mix; empty and null texts have no
    tokens and count as documents only; copies of a text are documents of their
    own; a source in no target is left out; an empty table gives no rows.
    """
    spark = documents.sparkSession
    wanted = targets.select("mix_name", "source", "target_share", "max_repeats").where("mix_name IS NOT NULL AND source IS NOT NULL").limit(MOST_TARGETS + 1).collect()
    if len(wanted) > MOST_TARGETS:
        raise ValueError("more targets than a table of settings may have")
    sizes = written(token_sizes(documents, vocabulary), "sizes")
    sums = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    named = spark.createDataFrame([(s,) for s in sorted({t["source"] for t in wanted})], "source string")
    totals = {r["source"]: (r["n"], r["tokens"]) for r in sums.join(F.broadcast(named), "source").collect()}
    rows = plan(wanted, totals)
    quotas = spark.createDataFrame([(m, s, b, p, max(1, -(-n // BUCKET_ROWS))) for m, s, _, b, p, n, _ in rows], "mix_name string, source string, base int, p double, buckets int")
    units = sizes.join(F.broadcast(quotas), "source")
    units = units.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), "buckets")).select("mix_name", "source", "doc_id", "tokens", "base", "p", "bucket", "buckets")
    kind = "mix_name string, source string, doc_id long, tokens long, base int, p double, bucket long, buckets int"
    sure = units.where(f"p <= {_EPS}").withColumn("p", F.lit(0.0))
    flown = written(units.where(f"p > {_EPS}").groupBy("mix_name", "source", "bucket").applyInPandas(_flight(False), kind), "flown")
    decided, open_ = [sure, flown.where("p IN (0, 1)")], flown.where("p NOT IN (0, 1)")
    most = max((-(-r[5] // BUCKET_ROWS) for r in rows), default=0)
    while most:
        last = most * 2 <= BUCKET_ROWS
        most = 1 if last else -(-2 * most // BUCKET_ROWS)
        together = open_.withColumn("bucket", F.pmod(F.xxhash64("bucket"), F.lit(most)))
        flown = together.groupBy("mix_name", "source", "bucket").applyInPandas(_flight(last), kind)
        if last:
            decided.append(flown)
            break
        flown = written(flown, "flown")
        decided.append(flown.where("p IN (0, 1)"))
        open_ = flown.where("p NOT IN (0, 1)")
    every = decided[0]
    for more in decided[1:]:
        every = every.unionByName(more)
    return every.select("mix_name", "source", "doc_id", "tokens", (F.col("base") + F.col("p").cast("int")).alias("copies")).where("copies > 0")


def shares(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """``mix_name, source, target_share, actual_share, docs, copies, tokens, most_copies`` of every target, those not met too."""
    got = chosen.groupBy("mix_name", "source").agg(F.count("*").alias("docs"), F.sum("copies").alias("copies"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.max("copies").alias("most_copies"))
    whole = got.groupBy("mix_name").agg(F.sum("tokens").alias("all"))
    rows = targets.select("mix_name", "source", "target_share").join(got, ["mix_name", "source"], "left").join(whole, "mix_name", "left")
    zero = {"docs": 0, "copies": 0, "tokens": 0, "most_copies": 0, "actual_share": 0.0}
    return rows.withColumn("actual_share", F.expr("try_divide(tokens, all)")).drop("all").fillna(zero)


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "documents", ["doc_id", "source", "text"]), table(spark, sf_dir, "mix_targets")


def p8_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(*_inputs(spark, sf_dir))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, targets = _inputs(spark, sf_dir)
    return shares(mixed(documents, targets), targets)


def p8_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per target that documents can meet: whether its share among such targets is reached to 2 % of the mix, whether no document is used too often, how many documents are not its source's."""
    documents, targets = _inputs(spark, sf_dir)
    chosen = written(mixed(documents, targets), "chosen")
    there = documents.where("trim(coalesce(text, '')) <> ''").select("source").distinct()
    wanted = targets.where("target_share > 0 AND max_repeats > 0").join(there, "source")
    among = wanted.groupBy("mix_name").agg(F.sum("target_share").alias("among"))
    got = chosen.groupBy("mix_name", "source").agg(F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.max("copies").alias("most"))
    whole = got.groupBy("mix_name").agg(F.sum("tokens").alias("whole"))
    strange = chosen.select("mix_name", "source", "doc_id").join(documents.select("doc_id", F.col("source").alias("own")), "doc_id").where("own IS NULL OR own <> source").groupBy("mix_name", "source").agg(F.count("*").alias("s"))
    rows = wanted.join(among, "mix_name").join(got, ["mix_name", "source"], "left").join(whole, "mix_name", "left").join(strange, ["mix_name", "source"], "left")
    off = F.abs(F.coalesce("tokens", F.lit(0)) / F.col("whole") - F.col("target_share") / F.col("among"))
    return rows.select("mix_name", "source", (off <= 0.02).alias("met"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_repeats"), F.coalesce("s", F.lit(0)).alias("strange"))


QUERIES = {"p8_selection": p8_selection, "p8_shares": p8_shares, "p8_checked": p8_checked}
SQL: dict[str, str] = {
    "p8_checked": "SELECT mix_name, t.source, TRUE AS met, TRUE AS within_repeats, CAST(0 AS BIGINT) AS strange FROM mix_targets t WHERE target_share > 0 AND max_repeats > 0 AND t.source IN (SELECT source FROM documents WHERE trim(coalesce(text, '')) <> '')"
}
