"""Problem 7: documents into containers of fixed capacity, by hierarchical residual packing.

Every partition packs what it holds best-fit, largest first, and emits the
containers that are nearly full. The others go on as items: they are spread
over an eighth as many groups, packed again, and so on until one group is left
or a round no longer merges anything worth while. No task ever holds more than
``GROUP_ROWS`` items of a container size.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.tokens import VOCABULARY, exact_counter
from foliospark.storage import table, written

#: A container so full is done.
NEARLY_FULL = 0.995
GROUP_ROWS = 20_000
#: Most members without tokens in a container: they take no space and would make it endless. Others are bounded by the capacity.
MOST_EMPTY = 8_192
#: How many containers are tried for members without tokens before a new one is begun.
TRIED = 64
#: A round that leaves more than this share of the containers it began with is the last.
WORTH_WHILE = 0.97
FAN_IN = 8
#: Containers in a group of the first merge.
FIRST_ROWS = 2_000

_MEMBER = "struct<doc_id: long, piece: int, token_start: int, tokens: int>"
_BIN = f"spec_id long, capacity int, size int, done boolean, members array<{_MEMBER}>"
_ARROW_MEMBERS = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("token_start", pa.int32()), ("tokens", pa.int32())]))


def best_fit(sizes: list[int], empty: list[int], capacity: int) -> list[list[int]]:
    """Indices of the items of each bin: largest first, each into the fullest bin that takes it. Ties keep their order.

    ``empty`` is how many members without tokens an item brings: those are spread
    over bins, ``MOST_EMPTY`` in each; items that bring none go by size alone.
    """
    room: list[tuple[int, int]] = []  # (free space, bin), sorted
    bins: list[list[int]] = []
    held: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(room, (sizes[i], -1))
        if empty[i]:
            last = min(len(room), at + TRIED)
            while at < last and held[room[at][1]] + empty[i] > MOST_EMPTY:
                at += 1
            at = at if at < last else len(room)
        if at < len(room):
            free, b = room.pop(at)
            bins[b].append(i)
            held[b] += empty[i]
        else:
            free, b = capacity, len(bins)
            bins.append([i])
            held.append(empty[i])
        insort(room, (free - sizes[i], b))
    return bins


def _packed(rows: list[tuple[int, list]], spec: int, capacity: int, out: list[list]) -> None:
    """Append to the columns ``out`` the bins of ``rows`` of (size, members)."""
    for b in best_fit([r[0] for r in rows], [sum(not m[3] for m in r[1]) for r in rows], capacity):
        size = sum(rows[i][0] for i in b)
        members = [m for i in b for m in rows[i][1]]
        for c, v in zip(out, (spec, capacity, size, size >= NEARLY_FULL * capacity, members)):
            c.append(v)


def _batch(out: list[list]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), _ARROW_MEMBERS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["spec_id", "capacity", "size", "done", "members"])


def _first_round(specs: list[tuple[int, int]], vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = exact_counter(vocabulary)
        waiting: dict[int, list] = {s: [] for s, _ in specs}
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, n in zip(batch.column(0).to_pylist(), count(batch.column(1).to_pylist())):
                for spec, capacity in specs:
                    start = piece = 0
                    while n - start > capacity:  # only what exceeds the capacity is cut, into full pieces and a rest
                        for c, v in zip(out, (spec, capacity, capacity, True, [(doc, piece, start, capacity)])):
                            c.append(v)
                        start, piece = start + capacity, piece + 1
                    waiting[spec].append((n - start, [(doc, piece, start, n - start)]))
            for spec, capacity in specs:
                if len(waiting[spec]) >= GROUP_ROWS:
                    _packed(waiting[spec], spec, capacity, out)
                    waiting[spec] = []
            if out[0]:
                yield _batch(out)
        out = [[], [], [], [], []]
        for spec, capacity in specs:
            _packed(waiting[spec], spec, capacity, out)
        yield _batch(out)

    return run


def _next_round(group: pd.DataFrame) -> pd.DataFrame:
    out: list[list] = [[], [], [], [], []]
    rows = [(int(s), [(m["doc_id"], m["piece"], m["token_start"], m["tokens"]) for m in ms]) for s, ms in zip(group["size"], group["members"])]
    rows.sort(key=lambda r: r[1][0])  # the order of arrival doesn't matter
    _packed(rows, int(group["spec_id"].iloc[0]), int(group["capacity"].iloc[0]), out)
    return pd.DataFrame({n: c for n, c in zip(("spec_id", "capacity", "size", "done", "members"), out)}).assign(members=[[dict(zip(("doc_id", "piece", "token_start", "tokens"), m)) for m in ms] for ms in out[4]])


def pack(documents: DataFrame, specs: list[tuple[int, int]], vocabulary: str = VOCABULARY) -> DataFrame:
    """``spec_id, capacity_tokens, container_id, doc_id, piece, token_start, tokens``: where every document goes, for every container size.

    A document above the capacity is cut into full pieces and a rest; no other is
    cut. Empty and null texts have no tokens and still get a place; copies are
    documents of their own; a capacity below one is refused. The container's id
    names its first member.
    """
    if any(c < 1 for _, c in specs):
        raise ValueError("a capacity must be at least one token")
    bins = written(documents.select("doc_id", "text").mapInArrow(_first_round(specs, vocabulary), _BIN), "bins")
    done, rest = [bins.where("done")], bins.where("NOT done")
    left = rest.count()
    groups = -(-left // FIRST_ROWS) * FAN_IN
    while left:
        groups = max(-(-groups // FAN_IN), -(-left // GROUP_ROWS))
        spread = rest.withColumn("g", F.pmod(F.xxhash64(F.col("members")[0]["doc_id"], F.col("members")[0]["piece"], F.lit(groups)), F.lit(groups)))
        bins = written(spread.groupBy("spec_id", "g").applyInPandas(_next_round, _BIN), "bins")
        rest = bins.where("NOT done")
        now = rest.count()
        if groups == 1 or now > WORTH_WHILE * left and groups <= -(-left // GROUP_ROWS):
            done.append(bins)
            break
        done.append(bins.where("done"))
        left = now
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    first = F.col("members")[0]
    named = every.select("spec_id", F.col("capacity").alias("capacity_tokens"), F.concat_ws("-", "spec_id", first["doc_id"], first["piece"]).alias("container_id"), F.explode("members").alias("m"))
    return named.select("spec_id", "capacity_tokens", "container_id", "m.*")


def _pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "container_specs", ["spec_id", "capacity_tokens"]).where("capacity_tokens IS NOT NULL").limit(1_001).collect()
    if len(rows) > 1_000:
        raise ValueError("container_specs is not a table of settings")
    return pack(table(spark, sf_dir, "documents", ["doc_id", "text"]), [(r["spec_id"], r["capacity_tokens"]) for r in rows])


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pack(spark, sf_dir)


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and the share of the space used, per container size."""
    by = _pack(spark, sf_dir).groupBy("spec_id", "capacity_tokens").agg(F.count_distinct("container_id").alias("containers"), F.sum("tokens").alias("tokens"), F.count_if(F.col("piece") > 0).alias("cuts"))
    return by.withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))


def p7_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per container size what must hold of any packing: documents placed, lost or in more than one place, cuts without need, containers above the capacity, fill of 95 % and above."""
    rows = written(_pack(spark, sf_dir), "packed")
    specs = rows.select("spec_id", "capacity_tokens").distinct()
    ids = table(spark, sf_dir, "documents", ["doc_id"])
    by = rows.groupBy("spec_id", "doc_id").agg(F.count("*").alias("n"), F.max("piece").alias("last"), F.sum("tokens").alias("size"), F.max("capacity_tokens").alias("capacity"))
    # Whole documents are one piece; of cut ones the pieces are numbered through, and there are no more than the size asks for.
    per = by.groupBy("spec_id").agg(
        F.count("*").alias("documents"), F.count_if(F.col("n") != F.col("last") + 1).alias("scattered"), F.count_if(F.col("n") > F.greatest(F.lit(1), F.ceil(F.col("size") / F.col("capacity")))).alias("needless_cuts")
    )
    unknown = rows.join(ids, "doc_id", "left_anti").groupBy("spec_id").agg(F.count("*").alias("u"))
    bins = rows.groupBy("spec_id", "capacity_tokens", "container_id").agg(F.sum("tokens").alias("size"))
    full = bins.groupBy("spec_id").agg(F.count_if(F.col("size") > F.col("capacity_tokens")).alias("overfull"), (F.sum("size") >= 0.95 * F.sum("capacity_tokens")).alias("well_filled"))
    return per.join(full, "spec_id").join(F.broadcast(specs), "spec_id").join(unknown, "spec_id", "left").select("spec_id", "documents", "scattered", "needless_cuts", "overfull", "well_filled", F.coalesce("u", F.lit(0)).alias("unknown"))


QUERIES = {"p7_containers": p7_containers, "p7_fill": p7_fill, "p7_checked": p7_checked}
SQL: dict[str, str] = {
    "p7_checked": "SELECT spec_id, count(doc_id) AS documents, CAST(0 AS BIGINT) AS scattered, CAST(0 AS BIGINT) AS needless_cuts, CAST(0 AS BIGINT) AS overfull, TRUE AS well_filled, CAST(0 AS BIGINT) AS unknown FROM container_specs, documents GROUP BY spec_id"
}
