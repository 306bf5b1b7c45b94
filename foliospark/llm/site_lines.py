"""Problem 4: lines repeated across one site's files.

1. One scan cuts texts into lines, native; only hashes of the normalised lines are kept.
2. ``(file, line)`` pairs are made distinct, and each site gets a mergeable
   frequent-items summary of them (DataSketches, through ``approx_top_k_accumulate``).
   A site whose threshold is too fine for one summary is cut into slices by
   line hash, each with its own, so that no frequent line can be missed.
3. The candidates are counted exactly and held against both thresholds.
4. Confirmed lines, few by their threshold, are broadcast after a check of their number.

A line is repeated if at least ``MIN_FILES`` of the site's files hold it and at
least one in ``ONE_IN`` of them does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.storage import small_enough, table, written

MIN_FILES, ONE_IN = 4, 5
#: Entries of a summary. Its error is below 3.5 / 2^ceil(log2(ITEMS / 0.75)) of what it saw; a slice sees so little that the error stays under a quarter of the threshold.
ITEMS = 12_288
SEEN_PER_THRESHOLD = 16_384 / 3.5 / 4
#: Most confirmed lines that are broadcast; beyond, the joins shuffle.
BROADCAST_ROWS = 500_000


def normalised(line: Column) -> Column:
    """Trimmed, white space as one space, digit runs as ``0``, without case (ß as ss)."""
    spaced = F.trim(F.regexp_replace(line, r"(?U)[\s\x1c-\x1f]+", " "))
    return F.lower(F.upper(F.regexp_replace(spaced, r"(?U)\d+", "0")))


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small_enough(df, BROADCAST_ROWS) else df


def lines_of(fragments: DataFrame) -> DataFrame:
    """``fragment_id, path, line_no, h, g``: the non-blank lines with 96 bits of hash; rows without text or path have none."""
    rows = fragments.select("fragment_id", F.col("metadata.source_path").alias("path"), "text").where("path IS NOT NULL AND text IS NOT NULL")
    lines = rows.select("fragment_id", "path", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select("fragment_id", "path", "line_no", normalised(F.col("line")).alias("line")).where("line <> ''")
    return lines.select("fragment_id", "path", "line_no", F.xxhash64("line").alias("h"), F.hash("line").alias("g"))


def repeated_lines(fragments: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(confirmed ``site, h, g, in_files``; occurrences ``fragment_id, line_no, site``).

    Null texts, null paths and paths unknown to ``files`` take no part; a file
    counts once however often it holds or delivers a line; empty tables give
    empty results; columns other than those named are not read.
    """
    lines = written(lines_of(fragments), "lines")
    sites = files.select(F.col("file_path").alias("path"), "site").where("site IS NOT NULL")
    # Distinct before the join: the largest file comes with each of its lines once, spread by the line.
    pairs = written(lines.select("path", "h", "g").distinct().join(sites, "path").select("site", "path", "h", "g"), "pairs")
    held = fragments.select(F.col("metadata.source_path").alias("path")).where("path IS NOT NULL").distinct()
    per_site = held.join(sites, "path").groupBy("site").agg(F.count("*").alias("files"))
    per_site = per_site.withColumn("least", F.greatest(F.lit(MIN_FILES), F.ceil(F.col("files") / ONE_IN))).where(F.col("files") >= MIN_FILES)
    seen = pairs.groupBy("site").agg(F.count("*").alias("seen"))
    per_site = written(per_site.join(seen, "site").withColumn("slices", F.ceil(F.col("seen") / (F.col("least") * SEEN_PER_THRESHOLD))), "sites")
    known = _sized(per_site.select("site", "least", "slices"))

    sliced = pairs.join(known, "site").withColumn("slice", F.pmod("h", "slices"))
    summaries = sliced.groupBy("site", "slice").agg(F.expr(f"approx_top_k_accumulate(h, {ITEMS})").alias("s"), F.first("least").alias("least"))
    frequent = summaries.select("site", "least", F.explode(F.expr(f"approx_top_k_estimate(s, {ITEMS})")).alias("e"))
    candidates = frequent.where(F.col("e.count") >= F.col("least")).select("site", F.col("e.item").alias("h")).distinct()

    exact = pairs.join(_sized(written(candidates, "candidates")), ["site", "h"]).groupBy("site", "h", "g").agg(F.count("*").alias("in_files"))
    confirmed = written(exact.join(known, "site").where(F.col("in_files") >= F.col("least")).select("site", "h", "g", "in_files"), "confirmed")

    anywhere = _sized(confirmed.select("h", "g").distinct())
    met = lines.join(anywhere, ["h", "g"], "left_semi").join(sites, "path")
    occurrences = met.join(_sized(confirmed.select("site", "h", "g")), ["site", "h", "g"], "left_semi").select("fragment_id", "line_no", "site")
    return confirmed, occurrences


def without_lines(fragments: DataFrame, occurrences: DataFrame) -> DataFrame:
    """``fragment_id, text, removed``: every fragment, its confirmed lines taken out; a null text stays null."""
    per = occurrences.groupBy("fragment_id").agg(F.collect_set("line_no").alias("gone"))
    rows = fragments.select("fragment_id", "text").join(per, "fragment_id", "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("gone", i)), "\n")
    return rows.select("fragment_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed"))


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "fragments", ["fragment_id", "text", "metadata"]), table(spark, sf_dir, "source_files", ["file_path", "site"])


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(*_inputs(spark, sf_dir))[1].select("fragment_id", "line_no")


def p4_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    fragments, files = _inputs(spark, sf_dir)
    return without_lines(fragments, repeated_lines(fragments, files)[1])


QUERIES = {"p4_found": p4_found, "p4_cleaned": p4_cleaned}
_FOUND = r"""
WITH f AS (SELECT fragment_id, text, site, metadata.source_path AS path FROM fragments JOIN source_files ON metadata.source_path = file_path),
n AS (SELECT site, count(DISTINCT path) AS files FROM f GROUP BY site),
parts AS (SELECT fragment_id, site, path, string_split(text, chr(10)) AS l FROM f WHERE text IS NOT NULL),
l AS (SELECT fragment_id, site, path, unnest(l) AS line, unnest(range(len(l))) AS line_no FROM parts),
k AS (SELECT fragment_id, site, path, line_no, replace(lower(upper(trim(regexp_replace(regexp_replace(line, '[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), '\p{Nd}+', '0', 'g')))), 'ß', 'ss') AS line FROM l),
c AS (SELECT site, line FROM k JOIN n USING (site) WHERE line <> '' GROUP BY site, line, files HAVING count(DISTINCT path) >= 4 AND 5 * count(DISTINCT path) >= files)
"""
SQL = {
    "p4_found": _FOUND + "SELECT fragment_id, CAST(line_no AS INTEGER) AS line_no FROM k JOIN c USING (site, line)",
    "p4_cleaned": _FOUND
    + """, gone AS (SELECT fragment_id, list(line_no) AS gone FROM k JOIN c USING (site, line) GROUP BY fragment_id)
SELECT fragment_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text,
       CAST(coalesce(len(gone), 0) AS INTEGER) AS removed FROM fragments LEFT JOIN gone USING (fragment_id)""",
}
