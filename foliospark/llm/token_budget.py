"""Problem 3: tokens per source, language and domain.

A segment's tokens are the length of the cheapest path through a double-array
trie of the vocabulary (count-only Viterbi, unigram costs); see ``tokens``.
Counts are summed per delivery and file before anything is joined, so a file
of any size meets the file table as one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.tokens import VOCABULARY, exact_counter, viterbi_counter
from foliospark.storage import table

#: ISO 639-2 codes of the languages in use, by their two-letter code.
THREE_LETTERS = {"eng": "en", "ger": "de", "deu": "de", "fre": "fr", "fra": "fr", "spa": "es", "pol": "pl", "rus": "ru"}


def clean_language(label: Column) -> Column:
    """``EN``, ``de_DE`` and ``fra`` as ``en``, ``de`` and ``fr``; null, blank and all else that is no code as ``und``."""
    code = F.lower(F.regexp_extract(F.trim(label), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    known = F.create_map(*[F.lit(x) for pair in THREE_LETTERS.items() for x in pair])
    return F.when(F.length(code) == 2, code).otherwise(F.coalesce(known[code], F.lit("und")))


def counted(fragments: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``source_path, delivery, tokens``: delivery is the hash of what makes two rows deliveries of one fragment."""
    same = F.md5(F.to_json(F.struct(F.col("metadata.page_or_section").alias("s"), F.col("chunk_index").alias("c"), F.col("text").alias("t"))))
    rows = fragments.select(F.col("metadata.source_path").alias("source_path"), same.alias("delivery"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = viterbi_counter(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(count(b.column(2).to_pylist()), pa.int64())], names=["source_path", "delivery", "tokens"])

    return rows.mapInArrow(run, "source_path string, delivery string, tokens long")


def token_budget(fragments: DataFrame, files: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Totals by ``site, lang, domain``.

    ``fragments`` and ``tokens`` count every row, ``unique_fragments`` and
    ``unique_tokens`` each repeated delivery once. A null text has no tokens;
    rows without a path or with one unknown to ``files`` come under ``unknown``
    / ``und`` / ``unknown``, as do null labels; empty tables give no rows.
    """
    deliveries = counted(fragments, path).groupBy("source_path", "delivery").agg(F.count("*").alias("n"), F.max("tokens").alias("tokens"))
    per_file = deliveries.groupBy("source_path").agg(
        F.sum("n").alias("fragments"), F.sum(F.col("n") * F.col("tokens")).alias("tokens"), F.count("*").alias("unique_fragments"), F.sum("tokens").alias("unique_tokens")
    )
    labels = files.select(F.col("file_path").alias("source_path"), "site", clean_language(F.col("lang")).alias("lang"), "domain")
    slices = per_file.join(labels, "source_path", "left")
    by = [F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in (("site", "unknown"), ("lang", "und"), ("domain", "unknown"))]
    return slices.groupBy(*by).agg(F.count("source_path").alias("files"), *[F.sum(c).alias(c) for c in ("fragments", "tokens", "unique_fragments", "unique_tokens")])


def p3_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_budget(table(spark, sf_dir, "fragments", ["text", "metadata", "chunk_index"]), table(spark, sf_dir, "source_files", ["file_path", "site", "lang", "domain"]))


def p3_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per slice: its files and fragments, and whether the estimate is within 3 % (of small slices 60 tokens) of the exact count."""
    fragments, files = table(spark, sf_dir, "fragments", ["text", "metadata", "chunk_index"]), table(spark, sf_dir, "source_files", ["file_path", "site", "lang", "domain"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = exact_counter(VOCABULARY)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count(b.column(1).to_pylist()), pa.int64())], names=["source_path", "exact"])

    exact = fragments.select(F.col("metadata.source_path").alias("source_path"), "text").mapInArrow(run, "source_path string, exact long").groupBy("source_path").agg(F.sum("exact").alias("exact"))
    labels = files.select(F.col("file_path").alias("source_path"), "site", clean_language(F.col("lang")).alias("lang"), "domain")
    by = [F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in (("site", "unknown"), ("lang", "und"), ("domain", "unknown"))]
    exact = exact.join(labels, "source_path", "left").groupBy(*by).agg(F.sum("exact").alias("exact"))
    off = F.abs(F.col("tokens") - F.col("exact"))
    return token_budget(fragments, files).join(exact, ["site", "lang", "domain"]).select("site", "lang", "domain", "files", "fragments", "unique_fragments", (off <= F.greatest(F.lit(60), 0.03 * F.col("exact"))).alias("near"))


QUERIES = {"p3_token_budget": p3_token_budget, "p3_checked": p3_checked}
SQL: dict[str, str] = {
    "p3_checked": """
WITH f AS (SELECT metadata.source_path AS source_path, metadata.page_or_section AS s, chunk_index AS c, text AS t FROM fragments),
l AS (SELECT file_path AS source_path, site, domain, lower(regexp_extract(trim(lang), '^([A-Za-z]{2,3})(?:[-_].*)?$', 1)) AS code FROM source_files),
k AS (SELECT source_path, site, domain, CASE WHEN length(code) = 2 THEN code ELSE coalesce(MAP {'eng': 'en', 'ger': 'de', 'deu': 'de', 'fre': 'fr', 'fra': 'fr', 'spa': 'es', 'pol': 'pl', 'rus': 'ru'}[code], 'und') END AS lang FROM l),
p AS (SELECT source_path, count(*) AS n, count(DISTINCT (s, c, t)) AS u FROM f GROUP BY source_path)
SELECT coalesce(site, 'unknown') AS site, coalesce(lang, 'und') AS lang, coalesce(domain, 'unknown') AS domain, count(p.source_path) AS files, CAST(sum(n) AS BIGINT) AS fragments, CAST(sum(u) AS BIGINT) AS unique_fragments, TRUE AS near
FROM p LEFT JOIN k ON p.source_path IS NOT DISTINCT FROM k.source_path GROUP BY 1, 2, 3"""
}
