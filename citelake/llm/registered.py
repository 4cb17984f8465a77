"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.llm import best_two_fit
from citelake.llm.hidden_markov import score
from citelake.llm.host_rules import apply_host_rules
from citelake.llm.latent_retrieval import contaminated
from citelake.llm.letter_runs import run_counts
from citelake.llm.license_scan import scan_licenses
from citelake.llm.packing import decompose
from citelake.llm.parity_join import near_duplicates
from citelake.llm.scratch import written
from citelake.llm.shipping import ship
from citelake.llm.site_bayes import classify
from citelake.llm.spelling import group_spellings
from citelake.llm.suffix_dedup import remove_repeats
from citelake.llm.token_spans import count_by_section, line_sections
from citelake.llm.transcripts import recover_roles
from citelake.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP6_SQL = r"""
WITH worded AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM worded WHERE len(words) >= 5),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i:i+4]) AS times FROM places),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM windows, (VALUES (0), (1), (2), (3), (4)) AS t(k) WHERE times > 1 GROUP BY doc_id),
measured AS (
  SELECT w.doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM worded w LEFT JOIN covered c ON w.doc_id = c.doc_id),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 3 * n_lines) AS DOUBLE) AS failures FROM judged GROUP BY source),
totals AS (SELECT sum(n) AS n, sum(failures) / sum(n) AS mean, sum(failures * failures / n) AS squares,
  count(*) AS hosts FROM hosts),
prior AS (
  SELECT mean, CASE WHEN squares / n - mean * mean - mean * (1 - mean) * (hosts - 1) / n > 1e-12
    THEN greatest(mean * (1 - mean) / (squares / n - mean * mean - mean * (1 - mean) * (hosts - 1) / n) - 1, 1.0)
    ELSE 1e12 END AS strength FROM totals),
verdicts AS (SELECT source, (failures + strength * mean) / (n + strength) <= 0.5 AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_kept AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source
"""


@query(OP6_SQL)
def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_host_rules(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def tokenizer() -> dict[str, str]:
    return {
        "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


@query()
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = decompose(table(spark, sf_dir, "documents"), **tokenizer())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query()
def op4_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op2_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


@query()
def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op5_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "p_own", "p_site", "p_reject", (~F.col("rejected")).alias("kept"))


@query()
def op3_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op1_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_section(
        table(spark, sf_dir, "documents"), **tokenizer(), sections=line_sections(F.col("text"))
    )


@query()
def op9_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    # Roles of a tenth of the conversations are not learned from.
    known = rows.filter(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 10 != 0)
    return recover_roles(rows, known).withColumnRenamed("role", "recovered")


@query()
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query()
def op11_golub_kahan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query()
def op12_prefix_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = run_counts(table(spark, sf_dir, "documents"), least=7, every=31)
    return group_spellings(written(words.filter("n >= 2")))


@query()
def op13_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = best_two_fit.encode_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return best_two_fit.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
