"""Quality rules whose verdict is taken by host (operator 6), in DataFrame functions only.

Each document is measured on its own. Failures are added up by host, the hosts' rates are shrunk
towards the common rate by a beta prior that is fitted to all hosts, and the verdict on a host is
joined back to its documents.

Defined results: a null or blank text has no words and fails; a null host is a host of its own;
repeated rows are judged as rows; an empty table gives an empty table. Other columns are kept, but
for those that bear the name of a result, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citelake.functions.once import with_computed
from citelake.llm.scratch import written

BLANKS = " \t\n\x0b\f\r"
BREAK = "[ \t-\r]+"
WINDOW = 5
# Parts that the rows of one host are dealt out over in the join.
HOST_PARTS = 16
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def word_list(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BREAK))


def line_list(text: Column) -> Column:
    """Lines with a word, as they stand."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike("[^ \t-\r]"))


def window_hashes(words: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def repeated_starts(hashes: Column) -> Column:
    """Positions, in order, of the values that occur more than once.

    Sorting puts equal values side by side, so that the work stays n log n in very long texts.
    """
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(
        F.size(F.array_distinct(hashes)) == F.size(hashes), F.array().cast("array<int>")
    ).otherwise(
        F.aggregate(
            F.array(placed),
            F.array().cast("array<int>"),
            lambda _, pairs: F.array_sort(
                F.transform(
                    F.filter(
                        pairs,
                        lambda x, k: F.coalesce(x["h"] == F.get(pairs, k - 1)["h"], F.lit(False))
                        | F.coalesce(x["h"] == F.get(pairs, k + 1)["h"], F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        )
    )


def covered_words(starts: Column) -> Column:
    """How many words lie in the windows that begin at the given places."""
    reach = F.transform(
        starts, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)))
    )
    return F.aggregate(reach, F.lit(0), lambda total, x: total + x).cast("bigint")


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of ``MEASURES``, each a bigint."""
    body = F.coalesce(F.col(text), F.lit(""))
    kept = documents.drop(*MEASURES)
    listed = with_computed(kept, _words=word_list(F.col(text)), _lines=line_list(F.col(text)))
    hashed = with_computed(
        listed,
        _hashes=window_hashes(F.col("_words")),
        n_words=F.size("_words").cast("bigint"),
        word_chars=F.length(F.array_join("_words", "")).cast("bigint"),
        n_symbols=F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("bigint"),
        n_lines=F.size("_lines").cast("bigint"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
    )
    placed = with_computed(hashed, _starts=repeated_starts(F.col("_hashes")))
    return placed.select(
        *[c for c in kept.columns],
        *[c for c in MEASURES[:-1]],
        covered_words(F.col("_starts")).alias(MEASURES[-1]),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def any_rule_failed() -> Column:
    """The base rules; more than one symbol for ten words; more than three of ten lines repeated."""
    return (
        base_failed()
        | (10 * F.col("n_symbols") > F.col("n_words"))
        | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
    )


def host_verdicts(measured: DataFrame, host: str, max_rate: float) -> DataFrame:
    """One row per host: documents, failures, the shrunken rate and the verdict.

    The prior's mean is the rate over all documents. Its strength comes from moments: the spread of
    the hosts' rates beyond what chance alone makes. Without such spread all hosts get the mean.
    """
    hosts = measured.groupBy(F.col(host).alias("_host")).agg(
        F.count("*").alias("host_docs"),
        F.count_if(any_rule_failed()).alias("host_failures"),
    )
    hosts = written(hosts)
    n, failures = F.col("host_docs"), F.col("host_failures")
    total, failed, squares, count = hosts.agg(
        F.sum(n), F.sum(failures), F.sum(failures * failures / n), F.count("*")
    ).first()
    total = total or 1
    mean = (failed or 0) / total
    chance = mean * (1 - mean)
    spread = (squares or 0.0) / total - mean * mean - chance * (count - 1) / total
    strength = chance / spread - 1 if spread > 1e-12 else 1e12
    strength = max(strength, 1.0)
    rate = (failures + F.lit(strength * mean)) / (n + F.lit(strength))
    return hosts.withColumn("host_rate", rate).withColumn("host_kept", rate <= max_rate)


def apply_host_rules(
    documents: DataFrame,
    text: str = "text",
    host: str = "source",
    key: str = "doc_id",
    max_rate: float = 0.5,
) -> DataFrame:
    """Each document's columns but for the text, its measures, and ``base_failed``,
    ``host_rate``, ``host_kept``, ``kept``.

    The measures are written once and serve both the sums by host and the result.
    """
    added = ("base_failed", "host_rate", "host_kept", "kept", "host_docs", "host_failures")
    measured = written(measure(documents.drop(*added), text).drop(text))
    verdicts = host_verdicts(measured, host, max_rate)
    copied = verdicts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(HOST_PARTS - 1))))
    dealt = measured.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(HOST_PARTS)).cast("int"))
    joined = dealt.join(
        copied, (dealt["_part"] == copied["_part"]) & dealt[host].eqNullSafe(copied["_host"]), "left"
    ).drop("_part", "_host")
    return joined.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.col("host_kept")
    )
