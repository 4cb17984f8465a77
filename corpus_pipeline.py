"""The corpus pipeline: quality, near copies, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
``documents``. ``run`` writes each stage's rows as Parquet and reads them back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake.llm.latent_retrieval import contaminated
from citelake.llm.packing import decompose
from citelake.llm.parity_join import near_duplicates
from citelake.llm.registered import table
from citelake.llm.scratch import written
from citelake.llm.shipping import ship
from citelake.llm.site_bayes import classify
from citelake.llm.suffix_dedup import remove_repeats

# SQL has no equal of the classifier and the tokenizer.
ORACLE_SQL = None


def without(docs: DataFrame, found: DataFrame) -> DataFrame:
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    judged = classify(docs, table(spark, sf_dir, "labels"))
    return judged.filter(~F.col("rejected")).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; a null id stands for itself."""
    ship(spark)
    groups = near_duplicates(docs)
    return without(docs, groups.filter("component_id != doc_id"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a document with a smaller id holds; characters cut in two go."""
    ship(spark)
    cut = remove_repeats(docs)
    changed = F.col("n_removed") > 0
    return (
        cut.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")))
        .select(*[F.col(f.name).cast(f.dataType) for f in docs.schema.fields])
    )


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids."""
    ship(spark)
    return decompose(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
