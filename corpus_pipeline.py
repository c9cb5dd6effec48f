"""The corpus pipeline: five of the text operators, one after another, over whole documents.

Each stage takes what its predecessor kept and returns the columns of ``documents``; the last returns
the packed pieces. ``run`` writes every stage's result to the shared folder and reads it again, so a
lost executor repeats one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import decontaminate, ngram_join, packing, quality_rules, substring_dedup
from waybill.sources.scratch import stored

#: Some stages have no SQL form; tests hold each against a brute-force version.
ORACLE_SQL = None
BROADCAST_IDS = 2_000_000


def _recounted(documents: DataFrame, text: DataFrame) -> DataFrame:
    """The given columns with n_chars of the new texts."""
    return text.withColumn("n_chars", F.length("text").cast("long")).select(*documents.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rule or a certified cutoff rejects.

    Cutoffs need the measures of labelled documents only, so those are measured first; then every
    document is measured and judged in the one pass that writes the stage. No table of texts with
    their measures is written in between.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ids = labels.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # The labelled ids, counted: broadcast up to BROADCAST_IDS, so no text is shuffled to find them.
    labelled = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    certified = stored(quality_rules.cutoffs(quality_rules.measured(labelled), labels), "cutoffs")
    return quality_rules.judged(quality_rules.measured(docs), certified).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar ones."""
    return ngram_join.one_of_each(docs)


def repeated_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out words that windows occurring more than once cover."""
    return _recounted(docs, substring_dedup.without_repeats(docs))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out words that benchmark windows cover."""
    return _recounted(docs, decontaminate.without_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of all documents into sequences."""
    return packing.pack(docs, packing.tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("substring_dedup", repeated_windows),
    ("decontaminate", benchmark_passages),
    ("packing", packed),
]


#: Rows a Python task takes at a time in every stage: several stages run two Arrow steps in one task,
#: and long texts make Spark's default of 10,000 rows a batch too much for one executor.
ARROW_ROWS = 1_000


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
