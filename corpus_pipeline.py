"""Clean a corpus for training: the stages in order, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import bpe, decontaminate, quality, secrets, setjoin
from strataflow.llm.queries import tokenizer_path
from strataflow.session import materialize

BATCH_ROWS = 1000  # of texts, in one Arrow batch


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_ROWS``.

    Spark's own 10,000 rows are tens of MB of text, which the JVM and Python
    both hold beside the heap, for every task, and keep from stage to stage.
    Fewer rows that a session asks for stay.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go."""
    small_batches(spark)
    return quality.keep_good(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the smallest id stays."""
    small_batches(spark)
    return setjoin.keep_one(docs, 5, (80, 100))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    small_batches(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark that says whether they look live or copied."""
    small_batches(spark)
    return secrets.redact(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text that they decode to."""
    small_batches(spark)
    return bpe.encode_decode(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("BPE encoding and decoding", bpe_encoding),
]

# The stages train models and verify near copies; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
