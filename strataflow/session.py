"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-plans joins from measured sizes: small sides become
# broadcasts, hot partitions are split, tiny ones are merged.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Spark 4.1 takes a union of parts that are dealt by one key as dealt by it, and joins it
# without a shuffle; but once run, the parts may come one after the other.
UNION_PARTITIONING = "spark.sql.unionOutputPartitioning"


def build_session(app: str = "strataflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, visible to every executor.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strataflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def deal_unions_again(spark: SparkSession) -> None:
    """Have unions shuffled before they are joined or grouped, for the rest of the session."""
    spark.conf.set(UNION_PARTITIONING, "false")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Fixes the rows and their order inside each file, survives the loss of
    executors, and gives later joins real file sizes to plan with.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A parquet table, or None when nothing was written there yet."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
