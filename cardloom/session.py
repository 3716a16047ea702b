"""Session defaults.

``configure`` only sets runtime SQL options, so it also works on a session
that a cluster hands in. Shuffle partition counts and memory stay with the
cluster.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key must be split even when the split costs one more exchange
    # before the aggregate that follows the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Wide feature lists make thousands of column calls; skip their call-site records.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM does not compile methods above 8,000 bytes; wide aggregates then run faster without one fused method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_OPTIONS.items():
        try:
            spark.conf.set(name, value)
        except AnalysisException:
            pass  # fixed at start on this deployment
    return spark


def build_session(app: str = "cardloom", cpus: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names. Only a session on one machine may go without."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local($|\[)", context.master):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="cardloom-checkpoint-")
    context.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Write an intermediate that several steps read to the shared checkpoint folder, once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A fresh path under the shared checkpoint folder, for staged tables."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stage-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write an intermediate that several steps read once, as Parquet in the shared folder, and read it back by column."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
