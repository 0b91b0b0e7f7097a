"""Session helpers: sensible defaults for local work and reliable checkpoints."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the session comes from the submit command; nothing in the library
    depends on the settings below.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loanweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


#: The JVM interprets larger methods for as long as a job runs.
COMPILED_BYTES = "8000"


def without_huge_methods(spark: SparkSession) -> SparkSession:
    """The session, which from now on runs plans operator by operator if their fused code is too long.

    The operators' own code is cut into methods that the JVM compiles.  A limit that somebody
    set lower stays.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name, "65535")) > int(COMPILED_BYTES):
        spark.conf.set(name, COMPILED_BYTES)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the cluster names it.

    ``spark.checkpoint.dir`` decides.  Only a local session that names none gets a
    temporary folder; on a cluster a machine-local folder would be lost with its machine,
    so a missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loanweave-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The DataFrame written to the checkpoint folder and read back, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
