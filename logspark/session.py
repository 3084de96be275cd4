"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on for right results.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # repeated keys in one JSON object: the last one wins instead of failing the row
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that only help speed; left alone where the cluster already set them.
ADVISED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # long plans: do not record the Python call site of every single Column
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator assumes and return the session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "logspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ADVISED, **REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Root of the folder all executors see, as named by ``spark.checkpoint.dir``.

    A local master may fall back to a temporary folder; a cluster may not, because
    another machine's task could never read it back.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="logspark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, never cleared here."""
    return f"{shared_dir(spark)}/logspark/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint: the result survives the loss of any executor."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
