"""Session helpers shared by every entry point."""

from __future__ import annotations

import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

REPO_ROOT = str(Path(__file__).resolve().parents[2])


def local_session(app: str = "siftwell", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests, the bench and the CLI share."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "6g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


#: Rows and bytes of an Arrow batch: a worker and the JVM each hold a few batches at once, and texts make rows large.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, whatever folder the driver was started in, and bound their batches.

    Batch sizes that the session was given smaller are left as they are.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        now = int(re.sub(r"\D", "", spark.conf.get(key)) or 0)
        if not 0 < now <= most:
            spark.conf.set(key, str(most))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if REPO_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([REPO_ROOT, *filter(None, paths)])
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; where
    that is unset, a local session takes a temporary folder, and any other is an
    error, as its executors would not see the driver's.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="siftwell-checkpoint-"))
    return df.checkpoint(eager=True)
