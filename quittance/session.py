"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings worth having on a cluster; all are runtime settings.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Texts are long to parse for their size: keep all cores busy on small inputs.
    # Large inputs still get parts of the advisory size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods of more than 8000 bytes; a generated stage
    # that gets longer runs faster as separate, compiled operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Recording the Python call site of every column costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}

_ALLOW_DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"


def local_session(cpus: int | str = "*", app: str = "quittance", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_last_duplicate_key(spark: SparkSession) -> None:
    """Let JSON objects with a repeated key parse, the last value winning.

    Spark reads the setting when the plan runs, so it stays on in the session.
    """
    if spark.conf.get(_ALLOW_DUPLICATE_KEYS, "false") != "true":
        spark.conf.set(_ALLOW_DUPLICATE_KEYS, "true")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, set up for ``checkpoint()``.

    It is the one named in ``spark.checkpoint.dir``.  Where that is unset, a local
    session uses a temporary folder; on a cluster the executors could not see
    one another's, so this raises.  Spark removes checkpoints that are no longer in
    use if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set; tables in
    this folder stay until its owner clears it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (not created yet)."""
    return f"{shared_folder(spark).rstrip('/')}/quittance-{name}-{uuid.uuid4().hex}"
