"""A ledger of answers: interrupted batches go on where they stopped, equal prompts are asked once.

A ledger is a folder of Parquet files, one row per call: ``model``, the digest of the
prompt, answer, error, seconds and when it was asked. Every task that ends adds its
answers for good, also if the job fails later, so that a run after a failure asks only
what no finished task has asked. Calls of a repeated task may be in the ledger twice;
the first answer counts, and an answer counts before any error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quittance.operators.inference import Ask, apply_inference

CALLS_PER_TASK = 500
SCHEMA = "model string, digest string, answer string, error string, seconds double, asked_at timestamp"


def prompt_digest(prompt: Column) -> Column:
    return F.sha2(prompt.cast("binary"), 256)


def entries(spark: SparkSession, ledger: str, model: str = "") -> DataFrame:
    """All calls of a model; none where the folder does not exist yet."""
    try:
        found = spark.read.schema(SCHEMA).parquet(ledger)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], SCHEMA)
    return found.filter(F.col("model") == model)


def answers(spark: SparkSession, ledger: str, model: str = "") -> DataFrame:
    """(digest, answer, error, seconds), one row per prompt that was ever asked."""
    best = F.min(F.struct(F.col("error").isNotNull().alias("failed"), "asked_at", "answer", "error", "seconds"))
    return entries(spark, ledger, model).groupBy("digest").agg(best.alias("best")).select("digest", "best.answer", "best.error", "best.seconds")


def open_prompts(requests: DataFrame, ledger: str, model: str = "", prompt: str = "prompt", ask_errors_again: bool = True) -> DataFrame:
    """(digest, prompt) of the prompts that the ledger has no answer to, each once."""
    known = entries(requests.sparkSession, ledger, model)
    if ask_errors_again:
        known = known.filter("error IS NULL")
    asked = requests.filter(F.col(prompt).isNotNull()).select(prompt_digest(F.col(prompt)).alias("digest"), F.col(prompt).alias("prompt"))
    return asked.dropDuplicates(["digest"]).join(known.select("digest").distinct(), "digest", "left_anti")


def ask_open_prompts(
    requests: DataFrame, connect: Callable[[], Ask], ledger: str, model: str = "", prompt: str = "prompt",
    calls_per_task: int = CALLS_PER_TASK, ask_errors_again: bool = True, **options,
) -> None:
    """Ask what the ledger does not know and add it. ``options`` go to ``apply_inference``.

    A lost task costs at most ``calls_per_task`` calls: its files enter the ledger as
    soon as it ends, not when the job does.
    """
    spark = requests.sparkSession
    # Written down before they are counted, so that the requests are worked out once. Spark reads no folder that starts with "_".
    folder = f"{ledger.rstrip('/')}/_open-{uuid.uuid4().hex}"
    try:
        todo = open_prompts(requests, ledger, model, prompt, ask_errors_again)
        todo.write.parquet(folder)
        todo = spark.read.schema(todo.schema).parquet(folder)
        calls = todo.count()
        if not calls:
            return
        spread = todo.repartition(-(-calls // calls_per_task), "digest")
        asked = apply_inference(spread, connect, "prompt", "answer", "error", seconds="seconds", **options)
        rows = asked.select(F.lit(model).alias("model"), "digest", "answer", "error", "seconds", F.current_timestamp().alias("asked_at"))
        rows.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def apply_with_ledger(
    requests: DataFrame, connect: Callable[[], Ask], ledger: str, model: str = "", prompt: str = "prompt",
    answer: str = "response", error: str = "error", seconds: str | None = None, **options,
) -> DataFrame:
    """``apply_inference`` through a ledger: one row per request, as many calls as there are new prompts.

    The calls are made now; the result only joins. ``ledger`` is a folder that all
    executors reach and that outlives the session. ``model`` names what is asked, with
    all settings that matter, so that one ledger can serve several.
    """
    ask_open_prompts(requests, connect, ledger, model, prompt, **options)
    added = {answer: "answer", error: "error"} | ({seconds: "seconds"} if seconds else {})
    found = answers(requests.sparkSession, ledger, model).select(F.col("digest").alias("_digest"), *[F.col(field).alias(f"_{field}") for field in added.values()])
    joined = requests.withColumn("_digest", prompt_digest(F.col(prompt))).join(found, "_digest", "left")
    return joined.select(*[c for c in requests.columns if c not in added], *[F.col(f"_{field}").alias(name) for name, field in added.items()])
