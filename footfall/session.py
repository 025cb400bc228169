"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the Python call site of every column operation makes wide plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "footfall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew-join splitting on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the cluster's checkpoint folder.

    Only where the session names none and runs in one process (local tests) is a temporary folder made, once per
    application. On a cluster every machine would write to a disk of its own, so there a folder must be named.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("on a cluster, name a folder all machines share in spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="footfall-"))
        folder = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """The application's own folder in the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/footfall-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cleanup(spark: SparkSession) -> None:
    """Delete what this application has written to its folder. Tables it handed out can't be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, partitioned ``by`` a column if given, and read it back.

    Cuts the lineage, survives the loss of executors, keeps columns prunable, and gives Catalyst true
    sizes, so that it broadcasts the result only when it is small.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_all(frames: dict[str, DataFrame]) -> list[DataFrame]:
    """Write independent tables at the same time, so that the tail of one job is filled by the next."""
    shared_folder(next(iter(frames.values())).sparkSession)
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(lambda item: materialise(item[1], item[0]), frames.items()))
