"""Session with the settings that the operators expect, and the shared folder for checkpoints."""

import gc
import re
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", **conf: str) -> SparkSession:
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true",
                "spark.ui.enabled": "false"}
    return SparkSession.builder.master(master).config(map=settings | conf).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The session's folder inside the one that spark.checkpoint.dir names. Where that is unset, a folder of our own in local mode, as in tests, and an
    error on a cluster, whose machines share no temporary folder."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and the executors share")
            folder = tempfile.mkdtemp(prefix="auralith-")
        context.setCheckpointDir(folder)
        # checkpoints go when nothing refers to them any more; the setting is read when one is written
        context._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts lineage in the shared folder.

    A checkpoint keeps the planner's estimate of its size. That of a join is the product of its sides, so in a loop that joins a table with itself the number's
    digits double each round, until planning takes seconds and hundreds of MB of the driver; estimates beyond 2 ** 62 bytes are forgotten."""
    shared_folder(df.sparkSession)
    out = df.checkpoint()
    plan = out._jdf.queryExecution().logical()
    if plan.stats().sizeInBytes().bit_length() <= 62:
        return out
    session, none = out._jdf.sparkSession(), df.sparkSession._jvm.scala.Option.empty()
    fresh = df.sparkSession._jvm.org.apache.spark.sql.execution.LogicalRDD(*[plan.productElement(i) for i in range(plan.productArity())], session, none, none)
    return DataFrame(df.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, fresh), df.sparkSession)


def tidy(spark: SparkSession) -> None:
    """Lets Spark's cleaner find the shuffle files and checkpoints that nothing refers to any more; for between the phases of long jobs, where disk would add up."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def brief(spark: SparkSession) -> Iterator[None]:
    """Each action on tables made inside deletes its shuffle files when it ends, not when Spark's cleaner finds them. For loops that checkpoint each table they go on with; a second
    action on the same DataFrame would compute it anew. Tables made afterwards are as before."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def tidied(spark: SparkSession, every: float = 3.0) -> Iterator[None]:
    """Tidies every few seconds while a long job runs, so that the driver's heap stays near what it holds and files go soon."""
    done = threading.Event()

    def loop() -> None:
        while not done.wait(every):
            spark._jvm.System.gc()

    thread = threading.Thread(target=loop, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
