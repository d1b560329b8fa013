"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the joins rely on: AQE splits the partitions a hot key
# fills, also where a later step would want the same partitioning.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
# Steps with much work per row: several tasks a core, as one more than there are cores would take two rounds.
TASKS_PER_CORE = 4


def build_session(app: str = "stockweave", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", **ADAPTIVE, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive defaults to a session somebody else made."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    least = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionNum", str(least))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; only a local session may fall back to /tmp."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stockweave-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once and go on from there.

    A reliable checkpoint survives the loss of any executor, and both sides of
    a self-join then see the very same rows and partition numbers.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def settle_table(df: DataFrame, name: str, at: str | None = None) -> DataFrame:
    """Like `settle`, as Parquet: later steps read back only the columns they need.

    With `at`, a folder that the caller uses again for every run, the table of the run
    before is overwritten, so that a stream leaves no more than one behind.
    """
    target = f"{at}/{name}" if at else scratch_path(df.sparkSession, name)
    df.write.mode("overwrite" if at else "errorifexists").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
