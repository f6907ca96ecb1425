"""Session helpers: settings for cluster runs and reliable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Sizes are estimated from the bytes of a file and a fixed width per column; feature rows
    # and tag maps are up to 200 times larger in memory, and a broadcast passes the driver.
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
    # The JVM never compiles a method above this size; larger operators are evaluated one by one in split methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Feature rows repeat the same literals in many columns; deriving constraints
    # from them grows without bound. Join keys that can be null are filtered by hand.
    "spark.sql.constraintPropagation.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors see."""
    _ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, so a lost executor costs no recomputation."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame) -> DataFrame:
    """Like cut, as Parquet: for long tables of plain columns, which are smaller and faster to write and read than checkpointed rows."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
