"""Session helpers: where to checkpoint, how wide to run, what may be broadcast."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of estimated plan size up to which a side may be broadcast.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table of a directory of tables."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir). A temporary one is made only where that is unset and Spark runs in one process; a cluster without it is refused."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared is None:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            return jvm_dir.get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="driftmill-checkpoint-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(shared)
    return shared


def cut(df: DataFrame) -> DataFrame:
    """Materialise a frame in the shared checkpoint folder, so that later stages survive lost executors without recomputing it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a frame's size. For a bare file scan this is the size of its files; filters and aggregates never lower it below what they can prove."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only where the estimated size is within the limit; otherwise the join stays a shuffle join."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def spread(df: DataFrame) -> DataFrame:
    """Widen a scan that has fewer splits than half the cores, for stages bound by Python CPU.

    Large inputs have plenty of splits and are returned as they are, so no shuffle is added at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


#: Parts that rows are dealt into where a join key may hold a large share of them.
SALTS = 16


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "left", rows: int | None = None, limit: int = 1_000_000) -> DataFrame:
    """Joins on a key that may hold a third of the left rows; how is inner, left, left_semi or left_anti, null matches nothing.

    The right side is broadcast if it is proven small: by Catalyst's estimate, or by rows, its number of rows where the
    caller has counted them. Otherwise the left rows are dealt into SALTS parts, and the right side stands in each.
    """
    small = broadcast_if_small(right) if rows is None else F.broadcast(right) if rows <= limit else right
    if small is not right:
        return left.join(small, key, how)
    others = [c for c in left.columns if c != key]
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*others) if others else F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return salted.join(right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [key, "__salt"], how).drop("__salt")
