"""Incremental ingestion of landed files as a stream that ends when it has caught up."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmill.plans.publish import append_batch
from driftmill.store import Store, Versions


def ingest(spark: SparkSession, landed: str, schema: T.StructType, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, kind: str = "parquet", files_per_batch: int = 1000) -> list[int]:
    """Takes every file that landed since the last run through a transformation into the target, each exactly once.

    A batch is appended under the checkpoint's id and its number, so one that is repeated after a failure isn't written
    twice, and one of another checkpoint isn't taken for it. Returns the numbers of the batches that this run wrote.
    """
    store = Store(spark, checkpoint)
    store.fs.mkdirs(store.path(checkpoint))
    if (name := store.read(f"{checkpoint}/ingest.id")) is None:
        name = uuid.uuid4().hex
        store.write(f"{checkpoint}/ingest.id", name, overwrite=False)
    written: list[int] = []

    def put(df: DataFrame, number: int) -> None:
        if append_batch(transform(df), target, f"{name}-{number}") == "appended":
            written.append(number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(landed)
    q = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return written


def keep_latest(spark: SparkSession, landed: str, schema: T.StructType, target: str, checkpoint: str, key: str, version: str, kind: str = "parquet") -> DataFrame:
    """Greatest version of every key and how many versions came (key, version, versions), kept by a stream over landed files.

    Each batch is aggregated by itself and merged with the table's current version into the next one, so the stream holds
    no state and no batch gives the whole table again. The version's manifest names the batch: one that is repeated after
    a failure finds its own number there and changes nothing.
    """
    store = Store(spark, target)
    versions = Versions(store, target)

    def put(df: DataFrame, number: int) -> None:
        before = versions.current()
        if before["number"] and before["batch"] >= number:
            return
        new = df.groupBy(key).agg(F.max(version).alias(version), F.count("*").alias("versions"))
        if before["number"]:
            new = new.unionByName(df.sparkSession.read.parquet(f"{target}/{before['folder']}")).groupBy(key).agg(F.max(version).alias(version), F.sum("versions").alias("versions"))
        folder = f"_version-{before['number'] + 1:012d}-{uuid.uuid4().hex}"
        new.write.parquet(f"{target}/{folder}")
        versions.take(before, {"batch": number, "folder": folder})
        versions.forget(before["number"])
        for child in store.children(target):
            if child.startswith("_version-") and child not in (folder, before.get("folder")):
                store.delete(f"{target}/{child}")

    stream = spark.readStream.schema(schema).format(kind).load(landed)
    q = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    now = versions.current()
    if not now["number"]:
        return spark.createDataFrame([], T.StructType([schema[key], schema[version], T.StructField("versions", T.LongType())]))
    return spark.read.parquet(f"{target}/{now['folder']}")


def latest_pages(stream: DataFrame, key: str, version: str, late: str = "1 day") -> DataFrame:
    """Greatest version of every key as a stream with a watermark on event time."""
    return stream.withWatermark(version, late).groupBy(key).agg(F.max(version).alias(version), F.count("*").alias("versions"))
