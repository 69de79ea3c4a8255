"""Places and neighbours of rows in groups of any size, without a task that sees more than it can hold.

A frame that Catalyst's estimate proves to be no larger than PLAIN_BYTES takes a plain window, as no group can be larger
than the frame. Beyond that, rows are range-partitioned by group and order, so a large group lies in many consecutive chunks. Ranks and neighbours are
taken within a chunk and carried over its border from a table with one row for each group and chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftmill.session import broadcast_if_small, cut, plan_bytes

_CHUNK = "__chunk"
#: Estimated bytes up to which a frame takes a plain window, and bytes of a chunk beyond it; the same in rows, for frames of which Catalyst has no estimate (what comes from a checkpoint, for one).
PLAIN_BYTES, CHUNK_BYTES = 64 << 20, 128 << 20
PLAIN_ROWS, CHUNK_ROWS = 200_000, 1_000_000
#: An estimate from which it is none.
UNKNOWN = 1 << 60


def _chunks(df: DataFrame) -> int:
    """Chunks that a frame is cut into; 0 if a plain window holds it."""
    size = plan_bytes(df)
    most, chunk = PLAIN_BYTES, CHUNK_BYTES
    if size >= UNKNOWN:
        size, most, chunk = df.count(), PLAIN_ROWS, CHUNK_ROWS
    return 0 if size <= most else max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // chunk))


def chunked(df: DataFrame, group: list[str], order: list[Column], parts: int) -> DataFrame:
    """Rows with the number of their chunk, rising with the order within each group. Kept in the checkpoint folder, because ranges are sampled anew when computed again."""
    return cut(df.repartitionByRange(parts, *(F.col(g) for g in group), *order).withColumn(_CHUNK, F.spark_partition_id()))


def _at_chunk(df: DataFrame, table: DataFrame, group: list[str]) -> DataFrame:
    """Rows with the columns of a table with one row for each group and chunk."""
    named = table.select(*(F.col(g).alias(f"__k{i}") for i, g in enumerate([*group, _CHUNK])), *(c for c in table.columns if c not in (*group, _CHUNK)))
    on = [df[g].eqNullSafe(named[f"__k{i}"]) for i, g in enumerate([*group, _CHUNK])]
    return df.join(broadcast_if_small(named), on).drop(*(f"__k{i}" for i in range(len(group) + 1)))


def placed(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Rows with their place within the group, from 1 (BIGINT). The order must be one without ties for the places to be fixed."""
    if not (parts := _chunks(df)):
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))
    rows = chunked(df, group, order, parts)
    sizes = rows.groupBy(*group, _CHUNK).agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(*group).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    local = rows.withColumn("__place", F.row_number().over(Window.partitionBy(*group, _CHUNK).orderBy(*order)))
    return _at_chunk(local, before, group).withColumn(name, F.col("__place") + F.col("__before")).drop("__place", "__before", _CHUNK)


def with_previous(df: DataFrame, group: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Rows with a value of the row before them in their group; null for the first."""
    if not (parts := _chunks(df)):
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(*group).orderBy(*order)))
    rows = chunked(df, group, order, parts).withColumn("__v", F.struct(value.alias("v")))
    w = Window.partitionBy(*group, _CHUNK).orderBy(*order)
    local = rows.withColumn("__last", F.lead("__v").over(w).isNull()).withColumn(name, F.lag("__v").over(w))
    ends = local.where("__last").select(*group, _CHUNK, F.col("__v").alias("__end"))
    border = ends.withColumn("__border", F.lag("__end").over(Window.partitionBy(*group).orderBy(_CHUNK))).drop("__end")
    return _at_chunk(local, border, group).withColumn(name, F.coalesce(F.col(name), F.col("__border"))["v"]).drop("__v", "__last", "__border", _CHUNK)
