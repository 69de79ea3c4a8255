"""De-duplication, ranking and checks of order, none of which gathers a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftmill.operators.order import placed, with_previous


def content_hash(df: DataFrame, ignore: list[str]) -> Column:
    """Hash of a row's content without its provenance columns."""
    return F.sha2(F.to_json(F.struct(*(c for c in df.columns if c not in ignore)), {"ignoreNullFields": "false"}), 256)


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the one greatest in the order columns. One aggregation, with partial results before its shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)) if all(_orderable(df.schema[c].dataType) for c in rest) else F.max_by(F.struct(*order, *rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*(F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in df.columns))


def _orderable(kind) -> bool:
    return kind.typeName() not in ("map", "variant") and all(_orderable(getattr(kind, a)) for a in ("elementType",) if hasattr(kind, a)) and all(_orderable(f.dataType) for f in getattr(kind, "fields", []))


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys the first by the order columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min_by(F.struct(*order, *rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*(F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in df.columns))


def duplicates(df: DataFrame, keys: list[str], order: list[str], ignore: list[str]) -> DataFrame:
    """Number of repeated rows, and of repeats whose content differs from the occurrence before them: duplicates, conflicts."""
    rows = df.select(*keys, *(c for c in order if c not in keys), content_hash(df, ignore).alias("__h"))
    pairs = with_previous(rows, keys, [F.col(c) for c in order], F.col("__h"), "__b")
    return pairs.agg(F.count("__b").alias("duplicates"), F.coalesce(F.sum((F.col("__b") != F.col("__h")).cast("bigint")), F.lit(0)).alias("conflicts"))


def ranked(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Rows with their place within the group, from 1."""
    return placed(df, group, order, name)


def top(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of every group; Spark keeps n of every partial sort before the shuffle."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


def rank_breaks(df: DataFrame, group: list[str], rank: str) -> DataFrame:
    """Rows whose stored rank isn't the one before plus one (1 for the first): the group, the rank, what came before."""
    return with_previous(df.select(*group, rank), group, [F.col(rank)], F.col(rank), "previous").where(F.col(rank) != F.coalesce(F.col("previous"), F.lit(0)) + 1)


def order_breaks(df: DataFrame, group: list[str], by: list[str], keys: list[str]) -> DataFrame:
    """Rows whose key struct, in the stored order, isn't below that of the row before (strictly falling expected)."""
    return with_previous(df, group, [F.col(c) for c in by], F.struct(*keys), "__before").where(F.col("__before").isNotNull() & (F.struct(*keys) >= F.col("__before"))).drop("__before")


def capped_count(df: DataFrame, group: list[str], cap: int) -> DataFrame:
    """Sum over groups of the smaller of their size and the cap: groups, rows, capped."""
    return df.groupBy(*group).agg(F.count("*").alias("n")).agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.least("n", F.lit(cap))), F.lit(0)).alias("capped"))


def last_known(df: DataFrame, group: list[str], value: str, order: list[str]) -> DataFrame:
    """Last value of each group that isn't null, by the order columns."""
    return df.groupBy(*group).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias(value))


def stops(df: DataFrame, group: list[str], order: str, content: str) -> DataFrame:
    """First page of each listing that is empty or equals the page before it: group, order."""
    return with_previous(df, group, [F.col(order)], F.col(content), "__b").where((F.col("__b") == F.col(content)) | F.col(content).isNull() | (F.size(content) == 0)).groupBy(*group).agg(F.min(order).alias(order))
