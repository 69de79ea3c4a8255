"""Distributions, histograms, completeness, gaps and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmill.operators.order import with_previous


def histogram(df: DataFrame, column: str, name: str = "status") -> DataFrame:
    """Rows of each value; null counts as the empty text."""
    return df.groupBy(F.coalesce(F.col(column), F.lit("")).alias(name)).agg(F.count("*").alias("rows"))


def incomplete_reasons(df: DataFrame, column: str, listed: list[str], also: str = "api_error", fine: str = "api_error_404") -> DataFrame:
    """``status: count`` for the listed statuses and those that begin with also, but for the fine one, sorted: one row, reasons."""
    h = histogram(df, column).where(F.col("status").isin(listed) | (F.col("status").startswith(also) & (F.col("status") != fine)))
    return h.agg(F.array_sort(F.collect_list(F.concat_ws(": ", "status", F.col("rows").cast("string")))).alias("reasons"))


def pair_stats(json: Column, label: str, count: str = "count") -> Column:
    """Map of label to count of a JSON list of objects; a repeated label keeps its last count, an unreadable list gives null."""
    pairs = F.from_json(json, f"array<struct<{label}: string, {count}: bigint>>")
    last = lambda x: F.try_element_at(F.filter(pairs, lambda y: y[label] == x), F.lit(-1))[count]
    labels = F.array_distinct(F.filter(F.transform(pairs, lambda y: y[label]), lambda v: v.isNotNull()))
    return F.map_from_arrays(labels, F.transform(labels, last))


def score_distribution(df: DataFrame, keys: list[str], json: str) -> DataFrame:
    """Counts of scores 10 to 1, their total, and the mean rounded half-even to four places; null counts where the list is missing, 0 for a score it lacks."""
    m = F.col("__m")
    there = df.select(*keys, pair_stats(F.col(json), "score").alias("__m"))
    values = F.map_values(m)
    total = F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    weighted = F.aggregate(F.map_entries(m), F.lit(0).cast("bigint"), lambda a, e: a + F.coalesce(e["key"].try_cast("bigint"), F.lit(0)) * F.coalesce(e["value"], F.lit(0)))
    return there.select(
        *keys, *(F.when(m.isNotNull(), F.coalesce(F.try_element_at(m, F.lit(str(i))), F.lit(0))).alias(f"score_{i}_count") for i in range(10, 0, -1)),
        F.when(m.isNotNull(), total).alias("score_votes_total"), F.when(m.isNotNull() & (total > 0), F.bround(weighted / total, 4)).alias("score_distribution_mean"),
    )


def list_distribution(df: DataFrame, keys: list[str], json: str, statuses: list[str]) -> DataFrame:
    """Counts of each list status and their total."""
    m = F.col("__m")
    there = df.select(*keys, pair_stats(F.col(json), "status").alias("__m"))
    total = F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return there.select(*keys, *(F.when(m.isNotNull(), F.coalesce(F.try_element_at(m, F.lit(s)), F.lit(0))).alias(f"list_{s}_count") for s in statuses), F.when(m.isNotNull(), total).alias("list_total"))


#: Emotion ids of the payload and the columns they fill (fixed values).
REACTIONS = {2: "like", 3: "fire", 4: "dislike", 5: "love", 6: "anger", 7: "shock"}


def reactions(df: DataFrame, keys: list[str], json: str) -> DataFrame:
    """Counts by reaction of a JSON list of (emotionId, count), the last of each id, and their total."""
    whole = lambda v: F.when(v.rlike(r"^\s*-?\d+(\.0+)?\s*$"), F.regexp_extract(v, r"-?\d+", 0).try_cast("bigint"))
    told = F.from_json(F.col(json), "array<struct<emotionId: string, count: string>>")
    items = F.filter(F.transform(told, lambda x: F.struct(whole(x["emotionId"]).alias("id"), whole(x["count"]).alias("n"))), lambda x: x["n"].isNotNull())
    rows = df.select(*keys, items.alias("__i"))
    last = lambda i: F.try_element_at(F.filter("__i", lambda x: x["id"] == i), F.lit(-1))["n"]
    counts = [F.coalesce(last(i), F.lit(0)).alias(f"reaction_{name}_count") for i, name in REACTIONS.items()]
    out = rows.select(*keys, *counts)
    return out.withColumn("reaction_total", sum((F.col(f"reaction_{n}_count") for n in REACTIONS.values()), F.lit(0)).cast("bigint"))


def completeness(loaded: DataFrame, declared: DataFrame, key: str, item: str, count: str) -> DataFrame:
    """Distinct loaded items against the declared count: key, loaded, declared, complete, missing."""
    n = loaded.groupBy(key).agg(F.count_distinct(item).alias("loaded"))
    return declared.select(key, F.col(count).alias("declared")).join(n, key, "left").select(key, F.coalesce("loaded", F.lit(0)).alias("loaded"), "declared", (F.coalesce("loaded", F.lit(0)) == F.col("declared")).alias("complete"), (F.col("declared") - F.coalesce("loaded", F.lit(0))).alias("missing"))


def contiguity(df: DataFrame, key: str) -> DataFrame:
    """First, last and number of distinct ids, and whether none between is missing."""
    return df.agg(F.min(key).alias("first_id"), F.max(key).alias("last_id"), F.count_distinct(key).alias("ids")).withColumn("contiguous", F.col("last_id") - F.col("first_id") + 1 == F.col("ids"))


def gaps(df: DataFrame, key: str) -> DataFrame:
    """Holes in a sequence of ids: after, gap (missing ids)."""
    ids = df.select(F.col(key).cast("bigint").alias("id")).where("id IS NOT NULL").distinct()
    return with_previous(ids, [], [F.col("id")], F.col("id"), "after").where("id > after + 1").select("after", (F.col("id") - F.col("after") - 1).alias("gap"))


def missing_numbers(df: DataFrame, group: list[str], number: str) -> DataFrame:
    """Numbers from 1 to the group's greatest that it lacks, as a sorted array; groups that lack none are left out.

    Holes come from neighbours, so only what is missing is ever listed.
    """
    held = df.where(F.col(number).cast("bigint") > 0).select(*group, F.col(number).cast("bigint").alias("__n")).distinct()
    holes = with_previous(held, group, [F.col("__n")], F.col("__n"), "__before").withColumn("__before", F.coalesce("__before", F.lit(0))).where("__n > __before + 1")
    listed = holes.select(*group, F.explode(F.sequence(F.col("__before") + 1, F.col("__n") - 1)).alias("__m"))
    return listed.groupBy(*group).agg(F.array_sort(F.collect_list("__m")).alias("missing"))


def fingerprint(df: DataFrame, path: str, digest: str, digits: int = 3) -> DataFrame:
    """Digest of a tree of files, from their paths and digests in order of path: files, digest.

    Digests are first folded by the first hex digits of the path's own hash, a multiple of 3, and folds then 4096 at a
    time, so that no task sees more than a part of a very large tree: 3 digits suit some ten million files, 6 any number.
    """
    fold = F.substring(F.sha2(F.col(path), 256), 1, digits)
    one = lambda rows: F.sha2(F.array_join(F.transform(F.array_sort(rows), lambda r: F.concat_ws("\t", r["p"], r["d"])), "\n"), 256)
    parts = df.groupBy(fold.alias("p")).agg(F.collect_list(F.struct(F.col(path).alias("p"), F.col(digest).alias("d"))).alias("r"), F.count("*").alias("n")).select("p", one(F.col("r")).alias("d"), "n")
    for upper in range(digits - 3, 0, -3):
        parts = parts.groupBy(F.substring("p", 1, upper).alias("q")).agg(F.collect_list(F.struct("p", "d")).alias("r"), F.sum("n").alias("n")).select(F.col("q").alias("p"), one(F.col("r")).alias("d"), "n")
    return parts.agg(F.sum("n").alias("files"), one(F.collect_list(F.struct("p", "d"))).alias("digest"))
