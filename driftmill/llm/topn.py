"""Top N rows of every group, also where one group holds a third of all rows.

Two passes. The first counts rows per group and score bin, which combines on the map side and leaves at most BINS rows a
group; a running count from the top bin down gives each group its threshold, the lowest bin needed to keep at least N
rows. The second drops all rows below the threshold and ranks what is left exactly. Bins only ever keep too much, never
too little, so the result is exact. Groups are salted where rows meet their threshold, and the final ranking keeps N
rows of each partial sort before its shuffle, so a group whose rows all tie still never meets in one task.

Defined results: a null group is a group; a null score sorts below every number and NaN above; ties fall to the tie
keys in order, descending, nulls last; equal rows in all keys are ordered by nothing else, so give a unique last key;
groups with fewer than N rows give all of them; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftmill.session import broadcast_if_small, cut

#: Sub-bins of each power of two of a score, and parts that the rows of one group are salted into.
SUB_BINS, SALTS = 8, 16


def score_bin(score: Column) -> Column:
    """Bin of a score, never falling where the score rises: SUB_BINS bins for each power of two, on both signs of zero."""
    x = score.cast("double")
    size = F.floor(F.log2(F.least(F.abs(x), F.lit(1e300)) + 1) * SUB_BINS).cast("int")
    return F.when(x.isNull(), F.lit(-(2**30))).when(F.isnan(x), F.lit(2**30)).when(x < 0, -size).otherwise(size)


def thresholds(df: DataFrame, group: str, score: str, n: int) -> DataFrame:
    """Lowest bin that each group needs so that at least n of its rows survive: columns group, __least."""
    counts = df.groupBy(F.col(group), score_bin(F.col(score)).alias("bin")).agg(F.count("*").alias("rows"))
    above = F.sum("rows").over(Window.partitionBy(group).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("above", F.coalesce(above, F.lit(0))).where(F.col("above") < n).groupBy(group).agg(F.min("bin").alias("__least"))


def top_n(df: DataFrame, group: str, score: str, ties: list[str], n: int, place: str = "place") -> DataFrame:
    """The n rows of every group highest in score, then in the tie keys, all descending; with their place from 1 (BIGINT).

    df is read twice; give a frame that is cheap to read again, as after cut().
    """
    least = thresholds(df, group, score, n).withColumnRenamed(group, "__group")
    hinted = broadcast_if_small(least)
    if hinted is least:  # not proven small: a salted shuffle join
        least = least.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(score, *ties), F.lit(SALTS)).cast("int"))
        kept = salted.join(least, salted[group].eqNullSafe(least["__group"]) & (salted["__salt"] == least["__salt"])).drop(least["__salt"]).drop("__salt")
    else:
        kept = df.join(hinted, df[group].eqNullSafe(hinted["__group"]))
    kept = kept.where(score_bin(F.col(score)) >= F.col("__least")).select(*df.columns)
    order = [F.desc_nulls_last(c) for c in (score, *ties)]
    return kept.withColumn(place, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("bigint")).where(F.col(place) <= n)


def current_reviews(reviews: DataFrame) -> DataFrame:
    """One row a review_id, that with the greatest (source_page, source_position): anime_id, review_id, score, votes_for.

    A null usefulness_score is votes_for - votes_against. Rows without a review_id are left out.
    """
    score = F.coalesce("usefulness_score", F.col("votes_for") - F.col("votes_against"))
    held = F.struct("source_page", "source_position", "anime_id", score.alias("score"), "votes_for")
    return reviews.where("review_id IS NOT NULL").groupBy("review_id").agg(F.max(held).alias("r")).select("r.anime_id", "review_id", "r.score", "r.votes_for")


def top_reviews(reviews: DataFrame, n: int = 5) -> DataFrame:
    return top_n(cut(current_reviews(reviews)), "anime_id", "score", ["votes_for", "review_id"], n).select("anime_id", "review_id", "place")
