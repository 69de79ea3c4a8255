"""Data-quality rules: each a named boolean expression of what is wrong; rows carry the names of the rules they break."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    """Named SQL expressions that are true where a row is wrong; null counts as not wrong."""

    wrong: dict[str, str]

    def violations(self) -> Column:
        return F.filter(F.array(*(F.when(F.coalesce(F.expr(e), F.lit(False)), F.lit(name)) for name, e in self.wrong.items())), lambda x: x.isNotNull())

    def check(self, df: DataFrame) -> DataFrame:
        """The rows with an array violations."""
        return df.withColumn("violations", self.violations())

    def counts(self, df: DataFrame) -> DataFrame:
        """Rows that break each rule, in one pass: rule, rows."""
        sums = df.agg(*(F.coalesce(F.sum(F.coalesce(F.expr(e), F.lit(False)).cast("bigint")), F.lit(0)).alias(n) for n, e in self.wrong.items()))
        return sums.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("rows")) for n in self.wrong))).alias("x")).select("x.*")

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Sound rows, and rows in quarantine with their violations."""
        checked = self.check(df)
        return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)

    def strict(self, df: DataFrame, key: str) -> DataFrame:
        """The rows, or an error that names the first row found wrong."""
        v = F.col("violations")
        ok = F.when(F.size(v) > 0, F.raise_error(F.concat(F.lit("row "), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(": "), F.array_join(v, ", ")))).otherwise(F.lit(True)).cast("boolean")
        return self.check(df).where(ok).drop("violations")


_BLANK_RATIO = "votes_for + votes_against = 0 AND usefulness_ratio IS NOT NULL"
REVIEW_RULES = Rules(
    {
        "non_positive_id": "anime_id <= 0 OR usefulness_rank <= 0 OR review_id <= 0 OR topic_id <= 0 OR author_id <= 0 OR source_page <= 0 OR source_position <= 0",
        "negative_count": "votes_for < 0 OR votes_against < 0 OR votes_total < 0 OR comments_count < 0 OR inline_spoilers_count < 0 OR block_spoilers_count < 0",
        "opinion": "coalesce(opinion, '') NOT IN ('positive', 'neutral', 'negative')",
        "user_score": "user_score NOT BETWEEN 0 AND 10",
        "votes_total": "votes_total <> votes_for + votes_against",
        "usefulness_score": "coalesce(usefulness_score <> votes_for - votes_against, true)",
        "usefulness_ratio": f"({_BLANK_RATIO}) OR (votes_for + votes_against > 0 AND coalesce(abs(usefulness_ratio - votes_for / (votes_for + votes_against)) > 1e-12, true))",
    }
)
NEWS_RULES = Rules(
    {
        "negative_id": "source_id < 0 OR news_id < 0",
        "source_bytes": "source_bytes <= 0",
        "status": "coalesce(status, '') NOT IN ('ok', 'not_found', 'nuxt_error', 'missing_news', 'parse_error')",
        "source_file": "source_file <> concat(source_id, '.html')",
        "source_sha256": "coalesce(source_sha256, '') NOT RLIKE '^[0-9a-f]{64}$'",
        "error_code_range": "error_status_code NOT BETWEEN 100 AND 599",
        "ok_with_error": "status = 'ok' AND error_status_code IS NOT NULL",
        "ok_other_id": "status = 'ok' AND NOT (news_id <=> source_id)",
        "not_found_code": "status = 'not_found' AND NOT (error_status_code <=> 404)",
        "parse_error_message": "status = 'parse_error' AND coalesce(error_message, '') = ''",
        "reaction_total": "reaction_total <> reaction_like_count + reaction_fire_count + reaction_dislike_count",
        "too_many_comments": "comments_loaded_count > comments_total",
        "comments_complete": "comments_loaded_count <= comments_total AND comments_complete <> (comments_loaded_count = comments_total)",
    }
)


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once, with the number of their rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def range_coverage(df: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """Ids of a range that are missing, and ids outside it: key, state."""
    wanted = df.sparkSession.range(first, last + 1).withColumnRenamed("id", key)
    present = df.select(F.col(key).cast("bigint").alias(key)).where(F.col(key).isNotNull()).distinct()
    return wanted.join(present, key, "left_anti").withColumn("state", F.lit("missing")).unionByName(present.where(~F.col(key).between(first, last)).withColumn("state", F.lit("extra")))


def key_set(json: Column | str, required: list[str], optional: list[str] = ()) -> Column:
    """Struct (missing, extra) of a JSON object's keys against a contract; null if it is no object."""
    keys = F.json_object_keys(json if isinstance(json, Column) else F.col(json))
    lit = lambda xs: F.array(*(F.lit(x) for x in xs)) if xs else F.array().cast("array<string>")
    return F.when(keys.isNotNull(), F.struct(F.array_except(lit(required), keys).alias("missing"), F.array_except(keys, lit([*required, *optional])).alias("extra")))


def field_coverage(expected: dict[str, list[str]], actual: DataFrame, kind: str = "type", field: str = "field") -> DataFrame:
    """Fields of each type that a selection lacks, and that it names in vain: type, field, state."""
    spark = actual.sparkSession
    wanted = spark.createDataFrame([(t, f) for t, fs in expected.items() for f in fs], f"{kind} string, {field} string")
    have = actual.select(kind, field).distinct()
    return have.join(wanted, [kind, field], "left_anti").withColumn("state", F.lit("missing")).unionByName(wanted.distinct().join(have, [kind, field], "left_anti").withColumn("state", F.lit("extra")))
