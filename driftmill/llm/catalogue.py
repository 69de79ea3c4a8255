"""All queries of the training-data operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmill.llm import abuse, markup, packing, pages, pii, residue, topn, winnow
from driftmill.session import table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return topn.top_reviews(table(spark, sf, "reviews"))


def _markup_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf, name) for name, _, _ in markup.SOURCES}


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return markup.found(_markup_tables(spark, sf))


def p4_clean(spark: SparkSession, sf: str) -> DataFrame:
    return markup.cleaned(_markup_tables(spark, sf))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.body_blocks_found(table(spark, sf, "raw_pages"), table(spark, sf, "anime_pages"), table(spark, sf, "news"))


def p5_texts(spark: SparkSession, sf: str) -> DataFrame:
    return pages.body_texts(table(spark, sf, "raw_pages"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return abuse.found(table(spark, sf, "reviews"), table(spark, sf, "news"), table(spark, sf, "labels"))


def p6_rates(spark: SparkSession, sf: str) -> DataFrame:
    return abuse.rates(table(spark, sf, "reviews"), table(spark, sf, "news"), table(spark, sf, "labels"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.found(table(spark, sf, "anime_pages"), table(spark, sf, "news"), table(spark, sf, "raw_pages"))


def p7_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Unfilled slots in every part that p7_found reads, sound records included."""
    return residue.slots_found(table(spark, sf, "anime_pages"), table(spark, sf, "news"), table(spark, sf, "raw_pages"))


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.containers(table(spark, sf, "documents"))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Containers, tokens in them, and the share of their room that is used."""
    c = packing.containers(table(spark, sf, "documents"))
    return c.groupBy("container", "capacity").agg(F.sum("n_tokens").alias("used")).agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), (F.sum("used") / F.sum("capacity")).alias("fill"))


#: Capacities of p8_variable.
CAPACITIES = [512, 1024, 2048]


def p8_variable(spark: SparkSession, sf: str) -> DataFrame:
    """Containers of three capacities, chosen jointly at the least cost of padded attention."""
    return packing.containers(table(spark, sf, "documents"), CAPACITIES, costs=packing.attention_costs(CAPACITIES))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return winnow.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def p9_credited(spark: SparkSession, sf: str) -> DataFrame:
    """Leaks with each stretch credited to the item it agrees with in the most words."""
    return winnow.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"), best=True)


def p9_items(spark: SparkSession, sf: str) -> DataFrame:
    """Leaked test items and how many documents hold each."""
    return p9_found(spark, sf).groupBy("item_id").agg(F.count("*").alias("documents"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return pii.found(table(spark, sf, "documents"), table(spark, sf, "known_names"))


def p10_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return pii.redacted(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "known_names"))


QUERIES = {
    "p2_found": p2_found,
    "p4_found": p4_found, "p4_clean": p4_clean,
    "p5_found": p5_found, "p5_texts": p5_texts,
    "p6_found": p6_found, "p6_rates": p6_rates,
    "p7_found": p7_found, "p7_slots": p7_slots,
    "p8_containers": p8_containers, "p8_fill": p8_fill, "p8_variable": p8_variable,
    "p9_found": p9_found, "p9_items": p9_items, "p9_credited": p9_credited,
    "p10_found": p10_found, "p10_redacted": p10_redacted,
}

SQL = {
    "p2_found": """
WITH last AS (
  SELECT anime_id, review_id, coalesce(usefulness_score, votes_for - votes_against) AS score, votes_for FROM reviews WHERE review_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY source_page DESC NULLS LAST, source_position DESC NULLS LAST) = 1)
SELECT anime_id, review_id, row_number() OVER (PARTITION BY anime_id ORDER BY score DESC NULLS LAST, votes_for DESC NULLS LAST, review_id DESC) AS place
FROM last QUALIFY place <= 5""",
}
