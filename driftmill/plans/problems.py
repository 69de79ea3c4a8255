"""Queries of the general data problems, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftmill.operators import incremental, nested
from driftmill.session import checkpoint_dir, spread, table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return nested.entity_links(spread(table(spark, sf, "animes").select("record_id", *nested.ENTITY_LAYOUTS)), spread(table(spark, sf, "news").select("source_id", "nuxt_news")))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """What completed runs wrote is published as one run; the next run takes the entity table from that run's saved tree."""
    current, written = incremental.entity_states(table(spark, sf, "animes"), table(spark, sf, "load_ledger"), table(spark, sf, "load_runs"))
    state = incremental.Published(spark, f"{checkpoint_dir(spark)}/entities-{uuid.uuid4().hex}")
    state.publish(written)
    return state.publish(current).select(F.col("key").alias("id"), F.floor(F.col("version") / F.lit(1_000_000)).cast("bigint").alias("updated_epoch"))


QUERIES = {"p1_found": p1_found, "p3_found": p3_found}

_EPOCH = r"""
CASE WHEN regexp_full_match(trim(updatedat), '\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}([.,]\d{1,9})?\s?([Zz]|UTC|GMT|[+-]\d{2}(:?\d{2})?)') THEN
  epoch(try_strptime(replace(replace(substr(trim(updatedat), 1, 19), 't', 'T'), ' ', 'T'), '%Y-%m-%dT%H:%M:%S'))
  + coalesce(try_cast('0.' || nullif(regexp_extract(trim(updatedat), '[.,](\d{1,9})', 1), '') AS DOUBLE), 0)
  - CASE WHEN regexp_matches(trim(updatedat), '[+-]\d{2}(:?\d{2})?$') AND NOT regexp_matches(trim(updatedat), '(Z|z|UTC|GMT)$') THEN
      (CASE WHEN regexp_extract(trim(updatedat), '([+-])\d{2}(:?\d{2})?$', 1) = '-' THEN -1 ELSE 1 END)
      * (CAST(regexp_extract(trim(updatedat), '[+-](\d{2})(:?\d{2})?$', 1) AS BIGINT) * 3600
         + coalesce(try_cast(nullif(regexp_extract(trim(updatedat), '[+-]\d{2}:?(\d{2})$', 1), '') AS BIGINT), 0) * 60)
    ELSE 0 END
END"""

_READ = """
  SELECT *, CASE WHEN json_type(j) = 'VARCHAR' THEN try_cast(j ->> '$' AS JSON) ELSE j END AS k FROM (
    SELECT *, CASE WHEN json_type(i) = 'VARCHAR' THEN try_cast(i ->> '$' AS JSON) ELSE i END AS j FROM (SELECT *, try_cast(v AS JSON) AS i FROM src))"""
_LIST = "CASE json_type({0}) WHEN 'ARRAY' THEN CAST({0} AS JSON[]) WHEN 'OBJECT' THEN [{0}] END"
_ID = "nullif(trim(CASE WHEN json_type({0}, '{1}') IN ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') THEN json_extract_string({0}, '{1}') END), '')"

SQL = {
    "p1_found": f"""
WITH src AS (
  SELECT record_id AS root_id, 'related' AS c, 'related' AS w, related AS v FROM animes UNION ALL SELECT record_id, 'character_role', 'characterRoles', characterroles FROM animes UNION ALL SELECT record_id, 'person_role', 'personRoles', personroles FROM animes
  UNION ALL SELECT source_id, 'news', 'news', nuxt_news FROM news),
told AS ({_READ}),
list AS (SELECT root_id, c, unnest(CASE WHEN json_type(k, '$.items') = 'ARRAY' THEN CAST(k -> '$.items' AS JSON[]) WHEN json_type(k, '$.nodes') = 'ARRAY' THEN CAST(k -> '$.nodes' AS JSON[]) WHEN json_type(k -> w) = 'ARRAY' THEN CAST(k -> w AS JSON[]) ELSE {_LIST.format("k")} END) AS e FROM told WHERE c <> 'news'),
el AS (SELECT root_id, c, e, {_ID.format("e", "$.id")} AS id FROM list WHERE json_type(e) = 'OBJECT'),
news_at AS (SELECT root_id, CASE WHEN json_type(k, '$.news') = 'OBJECT' THEN k -> '$.news' ELSE k END AS n FROM told WHERE c = 'news' AND json_type(k) = 'OBJECT'),
tag AS (SELECT root_id, unnest({_LIST.format("(n -> '$.tags')")}) AS e FROM news_at),
show_at AS (SELECT root_id, unnest({_LIST.format("(n -> '$.shows')")}) AS e FROM news_at),
shows AS (SELECT root_id, e, {_ID.format("e", "$.id")} AS id FROM show_at WHERE json_type(e) = 'OBJECT'),
season_at AS (SELECT root_id, id AS show_id, unnest({_LIST.format("(e -> '$.seasons')")}) AS e FROM shows),
season AS (SELECT root_id, show_id, e, show_id || ':' || {_ID.format("e", "$.number")} AS id FROM season_at WHERE json_type(e) = 'OBJECT'),
episode_at AS (SELECT root_id, id AS season_id, unnest({_LIST.format("(e -> '$.episodes')")}) AS e FROM season),
links AS (
  SELECT 'anime' AS root_kind, root_id, 'anime' AS parent_kind, CAST(root_id AS VARCHAR) AS parent_key, c AS child_kind, id AS child_key FROM el
  UNION ALL SELECT 'anime', root_id, 'related', id, 'related_anime', {_ID.format("e", "$.anime.id")} FROM el WHERE c = 'related'
  UNION ALL SELECT 'anime', root_id, 'related', id, 'related_manga', {_ID.format("e", "$.manga.id")} FROM el WHERE c = 'related'
  UNION ALL SELECT 'anime', root_id, 'character_role', id, 'character', {_ID.format("e", "$.character.id")} FROM el WHERE c = 'character_role'
  UNION ALL SELECT 'anime', root_id, 'person_role', id, 'person', {_ID.format("e", "$.person.id")} FROM el WHERE c = 'person_role'
  UNION ALL SELECT 'news', root_id, 'news', CAST(root_id AS VARCHAR), 'category', {_ID.format("n", "$.category.alias")} FROM news_at
  UNION ALL SELECT 'news', root_id, 'news', CAST(root_id AS VARCHAR), 'tag', {_ID.format("e", "$.alias")} FROM tag
  UNION ALL SELECT 'news', root_id, 'news', CAST(root_id AS VARCHAR), 'show', id FROM shows
  UNION ALL SELECT 'news', root_id, 'show', show_id, 'season', id FROM season
  UNION ALL SELECT 'news', root_id, 'season', season_id, 'episode', {_ID.format("e", "$.id")} FROM episode_at)
SELECT DISTINCT * FROM links WHERE root_id IS NOT NULL AND parent_key IS NOT NULL AND child_key IS NOT NULL""",
    "p3_found": f"""
WITH cur AS (SELECT id, max({_EPOCH}) AS at FROM animes WHERE id IS NOT NULL GROUP BY id),
was AS (SELECT id, max({_EPOCH}) AS at FROM load_ledger WHERE run_no IN (SELECT run_no FROM load_runs WHERE outcome = 'done') GROUP BY id)
SELECT cur.id, CAST(floor(cur.at) AS BIGINT) AS updated_epoch FROM cur LEFT JOIN was USING (id)
WHERE cur.at IS NOT NULL AND (was.at IS NULL OR cur.at > was.at)""",
}
