"""Explicit schemas, sort keys and versions of the tables; never inferred. Column names and order are the contract (fixed values)."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import types as T

VERSION = 1
_KINDS = {"s": T.StringType(), "l": T.LongType(), "d": T.DoubleType(), "b": T.BooleanType(), "x": T.BinaryType(), "as": T.ArrayType(T.StringType())}
LINK = T.StructType([T.StructField(k, T.StringType()) for k in ("href", "url", "text", "title", "rel")])
IMAGE = T.StructType([*(T.StructField(k, T.StringType()) for k in ("src", "url", "srcset", "alt", "title", "width", "height", "data_width", "data_height")), T.StructField("classes", T.ArrayType(T.StringType()))])
PAGE_META = T.StructType(
    [*(T.StructField(k, T.StringType()) for k in ("dataset", "source_file", "page_kind", "content_type")), T.StructField("content_bytes", T.LongType()), *(T.StructField(k, T.StringType()) for k in ("content_sha256", "file_mtime_utc"))]
    + [T.StructField("sources", T.ArrayType(T.StringType())), *(T.StructField(k, T.StringType()) for k in ("validation_status", "original_url"))]
)


def _struct(spec: str, optional: str = "", special: dict[str, T.DataType] | None = None) -> T.StructType:
    """name:kind pairs; a name without a kind is text. Names in optional may be null."""
    free, special = set(optional.split()), special or {}
    fields = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        fields.append(T.StructField(name, special.get(name) or _KINDS[kind or "s"], name in free))
    return T.StructType(fields)


REVIEWS = _struct(
    "anime_id:l usefulness_rank:l review_id:l topic_id:l anime_slug anime_title anime_url review_url author_id:l author_nickname author_nickname_snapshot author_url author_avatar_url author_avatar_srcset opinion user_score:l user_list_status "
    "votes_for:l votes_against:l votes_total:l usefulness_score:l usefulness_ratio:d comments_count:l created_at published_at updated_at is_written_before_release:b body_text body_html body_links body_images inline_spoilers_count:l block_spoilers_count:l source_file source_page:l source_position:l",
    "user_score user_list_status usefulness_ratio",
    {"body_links": T.ArrayType(LINK), "body_images": T.ArrayType(IMAGE)},
)
NEWS = _struct(
    "source_id:l news_id:l status error_status_code:l error_message slug url canonical_url page_title title foreword content_text content_html published_at modified_at source_site image_url image_width:l image_height:l image_alt media_source video_html "
    "author_id:l author_name author_url author_description author_articles_count:l category_title category_slug comments_total:l comments_new:l comments_loaded_count:l comments_meta_count:l comments_complete:b has_spoilers:b "
    "reaction_like_count:l reaction_fire_count:l reaction_dislike_count:l reaction_love_count:l reaction_anger_count:l reaction_shock_count:l reaction_total:l images tags content_links content_images similar_news categories comments comments_meta "
    "comments_with_images read_also_aside read_also_main emotions author catalog_links seo_meta hreflang_links json_ld nuxt_news nuxt_route nuxt_errors parse_warnings:as source_file source_bytes:l source_sha256",
    "news_id error_status_code image_width image_height author_id author_articles_count comments_total comments_new comments_loaded_count comments_meta_count",
)
RAW_PAGES = _struct("url html:x meta", special={"meta": PAGE_META})
#: Sort key of each table.
SORT_KEYS = {"reviews": ["anime_id", "usefulness_rank", "review_id"], "news": ["source_id"], "raw_pages": ["url"], "animes": ["id"]}
TABLES = {"reviews": REVIEWS, "news": NEWS, "raw_pages": RAW_PAGES}


def schema_hash(schema: T.StructType) -> str:
    """Digest of a schema's names, kinds and nullability, in order."""
    return hashlib.sha256(json.dumps([(f.name, f.dataType.simpleString(), f.nullable) for f in schema], separators=(",", ":")).encode()).hexdigest()


def signature(schema: T.StructType) -> list[tuple[str, str]]:
    """What two schemas must share to be one table's: names and kinds in order."""
    return [(f.name, f.dataType.simpleString()) for f in schema]
