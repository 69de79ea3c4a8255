"""Scalar functions on text, URLs, numbers and JSON, as Column expressions; Python only where Spark has no builtin."""

from __future__ import annotations

import html
import unicodedata
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Unicode white space, with the four separators that Java's class lacks.
SPACE = r"(?U)[\s\x1c-\x1f]+"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sanitize(x: Column | str) -> Column:
    """NUL to space; null to the empty text."""
    return F.coalesce(F.replace(col(x), F.lit("\x00"), F.lit(" ")), F.lit(""))


def collapse(x: Column | str) -> Column:
    """Every run of white space as one space, ends trimmed, null to the empty text."""
    return F.trim(F.regexp_replace(sanitize(x), SPACE, " "))


@F.pandas_udf(T.StringType())
def nfc(x: pd.Series) -> pd.Series:
    """Unicode composition; Spark has no builtin for it."""
    return x.map(lambda t: t if t is None or t.isascii() or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


def norm_text(x: Column | str) -> Column:
    """Composed, white space collapsed, trimmed; null to the empty text."""
    return collapse(nfc(col(x)))


@F.pandas_udf(T.StringType())
def unescape(x: pd.Series) -> pd.Series:
    """HTML entities decoded."""
    return x.map(lambda t: html.unescape(t) if t is not None and "&" in t else t)


@F.pandas_udf(T.StringType())
def url_join(base: pd.Series, url: pd.Series) -> pd.Series:
    """Absolute form of a URL as it stands in a page; an empty one stays empty, one that can't be joined stays as it is."""

    def one(b: str | None, u: str | None) -> str:
        if not u:
            return ""
        u = html.unescape(u)
        try:
            return urljoin(b or "", u)
        except ValueError:
            return u

    return pd.Series([one(b, u) for b, u in zip(base, url, strict=True)])


def filled(x: Column | str) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(col(x), F.lit(""))


def first_nonempty(*xs: Column | str) -> Column:
    """First text that is neither null nor empty, else the empty text."""
    return F.coalesce(*(filled(x) for x in xs), F.lit(""))


def join_nonempty(separator: str, *xs: Column | str) -> Column:
    """Texts that are neither null nor empty, joined."""
    return F.concat_ws(separator, *(filled(x) for x in xs))


def join_array(x: Column | str, separator: str = " | ") -> Column:
    """Elements that are neither null nor empty, joined."""
    return F.array_join(F.filter(col(x), lambda v: v.isNotNull() & (v != "")), separator)


def split_list(x: Column | str, separator: str = ",") -> Column:
    """A separated list without its empty members."""
    return F.filter(F.split(col(x), separator), lambda v: v != "")


def clean_url(url: Column | str) -> Column:
    """A URL without query and fragment."""
    return F.regexp_replace(col(url), r"[?#].*$", "")


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(clean_url(url), r"^(?:[a-zA-Z][\w+.-]*://[^/?#]*)?(/.*)?$", 1)


def url_host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(url), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def with_host(url: Column | str, host: str) -> Column:
    """The URL's path under https and a fixed host."""
    return F.concat(F.lit(f"https://{host}/"), F.regexp_replace(url_path(url), "^/+", ""))


def absolute_http(url: Column | str) -> Column:
    """Whether a URL is absolute, http or https, with a host."""
    return F.coalesce(col(url).rlike(r"^(?i:https?)://[^/?#\s]+"), F.lit(False))


def entity_id(url: Column | str, kind: str = "animes") -> Column:
    """Number that names an entity in a URL's path (letters may precede it, a slug may follow); null if there is none."""
    return F.nullif(F.regexp_extract(url_path(url), rf"/{kind}/[A-Za-z]?(\d+)(?:-|/?$)", 1), F.lit("")).try_cast("bigint")


def path_file_name(url: Column | str, suffix: str = ".html") -> Column:
    """A safe file name from a URL's path: slashes to hyphens, other signs but . _ - to hyphens."""
    return F.concat(F.regexp_replace(F.replace(F.regexp_replace(url_path(url), "^/+|/+$", ""), F.lit("/"), F.lit("-")), r"[^\p{L}\p{N}._-]", "-"), F.lit(suffix))


def hashed_file_name(url: Column | str, suffix: str = ".html") -> Column:
    return F.concat(F.sha2(col(url), 256), F.lit(suffix))


def integer(x: Column | str) -> Column:
    """First whole number of a text, spaces inside it ignored; null if there is none."""
    return F.regexp_extract(F.replace(collapse(x), F.lit(" "), F.lit("")), r"-?\d+", 0).try_cast("bigint")


def json_integer(json: Column | str, path: str) -> Column:
    """A whole number at a JSON path, given as number or text. Booleans, fractions, null, empty text and absence are null."""
    raw = F.get_json_object(col(json), path)
    return F.when(raw.isin("true", "false"), F.lit(None)).when(raw.rlike(r"^-?\d+\.0+$"), F.regexp_extract(raw, r"^-?\d+", 0).try_cast("bigint")).when(raw.rlike(r"^-?\d+\.\d+$"), F.lit(None)).otherwise(integer(raw))


def compact_json(json: Column | str) -> Column:
    """JSON text with sorted keys and no spaces; null, [] and {} become the empty text; what can't be read, null."""
    j = F.to_json(F.try_parse_json(col(json)))
    return F.when(j.isin("null", "[]", "{}") | col(json).isNull(), F.lit("")).otherwise(j)


def episodes(x: Column | str) -> Column:
    """Struct (aired, total) of ``a / b``, ``a / ?`` or a single number, which is both."""
    t = collapse(x)
    shape = r"^(\d+)\s*/\s*(\d+|\?)"
    aired, total = F.regexp_extract(t, shape, 1).try_cast("bigint"), F.regexp_extract(t, shape, 2).try_cast("bigint")
    single = F.regexp_extract(t, r"^(\d+)$", 1).try_cast("bigint")
    return F.struct(F.coalesce(aired, single).alias("aired"), F.coalesce(total, single).alias("total"))


def resolution(x: Column | str) -> Column:
    """Struct (width, height) of ``W x H`` with a Latin, Cyrillic or multiplication sign."""
    shape = r"(\d+)\s*[xхXХ×]\s*(\d+)"
    return F.struct(F.regexp_extract(col(x), shape, 1).try_cast("bigint").alias("width"), F.regexp_extract(col(x), shape, 2).try_cast("bigint").alias("height"))


def file_identity(stem: Column | str) -> Column:
    """Struct (id, kind, prefix) of a file's stem: numeric, letters then a number, or any other name."""
    s = col(stem)
    made = lambda i, kind, prefix: F.struct(i.alias("id"), F.lit(kind).alias("kind"), prefix.alias("prefix"))
    none = F.lit("")
    return F.when(s.rlike(r"^\d+$"), made(s, "numeric", none)).when(s.rlike(r"^[A-Za-z]+\d+$"), made(F.regexp_extract(s, r"\d+$", 0), "prefixed", F.regexp_extract(s, r"^[A-Za-z]+", 0))).otherwise(made(none, "named", none))


def error_detail(json: Column | str) -> Column:
    """Struct (status, message) of an error object: statusCode else status; distinct statusMessage and message joined."""
    status = F.coalesce(json_integer(json, "$.statusCode"), json_integer(json, "$.status"))
    parts = F.array_distinct(F.filter(F.array(*(F.trim(sanitize(F.get_json_object(col(json), f"$.{k}"))) for k in ("statusMessage", "message"))), lambda v: v != ""))
    return F.struct(status.alias("status"), F.array_join(parts, ": ").alias("message"))


def text_of_bytes(x: Column | str) -> Column:
    """UTF-8 bytes as text, bad sequences replaced."""
    return F.make_valid_utf8(col(x).cast("string"))
