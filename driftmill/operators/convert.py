"""JSON rows to typed columns under a contract; each table has rules of its own, so nothing is shared by accident.

A field is whole, double, boolean, text or json. What a value must be depends on the mode:
``lenient``  a whole number may stand as text, a boolean is no number, null and absence are null;
``strict``   a value must have its own JSON kind, and null is allowed in optional fields only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmill.operators.quality import key_set

KINDS = {"whole": "bigint", "double": "double", "boolean": "boolean", "text": "string", "json": "string"}


def _raw(j: Column, name: str) -> Column:
    return F.variant_get(j, f"$['{name}']", "variant")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def field(j: Column, name: str, kind: str, strict: bool) -> tuple[Column, Column]:
    """Value of a field of a variant object, and whether it breaks the contract."""
    v = _raw(j, name)
    k = F.coalesce(_kind(v), F.lit("VOID"))
    text = v.cast("string")
    none = k == "VOID"
    whole, number, boolean, string = k.isin("BIGINT"), k.isin("BIGINT", "DOUBLE") | k.startswith("DECIMAL"), k == "BOOLEAN", k == "STRING"
    if kind == "whole":
        ok = whole | (F.lit(not strict) & (string & text.rlike(r"^\s*-?\d+\s*$")))
        value = F.when(ok, F.trim(text).try_cast("bigint"))
    elif kind == "double":
        ok = number | (F.lit(not strict) & string & text.try_cast("double").isNotNull())
        value = F.when(ok, text.try_cast("double"))
    elif kind == "boolean":
        ok, value = boolean, F.when(boolean, text.try_cast("boolean"))
    elif kind == "text":
        ok = string | (F.lit(not strict) & number)
        value = F.when(ok, text)
    else:
        ok = k.startswith("ARRAY") | k.startswith("OBJECT") | F.lit(not strict)
        value = F.when(~none & ok, F.to_json(v))
    return value, ~none & ~ok


def typed(df: DataFrame, json: str, fields: dict[str, str], *, optional: tuple[str, ...] = (), strict: bool = True, exact: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a JSON column as typed columns, with an array problems: unreadable, missing:x, extra:x, null:x, kind:x.

    exact: keys beyond the fields are problems. A row without problems meets its contract; filter or raise on the others.
    """
    j = F.col("__j")
    told = df.select(*keep, F.col(json).alias("__text"), F.try_parse_json(F.col(json)).alias("__j"))
    keys = key_set("__text", [f for f in fields if f not in optional], [f for f in fields if f in optional])
    read = {name: field(j, name, kind, strict) for name, kind in fields.items()}
    label = lambda word, a: F.transform(a, lambda x: F.concat(F.lit(f"{word}:"), x))
    only = lambda *xs: F.filter(F.array(*xs), lambda x: x.isNotNull())
    null = [F.when(F.array_contains(F.json_object_keys("__text"), n) & read[n][0].isNull() & ~read[n][1], F.lit(f"null:{n}")) for n in fields if n not in optional and strict]
    problems = F.when(keys.isNull(), F.array(F.lit("unreadable"))).otherwise(
        F.concat(label("missing", keys["missing"]), label("extra", keys["extra"]) if exact else F.array().cast("array<string>"), only(*(F.when(b, F.lit(f"kind:{n}")) for n, (_, b) in read.items())), only(*null) if null else F.array().cast("array<string>"))
    )
    return told.select(*keep, *(v.cast(KINDS[fields[n]]).alias(n) for n, (v, _) in read.items()), problems.alias("problems"))


#: Kinds of the entity table's columns (fixed values): numbers, then nested values; the rest is text.
ENTITY_KINDS = dict.fromkeys(("id", "malId", "episodes", "episodesAired", "duration"), "whole") | {"score": "double", "isCensored": "boolean"} | dict.fromkeys(("synonyms", "airedOn", "genres", "studios", "scoresStats", "statusesStats", "related", "characterRoles", "personRoles"), "json")
