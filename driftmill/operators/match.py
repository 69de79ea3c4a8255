"""Matching of sources against each other: coverage both ways, parts of one record, recovered fields, references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmill.session import join_hot


def coverage(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Every key of either side with ``both``, ``missing`` (expected only) or ``extra``; repeated keys count once."""
    a = expected.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__a", F.lit(True))
    b = present.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__b", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("__a").isNull(), "extra").when(F.col("__b").isNull(), "missing").otherwise("both").alias("state"))


def only_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of the left side whose key the right side lacks."""
    return join_hot(left, right.select(key).distinct(), key, "left_anti")


def merged_sources(lists: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Lists united by key: key, value, sources (sorted names of the lists), conflict (whether lists disagree on the value)."""
    rows = reduce(DataFrame.unionByName, (df.select(key, value, F.lit(name).alias("source")) for name, df in lists.items()))
    return rows.groupBy(key).agg(F.min(value).alias(value), F.array_sort(F.collect_set("source")).alias("sources"), (F.count_distinct(value) > 1).alias("conflict"))


def part_merge(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """One record from parts that share its key.

    The columns of all parts, a part's own value first found; missing_parts (names of parts without the key), and
    conflicts (columns on which parts that hold a value disagree). A record is sound if both are empty.
    """
    names = list(parts)
    columns = list(dict.fromkeys(c for df in parts.values() for c in df.columns if c != key))
    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), (df.select(F.col(key), *(F.col(c).alias(f"{p}__{c}") for c in df.columns if c != key), F.lit(True).alias(f"{p}__here")) for p, df in parts.items()))
    holders = {c: [f"{p}__{c}" for p in names if c in parts[p].columns] for c in columns}
    disagree = lambda cs: reduce(lambda a, b: a | b, (F.coalesce(F.col(x) != F.col(y), F.lit(False)) for i, x in enumerate(cs) for y in cs[i + 1 :]), F.lit(False))
    return joined.select(
        key, *(F.coalesce(*(F.col(x) for x in holders[c])).alias(c) for c in columns),
        F.filter(F.array(*(F.when(F.col(f"{p}__here").isNull(), F.lit(p)) for p in names)), lambda x: x.isNotNull()).alias("missing_parts"),
        F.filter(F.array(*(F.when(disagree(holders[c]), F.lit(c)) for c in columns)), lambda x: x.isNotNull()).alias("conflicts"),
    )


def recovery_merge(fallback: DataFrame, partial: DataFrame, key: str, nested: str, fields: list[str]) -> DataFrame:
    """Fallback records whose nested struct gets the named fields back from partial responses; null where those lack them.

    A record without the nested struct keeps it null. state tells keys that only one side has.
    """
    p = partial.select(key, *(F.col(f"{nested}.{f}").alias(f"__{f}") for f in fields), F.lit(True).alias("__p"))
    f = fallback.withColumn("__f", F.lit(True))
    back = F.col(nested)
    for name in fields:
        back = back.withField(name, F.col(f"__{name}"))
    out = f.join(p, key, "full_outer")
    state = F.when(F.col("__f").isNull(), "extra").when(F.col("__p").isNull(), "missing").otherwise("both")
    return out.withColumn(nested, F.when(F.col(nested).isNotNull(), back)).withColumn("state", state).select(*fallback.columns, "state")


def enriched(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows with the columns of a lookup that has at most one row a key; a repeated lookup key is an error."""
    once = lookup.groupBy(key).agg(*(F.first(c).alias(c) for c in lookup.columns if c != key), F.count("*").alias("__n"))
    checked = once.withColumn("__ok", F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit("repeated lookup key "), F.col(key).cast("string")))).otherwise(F.lit(1)).cast("int"))
    return join_hot(df, checked.where("__ok = 1").drop("__n", "__ok"), key, "left")


def redirects(pages: DataFrame, own: str, target: str, content: str | None = None) -> DataFrame:
    """Pages that point elsewhere: own id, target id, whether the target is there, and whether its content names the page."""
    there = pages.select(F.col(own).alias(target), *([F.col(content).alias("__c")] if content else [])).where(F.col(target).isNotNull()).groupBy(target).agg(F.lit(True).alias("__there"), *([F.min("__c").alias("__c")] if content else []))
    rows = pages.where(F.coalesce(F.col(target), F.lit("")) != "").select(own, target)
    out = join_hot(rows, there, target)  # many pages may point to one
    return out.select(own, target, F.coalesce("__there", F.lit(False)).alias("target_present"), *([F.coalesce(F.contains(F.col("__c"), F.col(own)), F.lit(False)).alias("mentions_source")] if content else []))


def strict_part_merge(parts: dict[str, DataFrame], key: str, ordinal: str) -> DataFrame:
    """One record from parts that must hold the same ids in the same order.

    parts: frames with key, ordinal (place in the part's response) and columns, of which structs are merged field by
    field, at any depth. Columns of all parts; problems: missing:<part>, order:<part> (another place than in the first
    part), repeated:<part>, differs:<path> for values on which parts disagree. A record is sound if it has none.
    """
    names = list(parts)
    kinds: dict[str, list[tuple[str, object]]] = {}
    for p in names:
        for f in parts[p].schema:
            if f.name not in (key, ordinal):
                kinds.setdefault(f.name, []).append((p, f.dataType))
    once = {p: parts[p].groupBy(key).agg(F.min(F.struct(F.col(ordinal).alias("at"), *(F.col(c).alias(c) for c in parts[p].columns if c not in (key, ordinal)))).alias(f"{p}__"), F.count("*").alias(f"{p}__n")) for p in names}
    joined = reduce(lambda a, b: a.join(b, key, "full_outer"), once.values())
    problems = [F.when(F.col(f"{p}__n").isNull(), F.lit(f"missing:{p}")) for p in names] + [F.when(F.col(f"{p}__n") > 1, F.lit(f"repeated:{p}")) for p in names]
    problems += [F.when(F.col(f"{p}__")["at"] != F.col(f"{names[0]}__")["at"], F.lit(f"order:{p}")) for p in names[1:]]

    def one(values: list[tuple[Column, object]], path: str) -> Column:
        if len(values) > 1 and all(isinstance(t, T.StructType) for _, t in values):
            fields: dict[str, list[tuple[Column, object]]] = {}
            for c, t in values:
                for f in t:
                    fields.setdefault(f.name, []).append((c[f.name], f.dataType))
            made = F.struct(*(one(v, f"{path}.{n}").alias(n) for n, v in fields.items()))
            return F.when(reduce(lambda a, b: a | b, (c.isNotNull() for c, _ in values)), made)
        for i, (a, _) in enumerate(values):
            for b, _ in values[i + 1 :]:
                problems.append(F.when(a != b, F.lit(f"differs:{path}")))
        return F.coalesce(*(c for c, _ in values)) if len(values) > 1 else values[0][0]

    columns = [one([(F.col(f"{p}__")[c], t) for p, t in held], c).alias(c) for c, held in kinds.items()]
    return joined.select(key, *columns, F.array_distinct(F.array_compact(F.array(*problems))).alias("problems"))
