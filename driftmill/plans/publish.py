"""Staged, verified, idempotent publication of typed tables, with a manifest for each version.

A table is a folder of versions, of which a small numbered file names the current one (store.Versions). publish() writes
the rows once, into a stage that carries what it was made from; reads the stage back and verifies it there (rows, schema,
repeated keys, digest); and makes it current by creating the next number, so readers see the earlier version or the new
one, and of two publishers at once the second fails. Data equal to the current version is left out again. Data that calls
itself incomplete is refused unless that is allowed. A stage is written in parts: after a run that died, the parts that
are verified whole are kept and only the others written, if source, schema, keys and number of parts are the same.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmill import schemas
from driftmill.operators.order import with_previous
from driftmill.session import cut
from driftmill.store import Store, Versions


def table_digest(df: DataFrame) -> str:
    """Digest of a table's rows without regard to their order; one aggregation."""
    h = F.xxhash64(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    r = df.agg(F.bit_xor(h).alias("x"), F.sum(F.pmod(F.xxhash64(h), F.lit(2**31))).alias("s"), F.count("*").alias("n")).first()
    return f"{(r['x'] or 0) & (2**64 - 1):016x}-{r['s'] or 0}-{r['n']}"


def unsorted(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once; with the sort done by the writer this is all that can break a strict order."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def _parts(df: DataFrame, keys: list[str], parts: int) -> list[DataFrame]:
    if parts == 1:
        return [df]
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    return [df.where(part == i) for i in range(parts)]


def stage(df: DataFrame, path: str, keys: list[str], source: str | None = None, parts: int = 1, rows_per_file: int = 1_000_000) -> tuple[str, int]:
    """Writes a frame's parts into a stage of the table; its folder, and how many parts an earlier run had left whole.

    source: what the rows are made from (a fingerprint, a manifest's digest). Without it nothing is resumed.
    """
    store = Store(df.sparkSession, path)
    made_of = {"source": source, "schema_sha256": schemas.schema_hash(df.schema), "keys": keys, "parts": parts}
    folder = f"{path}/_stage"
    told = store.read(f"{folder}/_made_of.json")
    if source is None or told is None or json.loads(told) != made_of:
        store.delete(folder)
        store.fs.mkdirs(store.path(folder))
        store.write(f"{folder}/_made_of.json", json.dumps(made_of, sort_keys=True))
    kept = 0
    for i, one in enumerate(_parts(df, keys, parts)):
        at, sound = f"{folder}/part={i}", store.read(f"{folder}/_part-{i}.json")
        if sound is not None and store.exists(f"{at}/_SUCCESS") and json.loads(sound)["identity"] == json.loads(json.dumps(store.identity(at))):
            kept += 1
            continue
        store.delete(at)
        one.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").parquet(at)
        store.write(f"{folder}/_part-{i}.json", json.dumps({"identity": store.identity(at)}))
    return folder, kept


def publish(df: DataFrame, path: str, keys: list[str], *, force: bool = False, complete: bool = True, allow_incomplete: bool = False, rows_per_file: int = 1_000_000, attributes: dict | None = None, source: str | None = None, parts: int = 1) -> dict:
    """Writes a table sorted by its keys; returns the manifest with status ``published`` or ``already_present``.

    The frame is computed once for each part. source and parts: see stage(); a run that resumes a stage says how many
    parts it kept in resumed_parts.
    """
    spark = df.sparkSession
    if not complete and not allow_incomplete:
        raise ValueError("the source is incomplete; allow_incomplete publishes it as it is")
    store = Store(spark, path)
    versions = Versions(store, path)
    old = versions.current()
    folder, kept = stage(df, path, keys, source, parts, rows_per_file)
    back = spark.read.schema(df.schema).parquet(*(f"{folder}/part={i}" for i in range(parts)))
    written = spark.read.parquet(*(f"{folder}/part={i}" for i in range(parts)))
    if schemas.signature(written.schema) != schemas.signature(df.schema):
        raise ValueError("what was written isn't what was to be written")
    digest, schema = table_digest(back), schemas.schema_hash(df.schema)
    if old["number"] and old["digest"] == digest and old["schema_sha256"] == schema and not force:
        store.delete(folder)
        return old | {"status": "already_present"}
    if old["number"] and not force:
        store.delete(folder)
        raise FileExistsError(f"{path} holds other rows; force replaces them")
    if repeated := unsorted(back, keys).limit(20).collect():
        store.delete(folder)
        raise ValueError(f"repeated keys: {[tuple(r)[:-1] for r in repeated]}")
    name = f"_version-{old['number'] + 1:06d}-{uuid.uuid4().hex}"
    manifest = {"version_folder": name, "parts": parts, "rows": int(digest.rsplit("-", 1)[1]), "columns": len(back.columns), "digest": digest, "schema_sha256": schema, "sorted_by": keys, "bytes": store.size(folder), "version": schemas.VERSION, "complete": complete, "source": source, **(attributes or {})}
    store.move(folder, f"{path}/{name}")
    now = versions.take(old, manifest)
    versions.forget(old["number"])
    live = {name, old.get("version_folder")}
    for child in store.children(path):  # the version before stays for those who still read it
        if child.startswith("_version-") and child not in live:
            store.delete(f"{path}/{child}")
    return now | {"status": "published", "resumed_parts": kept}


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current version of a published table."""
    m = manifest(spark, path)
    if m is None:
        raise FileNotFoundError(f"no table is published at {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*(f"{path}/{m['version_folder']}/part={i}" for i in range(m["parts"])))


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the current version."""
    m = Versions(Store(spark, path), path).current()
    return m if m["number"] else None


def verify(spark: SparkSession, path: str) -> list[str]:
    """What is wrong with a published table, by its manifest."""
    m = manifest(spark, path)
    if not m:
        return ["no manifest"]
    df = read(spark, path)
    wrong = []
    digest = table_digest(df)
    if int(digest.rsplit("-", 1)[1]) != m["rows"]:
        wrong.append("rows")
    if digest != m["digest"]:
        wrong.append("digest")
    if len(df.columns) != m["columns"]:
        wrong.append("columns")
    return wrong


def bounds(spark: SparkSession, path: str, keys: list[str]) -> tuple | None:
    """First and last key of a published table; min and max of a struct, answered from the key columns alone."""
    r = read(spark, path).select(F.struct(*keys).alias("k")).agg(F.min("k").alias("a"), F.max("k").alias("b")).first()
    return None if r["a"] is None else (tuple(r["a"]), tuple(r["b"]))


def append_batch(df: DataFrame, path: str, batch: str) -> str:
    """Appends a batch once: one that was written before, even if its acknowledgement was lost, is not written again.

    The batch's rows are counted where they were written, before and after it takes its place.
    """
    store = Store(df.sparkSession, path)
    target, staging = f"{path}/batch={batch}", f"{path}/.staging-{batch}"
    if store.exists(f"{target}/_SUCCESS"):
        return "already_present"
    store.delete(staging)
    store.delete(target)
    df.write.parquet(staging)
    before = store.identity(staging)
    store.move(staging, target)
    if store.identity(target) != before:
        raise OSError(f"batch {batch} changed on its way")
    return "appended"


def greedy_batches(df: DataFrame, order: list[str], size: str, max_rows: int, max_bytes: int) -> DataFrame:
    """Batches in order, each closed before it would pass max_rows or max_bytes; a row larger than that is a batch of its own.

    The borders are those of one pass over all rows in order, whatever the partitions. Rows are range-partitioned; for
    each range and each possible start within its first max_rows rows the batches are followed to the range's end, which
    gives the place in the next range where the next batch begins; chaining these small tables gives every range its start.
    """
    names = [f.name for f in df.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", batch bigint"
    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()))

    def ends(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # state carried into a range: rows and bytes of the batch that is open there; what it becomes depends on both, so
        # the sizes of the range's first rows, up to where any open batch must close, and its own batches from each of them
        sizes: list[int] = []
        p = None
        for pdf in parts:
            p = int(pdf["__p"].iloc[0]) if p is None and len(pdf) else p
            sizes += [int(b) for b in pdf[size]]
        if p is None:
            return
        n = len(sizes)
        after = [n] * (n + 1)  # the first row that no longer fits a batch which starts at a row
        end, used = 0, 0
        for i in range(n):
            if end < i:
                end, used = i, 0
            while end < n and (end == i or end - i < max_rows and used + sizes[end] <= max_bytes):
                used += sizes[end]
                end += 1
            after[i] = end
            used -= sizes[i]
        count, last = [0] * (n + 1), [n] * (n + 1)  # batches that close within the range from a start on, and the start of the one left open
        for i in range(n - 1, -1, -1):
            j = after[i]
            count[i], last[i] = (0, i) if j >= n else (count[j] + 1, last[j])
        head = min(n, max_rows)
        left = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            left[i] = left[i + 1] + sizes[i]
        # any open batch closes within the first max_rows rows: for each of these as the start of the next one, how the range ends
        yield pd.DataFrame({"__p": [p], "n": [n], "head": [sizes[:head]], "count": [count[: head + 1]], "open_rows": [[n - last[i] for i in range(head + 1)]], "open_bytes": [[left[last[i]] for i in range(head + 1)]]})

    table = ranged.select("__p", size).mapInPandas(ends, "__p int, n bigint, head array<bigint>, count array<bigint>, open_rows array<bigint>, open_bytes array<bigint>")
    start: dict[int, tuple[int, int, int]] = {}  # of each range: number of the batch that is open, its rows and bytes
    batch, rows, used = 0, 0, 0
    for r in table.orderBy("__p").toLocalIterator():  # one row a range, of at most max_rows numbers
        start[r["__p"]] = (batch, rows, used)
        i = 0
        while i < len(r["head"]) and (not rows or rows < max_rows and used + r["head"][i] <= max_bytes):
            if not rows:
                break
            rows, used, i = rows + 1, used + r["head"][i], i + 1
        if i < r["n"]:
            batch += int(rows > 0) + r["count"][i]
            rows, used = r["open_rows"][i], r["open_bytes"][i]

    def number(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for pdf in parts:
            if state is None and len(pdf):
                state = start[int(pdf["__p"].iloc[0])]
            batch, n, used = state or (0, 0, 0)
            numbers = []
            for b in pdf[size]:
                if n and (n >= max_rows or used + int(b) > max_bytes):
                    batch, n, used = batch + 1, 0, 0
                n, used = n + 1, used + int(b)
                numbers.append(batch)
            state = (batch, n, used)
            yield pdf[names].assign(batch=numbers)

    return ranged.mapInPandas(number, schema)


def move_tree(spark: SparkSession, source: str, target: str, *, dry_run: bool = False, expected: set[str] | None = None) -> dict:
    """Moves a folder once: done already, to do, or in conflict; refuses targets inside the source and unexpected children. What arrives must be what left (Store.identity)."""
    a, b = source.rstrip("/"), target.rstrip("/")
    if b == a or b.startswith(a + "/") or a.startswith(b + "/"):
        raise ValueError("source and target overlap")
    store = Store(spark, a)
    here, there = store.exists(a), store.exists(b)
    if here and there:
        raise FileExistsError("both source and target exist")
    if not here and not there:
        raise FileNotFoundError(a)
    children, before = store.children(a if here else b), store.identity(a if here else b)
    if expected is not None and set(children) != expected:
        raise ValueError(f"children differ: {sorted(set(children) ^ expected)}")
    if there:
        return {"status": "already_moved", "children": children}
    if not dry_run:
        store.move(a, b)
        if store.identity(b) != before:
            raise OSError("the folder changed on the way")
    return {"status": "would_move" if dry_run else "moved", "children": children}


def report(df: DataFrame, size: str, key: str, status: str) -> dict:
    """Rows, bytes, first and last key, and rows by status, before anything is published."""
    r = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.min(key).alias("first"), F.max(key).alias("last")).first().asDict()
    return r | {"statuses": {x[0]: x[1] for x in df.groupBy(status).count().collect()}}


def cached(spark: SparkSession, path: str, inventory: str, code: str) -> dict | None:
    """The manifest of an earlier result, if inventory and code are the same and the table is still sound."""
    m = manifest(spark, path)
    return m if m and m.get("inventory") == inventory and m.get("code") == code and not verify(spark, path) else None


def export_tsv(df: DataFrame, path: str, keys: list[str]) -> None:
    """A folder of TSV files in order of the keys, every text on one line: white space collapsed, blanks for null."""
    from driftmill.functions.text import collapse

    clean = df.orderBy(*keys).select(*(collapse(F.col(f.name).cast("string")).alias(f.name) for f in df.schema))
    clean.write.mode("errorifexists").options(sep="\t", header=True, quote="", escape="", emptyValue="", nullValue="").csv(path)


def export_json_lines(df: DataFrame, path: str, keys: list[str], *, keep_nulls: bool, files: int | None = None) -> None:
    """Gzip JSON Lines in order of the keys, fields in the table's order; keep_nulls writes null fields too.

    Equal rows give equal bytes: the order is total where the keys are, and the codec writes neither a time nor a name.
    files: how many ranges the keys are cut into, by default as many as the rows' size asks for.
    """
    (df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)).sortWithinPartitions(*keys).write.mode("errorifexists").options(compression="gzip", ignoreNullFields=str(not keep_nulls).lower()).json(path)


def pending(df: DataFrame, path: str, key: str) -> DataFrame:
    """Rows whose key a target doesn't hold yet; all of them before the target exists."""
    spark = df.sparkSession
    return df.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti") if Store(spark, path).exists(path) else df


def manifest_problems(manifest: dict, contract: dict[str, object], counts: dict[str, tuple[str, ...]] | None = None) -> list[str]:
    """What a manifest breaks: values it must have (a type, or the value itself), and totals that must equal the sum of other entries."""
    wrong = []
    for key, want in contract.items():
        have = manifest.get(key)
        if isinstance(want, type):
            if not isinstance(have, want) or (want is int and (isinstance(have, bool) or have < 0)):
                wrong.append(f"{key} is no {want.__name__}")
        elif have != want:
            wrong.append(f"{key} is {have!r}, not {want!r}")
    for total, parts in (counts or {}).items():
        if all(isinstance(manifest.get(k), int) for k in (total, *parts)) and manifest[total] != sum(manifest[k] for k in parts):
            wrong.append(f"{total} isn't the sum of {', '.join(parts)}")
    return wrong
