"""Landed files as tables. Names and lengths come from Spark's own listing, so empty files aren't lost; folders are listed on the driver only where empty ones count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftmill.functions.text import absolute_http, file_identity
from driftmill.operators.order import with_previous
from driftmill.session import cut


def _base(spark: SparkSession, folder: str):
    """The folder's file system, its path, and its qualified name with a slash."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, root, fs.makeQualified(root).toString().rstrip("/") + "/"


def _empty(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Files without content, which Spark's scans leave out: path, length, modified_ms. The driver passes over all names but keeps only these."""
    fs, root, base = _base(spark, folder)
    files, rows = fs.listFiles(root, True), []
    while files.hasNext():
        s = files.next()
        if not s.getLen():
            p = s.getPath().toString()
            if p.endswith(suffix) and not p.rsplit("/", 1)[1].startswith((".", "_")):
                rows.append((p.removeprefix(base), 0, s.getModificationTime()))
    return spark.createDataFrame(rows, "path string, length bigint, modified_ms bigint")


def listing(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """Files below a folder: path (relative), length, modified_ms. Hidden files are left out; contents aren't read."""
    _, _, base = _base(spark, folder)
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=f"*{suffix}").load(folder)
    return files.select(F.substring("path", len(base) + 1, 1 << 30).alias("path"), "length", F.unix_millis("modificationTime").alias("modified_ms")).unionByName(_empty(spark, folder, suffix))


def pages(spark: SparkSession, folder: str, pattern: str = "*.html", limit: int | None = None) -> DataFrame:
    """Page files below a folder: source_file, length, content (empty, not lost, for an empty file), modified, sha256; first ones by path if limited."""
    _, _, base = _base(spark, folder)
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    out = content.select(F.substring("path", len(base) + 1, 1 << 30).alias("path"), "length", "content", F.unix_millis("modificationTime").alias("modified_ms"))
    out = out.unionByName(_empty(spark, folder, pattern.lstrip("*")).withColumn("content", F.lit(bytearray())))
    if limit is not None:
        out = out.join(F.broadcast(out.select("path").orderBy("path").limit(limit)), "path", "left_semi") if limit <= 100_000 else out.orderBy("path").limit(limit)
    return out.select(F.col("path").alias("source_file"), "length", "content", F.timestamp_millis("modified_ms").alias("modified")).withColumn("sha256", F.sha2("content", 256))


def numbered_pages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Pages named by number, and what is wrong with the folder: source_file with reason bad_name or repeated_id."""
    all_files = listing(spark, folder)
    named = all_files.withColumn("id", F.regexp_extract("path", r"^(\d+)\.html$", 1).try_cast("bigint"))
    bad = named.where("id IS NULL").select(F.col("path").alias("source_file"), F.lit("bad_name").alias("reason"))
    again = named.where("id IS NOT NULL").groupBy("id").agg(F.array_sort(F.collect_list("path")).alias("p")).where(F.size("p") > 1).select(F.explode("p").alias("source_file"), F.lit("repeated_id").alias("reason"))
    good = pages(spark, folder).withColumn("source_id", F.regexp_extract("source_file", r"^(\d+)\.html$", 1).try_cast("bigint")).where("source_id IS NOT NULL")
    return good, bad.unionByName(again)


def identified(df: DataFrame, source_file: str = "source_file") -> DataFrame:
    """Rows with the identity that a page's file name gives: source_stem, source_requested_id, source_variant, source_prefix."""
    stem = F.regexp_extract(source_file, r"([^/]+?)(?:\.[^./]*)?$", 1)
    i = file_identity(stem)
    return df.withColumns({"source_stem": stem, "source_requested_id": i["id"], "source_variant": i["kind"], "source_prefix": i["prefix"]})


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their numbers (line_no, value), read in splits: a line's number is its place within the split plus the lines of the splits before it."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    rows = cut(raw)  # ids depend on the splits
    before = rows.groupBy("f", "b").agg(F.count("*").alias("n"), F.min("i").alias("first")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a split
    return rows.join(F.broadcast(before.select("f", "b", "first", "before")), ["f", "b"]).select((F.col("i") - F.col("first") + F.col("before") + 1).alias("line_no"), F.regexp_replace("value", "^\ufeff|\r$", "").alias("value"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor comments, in order: line_no, value; a byte-order mark falls away."""
    told = _numbered(spark, path).select("line_no", F.trim("value").alias("value"))
    return told.where((F.col("value") != "") & ~F.startswith("value", F.lit("#")))


def partial_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Whole rows of a TSV file whose writer may have died: line_no and the columns as text, an empty cell null.

    The header must be the columns. A last line without its line end is left out, as the next run writes it again; any
    other line with another number of cells is an error.
    """
    fs, root, _ = _base(spark, path)
    size = fs.getFileStatus(root).getLen()
    whole = False
    if size:
        stream = fs.open(root)
        try:
            stream.seek(size - 1)
            whole = stream.read() == 10
        finally:
            stream.close()
    rows = _numbered(spark, path)
    head = rows.where("line_no = 1").first()
    last = rows.agg(F.max("line_no")).first()[0]
    if head is None or head["value"].split("\t") != columns or (last == 1 and not whole):
        raise ValueError(f"the header of {path} isn't {columns}")
    cells = F.split("value", "\t", -1)
    body = rows.where((F.col("line_no") > 1) & (F.lit(whole) | (F.col("line_no") < last)))
    wrong = F.raise_error(F.concat(F.lit(f"{path}: wrong number of cells in line "), F.col("line_no").cast("string"))).cast("array<string>")
    told = body.select("line_no", F.when(F.size(cells) == len(columns), cells).otherwise(wrong).alias("c"))
    return told.select("line_no", *(F.nullif(F.col("c")[i], F.lit("")).alias(c) for i, c in enumerate(columns)))


def urls(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A list of addresses, each once, in the order of its first line (url, line_no); and the lines that are none."""
    rows = lines(spark, path)
    good = rows.where(absolute_http("value")).groupBy(F.col("value").alias("url")).agg(F.min("line_no").alias("line_no"))
    return good, rows.where(~absolute_http("value"))


def strict_urls(spark: SparkSession, path: str) -> DataFrame:
    """As urls(), but lines that are no address are an error that names the first five with their numbers."""
    good, bad = urls(spark, path)
    if wrong := [f"line {r['line_no']}: {r['value']}" for r in bad.orderBy("line_no").limit(5).collect()]:
        raise ValueError(f"{path} holds lines that are no address: {wrong}")
    return good


def proxies(spark: SparkSession, path: str) -> DataFrame:
    """A list of proxies, each once (proxy, line_no), http:// where a line names no scheme; an empty list is an error."""
    rows = lines(spark, path).select(F.when(F.col("value").rlike("^[a-z0-9]+://"), F.col("value")).otherwise(F.concat(F.lit("http://"), "value")).alias("proxy"), "line_no")
    out = rows.groupBy("proxy").agg(F.min("line_no").alias("line_no"))
    if not out.take(1):
        raise ValueError(f"{path} names no proxy")
    return out


def tsv(spark: SparkSession, path: str, columns: list[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """A TSV file whose header must equal the columns; an empty cell is null; kinds (``bigint``, ``double``, ``flag`` for 0/1) are cast strictly."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.options(sep="\t", header=True, enforceSchema=False, maxCharsPerColumn=-1, mode="FAILFAST", quote="\u0000", nullValue="", emptyValue="").schema(schema).csv(path)
    cast = lambda c: F.nullif(F.col(c), F.lit(""))
    kind = lambda c: (kinds or {}).get(c, "string")
    return df.select(*((cast(c).cast("int").cast("boolean") if kind(c) == "flag" else cast(c).cast(kind(c))).alias(c) for c in columns))


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of (gzip) JSON Lines under a schema, and the lines that are no object of it."""
    wide = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in schema), T.StructField("_corrupt", T.StringType())])
    df = spark.read.text(path).where(F.trim("value") != "").select("value", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("x"))
    bad = F.col("x").isNull() | F.col("x._corrupt").isNotNull() | ~F.startswith(F.ltrim("value"), F.lit("{"))
    return df.where(~bad).select(*(F.col("x")[f.name].alias(f.name) for f in schema)), df.where(bad).select(F.col("value").alias("_corrupt"))


def ordered_json_lines(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """Rows of JSON Lines that must all be readable and stand in strictly rising order of the keys; breaks are an error that names five lines."""
    text = lines(spark, path)
    rows = text.select("line_no", F.from_json("value", schema).alias("x"), F.startswith("value", F.lit("{")).alias("__object"))
    pairs = with_previous(rows.select("line_no", "__object", F.struct(*(F.col("x")[k].alias(k) for k in keys)).alias("k")), [], [F.col("line_no")], F.col("k"), "before")
    bad = pairs.where(~F.col("__object") | F.greatest(*(F.col("k")[k].isNull() for k in keys), F.lit(False)) | (F.col("k") <= F.col("before"))).orderBy("line_no").limit(5).collect()
    if bad:
        raise ValueError(f"{path} breaks its order at lines {[r['line_no'] for r in bad]}")
    return rows.select("x.*")


def json_object(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A (gzip) file that is one JSON object, as a row; anything else is an error."""
    df = spark.read.text(path, wholetext=True)
    made = F.when(F.trim("value").rlike(r"(?s)^\{.*\}$"), F.from_json("value", schema))
    return df.select(F.when(made.isNull(), F.raise_error(F.lit(f"{path} is no object")).cast("string")).alias("__e"), made.alias("x")).where("__e IS NULL").select("x.*")


def work_order(df: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """Rows in an order that is random, but the same for one seed whatever the partitions."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys)


def download_manifest(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of download results (filename, url, ok) the manifest of what came (filename, url, once each, by name) and the addresses of which nothing ever did."""
    good = results.where("ok").groupBy("filename").agg(F.min("url").alias("url")).orderBy("filename")
    tried = results.groupBy("url").agg(F.max(F.coalesce("ok", F.lit(False))).alias("__ok"))
    return good, tried.where(~F.col("__ok")).select("url").orderBy("url")


def tree_count(pages: DataFrame, group: list[str], cached: str) -> DataFrame:
    """Pages by group with how many came from the cache and how many had to be requested: group, pages, cache_hits, requests."""
    hit = F.coalesce(F.col(cached), F.lit(False)).cast("bigint")
    return pages.groupBy(*group).agg(F.count("*").alias("pages"), F.sum(hit).alias("cache_hits"), F.sum(1 - hit).alias("requests"))


def envelopes(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Records of page files ``{"_meta": {...}, "records": [...]}``: meta (map), ordinal from 0, record under the given schema; a page without records is the end of the data."""
    df = spark.read.text(path, wholetext=True).select(F.from_json("value", f"_meta map<string,string>, records array<{record}>").alias("x"))
    return df.where("x.records IS NOT NULL").select(F.col("x._meta").alias("meta"), F.posexplode("x.records").alias("ordinal", "record"))


def last_page(df: DataFrame, page: str, n: str) -> DataFrame:
    """Pages before the first empty one; a short page does not end the data."""
    end = df.where(F.col(n) == 0).agg(F.min(page)).first()[0]
    return df if end is None else df.where(F.col(page) < F.lit(end))


def raw_page_rows(files: DataFrame, dataset: str, inventory: DataFrame) -> DataFrame:
    """Files joined to their inventory (source_file, url, page_kind, sources, original_url) as rows of the raw-page table."""
    meta = F.struct(
        F.lit(dataset).alias("dataset"), "source_file", "page_kind", F.lit("text/html").alias("content_type"), F.col("length").alias("content_bytes"), F.col("sha256").alias("content_sha256"),
        F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("file_mtime_utc"), "sources", F.when(F.col("length") > 0, "ok").otherwise("empty").alias("validation_status"), F.when(F.col("original_url") != F.col("url"), F.col("original_url")).alias("original_url"),
    )
    return files.join(inventory, "source_file").select("url", F.col("content").alias("html"), meta.alias("meta"))


def marked(content: str, marker: bytes, within: int = 32_768):
    """Whether a byte marker stands near the beginning of a page."""
    return F.contains(F.substring(F.col(content), 1, within), F.lit(bytearray(marker)))


def review_folders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Folders ``<letter?><id>-<slug>`` of numbered pages, empty ones too, and what is wrong below them.

    First: anime_id, slug, pages (sorted numbers), missing (numbers between 1 and the last that are not there), bytes.
    Second: path with reason bad_folder, bad_page or repeated_id.
    """
    fs, root, _ = _base(spark, folder)
    folders = spark.createDataFrame([(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(root)], "name string, is_folder boolean")
    named = folders.withColumn("anime_id", F.regexp_extract("name", r"^[A-Za-z]?(\d+)-.+$", 1).try_cast("bigint"))
    again = named.where("is_folder AND anime_id IS NOT NULL").groupBy("anime_id").agg(F.collect_list("name").alias("n")).where(F.size("n") > 1)
    below = listing(spark, folder).withColumn("name", F.regexp_extract("path", "^([^/]+)/", 1)).withColumn("page", F.regexp_extract("path", r"^[^/]+/(\d+)\.json$", 1).try_cast("bigint"))
    wrong = (
        named.where("NOT is_folder OR anime_id IS NULL").select(F.col("name").alias("path"), F.lit("bad_folder").alias("reason"))
        .unionByName(below.where("page IS NULL AND name <> ''").select("path", F.lit("bad_page").alias("reason")))
        .unionByName(again.select(F.explode("n").alias("path"), F.lit("repeated_id").alias("reason")))
    )
    counted = below.where("page IS NOT NULL").groupBy("name").agg(F.array_sort(F.collect_set("page")).alias("pages"), F.sum("length").alias("bytes"))
    good = named.where("is_folder AND anime_id IS NOT NULL").join(counted, "name", "left").withColumn("pages", F.coalesce("pages", F.array().cast("array<bigint>")))
    full = F.when(F.size("pages") > 0, F.sequence(F.lit(1).cast("bigint"), F.array_max("pages"))).otherwise(F.array().cast("array<bigint>"))
    return good.select("anime_id", F.col("name").alias("slug"), "pages", F.array_except(full, "pages").alias("missing"), F.coalesce("bytes", F.lit(0)).alias("bytes")), wrong


def manifest(spark: SparkSession, path: str, required: tuple[str, ...] = ("filename", "url", "sources")) -> DataFrame:
    """A TSV manifest that must have at least the required columns; other columns stay, sources becomes a list."""
    df = spark.read.options(sep="\t", header=True, quote="\u0000", maxCharsPerColumn=-1).csv(path)  # all text: no types are inferred
    if lacking := [c for c in required if c not in df.columns]:
        raise ValueError(f"the manifest lacks {lacking}")
    return df.withColumn("sources", F.filter(F.split(F.coalesce("sources", F.lit("")), ","), lambda v: v != "")) if "sources" in df.columns else df


def inventory(files: DataFrame, listed: DataFrame, name: str = "filename") -> DataFrame:
    """Files (source_file) joined to the list that names them by their last path part; either side missing is an error that names five of each."""
    from driftmill.operators.match import coverage

    own = files.withColumn(name, F.regexp_extract("source_file", r"([^/]+)$", 1))
    state = coverage(listed, own, name)
    bad = {s: [r[0] for r in state.where(F.col("state") == s).orderBy(name).limit(5).collect()] for s in ("missing", "extra")}
    if any(bad.values()):
        raise ValueError(f"files and list differ: {bad}")
    return own.join(listed, name)


def page_kind(url, kinds: dict[str, str]):
    """Kind of a page by the first part of its address's path; an unknown one is an error that names the address."""
    from driftmill.functions.text import url_path

    u = F.col(url) if isinstance(url, str) else url
    out = None
    for prefix, kind in kinds.items():
        fits = url_path(u).startswith(prefix)
        out = F.when(fits, kind) if out is None else out.when(fits, kind)
    unknown = F.raise_error(F.concat(F.lit("no kind for "), F.coalesce(u, F.lit("null")))).cast("string")
    return unknown if out is None else out.otherwise(unknown)


def excluded(df: DataFrame, exclusions: DataFrame, *keys: str) -> DataFrame:
    """Rows that a list of exclusions doesn't name."""
    return df.join(exclusions.select(*keys).distinct(), list(keys), "left_anti")
