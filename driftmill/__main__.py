"""Command line: saved pages to published tables.

    python -m driftmill pages IN OUT            entity pages
    python -m driftmill reviews IN OUT          review pages in folders <prefix><id>-<slug>/<page>.json
    python -m driftmill news IN OUT             news pages <id>.html
    python -m driftmill raw IN OUT --manifest M.tsv --dataset NAME    pages as they are, with where they came from
    python -m driftmill lines IN OUT --kind reviews|news --keys a,b   JSON Lines of a known table, strictly in order of the keys
    python -m driftmill verify TABLE            a published table against its manifest
    python -m driftmill move SOURCE TARGET      a folder, once
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, kind: str, source: str, limit: int | None, a: argparse.Namespace | None = None) -> tuple[DataFrame, list[str]]:
    from driftmill import schemas
    from driftmill.operators import entity_page, news_page, quality, review_page
    from driftmill.sources import files

    if kind == "raw":
        listed = files.manifest(spark, a.manifest, ("filename", "url", "sources"))
        told = listed.select("filename", "url", "sources", F.coalesce(F.col("original_url") if "original_url" in listed.columns else F.lit(None), F.col("url")).alias("original_url"), F.lit(a.page_kind).alias("page_kind"))
        return files.raw_page_rows(files.pages(spark, source, limit=limit), a.dataset, files.inventory(files.pages(spark, source, limit=limit).select("source_file"), told).drop("filename")), ["url"]
    if kind == "lines":
        keys = a.keys.split(",")
        return files.ordered_json_lines(spark, source, {"reviews": schemas.REVIEWS, "news": schemas.NEWS}[a.kind], keys), keys
    if kind == "pages":
        return entity_page.entity_pages(files.pages(spark, source, limit=limit)), ["source_file"]
    if kind == "news":
        good, bad = files.numbered_pages(spark, source)
        if wrong := bad.limit(20).collect():
            raise SystemExit(f"the folder holds other files: {[tuple(r) for r in wrong]}")
        if a is not None and a.last_id is not None:
            gaps = quality.range_coverage(good, "source_id", a.first_id, a.last_id).orderBy("source_id").limit(20).collect()
            if gaps and not a.allow_incomplete:
                raise SystemExit(f"ids {a.first_id} to {a.last_id} aren't all there, or others are: {[tuple(r) for r in gaps]}")
        return news_page.news_pages(good), ["source_id"]
    found = files.pages(spark, source, "*.json", limit)
    name = r"^[A-Za-z]?(\d+)-[^/]*/(\d+)\.json$"
    rows = found.withColumn("anime_id", F.regexp_extract("source_file", name, 1).try_cast("bigint")).withColumn("source_page", F.regexp_extract("source_file", name, 2).try_cast("bigint"))
    return review_page.reviews(review_page.review_pages(rows.where("anime_id IS NOT NULL"))), ["anime_id", "usefulness_rank", "review_id"]


def main(argv: list[str] | None = None) -> int:
    from driftmill.plans import publish

    p = argparse.ArgumentParser(prog="driftmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=["pages", "reviews", "news", "raw", "lines", "verify", "move"])
    p.add_argument("source")
    p.add_argument("target", nargs="?")
    p.add_argument("--limit", type=int)
    p.add_argument("--force", action="store_true")
    p.add_argument("--allow-incomplete", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--rows-per-file", type=int, default=1_000_000)
    p.add_argument("--parts", type=int, default=1, help="parts of the stage, of which a run that died leaves whole ones to the next")
    p.add_argument("--source-id", help="what the input is (a digest, a manifest's id); needed to resume a stage")
    p.add_argument("--first-id", type=int, default=0)
    p.add_argument("--last-id", type=int, help="news: last id of the range that must be there")
    p.add_argument("--manifest")
    p.add_argument("--dataset", default="pages")
    p.add_argument("--page-kind", default="page")
    p.add_argument("--kind", choices=["reviews", "news"])
    p.add_argument("--keys", default="")
    a = p.parse_args(argv)
    if a.command != "verify" and not a.target:
        p.error("a target is needed")
    if a.limit is not None and a.limit < 1 or a.rows_per_file < 1 or a.parts < 1:
        p.error("limits are positive")
    if a.command == "raw" and not a.manifest or a.command == "lines" and not (a.kind and a.keys):
        p.error("raw needs a manifest, lines a kind and keys")
    spark = SparkSession.builder.appName("driftmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "verify":
        wrong = publish.verify(spark, a.source)
        print(json.dumps({"wrong": wrong}))
        return int(bool(wrong))
    if a.command == "move":
        print(json.dumps(publish.move_tree(spark, a.source, a.target, dry_run=a.dry_run)))
        return 0
    df, keys = table(spark, a.command, a.source, a.limit, a)
    if a.dry_run:
        print(json.dumps({"rows": df.count(), "columns": len(df.columns), "sorted_by": keys}))
        return 0
    print(json.dumps(publish.publish(df, a.target, keys, force=a.force, complete=a.limit is None, allow_incomplete=a.allow_incomplete, rows_per_file=a.rows_per_file, source=a.source_id, parts=a.parts)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
