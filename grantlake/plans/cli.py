"""``python -m grantlake.plans.cli FOLDER status|loaded|refresh|build|match``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from grantlake.plans.catalog import Catalog
from grantlake.sources.registry import REGISTRY, get_source, list_folder, resolve_latest


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0: done; 1: some source failed; 2: some source has no file."""
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("folder", help="where the tables are kept")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("status", "refresh"):
        s = sub.add_parser(name)
        s.add_argument("--from", dest="origin", required=True, help="folder of the published CSV files")
        s.add_argument("--source", action="append", help="logical name; without it the default set")
        s.add_argument("--force", action="store_true", help="load a version again")
    sub.add_parser("loaded")
    sub.add_parser("build").add_argument("--with-people", action="store_true")
    s = sub.add_parser("match")
    s.add_argument("--limit", type=int, help="key tuples of either side, for a trial that is kept apart")
    s.add_argument("--force", action="store_true", help="match the same inputs again")
    a = p.parse_args(args)
    spark = spark or SparkSession.builder.appName("grantlake").getOrCreate()
    catalog = Catalog(spark, a.folder)
    if a.command == "loaded":
        catalog.loaded().select("logical_name", "source_version", "status", "row_count", "started_at", "n_warnings", "error").show(100, truncate=False)
        return 0
    if a.command in ("build", "match"):
        print(catalog.build(with_people=a.with_people) if a.command == "build" else catalog.match(limit=a.limit, force=a.force))
        return 0
    sources = [get_source(n) for n in a.source] if a.source else [s for s in REGISTRY if a.command == "status" or not s.skip_default_refresh]
    listing, failed, absent = list_folder(spark, a.origin), 0, 0
    for source in sources:
        newest = resolve_latest(source, a.origin, listing)
        absent += newest is None
        if a.command == "refresh" and newest:
            try:
                print(source.logical_name, newest.version, catalog.ingest(newest, force=a.force) or "there already")
            except Exception as e:  # the others are still loaded
                failed += 1
                print(source.logical_name, newest.version, "failed:", e)
        else:
            print(source.logical_name, newest and newest.version, newest and newest.filename, newest and newest.size)
    return 1 if failed else 2 if absent else 0


if __name__ == "__main__":
    raise SystemExit(main())
