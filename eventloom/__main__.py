"""Syncs staged events to source happenings: `python -m eventloom --events PATH --table PATH [--source-id ID] [--limit N] [--dry-run]`.

Prints the counters as JSON. Ends with 2 if rows could not be written.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from .operators import contracts, sync
from .session import session
from .sources.sinks import Table


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="eventloom", description="Sync staged events to source happenings.")
    parser.add_argument("--events", required=True, help="parquet of staged events")
    parser.add_argument("--table", required=True, help="folder of the versioned table")
    parser.add_argument("--source-id", help="only this source")
    parser.add_argument("--limit", type=int, help="at most so many events")
    parser.add_argument("--dry-run", action="store_true", help="count, write nothing")
    given = parser.parse_args(args)
    spark = session()
    events = spark.read.parquet(given.events)
    if given.source_id:
        events = events.filter(F.col("source_id") == given.source_id)
    if given.limit:
        events = events.limit(given.limit)
    rows = sync.source_happenings(events)
    counters = sync.sync_counters(rows).first().asDict()
    good, bad = contracts.split(rows.filter(F.col("source_id").isNotNull()))
    counters["quarantined"] = bad.count()
    counters["written"] = Table(spark, given.table).upsert(good, ["source_id", "external_id"], [F.desc_nulls_last("fetched_at"), F.col("dedupe_key")], given.dry_run)
    print(json.dumps(counters | {"dry_run": given.dry_run}))
    return 2 if counters["errors"] else 0


if __name__ == "__main__":
    sys.exit(main())
