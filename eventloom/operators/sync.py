"""From scans to canonical tables: raw rows, normalized rows, staging sync, the three-level bridge and run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..sources.sinks import run_id


def raw_events(items: DataFrame, sources: DataFrame, now: Column) -> DataFrame:
    """Items with their source's URL and defaults: the time of fetching is the item's or `now`, extra an empty object."""
    named = sources.select(F.col("source_id").alias("_s"), F.col("seed_url").alias("source_url"))
    joined = items.join(named, F.col("source_id") == F.col("_s"), "left").drop("_s")
    return joined.withColumn("fetched_at", F.coalesce("fetched_at", now)).withColumn("extra", F.coalesce("extra", F.lit("{}")))


def normalized(raw: DataFrame, seen_at: Column, zone: str = D.ZONE) -> DataFrame:
    """Raw rows with a time that can be read, as normalized events; the rest belongs in the quarantine."""
    t = F.col("_time")
    parsed = raw.withColumn("_time", D.parse_time(F.col("datetime_raw"), zone)).filter(t.isNotNull())
    title, place = T.strip(F.coalesce(F.col("title_raw"), F.lit(""))), T.strip(F.col("location_raw"))
    start = F.coalesce(t["start_at"], F.to_utc_timestamp(t["start_date"].cast("timestamp"), zone))
    external = T.external_id(F.col("source_id"), F.col("item_url"), title, start, place)
    return parsed.withColumn("external_id", external).select(
        "external_id", "source_id", D.event_type(t).alias("event_type"), (t["precision"] == "date").alias("is_all_day"), t["precision"].alias("date_precision"),
        title.alias("title"), t["start_date"].alias("start_date_local"), t["end_date"].alias("end_date_local"), t["start_at"].alias("start_at"), t["end_at"].alias("end_at"), F.lit(zone).alias("timezone"),
        place.alias("location_name"), T.strip(F.col("description_raw")).alias("description"),
        T.canonical_url(F.col("item_url"), F.col("source_url"), F.col("external_id")).alias("canonical_url"), seen_at.alias("last_seen_at"),
    )


def source_happenings(events: DataFrame, zone: str = D.ZONE) -> DataFrame:
    """Staged events as source happenings.

    The local date comes from the start, else from a date in the time text, never from the title. Rows without a date,
    and datetimes without a start, need review; dates lose their times.
    """
    precision = F.coalesce(F.col("date_precision"), F.lit("datetime"))
    timed = precision != "date"
    start_date = F.coalesce(D.local_date(F.col("start_at"), zone), D.explicit_date(F.col("datetime_raw")))
    seed = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source_id", "title", "datetime_raw", "canonical_url")])
    external = F.coalesce(T.blank_to_null(F.col("external_id")), F.concat(F.lit("events:"), F.col("id").cast("string")), F.concat(F.lit("hash:"), T.sha256_hex(seed, 24)))
    review = start_date.isNull() | (timed & F.col("start_at").isNull())
    return events.select(
        "source_id", F.lit("crawler").alias("source_type"), T.tier(F.col("source_id")).alias("source_tier"), external.alias("external_id"),
        F.col("title").alias("title_raw"), "datetime_raw", F.col("location_name").alias("location_raw"), F.col("description").alias("description_raw"),
        precision.alias("date_precision"), F.when(timed, F.col("start_at")).alias("start_at"), F.when(timed, F.col("end_at")).alias("end_at"),
        F.coalesce(F.col("timezone"), F.lit(zone)).alias("timezone"), start_date.alias("start_date_local"), D.local_date(F.col("end_at"), zone).alias("end_date_local"),
        F.col("canonical_url").alias("item_url"), "content_hash", T.fingerprint(F.col("title"), start_date, F.col("location_name")).alias("dedupe_key"),
        F.when(review, "needs_review").otherwise("pending").alias("status"), F.lit(None).cast("string").alias("error_message"), F.col("last_seen_at").alias("fetched_at"),
    )


def sync_counters(rows: DataFrame) -> DataFrame:
    """events_seen, upserted (rows that would be written), needs_review and errors (rows without a source), in one row."""
    bad = F.col("source_id").isNull()
    return rows.agg(
        F.count(F.lit(1)).alias("events_seen"), F.count_if(~bad).alias("upserted"), F.count_if(F.col("status") == "needs_review").alias("needs_review"), F.count_if(bad).alias("errors")
    )


def bridged(events: DataFrame, source: str, now: Column, zone: str = D.ZONE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """happening, offering and occurrence of each event (external_id, title, start_at, end_at) with a start before its end.

    Ids follow from the source and what they name, so that no lookup is needed; an end that isn't known stays null.
    """
    s = F.lit(source)
    held = events.filter(F.col("start_at").isNotNull() & (F.col("end_at").isNull() | (F.col("end_at") >= F.col("start_at"))))
    happening, offering = T.public_id(s, "happening", F.col("external_id")), T.public_id(s, "offering", F.col("external_id"), F.lit("default"))
    occurrence = T.public_id(s, "occ", F.col("external_id"), F.date_format("start_at", "yyyy-MM-dd'T'HH:mm:ss"))
    # of an id's rows the earliest speaks for it, whatever the order of reading
    first = F.struct("start_at", F.col("end_at").isNull().alias("_open"), "end_at", "title")
    one = held.groupBy("external_id").agg(F.min(first).alias("_f")).select("external_id", "_f.start_at", "_f.end_at", "_f.title")
    return (
        one.select(happening.alias("public_id"), F.lit("event").alias("happening_kind"), "title", F.lit("published").alias("visibility_status"), now.alias("updated_at")),
        one.select(
            offering.alias("public_id"), happening.alias("happening_id"), F.lit("one_off").alias("offering_type"), F.lit(zone).alias("timezone"),
            D.local_date(F.col("start_at"), zone).alias("start_date"), D.local_date(F.col("end_at"), zone).alias("end_date"), now.alias("updated_at"),
        ),
        held.select(
            occurrence.alias("public_id"), offering.alias("offering_id"), "start_at", "end_at", F.lit("scheduled").alias("status"), F.lit(f"bridged_from={source}").alias("notes"), now.alias("updated_at")
        ),
    )


def run_metrics(surfaces: DataFrame) -> DataFrame:
    """Counters by source over surfaces (source_id, kind: listing or detail, ok, items, failed, skipped, breaker_open)."""
    detail = F.col("kind") == "detail"
    return surfaces.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("surfaces_attempted"), F.count_if("ok").alias("surfaces_succeeded"), F.sum(F.when(~detail, F.col("items")).otherwise(0)).alias("dom_items_visible"),
        F.count_if(detail).alias("detail_urls_found"), F.count_if(detail & F.col("ok")).alias("detail_urls_fetched"), F.sum(F.when(detail, F.col("items")).otherwise(0)).alias("items_extracted"),
        F.sum("failed").alias("items_failed"), F.sum("skipped").alias("items_skipped"), F.coalesce(F.max("breaker_open"), F.lit(False)).alias("circuit_breaker_triggered"),
    )


def open_runs(sources: DataFrame, started: Column) -> DataFrame:
    """A row of crawl_run for each source_id, running since `started`; the id follows from both, so that a repeated task opens the same run."""
    return sources.select(run_id(F.col("source_id"), started).alias("id"), "source_id", F.lit("running").alias("status"), started.alias("started_at"))


def close_runs(runs: DataFrame, surfaces: DataFrame, finished: Column, errors: DataFrame | None = None) -> DataFrame:
    """The rows of open runs with their nine metrics (zeros without surfaces), end and status: failed with its error_message if `errors` (source_id, error_message) names the source, else success."""
    metrics = run_metrics(surfaces).withColumnRenamed("source_id", "_m")
    joined = runs.drop("status").join(metrics, F.col("source_id") == F.col("_m"), "left").drop("_m")
    if errors is None:
        joined = joined.withColumn("error_message", F.lit(None).cast("string"))
    else:
        one = errors.groupBy(F.col("source_id").alias("_e")).agg(F.min("error_message").alias("error_message"))
        joined = joined.join(one, F.col("source_id") == F.col("_e"), "left").drop("_e")
    counts = [c for c in metrics.columns if c not in ("_m", "circuit_breaker_triggered")]
    status = F.when(F.col("error_message").isNotNull(), "failed").otherwise("success")
    return joined.select(
        "id", "source_id", status.alias("status"), "started_at", finished.alias("finished_at"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("circuit_breaker_triggered", F.lit(False)).alias("circuit_breaker_triggered"), "error_message",
    )


def source_yield(sources: DataFrame, rows: DataFrame, failed: DataFrame) -> DataFrame:
    """Rows by enabled source: -1 for failed ones, 0 with a warning for those that gave none."""
    counts = rows.groupBy(F.col("source_id").alias("_r")).agg(F.count(F.lit(1)).alias("_rows"))
    bad = failed.select(F.col("source_id").alias("_f")).distinct()
    joined = sources.filter("enabled").join(counts, F.col("source_id") == F.col("_r"), "left").join(bad, F.col("source_id") == F.col("_f"), "left")
    n = F.when(F.col("_f").isNotNull(), F.lit(-1)).otherwise(F.coalesce("_rows", F.lit(0)))
    return joined.select("source_id", n.cast("bigint").alias("rows"), (n == 0).alias("warning"))


def registry_difference(configured: DataFrame, registered: DataFrame, key: str = "source_id") -> DataFrame:
    """Keys on one side only, with the side that lacks them."""
    a, b = configured.select(key).distinct(), registered.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("missing_in", F.lit("registry")).unionByName(b.join(a, key, "left_anti").withColumn("missing_in", F.lit("config")))


def enriched(items: DataFrame, details: DataFrame, key: str, fill: list[str], copy: list[str], order: list[str] | None = None) -> DataFrame:
    """Items with the details of their key: blanks of `fill` filled and `copy` added; items without details stay.

    Of several detail rows each column takes its first value that isn't null, by the columns `order` and then the value itself.
    """
    least = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order or [])], F.col(c).alias("v"))))["v"]
    one = details.groupBy(F.col(key).alias("_key")).agg(*[least(c).alias(f"_{c}") for c in fill + copy])
    joined = items.join(one, F.col(key) == F.col("_key"), "left")
    return joined.select(*[F.coalesce(T.blank_to_null(F.col(c)), F.col(f"_{c}")).alias(c) if c in fill else F.col(c) for c in items.columns], *[F.col(f"_{c}").alias(c) for c in copy])


def coverage(organizers: DataFrame, raw: DataFrame, canonical: DataFrame) -> DataFrame:
    """By organizer: raw rows, canonical rows and eligible ones, each counted before it is joined."""
    r = raw.groupBy(F.col("organizer_id").alias("_r")).agg(F.count(F.lit(1)).alias("raw_rows"))
    c = canonical.groupBy(F.col("organizer_id").alias("_c")).agg(F.count(F.lit(1)).alias("canonical_rows"), F.count_if("eligible").alias("eligible_rows"))
    joined = organizers.join(r, F.col("organizer_id") == F.col("_r"), "left").join(c, F.col("organizer_id") == F.col("_c"), "left").drop("_r", "_c")
    return joined.fillna(0, ["raw_rows", "canonical_rows", "eligible_rows"])


def gaps(rows: DataFrame, fields: list[str], by: str = "source_tier") -> DataFrame:
    """By tier: rows, their share of all in percent, and how many lack each field (null or blank)."""
    lacking = [F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "").alias(f"missing_{c}") for c in fields]
    counted = rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *lacking)
    # a row a tier is left here
    return counted.join(F.broadcast(counted.agg(F.sum("rows").alias("_all")))).withColumn("percentage", 100 * F.col("rows") / F.col("_all")).drop("_all")
