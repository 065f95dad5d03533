"""Contracts: checks of rows, keys and references, quarantine, and eligibility with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Allowed values, by column.
DOMAINS = {
    "source_type": ("crawler", "internal_manual", "partner_feed"),
    "source_tier": ("A", "B", "C"),
    "date_precision": ("date", "datetime"),
    "extraction_method": ("jsonld", "time_element", "iso_text", "text_heuristic", "ics", "rss_description_cdata", "listing", "none"),
    "visibility_status": ("draft", "published", "archived"),
    "session_status": ("scheduled", "cancelled", "completed"),
    "resolution": ("merged", "kept_separate", "dismissed"),
}


def broken(condition: Column) -> Column:
    """Whether a check fails; as in SQL a check of unknown truth passes."""
    return F.coalesce(~condition, F.lit(False))


def time_contract(precision: str = "date_precision", start: str = "start_at", end: str = "end_at") -> Column:
    """A date has no times; a datetime has a start."""
    p, s, e = F.col(precision), F.col(start), F.col(end)
    return ((p == "date") & s.isNull() & e.isNull()) | ((p == "datetime") & s.isNotNull())


def local_date_contract() -> Column:
    """Pending rows with a precision have a local start date."""
    return F.col("date_precision").isNull() | (F.col("status") != "pending") | F.col("start_date_local").isNotNull()


def rules(columns: list[str]) -> dict[str, Column]:
    """The checks that apply to a table with these columns, by name."""
    out: dict[str, Column] = {}
    if {"date_precision", "start_at", "end_at"} <= {*columns}:
        out["time_contract"] = time_contract()
    if {"date_precision", "status", "start_date_local"} <= {*columns}:
        out["local_date"] = local_date_contract()
    for name, values in DOMAINS.items():
        if name in columns:
            out[f"domain_{name}"] = F.col(name).isin(*values)
    return out


def with_violations(df: DataFrame, checks: dict[str, Column] | None = None) -> DataFrame:
    """df with `violations`, the names of the checks each row breaks, in order."""
    found = [F.when(broken(c), F.lit(n)) for n, c in (checks if checks is not None else rules(df.columns)).items()]
    return df.withColumn("violations", F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>"))


def split(df: DataFrame, checks: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the quarantine with its violations; a bad row never stops its source."""
    marked = with_violations(df, checks)
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)


def repeated_keys(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys without nulls that occur more than once, with `rows`."""
    held = df.filter(where) if where is not None else df
    return held.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def orphans(df: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Rows that name a parent that isn't there."""
    return df.filter(F.col(column).isNotNull()).join(parents.select(F.col(key).alias("_key")), F.col(column) == F.col("_key"), "left_anti")


def after_delete(df: DataFrame, column: str, parents: DataFrame, key: str, keep: bool = False) -> DataFrame:
    """What is left of rows once parents are gone: those without one go too, or with `keep` stay with a null in the column."""
    left = parents.select(F.col(key).alias("_key")).distinct()
    if not keep:
        return df.join(left, F.col(column) == F.col("_key"), "left_semi")
    return df.join(left, F.col(column) == F.col("_key"), "left").withColumn(column, F.col("_key").cast(df.schema[column].dataType)).drop("_key")


def archived_in_use(happenings: DataFrame, links: DataFrame) -> DataFrame:
    """Archived happenings that still have links."""
    gone = happenings.filter(F.col("visibility_status") == "archived")
    return gone.join(links.select(F.col("happening_id").alias("_id")), F.col("id") == F.col("_id"), "left_semi")


def eligibility_reasons() -> Column:
    """Why a row isn't eligible for the feed, in order; empty if it is.

    Reads title, date_precision, start_date_local, start_at, end_at, location, online, status, age_max.
    """
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    reasons = [
        F.when(blank("title"), "missing_title"),
        F.when(F.col("start_date_local").isNull() & ~F.coalesce((F.col("date_precision") == "datetime") & F.col("start_at").isNotNull(), F.lit(False)), "missing_start"),
        F.when(blank("location") & ~F.coalesce(F.col("online"), F.lit(False)), "missing_location"),
        F.when(F.coalesce(F.col("status") == "cancelled", F.lit(False)), "cancelled"),
        F.when(broken(time_contract()), "time_contract"),
        F.when(F.coalesce(F.col("age_max") < 1, F.lit(False)), "newborn_only"),
    ]
    return F.filter(F.array(*reasons), lambda x: x.isNotNull())
