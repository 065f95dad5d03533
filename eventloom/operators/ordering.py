"""Operators that depend on the order of rows: first occurrences, forward fill, streaks, quotas and top-k.

Order is always given by columns. Groups go by window partitions; an operator over all rows takes `by` to say what is one
sequence (a source, a page), since a single sequence of a whole table would be sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key; null keys are one key."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_n = 1").drop("_n")


def forward_fill(df: DataFrame, column: str, by: list[str], order: list[str | Column], fallback: Column | None = None) -> DataFrame:
    """Nulls take the last value before them in their group, or else the fallback."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.last(column, ignorenulls=True).over(w)
    return df.withColumn(column, F.coalesce(filled, fallback) if fallback is not None else filled)


def _streak(df: DataFrame, failed: Column, by: list[str], order: list[str | Column]) -> DataFrame:
    """_streak: how many failures in a row end at each row."""
    w = Window.partitionBy(*by).orderBy(*order)
    f = F.coalesce(failed, F.lit(False))
    run = df.withColumn("_failed", f).withColumn("_run", F.sum(F.when(~f, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    within = Window.partitionBy(*by, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return run.withColumn("_streak", F.sum(F.col("_failed").cast("int")).over(within)).drop("_run", "_failed")


def breaker_cut(df: DataFrame, failed: Column, by: list[str], order: list[str | Column], limit: int = 5) -> DataFrame:
    """Rows up to the one at which `limit` failures in a row are reached, by group; all rows where they never are."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    marked = _streak(df, failed, by, order).withColumn("_open", F.coalesce(F.max(F.col("_streak") >= limit).over(w), F.lit(False)))
    return marked.filter(~F.col("_open")).drop("_open", "_streak")


def breaker_blank(df: DataFrame, failed: Column, by: list[str], order: list[str | Column], blank: list[str], limit: int = 5) -> DataFrame:
    """All rows; after the breaker has tripped the columns `blank` are null, since nothing enriches these rows any more."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    marked = _streak(df, failed, by, order).withColumn("_open", F.coalesce(F.max(F.col("_streak") >= limit).over(w), F.lit(False)))
    return marked.select(*[F.when(~F.col("_open"), F.col(c)).alias(c) if c in blank else F.col(c) for c in df.columns], F.col("_open").alias("breaker_open"))


def until_nothing_new(df: DataFrame, key: str, page: str, by: list[str], order: list[str | Column]) -> DataFrame:
    """First occurrences of keys on the pages before the first page that has none."""
    first = df.withColumn("_n", F.row_number().over(Window.partitionBy(*by, key).orderBy(page, *order)))
    pages = first.groupBy(*by, page).agg(F.count_if(F.col("_n") == 1).alias("_new"))
    stop = pages.filter("_new = 0").groupBy(*by).agg(F.min(page).alias("_stop"))
    kept = first.filter("_n = 1")
    same = F.lit(True)
    stop = stop.select(*[F.col(b).alias(f"_{b}") for b in by], "_stop")
    for b in by:
        same &= F.col(b).eqNullSafe(F.col(f"_{b}"))
    joined = kept.join(F.broadcast(stop) if not by else stop, same, "left")
    return joined.filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_n", "_stop", *[f"_{b}" for b in by])


def quota(df: DataFrame, by: list[str], order: list[str | Column], most: int, keep: str | None = None) -> DataFrame:
    """The first `most` rows of each group, with their number in the column `keep` if it is given."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_n") <= most)
    return ranked.withColumnRenamed("_n", keep) if keep else ranked.drop("_n")


def top(df: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """Distinct keys and then the first `most` rows of all, without a sort of all."""
    return df.dropDuplicates(keys).orderBy(*order).limit(most)


def numbered(df: DataFrame, by: list[str], order: list[str | Column], to: str = "session_index") -> DataFrame:
    return df.withColumn(to, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def cards(df: DataFrame) -> DataFrame:
    """One row for each feed card: by series, or else by title, place, date and time; with a time first, then the newest, then the id."""
    key = F.coalesce(
        F.concat(F.lit("series|"), F.col("series_label")),
        F.concat_ws("|", F.lit("event"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("title", "location_name", "start_date", "start_time_local")]),
    )
    keyed = df.withColumn("card_key", key)
    return keep_first(keyed, ["card_key"], [F.col("start_time_local").isNotNull().desc(), F.desc_nulls_last("updated_at"), F.col("external_id")])


def best_and_margin(df: DataFrame, by: list[str], score: str, ties: list[str]) -> DataFrame:
    """The best row of each group with `margin`, what it is ahead of the second; null where there is no second."""
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), *ties)
    marked = df.withColumn("margin", F.col(score) - F.lead(score).over(w)).withColumn("_n", F.row_number().over(w))
    return marked.filter("_n = 1").drop("_n")
