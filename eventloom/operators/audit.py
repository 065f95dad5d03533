"""Audits of sources: shares of rows with times, precision and extraction methods, and how links and items are spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D


def percentage(condition: Column) -> Column:
    """The share of rows that meet a condition, in percent; unknown counts as not."""
    return 100 * F.count_if(condition) / F.count(F.lit(1))


def time_audit(raw: DataFrame) -> DataFrame:
    """By source: rows, percentages with a time text, with a time of day, readable, and of an approved form (source_id, datetime_raw)."""
    t = F.col("datetime_raw")
    return raw.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("rows"), percentage(t.isNotNull()).alias("with_text"), percentage(D.has_time(t)).alias("with_time"),
        percentage(D.parse_time(t).isNotNull()).alias("readable"), percentage(D.approved_text(t)).alias("approved"),
    )


def histogram(rows: DataFrame, by: list[str], column: str, order: list[str], examples: int = 5) -> DataFrame:
    """By group and value: rows, their percentage in the group, and the first few examples of `title_raw`, by `order`."""
    from pyspark.sql import Window

    counted = rows.groupBy(*by, column).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(*by))
    shares = counted.withColumn("percentage", 100 * F.col("rows") / total)
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by, column).orderBy(*order))).filter(F.col("_n") <= examples)
    listed = first.groupBy(*by, column).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "title_raw"))), lambda s: s["title_raw"]).alias("examples"))
    keys = [*by, column]
    right = listed.select(*[F.col(k).alias(f"_{k}") for k in keys], "examples")
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return shares.join(right, same, "left").drop(*[f"_{k}" for k in keys])
