"""Precedence between sources, merged fields and their provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sha256_hex

#: Ranks of the kinds of sources.
RANKS = {"partner_feed": 100, "internal_manual": 50, "crawler_b": 20, "crawler": 10}


def rank(kind: Column, ranks: dict[str, int] | None = None) -> Column:
    """A kind's rank; 0 for others."""
    out = F.lit(0)
    for name, value in (ranks or RANKS).items():
        out = F.when(kind == name, F.lit(value)).otherwise(out)
    return out


def winners(rows: DataFrame, by: str, fields: list[str], rank_column: str, newest: str, row_id: str) -> DataFrame:
    """For each group and field: the value, source row and rank that win: the highest rank, then the newest, then the least id.

    Nulls and blanks never win. One aggregation over all fields, without a sort.
    """
    filled = rows.unpivot([by, rank_column, newest, row_id], fields, "field_name", "value").filter(F.coalesce(F.trim("value"), F.lit("")) != "")
    order = F.struct(F.col(rank_column), F.col(newest), -F.col(row_id).cast("bigint"))
    chosen = F.max_by(F.struct("value", row_id, rank_column), order)
    return filled.groupBy(by, "field_name").agg(chosen.alias("w")).select(by, "field_name", F.col("w.value").alias("value"), F.col(f"w.{row_id}").alias(row_id), F.col(f"w.{rank_column}").alias("precedence_rank"))


def merged(found: DataFrame, by: str, fields: list[str]) -> DataFrame:
    """One row a group with the winning value of each field."""
    return found.groupBy(by).pivot("field_name", fields).agg(F.first("value"))


def provenance(found: DataFrame, by: str, row_id: str) -> DataFrame:
    """A row for each field of each group: where its value comes from, with the value's SHA-256."""
    return found.select(F.col(by).alias("happening_id"), F.col(row_id).alias("source_happening_id"), "field_name", sha256_hex(F.col("value")).alias("value_hash"), "precedence_rank")


def primary(links: DataFrame) -> DataFrame:
    """links (happening_id, source_happening_id, source_priority) with is_primary: the highest priority, then the least id."""
    from pyspark.sql import Window

    w = Window.partitionBy("happening_id").orderBy(F.desc_nulls_last("source_priority"), "source_happening_id")
    return links.withColumn("is_primary", F.row_number().over(w) == 1)
