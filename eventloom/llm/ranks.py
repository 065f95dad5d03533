"""Ranks within groups of any size, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts into which each group is dealt at least, and rows of a part; the ranks of a part are found in one task.
PARTS, ROWS = 256, 200_000


def parts_for(rows: int | None) -> int:
    """Parts for groups of so many rows at most."""
    return max(PARTS, -(-(rows or 0) // ROWS))


def ranked(df: DataFrame, group: list[str], order: str, ties: list[Column], to: str, parts: int = PARTS) -> DataFrame:
    """df with `to`: the rank, from 0, of each row in its group by the column `order`, a hash of 32 bits, and then `ties`.

    A group is split by ranges of `order`; the rows of each range are ranked in their own task, after the number of rows
    in the group's ranges before it, which come from a partial aggregation. Rows alike in everything get ranks of their own.
    """
    part = F.floor(F.col(order) * F.lit(parts) / F.lit(2**32)).cast("int")
    split = df.withColumn("_part", part)
    sizes = split.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = split.withColumn("_rank", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(order, *ties)))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return within.join(starts, same).withColumn(to, F.col("_start") + F.col("_rank") - 1).drop("_part", "_p", "_start", "_rank", *[f"_g{i}" for i in range(len(group))])


def hash32(*columns: Column) -> Column:
    """The first 32 bits of the MD5 of the columns' texts, as a long; nulls count as empty."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
