"""Mixing of sources to target weights by systematic sampling, with DataFrame functions alone.

Each source gets a target of words by weight, bounded by a multiple of what it has. A document's expected number of copies
is its source's target over the source's size; these are prefix-summed within the source, one random offset is added, and
a document is taken once for each whole number that its interval crosses. Documents go in order of their size's class, so
that words taken come as near to the target as copies do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .ranks import hash32, parts_for, ranked

#: Words stand between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def size_class(size: Column) -> Column:
    """Sizes below 16 by themselves, others by their four leading binary digits and length: it grows with the size."""
    digits = F.length(F.bin(size))
    lead = F.expr("cast(0 as bigint)")
    for b in range(5, 64):
        lead = F.when(digits == b, F.shiftright(size, b - 4).bitwiseAND(F.lit(7))) if b == 5 else lead.when(digits == b, F.shiftright(size, b - 4).bitwiseAND(F.lit(7)))
    return F.when(size < 16, size).otherwise(8 * digits + lead).cast("int")


def targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """source, source_size and target for each row (source, source_size) of sizes.

    Weights go round the sources in code point order, null last. All targets together are `share` of all sizes. A
    target stops at `most` times its source's size and the rest is shared again by weight. In the order of the level at
    which sources stop, the level that shares out what is left is at its largest at the first source that doesn't stop;
    that level gives all targets. One row a source: the only step that isn't divided.
    """
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighted = sizes.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(number, F.lit(len(weights))) + 1).cast("int")))
    limit = F.lit(float(most)) * F.col("source_size")
    order = Window.orderBy(limit / F.col("_weight"), F.asc_nulls_last("source"))
    stopped = F.coalesce(F.sum(limit).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.partitionBy(F.lit(1))
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - stopped) / left
    leveled = weighted.withColumn("_level", level).withColumn("_level", F.max("_level").over(everything))
    return leveled.select("source", "source_size", F.least(limit, F.col("_level") * F.col("_weight")).alias("target"))


def copies(docs: DataFrame, weights: list[float] = (3, 1, 2), share: float = 1.5, most: float = 2, seed: int = 0, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and copies for each row; the same for the same rows, seed and parameters.

    Null texts have no words; a null source is a source; a source without words has target 0 and gives nothing. Rows alike in
    id and size are counted as rows of their own. An empty table gives none. Only id, text and source are read, once.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    sized = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size")))
    by_class = sized.withColumn("_class", size_class(F.col("size")))
    held = stored(by_class.groupBy("source", "_class").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_words")))
    order = Window.partitionBy("source").orderBy("_class")
    total = F.sum("_words").over(Window.partitionBy("source"))
    start = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = held.select("source", "_class", start.alias("_first"), total.alias("source_size"))
    shared = targets(held.groupBy("source").agg(F.sum("_words").alias("source_size")), list(weights), share, most)
    offset = hash32(F.coalesce(F.col("source"), F.lit("")), F.lit(seed)) / F.lit(float(2**32))
    places = starts.drop("source_size").withColumnRenamed("source", "_s").withColumnRenamed("_class", "_c").join(shared, F.col("_s").eqNullSafe(F.col("source"))).withColumn("_offset", offset).drop("source")
    ranks = ranked(by_class.withColumn("_h", hash32(F.col("doc_id"))), ["source", "_class"], "_h", [F.col("doc_id")], "_rank_in", parts_for(held.agg(F.max("_n")).first()[0]))
    placed = ranks.join(places, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")))
    rank = (F.col("_first") + F.col("_rank_in")).cast("double")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(expected * (rank + 1) + F.col("_offset")) - F.floor(expected * rank + F.col("_offset"))
    return placed.select("doc_id", "size", "source_size", "target", F.least(crossed, F.lit(int(most))).cast("bigint").alias("copies"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, with their columns, each as often as the mix takes it; rows with equal ids as often as the least of them."""
    times = copies(docs, **how).groupBy("doc_id").agg(F.min("copies").alias("__copies")).filter("__copies > 0").withColumnRenamed("doc_id", "__id")
    met = docs.join(times, F.col("doc_id").eqNullSafe(F.col("__id")))
    return met.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int")))).select(*[docs[c] for c in docs.columns])


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), classed AS (
  SELECT *, CASE WHEN size < 16 THEN size ELSE 8 * length(bin(size)) + ((size >> (length(bin(size)) - 4)) & 7) END AS class,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM sized
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sizes
), leveled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted
), targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT max(level) FROM leveled) * weight) AS target,
    CAST('0x' || substr(md5(coalesce(source, '') || '|0'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM leveled
), placed AS (
  SELECT c.doc_id, c.size, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS e,
    CAST(row_number() OVER (PARTITION BY c.source ORDER BY c.class, c.h, c.doc_id) - 1 AS DOUBLE) AS r
  FROM classed c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * CAST(least(floor(e * (r + 1) + u) - floor(e * r + u), 2) AS BIGINT) AS taken FROM placed
"""
