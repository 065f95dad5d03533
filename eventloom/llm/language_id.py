"""Language identification by bit-sliced Bloom filters over character n-grams.

Each slot of the filter holds one bit for every language, so that one look-up returns the set of all languages whose
training texts hold an n-gram. A text's n-grams are looked up, the bits of each language are counted, the counts are
corrected for the filter's false positives, and the language with the largest corrected share wins.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE, mapped, on_arrow

#: A word bound is one space; anything but letters is a bound.
NOT_LETTERS = re.compile(r"[\W\d_]+")
SLICE_BITS = 64
ROUND = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class BloomModel:
    """`planes[slot, k]`: bits of languages 64k to 64k+63; `fill[l]`: share of the slots in which language l is set."""

    languages: tuple[str, ...]
    planes: np.ndarray
    fill: np.ndarray
    gram: int
    hashes: int


def letters(text: str | None) -> str:
    """Lower-case words between single spaces; empty if there is no letter."""
    out = NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""
    return f" {out} " if out else ""


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n code points; shorter texts have one, of all they hold."""
    n = max(1, min(n, len(codes)))
    h = np.zeros(len(codes) - n + 1, np.uint64)
    for i in range(n):
        h = (h ^ codes[i : len(codes) - n + 1 + i].astype(np.uint64)) * ROUND
        h ^= h >> np.uint64(29)
    return h


def slots(h: np.ndarray, hashes: int, size: int) -> list[np.ndarray]:
    """The filter's positions of each n-gram, by double hashing; size is a power of two."""
    step, mask = (h >> np.uint64(32)) | np.uint64(1), np.uint64(size - 1)
    return [((h + np.uint64(i) * step) & mask).astype(np.int64) for i in range(hashes)]


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fit(
    rows: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", per_language: int = 400, languages: int = 1024,
    gram: int = 4, least: int = 3, slot_bits: int = 21, hashes: int = 2, longest: int = 1 << 22,
) -> BloomModel:
    """Fits the filters on a bounded sample of labelled rows.

    The sample is `per_language` ids of each language, those with the smallest hashes, with their whole texts but for those of over
    `longest` bytes, of the `languages` with the most ids (ties by name); these parameters bound what the driver gets. An n-gram counts for a language if `least` of its sampled rows hold it
    (fewer for a language with few rows). Rows without id, text or language teach nothing; of rows with equal id and
    language the smallest text does. Only ids are counted and ranked, and of these only some four times as many as are wanted,
    below a hash that follows from the language's number of ids; texts are read for the sample alone.
    """
    labelled = rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id_col).isNotNull())
    keys = labelled.select(F.col(lang).cast("string").alias("l"), F.col(id_col).alias("i")).distinct()
    most = keys.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(languages)
    # the hash as a number from 0 to 1; of n of them some 4 k lie below 4 k / n, and fewer than k never in practice
    share = (F.xxhash64(F.col("i").cast("string"), F.lit("language sample")) / F.lit(2.0**64)) + F.lit(0.5)
    below = keys.withColumn("share", share).join(F.broadcast(most), "l").filter(F.col("share") * F.col("n") <= 4 * per_language + 64)
    order = Window.partitionBy("l").orderBy("share", "i")
    ids = below.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_language).select("l", "i")
    texts = labelled.select(F.col(lang).cast("string").alias("l"), F.col(id_col).alias("i"), F.col(text).alias("t")).join(F.broadcast(ids), ["l", "i"], "left_semi").filter(F.octet_length("t") <= longest)
    sample = texts.groupBy("l", "i").agg(F.min("t").alias("t"))
    by: dict[str, list[str]] = {}
    for row in sample.toLocalIterator():
        by.setdefault(row["l"], []).append(row["t"])
    names = tuple(sorted(by))
    size = 1 << slot_bits
    planes = np.zeros((size, max(1, -(-len(names) // SLICE_BITS))), np.uint64)
    fill = np.zeros(len(names))
    for k, name in enumerate(names):
        found = [np.unique(grams(codes_of(x), gram)) for t in by[name] if (x := letters(t))]
        if not found:
            continue
        h, n = np.unique(np.concatenate(found), return_counts=True)
        keep = h[n >= min(least, -(-len(found) // 10))]
        for at in slots(keep, hashes, size):
            planes[at, k // SLICE_BITS] |= np.uint64(1 << (k % SLICE_BITS))
        fill[k] = np.mean((planes[:, k // SLICE_BITS] >> np.uint64(k % SLICE_BITS)) & np.uint64(1))
    return BloomModel(names, planes, fill, gram, hashes)


def shares(model: BloomModel, text: str | None) -> np.ndarray | None:
    """For each language, the share of the text's n-grams it holds, without what false positives add; None without letters."""
    clean = letters(text)
    if not clean or not model.languages:
        return None
    h = grams(codes_of(clean), model.gram)
    hits = np.zeros(len(model.languages))
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)]
        where = slots(part, model.hashes, len(model.planes))
        bits = model.planes[where[0]]
        for x in where[1:]:
            bits = bits & model.planes[x]
        for k in range(len(model.languages)):
            hits[k] += np.count_nonzero(bits[:, k // SLICE_BITS] & np.uint64(1 << (k % SLICE_BITS)))
    false = model.fill**model.hashes
    return np.clip((hits / len(h) - false) / np.maximum(1 - false, 1e-9), 0, 1)


def decide(model: BloomModel, text: str | None) -> tuple[str, float]:
    """The language with the largest share (the first by name of equal ones) and that share; und and 0 without letters."""
    found = shares(model, text)
    if found is None:
        return "und", 0.0
    k = int(np.argmax(found))
    return model.languages[k], float(found[k])


def predict(df: DataFrame, model: BloomModel, keys: list[Column], names: list[str], text: str = "text") -> DataFrame:
    """keys under names, lang_pred and score for each row, from its whole text.

    Null and empty texts and those without a letter get `und` and 0. Repeated rows give equal results; an empty table
    gives none. Only `keys` and the text are read, so further columns of whatever name don't matter. The filter goes to
    the executors as one broadcast of 8 bytes for each slot and 64 languages, whatever the size of the corpus.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def make():
        held = shared.value
        return lambda *c: dict(zip(names, c[:-1])) | {k: list(v) for k, v in zip(("lang_pred", "score"), zip(*[decide(held, t) for t in c[-1]]))}

    kinds = df.select(*[k.alias(n) for k, n in zip(keys, names)]).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", lang_pred string, score double"
    return on_arrow(df, [*keys, F.col(text)], make, schema)


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, by its remainder; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(by))


def identify(df: DataFrame, folds: int = 4, held_fold: int = 2, **how) -> DataFrame:
    """doc_id, held_out, lang_pred and score: learns from the rows outside the held fold and predicts all.

    Null ids count as the empty text for the fold. A table without labelled rows teaches no language, so that all rows
    get `und`.
    """
    held = remainder("doc_id", folds) == held_fold
    model = fit(df.filter(~held), **how)
    return predict(df, model, [F.col("doc_id"), held], ["doc_id", "held_out"])


def keep_identified(docs: DataFrame, folds: int = 4, held_fold: int = 2, least_share: float = 0.0) -> DataFrame:
    """The rows of docs, with their columns, whose text has a learned language with a share over `least_share`.

    Rows go if their text is null or has no letter, or if no language holds any of its n-grams beyond chance. The
    decision is made in one pass that carries whole rows, so that equal ids can't be mixed up and nothing is shuffled.
    """
    model = fit(docs.filter(remainder("doc_id", folds) != held_fold))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        held = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [decide(held, t) for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                yield part.filter(pa.array([x != "und" and s > least_share for x, s in found], pa.bool_()))

    return mapped(docs, keep, docs.schema)
