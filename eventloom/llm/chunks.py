"""Substring deduplication by content-defined chunks.

A gear rolling hash over the UTF-8 bytes cuts a text where its top bits vanish and haven't just before, so that a cut depends on the 48 bytes
before it and an insertion moves only the cuts next to it. Chunks are identified by a digest of their bytes; a digest that
occurs again marks a repeat. Runs of repeated chunks are anchors: each grows to both sides as long as its bytes are those around the
chunk's first occurrence, and what then holds enough words is reported or removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, mapped, on_arrow, stored, utf8

#: Chunk sizes in bytes. One byte in 2^CUT_BITS is a candidate, and a cut if there is none within the LEAST bytes before it; MOST ends a chunk.
LEAST, CUT_BITS, MOST = 16, 5, 112
#: Words that a repeated passage must hold, and that the run of whole chunks in it must.
WORDS, ANCHOR = 20, 4
#: Bytes around a chunk's first occurrence with which a run is compared. A cut depends on the 48 bytes before it alone, so the first equal
#: chunk of a passage begins with the first candidate after these; it is further off than this but once in 5,000.
AROUND = 320


def _gear() -> np.ndarray:
    """256 numbers of 32 bits, by a fixed mixing of the byte's value."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed=9) for b in range(256)], np.uint32)


GEAR = _gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: h = 2h + gear(byte) mod 2^32, by doubling windows."""
    h = GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)
    return h


def cuts(text: bytes) -> list[int]:
    """The end of each chunk, in bytes."""
    n = len(text)
    if not n:
        return []
    places: list[int] = []
    data = np.frombuffer(text, np.uint8)
    block = 1 << 22
    for at in range(0, n, block):  # 31 bytes before a block give its first hashes their whole window
        lead = min(at, 31)
        h = rolling(data[at - lead : at + block])[lead:]
        places += (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + at + 1).tolist()
    out, start, before = [], 0, 0
    for p in places:
        before, near = p, p - before < LEAST
        if near:
            continue
        while p - start > MOST:
            start += MOST
            out.append(start)
        out.append(p)
        start = p
    while n - start > MOST:
        start += MOST
        out.append(start)
    if start < n:
        out.append(n)
    return out


SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def chunked(text: bytes) -> tuple[list[int], list[int]]:
    """Signed 64-bit digest and place of each chunk; a place is start * 2^17 + length * 2^9 + word starts * 2 + again.

    `again` is 1 if the digest has occurred before in the same text.
    """
    ends = cuts(text)
    if not ends:
        return [], []
    starts = [0, *ends[:-1]]
    found = np.array(list(map(xxhash.xxh3_64_intdigest, [text[a:b] for a, b in zip(starts, ends)])), np.uint64).view(np.int64)
    space = SPACE[np.frombuffer(text, np.uint8)]
    begins = ~space
    begins[1:] &= space[:-1]
    edges = np.array(starts, np.int64)
    words = np.add.reduceat(begins, edges, dtype=np.int64)
    again = np.ones(len(found), np.int64)
    again[np.unique(found, return_index=True)[1]] = 0
    places = (edges << 17) | ((np.array(ends, np.int64) - edges) << 9) | (words << 1) | again
    return found.tolist(), places.tolist()


def chunk_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest and place of every chunk of every whole text."""
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        def apply(keys, texts):
            ids, digests, places = [], [], []
            for key, t in zip(keys, texts):
                found, at = chunked(utf8(t))
                ids += [key] * len(at)
                digests += found
                places += at
            return {"doc_id": ids, "digest": digests, "place": places}

        return apply

    return on_arrow(df, [F.col(id_col), F.col(text)], make, f"doc_id {kind}, digest bigint, place bigint")


def repeats(chunks: DataFrame) -> DataFrame:
    """doc_id, digest, place and source_doc_id of the chunks that are not the first of their digest.

    The first is the first in the document with the least id. Digests are counted with partial aggregation; those that
    occur twice meet the chunks, cut again rather than kept, in a join whose hot keys can be split.
    """
    counted = chunks.groupBy("digest").agg(F.min("doc_id").alias("source_doc_id"), F.count(F.lit(1)).alias("copies"))
    twice = stored(counted.filter("copies > 1").select(F.col("digest").alias("_d"), "source_doc_id"))
    again = F.col("place").bitwiseAND(F.lit(1)) == 1
    return chunks.join(twice, F.col("digest") == F.col("_d")).filter(again | (F.col("doc_id") != F.col("source_doc_id"))).select("doc_id", "digest", "place", "source_doc_id")


def runs(found: list[dict], words: int = ANCHOR) -> list[dict]:
    """Runs of adjacent chunks with at least `words` word starts: a check sum of the digests in each, its first and last digest and their sources, and all sources."""
    out: list[dict] = []
    for place, digest, source in sorted((r["place"], r["digest"], r["source_doc_id"]) for r in found):
        at, n, w = place >> 17, place >> 9 & 0xFF, place >> 1 & 0xFF
        if out and out[-1]["start"] + out[-1]["length"] > at:
            continue  # the same chunk of a repeated row
        if out and out[-1]["start"] + out[-1]["length"] == at:
            last = out[-1]
            last["length"] += n
            last["n_words"] += w
            last["digest"] ^= digest
            last |= {"last": digest, "last_source": source}
            last["sources"][source] = None
        else:
            out.append({"start": at, "length": n, "n_words": w, "digest": digest, "first": digest, "first_source": source, "last": digest, "last_source": source, "sources": {source: None}})
    return [x | {"sources": list(x["sources"])} for x in out if x["n_words"] >= words]


def surroundings(text: bytes, wanted: set[int]) -> dict[int, tuple[bytes, bytes]]:
    """The AROUND bytes before and after the first chunk of each wanted digest."""
    out: dict[int, tuple[bytes, bytes]] = {}
    for digest, place in zip(*chunked(text)):
        if digest in wanted and digest not in out:
            at = place >> 17
            end = at + (place >> 9 & 0xFF)
            out[digest] = text[max(0, at - AROUND) : at], text[end : end + AROUND]
    return out


def anchors(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and found: the runs of each document, with the bytes before and after them at the first occurrence of their first and last chunk."""
    kind = df.schema[id_col].dataType.simpleString()
    named = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    gathered = repeats(chunk_rows(named)).groupBy("doc_id").agg(F.collect_list(F.struct("place", "digest", "source_doc_id")).alias("found"))

    def make_runs():
        return lambda keys, found: {"doc_id": keys, "runs": [runs(x) for x in found]}

    run = f"struct<start:bigint,length:bigint,digest:bigint,first:bigint,first_source:{kind},last:bigint,last_source:{kind},sources:array<{kind}>>"
    every = stored(on_arrow(gathered, [F.col("doc_id"), F.col("found")], make_runs, f"doc_id {kind}, runs array<{run}>").select("doc_id", F.explode("runs").alias("r")).select("doc_id", "r.*"))
    ends = every.select(F.explode(F.array(F.struct(F.col("first_source").alias("source"), F.col("first").alias("d")), F.struct(F.col("last_source").alias("source"), F.col("last").alias("d")))).alias("e"))
    wanted = ends.select("e.source", "e.d").distinct().groupBy("source").agg(F.collect_list("d").alias("wanted"))

    def make_around():
        def apply(keys, texts, digests):
            ids, found = [], []
            for key, t, d in zip(keys, texts, digests):
                for digest, (before, after) in surroundings(utf8(t), set(d)).items():
                    ids.append(key)
                    found.append((digest, before, after))
            return {"source": ids} | dict(zip(("d", "before", "after"), map(list, zip(*found)) if found else ([], [], [])))

        return apply

    sources = named.join(wanted, F.col("doc_id") == F.col("source"))
    # rows with equal ids may both hold a chunk; one of them is compared
    around = stored(
        on_arrow(sources, [F.col("doc_id"), F.col("text"), F.col("wanted")], make_around, f"source {kind}, d bigint, before binary, after binary").groupBy("source", "d").agg(F.min("before").alias("before"), F.min("after").alias("after"))
    )
    left = around.select(F.col("source").alias("_a"), F.col("d").alias("_b"), "before")
    right = around.select(F.col("source").alias("_c"), F.col("d").alias("_d"), "after")
    met = every.join(left, (F.col("first_source") == F.col("_a")) & (F.col("first") == F.col("_b")), "left").join(right, (F.col("last_source") == F.col("_c")) & (F.col("last") == F.col("_d")), "left")
    # within one text the bytes before a chunk may belong to its first occurrence, which stays
    before = F.when(F.col("first_source") != F.col("doc_id"), F.col("before")).alias("before")
    return met.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "digest", "sources", before, "after")).alias("found"))


def common_end(a: bytes, b: bytes) -> int:
    """How many bytes both end with."""
    n = min(len(a), len(b))
    same = np.frombuffer(a, np.uint8, n, len(a) - n)[::-1] == np.frombuffer(b, np.uint8, n, len(b) - n)[::-1]
    return n if same.all() else int(same.argmin())


def common_start(a: bytes, b: bytes) -> int:
    return common_end(a[::-1], b[::-1])


def grown(data: bytes, found: list[dict], words: int = WORDS) -> list[dict]:
    """Passages of the text: its runs, grown to both sides, joined where they touch, of `words` words or more that end inside of them whole or in part.

    A run whose bytes aren't those it was found on, in another row with the same id, has none.
    """
    digests, places = chunked(data)
    at = {p >> 17: i for i, p in enumerate(places)}
    ends = [(p >> 17) + (p >> 9 & 0xFF) for p in places]
    out: list[dict] = []
    for x in sorted(found, key=lambda x: x["start"]):
        a, b = x["start"], x["start"] + x["length"]
        i, check = at.get(a), 0
        while i is not None and i < len(ends) and ends[i] <= b:
            check ^= digests[i]
            i += 1
        if check != x["digest"] or i is None or ends[i - 1] != b:
            continue
        a -= common_end(data[max(0, a - AROUND) : a], x["before"] or b"")
        b += common_start(data[b : b + AROUND], x["after"] or b"")
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(b, out[-1]["end"])
            out[-1]["sources"] += [s for s in x["sources"] if s not in out[-1]["sources"]]
        else:
            out.append({"start": a, "end": b, "sources": list(x["sources"])})
    for x in out:
        # a character that only its first bytes repeat isn't repeated
        while x["start"] < x["end"] and data[x["start"]] & 0xC0 == 0x80:
            x["start"] += 1
        while x["start"] < x["end"] < len(data) and data[x["end"]] & 0xC0 == 0x80:
            x["end"] -= 1
        x["n_words"] = len(data[x["start"] : x["end"]].split())
    return [x for x in out if x["n_words"] >= words]


def spans(df: DataFrame, words: int = WORDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans: for each document with repeats, the repeated passages that hold `words` words or more (a word cut at an end counts).

    Each span has start and length in bytes of UTF-8, n_words, and sources, the least ids of documents that hold its chunks, in the
    order of these. Null and empty texts have none; rows without id take no part;
    rows with equal ids count as one document, and identical rows among them don't repeat each other. An empty table
    gives none. Only id and text are read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    found = anchors(df, id_col, text).select(F.col("doc_id").alias("_id"), "found")
    joined = df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).join(found, F.col("doc_id") == F.col("_id"))

    def make():
        def apply(keys, texts, found):
            every = [grown(utf8(t), x, words) for t, x in zip(texts, found)]
            return {"doc_id": keys, "spans": [[{"start": x["start"], "length": x["end"] - x["start"], "n_words": x["n_words"], "sources": x["sources"]} for x in own] for own in every]}

        return apply

    span = f"struct<start:bigint,length:bigint,n_words:bigint,sources:array<{kind}>>"
    every = on_arrow(joined, [F.col("doc_id"), F.col("text"), F.col("found")], make, f"doc_id {kind}, spans array<{span}>").filter(F.size("spans") > 0)
    return every.groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))


def without(data: bytes, found: list[dict]) -> str:
    """The text without the passages, each drawn in to whole words."""
    out, done = [], 0
    for x in found:
        a, b = x["start"], x["end"]
        while 0 < a < b and not SPACE[data[a - 1]]:
            a += 1
        while a < b < len(data) and not SPACE[data[b]]:
            b -= 1
        out.append(data[done:a])
        done = b
    return b"".join([*out, data[done:]]).decode("utf-8", "surrogatepass")


def remove(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """docs, with their columns, without repeated passages; documents that hold nothing else go, n_chars follows the text.

    The first occurrence of each passage stays. Documents without repeats, and those without id or text, are as before.
    """
    found = anchors(docs).select(F.col("doc_id").alias("__id"), F.col("found").alias("__found"))
    joined = docs.join(found, F.col("doc_id") == F.col("__id"), "left").drop("__id")
    schema = docs.schema

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts, lists = part.column("text").to_pylist(), part.column("__found").to_pylist()
                new = [without(utf8(t), grown(utf8(t), x, words)) if t and x else t for t, x in zip(texts, lists)]
                changed = [a != b for a, b in zip(texts, new)]
                columns = {n: part.column(n) for n in part.schema.names if n != "__found"}
                columns["text"] = pa.array(new, part.schema.field("text").type)
                if "n_chars" in columns:
                    kind = part.schema.field("n_chars").type
                    columns["n_chars"] = pa.array([len(t) if c else n for t, c, n in zip(new, changed, columns["n_chars"].to_pylist())], kind)
                keep = pa.array([not (c and not t.strip()) for t, c in zip(new, changed)], pa.bool_())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).filter(keep)

    return mapped(joined.select(*schema.names, "__found"), cut, schema)
