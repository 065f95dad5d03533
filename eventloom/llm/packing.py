"""Packing of token sequences as a cutting-stock problem solved by column generation.

Documents are cut into pieces of at most a sequence's length. The histogram of piece lengths, rounded up to a fixed set
of sizes, is the demand of a linear program over patterns (how many pieces of each size share one sequence); a knapsack
by dynamic programming prices new patterns until none helps. Patterns are rounded down to whole numbers, what remains is
filled first-fit by decreasing size, and pieces take their places in the patterns by their rank within their size.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import give_back, on_arrow, per_worker, stored
from .ranks import hash32, parts_for, ranked
from .token_counts import byte_alphabet

#: Words, and parts of words, whose ids a worker keeps.
KEPT = 300_000
#: Places of the filter that tells which words have been learned before.
SEEN = 1 << 23


def sizes_up_to(length: int, exact: int = 64, step: float = 1.015) -> list[int]:
    """The sizes pieces are rounded up to: all up to `exact`, then each about `step` times the one before."""
    out = list(range(1, min(exact, length) + 1))
    while out[-1] < length:
        out.append(min(length, max(out[-1] + 1, int(out[-1] * step))))
    return out


def priced(sizes: np.ndarray, values: np.ndarray, length: int) -> tuple[float, list[np.ndarray]]:
    """The largest value of a pattern that fits, and for each size the best pattern that holds it, best first.

    One unbounded knapsack, solved by dynamic programming over all capacities, serves all of them.
    """
    best, took, at = np.zeros(length + 1), np.full(length + 1, -1), np.zeros(length + 1, np.int64)
    order = np.argsort(sizes)
    small, worth = sizes[order], values[order]
    fits = np.searchsorted(small, np.arange(length + 1), side="right")
    for c in range(int(small[0]), length + 1):
        best[c], at[c] = best[c - 1], at[c - 1]
        got = best[c - small[: fits[c]]] + worth[: fits[c]]
        k = got.argmax()
        if got[k] > best[c] + 1e-12:
            best[c], took[c], at[c] = got[k], order[k], c
    out = []
    for k in np.argsort(-(values + best[length - sizes])):
        pattern, c = np.zeros(len(sizes), np.int64), length - sizes[k]
        pattern[k] = 1
        while c := at[c]:  # the least capacity of the same value
            pattern[took[c]] += 1
            c -= sizes[took[c]]
        out.append(pattern)
    return float(best[length]), out


def solve(sizes: np.ndarray, demand: np.ndarray, length: int, gap: float = 5e-4, rounds: int = 20, pull: float = 0.7) -> tuple[np.ndarray, np.ndarray]:
    """The linear program's patterns (columns) and how often each is used, by the revised simplex method.

    The first columns are those of a first-fit filling. Each round prices a new column for every size, at prices pulled
    towards those of the best lower bound so far, which keeps them from swinging, and lets columns enter until none is
    worth it. It ends within a share `gap` of the lower bound, or after `rounds`.
    """
    n = len(sizes)
    basis = np.diag(length // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    used = inverse @ demand
    place = {int(s): i for i, s in enumerate(sizes)}
    first = fill({int(s): int(d) for s, d in zip(sizes, demand)}, length)
    pool = np.zeros((n, len(first)))
    for j, (pattern, _) in enumerate(first):
        for s, a in pattern.items():
            pool[place[s], j] = a
    center, bound, near = sizes / length, float(sizes @ demand) / length, pull
    for _ in range(rounds):
        for _ in range(20 * n):
            worth = inverse.sum(axis=0) @ pool
            best = int(worth.argmax())
            if worth[best] <= 1 + 1e-7:
                break
            pattern = pool[:, best]
            direction = inverse @ pattern
            up = direction > 1e-9
            ratio = np.full(n, np.inf)
            ratio[up] = used[up] / direction[up]
            out = int(ratio.argmin())
            step = ratio[out]
            if not np.isfinite(step):
                break
            used = np.maximum(used - step * direction, 0)
            used[out] = step
            basis[:, out] = pattern
            row = inverse[out] / direction[out]
            inverse -= np.outer(direction, row)
            inverse[out] = row
        if used.sum() <= bound * (1 + gap):
            break
        duals = np.maximum(inverse.sum(axis=0), 0)
        prices = near * center + (1 - near) * duals
        value, columns = priced(sizes, prices, length)
        if (least := float(prices @ demand) / max(value, 1e-9)) > bound:
            bound, center = least, prices / value
        new = [c for c in columns if duals @ c > 1 + 1e-6]
        if new:
            pool, near = np.column_stack([pool, *new]), pull
        elif near == 0:
            break
        else:
            near = near / 2 if near > 0.05 else 0.0
    return basis.astype(np.int64), used


def plan(histogram: dict[int, int], length: int, gap: float = 5e-4) -> list[tuple[dict[int, int], int]]:
    """Patterns {size: pieces} with the whole number of sequences that use each; every piece of the histogram has a place."""
    left = {s: n for s, n in histogram.items() if n}
    out: list[tuple[dict[int, int], int]] = []
    if full := left.pop(length, 0):
        out.append(({length: 1}, full))
    if left:
        names = sorted(left, reverse=True)
        columns, used = solve(np.array(names), np.array([left[s] for s in names], float), length, gap)
        for k in np.argsort(-used):
            pattern = {s: int(a) for s, a in zip(names, columns[:, k]) if a}
            times = min([int(used[k] + 1e-6), *(left[s] // a for s, a in pattern.items())])
            if pattern and times > 0:
                out.append((pattern, times))
                for s, a in pattern.items():
                    left[s] -= a * times
        out += fill(left, length)
    return out


def fill(left: dict[int, int], length: int) -> list[tuple[dict[int, int], int]]:
    """Fills sequences with the largest piece that fits, again and again; equal fillings are made at once."""
    out = []
    while left := {s: n for s, n in left.items() if n}:
        room, pattern = length, {}
        for s in sorted(left, reverse=True):
            if a := min(left[s], room // s):
                pattern[s] = a
                room -= a * s
        times = min(left[s] // a for s, a in pattern.items())
        out.append((pattern, times))
        for s, a in pattern.items():
            left[s] -= a * times
    return out


class Ids:
    """Token ids of texts, by words between ASCII white space, across which no token of the vocabulary runs.

    Words of plain letters, digits and marks are lower-cased and cut into the library's pre-tokens here, so that
    `word,` and `Word.` share the ids of `word`; all other words go to the library whole.
    """

    #: Fixed value: the vocabulary's pre-token pattern.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    #: ASCII and the Latin-1 letters, which NFC leaves as they are.
    PLAIN = regex.compile(r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

    def __init__(self, content: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.findall = regex.compile(self.PATTERN).findall
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.seen = bytearray(SEEN)
        self.characters = {b: c for c, b in byte_alphabet().items()}

    def spelled(self, part: str) -> str:
        """A pre-token in the vocabulary's characters for bytes, as the library's merges take it."""
        return part if part.isascii() else part.encode().decode("latin-1").translate(self.characters)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learned(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The ids of words not known yet. A word is kept from the second time that it is learned: most never come again."""
        if len(self.parts) > KEPT:
            self.parts.clear()
        if len(self.words) > KEPT:
            self.words.clear()
        texts = [w.decode() for w in new]
        whole = self.PLAIN.fullmatch
        cut = [self.findall(t.lower()) if whole(t) and "<|" not in t else None for t in texts]
        model, spelled = self.tokenizer.model.tokenize, self.spelled
        for p in {p for x in cut if x for p in x}.difference(self.parts):
            self.parts[p] = b"".join([t.id.to_bytes(4, "little") for t in model(spelled(p))])
        other = [i for i, x in enumerate(cut) if x is None]
        library = dict(zip(other, self._encoded([texts[i] for i in other])))
        of = self.parts.__getitem__
        out = {w: library[i] if x is None else b"".join(map(of, x)) for i, (w, x) in enumerate(zip(new, cut))}
        seen, words = self.seen, self.words
        for w, ids in out.items():
            h = hash(w) % SEEN
            if seen[h]:
                words[w] = ids
            else:
                seen[h] = 1
        return out

    def of(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids, none for null."""
        if not text:
            return b""
        words = text.encode("utf-8", "replace").split()  # bytes.split cuts at ASCII white space alone
        found = list(map(self.words.get, words))
        missing, at = [], -1
        while True:
            try:
                at = found.index(None, at + 1)
            except ValueError:
                break
            missing.append(at)
        if missing:
            learned = self._learned(list({words[i] for i in missing}))
            for i in missing:
                found[i] = learned[words[i]]
        return b"".join(found)


@per_worker
def _ids(content: str) -> Ids:
    """One for each worker process, so that what it has learned serves all of the worker's tasks of packing."""
    out = Ids(content)
    give_back()  # what reading the vocabulary took
    return out


def pieces(df: DataFrame, tokenizer: str, length: int, end: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens for each piece: documents cut after every `length` ids."""
    shared = df.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    last = np.array([end], "<u4").tobytes()

    def make():
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        ids = _ids(shared.value)

        def apply(keys, texts):
            rows = []
            for key, t in zip(keys, texts):
                found = ids.of(t) + last
                n = len(found) // 4
                for at in range(0, n, length):
                    rows.append((key, at, min(length, n - at), zlib.crc32(found[4 * at : 4 * (at + length)]), n))
            return dict(zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens"), map(list, zip(*rows))))

        return apply

    kind = df.schema[id_col].dataType.simpleString()
    return on_arrow(df, [F.col(id_col), F.col(text)], make, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint", _ids)


def pack(df: DataFrame, tokenizer: str, length: int = 4096, end: int = 2, id_col: str = "doc_id", text: str = "text", gap: float = 5e-4) -> DataFrame:
    """The pieces with sequence_id, from 0, and offset in the sequence, gapless from 0.

    Each document's ids, with `end` after them, lie in exactly one piece each; null and empty texts are the end id alone.
    Repeated rows are packed as rows of their own; an empty table gives none. Only id and text are read. The driver gets
    a histogram over a fixed set of sizes, whatever the number of documents; it holds patterns, never documents.
    """
    spark = df.sparkSession
    sizes = sizes_up_to(length)
    cut = pieces(df, tokenizer, length, end, id_col, text)
    held = stored(cut.withColumn("h", hash32(F.col("doc_id"), F.col("start"))))
    size = F.element_at(F.array(*[F.lit(s) for s in _size_table(sizes)]), F.col("length").cast("int"))
    sized = held.withColumn("size", size)
    histogram = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    # for each size, the ranks at which another pattern begins: a table of as many rows as the patterns have sizes
    rows, first, taken = [], 0, dict.fromkeys(sizes, 0)
    for pattern, times in plan(histogram, length, gap):
        place = 0
        for s, a in sorted(pattern.items(), reverse=True):
            rows.append((s, taken[s], a, first, place))
            taken[s] += a * times
            place += a
        first += times
    starts: dict[int, list] = {}
    for s, at, a, of, place in rows:
        starts.setdefault(s, []).append((at, a, of, place))
    kind = "size int, slots array<struct<at:bigint,a:bigint,of:bigint,place:bigint>>"
    names = ("at", "a", "of", "place")
    slots = [[dict(zip(names, x)) for x in starts[s]] for s in sorted(starts)]
    # by Arrow: of a list Spark makes a table in Python workers of another kind, which an executor holds beside the others
    patterns = spark.createDataFrame(pa.table({"size": pa.array(sorted(starts), pa.int32()), "slots": pa.array(slots, pa.list_(pa.struct([(x, pa.int64()) for x in names])))}), kind)
    ranks = ranked(sized, ["size"], "h", [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], "rank", parts_for(max(histogram.values(), default=0)))
    placed = ranks.join(F.broadcast(patterns), "size")
    slot = F.element_at(F.filter("slots", lambda x: x["at"] <= F.col("rank")), -1)
    inside = F.col("rank") - F.col("slot.at")
    placed = placed.withColumn("slot", slot).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("slot.of") + F.floor(inside / F.col("slot.a"))).cast("bigint").alias("sequence_id"),
        (F.col("slot.place") + F.pmod(inside, F.col("slot.a"))).alias("place"),
    )
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))


def _size_table(sizes: list[int]) -> list[int]:
    return [sizes[bisect_left(sizes, n)] for n in range(1, sizes[-1] + 1)]
