"""Document fingerprints: a Merkle tree over sections, paragraphs and phrases.

Sections are divided by empty lines, paragraphs are lines, and phrases are what lies between sentence ends, in pieces of
a few words. Every node is the digest of its children's; equal roots are equal texts, and where roots differ the branches
that differ locate the edit. The fingerprint writes the tree down with the length of each phrase, so that two fingerprints alone tell
how alike two texts are and where they differ: their trees are walked together from the root, and only differing branches are entered.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, _arrow_schema, utf8

#: A phrase ends with a sentence after LEAST_PHRASE words or more, or else after PHRASE, and takes the white space after it.
PHRASE, LEAST_PHRASE = 4, 2
PHRASES = re.compile(r"(?:\S+[^\S\n]+){%d,%d}?\S*[.!?](?!\S)\s*|(?:\S+[^\S\n]+){0,%d}\S*\s*" % (LEAST_PHRASE - 1, PHRASE - 1, PHRASE - 1))
SECTION = re.compile(r"(?<=\n)(?=[^\S\n]*\n)")
#: Code points of a leaf at most: its length is written with two digits.
LONGEST = 255
#: Bytes of text that one range of documents holds.
RANGE_BYTES = 32 << 20


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def sections(text: str) -> list[list[str]]:
    """Paragraphs, with their line ends, by section; joined they are the text."""
    return [s.splitlines(keepends=True) if "\r" in s else [x for x in re.split(r"(?<=\n)", s) if x] for s in SECTION.split(text) if s]


def pieces(paragraph: str) -> list[str]:
    """The phrases, cut where they are longer than a leaf; joined they are the paragraph."""
    found = [m for m in PHRASES.findall(paragraph) if m]
    if len(paragraph) > LONGEST and max(map(len, found)) > LONGEST:
        return [x[i : i + LONGEST] for x in found for i in range(0, len(x), LONGEST)]
    return found


def _leaves(paragraph: str) -> str:
    """Ten hexadecimal digits a phrase: eight of its digest, two of its length in code points."""
    h = xxhash.xxh32_intdigest
    return "".join([f"{h(x.encode('utf-8', 'surrogatepass')):08x}{len(x):02x}" for x in pieces(paragraph)])


def fingerprint(text: str, known: dict[str, str] | None = None) -> str:
    """root|section/section...: a section is its node and its paragraphs, each after a `;`, a paragraph its node and its leaves.

    A paragraph's node is the digest of its exact bytes, a section's that of its paragraphs' and the root that of its sections';
    the root is written with 32 hexadecimal digits, inner nodes with their first eight. `known` holds paragraphs that have been written
    before; it changes no result.
    """
    known = {} if known is None else known
    nodes, tree = [], []
    for section in sections(text):
        below = []
        for p in section:
            node = digest(utf8(p))
            below.append(node)
            if p not in known:
                known[p] = f"{node.hex()[:8]}{_leaves(p)}"
        nodes.append(digest(b"".join(below)))
        tree.append(";".join([nodes[-1].hex()[:8], *[known[p] for p in section]]))
    return f"{digest(b''.join(nodes)).hex()}|{'/'.join(tree)}"


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of equal children, in order on both sides: all at the start, all at the end, and between these each with the next equal one."""
    n = min(len(a), len(b))
    head = next((i for i in range(n) if a[i] != b[i]), n)
    tail = next((i for i in range(n - head) if a[-1 - i] != b[-1 - i]), n - head)
    out = [(i, i) for i in range(head)]
    where = defaultdict(list)
    for i in range(head, len(a) - tail):
        where[a[i]].append(i)
    last = head - 1
    if where:
        for j in range(head, len(b) - tail):
            own = where.get(b[j])
            if own and own[-1] > last:
                last = own[bisect_right(own, last)]
                out.append((last, j))
    return out + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]


def _gaps(a: list[str], b: list[str]) -> Iterator[tuple[range, range]]:
    """The children on both sides between equal ones."""
    i = j = 0
    for x, y in [*aligned(a, b), (len(a), len(b))]:
        if x > i or y > j:
            yield range(i, x), range(j, y)
        i, j = x + 1, y + 1


def _cut(leaves: str) -> list[str]:
    return [leaves[i : i + 10] for i in range(0, len(leaves), 10)]


def _size(branch: str) -> int:
    """Code points under a section or paragraph as it is written."""
    return sum(int(x[8:], 16) for p in branch.split(";") for x in _cut(p[8:]))


def differences(a: str, b: str) -> Iterator[tuple[int, int, str, str]]:
    """Pairs of paragraphs that differ, as written, with the section and paragraph of the second. An empty text stands for none; the
    place is then that of the paragraph before which one is missing."""
    one, two = (x[33:].split("/") if x[33:] else [] for x in (a, b))
    for left, right in _gaps([s[:8] for s in one], [s[:8] for s in two]):
        old = [p for i in left for p in one[i].split(";")[1:]]
        new = [(j, k, p) for j in right for k, p in enumerate(two[j].split(";")[1:])]
        for xs, ys in _gaps([p[:8] for p in old], [p[:8] for _, _, p in new]):
            following = new[ys.stop][:2] if ys.stop < len(new) else (right.stop, 0)
            for k in range(max(len(xs), len(ys))):
                yield *(new[ys[k]][:2] if k < len(ys) else following), old[xs[k]] if k < len(xs) else "", new[ys[k]][2] if k < len(ys) else ""


def likeness(a: str, b: str) -> float:
    """1 for equal roots; else the code points of the branches that both trees share over those of the longer text.

    Equal sections and paragraphs, in order, are shared whole; of paragraphs that differ, the leaves that are equal in order.
    """
    if a[:32] == b[:32]:
        return 1.0
    one, two = (sum(map(_size, x[33:].split("/"))) if x[33:] else 0 for x in (a, b))
    if not one or not two:
        return 0.0
    lost = 0
    for _, _, old, new in differences(a, b):
        x, y = _cut(old[8:]), _cut(new[8:])
        lost += _size(new) - sum(int(y[j][8:], 16) for _, j in aligned(x, y))
    return (two - lost) / max(one, two)


def located(a: str, b: str) -> list[dict]:
    """Where the text of fingerprint b differs from that of a: section, paragraph, start and end in code points of b's text; start is end where something is missing."""
    if a[:32] == b[:32]:
        return []
    starts, at = {}, 0
    written = b[33:].split("/") if b[33:] else []
    for i, s in enumerate(written):
        for k, p in enumerate(s.split(";")[1:]):
            starts[i, k] = at
            at += _size(p)
    out = []
    for section, paragraph, old, new in differences(a, b):
        begin = starts.get((section, paragraph), at)
        sizes = [int(leaf[8:], 16) for leaf in _cut(new[8:])]
        for _, js in _gaps(_cut(old[8:]), _cut(new[8:])):
            start = begin + sum(sizes[: js.start])
            out.append({"section": section, "paragraph": paragraph, "start": start, "end": start + sum(sizes[js.start : js.stop])})
    return out


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points (rounded down) replaced by the first as many of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n] if n else text


def compare_next(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each whole text's fingerprint beside those of its edited text and of the next document's, by ascending id of any type that has an order.

    Null texts are empty. After the last document comes the first; an only document follows itself. Null ids come first;
    rows with equal ids are ordered by text and follow each other. An empty table gives none; other columns aren't read.

    Rows are dealt by ranges of ids, as many as RANGE_BYTES of text ask for, and sorted in their tasks; the first row of each range
    also goes to the end of the range before. So a text is shuffled once and a task holds two rows at a time. The driver holds an id a range.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(8, -(-size // RANGE_BYTES))
    # Python orders what it is given as Spark does, but for times, which go as numbers
    place = F.unix_micros(F.col("doc_id").cast("timestamp")) if kind.startswith("timestamp") else F.col("doc_id")
    ranges = rows.select(place.alias("place")).repartitionByRange(parts, F.asc_nulls_first("place")).withColumn("part", F.spark_partition_id())
    firsts = ranges.groupBy("part").agg(F.min("place").alias("low"), F.max(F.col("place").isNull()).alias("none")).orderBy("part").collect()
    lows = [bytes(r["low"]) if isinstance(r["low"], bytearray) else r["low"] for r in firsts]  # of a range that begins with nulls, the least id if there is one
    nulls = bool(firsts) and firsts[0]["none"]
    bounds = lows[1:]
    routed = spark.createDataFrame([], f"doc_id {kind}, text string, part int, ahead boolean").schema
    routed_arrow = _arrow_schema(routed)

    def route(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                cut = batch.slice(at, SLICE)
                keys = cut.column(2).to_pylist()
                part = [0 if k is None else bisect_right(bounds, k) for k in keys]
                again = [i for i, (k, p) in enumerate(zip(keys, part)) if (k is None if p == 0 and nulls else k == lows[p])]
                ahead = cut.take(pa.array(again, pa.int64()))
                before = [(part[i] or len(lows)) - 1 for i in again]  # the first range's row goes to the last
                for some, to, flag in ((cut, part, False), (ahead, before, True)):
                    yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(to, pa.int32()), pa.array([flag] * len(to))], schema=routed_arrow)

    dealt = rows.withColumn("place", place).mapInArrow(route, routed).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "ahead", F.asc_nulls_first("doc_id"), "text")
    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    fields = spark.createDataFrame([], schema).schema
    arrow = _arrow_schema(fields)

    def run(batches):
        out: list[tuple] = []
        held = None  # id, text, fingerprint, its paragraphs
        done = None  # the part whose last row has had its next one
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                cut = batch.slice(at, SLICE)
                for key, t, p, ahead in zip(*[c.to_pylist() for c in cut.columns]):
                    if ahead and p == done:
                        continue  # rows with the first row's id that aren't the least
                    known: dict[str, str] = {}
                    mark = fingerprint(t, known)
                    if held is not None:
                        out.append(_row(held, t, mark))
                    held = None if ahead else (key, t, mark, known)
                    done = p if ahead else done
                yield _batch(out, arrow)
                out = []
        # every part ends with a row that is ahead

    return dealt.mapInArrow(run, fields)


def _row(held: tuple, following: str, mark: str) -> tuple:
    key, text, own, known = held
    new = edited(text, following)
    changed = own if new == text else fingerprint(new, known)
    return (key, len(text), hashlib.sha256(utf8(new)).hexdigest(), own, changed, likeness(own, changed), likeness(own, mark))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
