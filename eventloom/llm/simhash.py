"""SimHash fingerprints and near-duplicate groups, with a pigeonring filter.

A fingerprint of 64 bits is a ring of four segments of 16. If two fingerprints differ in at most three bits, some segment
starts a chain in which the first l segments together differ in at most 3l/4 bits, for every l. So the first segment is
equal and the second differs in one bit at most, which leaves three of the second segment's quarters equal. Fingerprints
meet in buckets by the first segment and three quarters of the second, 28 bits. A bucket is searched segment by segment
along the chain, and only pairs within each budget reach the full comparison.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _arrow_schema, checkpointed, mapped, on_arrow, stored, utf8
from .components import components, thinned

SEED = 42
BITS, SEGMENTS, WIDTH = 64, 4, 16
#: Distinct fingerprints of a bucket that one task searches; larger buckets are divided.
BUCKET = 20_000


def shingles(words: list[bytes], n: int) -> list[bytes]:
    """Runs of n words, repeats included; all words where there are fewer; none for no words."""
    if len(words) < n:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[i:] for i in range(n)])))


def fingerprint(text: str | None, n: int = 3) -> int:
    """The fingerprint of a text's lower-cased (A-Z) words; 0 without words."""
    found = shingles(utf8(text).lower().split(), n)
    if not found:
        return 0
    set_bits = np.zeros(BITS, np.int64)
    of = partial(xxhash.xxh64_intdigest, seed=SEED)
    for at in range(0, len(found), 1 << 15):
        h = np.array(list(map(of, found[at : at + (1 << 15)])), np.uint64).astype(">u8")
        set_bits += np.unpackbits(h.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(found)).tobytes(), "big")


def fingerprints(df: DataFrame, n: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp, a signed 64-bit long, of each row's whole text."""
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        return lambda keys, texts: {"doc_id": keys, "fp": [signed(fingerprint(t, n)) for t in texts]}

    return on_arrow(df, [F.col(id_col), F.col(text)], make, f"doc_id {kind}, fp bigint")


def _segment(i: int) -> int:
    return ((1 << WIDTH) - 1) << (BITS - WIDTH * (i % SEGMENTS + 1))


def _divided(bits: int, parts: int = 4) -> list[int]:
    """A set of bits cut into `parts` of about the same number of bits."""
    places = [i for i in range(BITS) if bits >> i & 1]
    return [sum(1 << i for i in places[k * len(places) // parts : (k + 1) * len(places) // parts]) for k in range(parts)]


def masks(level: int) -> list[int]:
    """The bits that a bucket shares: a segment and three quarters of the next, and from level 1 on also one of four parts of the rest.

    Of a segment with one differing bit at most three quarters are equal, whichever they are: each of the four choices
    is a bucket of its own. What is left differs in three bits at most, so one of its four parts is equal.
    """
    out = [_segment(i) | (_segment(i + 1) & ~q) for i in range(SEGMENTS) for q in _divided(_segment(i + 1))]
    for _ in range(level):
        out = [m | part for m in out for part in _divided(~m & ((1 << BITS) - 1))]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chained(x: np.ndarray, start: int, limit: int) -> np.ndarray:
    """Which differences x stay within the budgets of the chain that begins with segment `start`."""
    left = np.arange(len(x))
    chain = 0
    for length in range(1, SEGMENTS + 1):
        chain |= _segment(start + length - 1)
        within = np.bitwise_count(x[left] & np.uint64(chain)) <= limit * length // SEGMENTS
        left = left[within]
        if not len(left):
            break
    return left


def links(fps: np.ndarray, start: int, limit: int = 3) -> list[tuple[int, int]]:
    """A spanning forest, as pairs of positions, of the fingerprints of a bucket that the chain from `start` links."""
    out, left = [], np.arange(len(fps))
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = chained(fps[left] ^ fps[at], start, limit)
            if len(near):
                out += [(int(at), int(k)) for k in left[near]]
                front += list(left[near])
                left = np.delete(left, near)
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])))
def _bucket_links(buckets: pd.Series, level: pd.Series, kind: pd.Series) -> pd.Series:
    out = []
    for rows, lv, k in zip(buckets, level, kind):
        start = int(k) // 4 ** (int(lv) + 1)
        fps = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
        out.append([{"a": rows[i]["node"], "b": rows[j]["node"]} for i, j in links(fps, start)])
    return pd.Series(out)


def linked(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges a, b between nodes (node, fp; distinct fps) that differ in three bits at most: enough of them to connect all that are.

    A bucket of over `bucket` fingerprints is divided by further shared bits, twice at most; after that a bucket shares 40 bits or
    more and can't hold more than the 2^20 or so fingerprints that the rest of the bits allow in practice, each of 16 bytes.
    """
    edges = None
    rows, level = nodes.select("node", "fp", F.lit(0).alias("kind")), 0
    choices = 16
    while True:
        every = F.array(*[F.lit(_signed(m)) for m in masks(level)])
        kinds = F.sequence(F.lit(0), F.lit(choices - 1))
        wide = rows.select("node", "fp", F.explode(F.transform(kinds, lambda c: F.col("kind") * choices + c)).alias("kind"))
        keyed = wide.withColumn("key", F.col("fp").bitwiseAND(F.element_at(every, F.col("kind") + 1)))
        sizes = keyed.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        over = checkpointed(sizes.filter(F.col("n") > bucket).select("kind", "key")) if level < 2 else None
        more = over is not None and not over.isEmpty()
        small = keyed.join(over, ["kind", "key"], "left_anti") if more else keyed
        gathered = small.groupBy("kind", "key").agg(F.collect_list(F.struct("node", "fp")).alias("rows")).filter(F.size("rows") > 1)
        found = gathered.select(F.explode(_bucket_links("rows", F.lit(level), "kind")).alias("e")).select("e.a", "e.b")
        edges = found if edges is None else edges.unionByName(found)
        if not more:
            return edges
        rows = keyed.join(over, ["kind", "key"], "left_semi").select("node", "fp", "kind")
        level, choices = level + 1, 4


def groups(df: DataFrame, n: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp and component_id, the least doc_id that a chain of links reaches, for each row.

    The distinct fingerprints are the nodes; documents without words have fingerprint 0 and link like any other. Rows with null
    ids link like all others but no component is named after them: component_id is null where no row of it has an id. Repeated rows stay.
    """
    held = stored(fingerprints(df, n, id_col, text))
    nodes = checkpointed(held.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(linked(nodes.select(F.col("fp").alias("node"), "fp")))
    named = checkpointed(nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = checkpointed(named.select(F.col("fp").alias("_fp"), "root").join(names, "root").drop("root"))
    return held.join(whole, F.col("fp") == F.col("_fp")).drop("_fp")


# Similar texts rather than nearly equal fingerprints: longer fingerprints, met by parts of permuted rings.

#: Bits of a long fingerprint, by as many hashes of 64 bits as needed.
LONG = 256
#: Bits of a key at least.
LEAST_BITS = 20
#: Rows of one run that are compared with each other at a time.
RUN = 4096
#: Rows of a key of which all pairs are compared at once; of more, `apart_links` compares the pairs that no link joins. The links found are the same.
FEW = 8


def long_fingerprint(text: str | None, n: int = 5) -> bytes:
    """LONG bits, as bytes, of a text's lower-cased (A-Z) words in distinct shingles of n; zeros without words.

    A repeated shingle counts once, so that the differing bits follow the similarity of sets, which decides.
    """
    found = list(set(shingles(utf8(text).lower().split(), n)))
    if not found:
        return bytes(LONG // 8)
    set_bits = np.zeros(LONG, np.int64)
    for at in range(0, len(found), 1 << 13):
        part = found[at : at + (1 << 13)]
        h = np.frombuffer(b"".join(x for s in part for x in (xxhash.xxh3_128_digest(s, seed=SEED), xxhash.xxh3_128_digest(s, seed=SEED + 1))), np.uint8)
        set_bits += np.unpackbits(h).reshape(-1, LONG).sum(axis=0, dtype=np.int64)
    return np.packbits(set_bits * 2 > len(found)).tobytes()


def shingle_digest(text: str | None, n: int = 5) -> bytes:
    """128 bits that name a text's set of shingles of n: equal for equal sets alone, but for chance."""
    return xxhash.xxh3_128_digest(b"\n".join(sorted(set(shingles(utf8(text).lower().split(), n)))), seed=SEED)


def differing(similarity: float, deviations: float = 2.5) -> int:
    """Bits of LONG in which texts of that Jaccard similarity differ at most, but for one in 160.

    The angle between sets of similarity s has the cosine 2s / (1 + s); each bit differs with the angle over pi.
    """
    p = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return int(LONG * p + deviations * (LONG * p * (1 - p)) ** 0.5)


def rings(tables: int, bits: int) -> np.ndarray:
    """[tables, LONG]: for each table the order of the bits on its ring; a table's first `bits` are its key.

    Tables take turns on the segments of one permuted ring after another, each starting at its own segment.
    """
    per, out, generator = LONG // bits, [], np.random.default_rng(SEED)
    while len(out) < tables:
        ring = generator.permutation(LONG)
        out += [np.roll(ring, -bits * k) for k in range(per)]
    return np.array(out[:tables])


def _near(x: np.ndarray, ring: np.ndarray, bits: int, limit: int) -> np.ndarray:
    """Which of the fingerprints' differences (bytes [n, LONG / 8]) stay within the budgets of growing chains of segments."""
    left = np.arange(len(x))
    for chain in (LONG // 4, LONG // 2, LONG):
        mask = np.zeros(LONG, np.uint8)
        mask[ring[:chain]] = 1
        # a chain's budget is its share of the limit, with what chance adds to it but once in a thousand
        share = limit * chain / LONG
        most = limit if chain == LONG else share + 3 * (share * (1 - chain / LONG)) ** 0.5
        counts = np.bitwise_count((x[left] & np.packbits(mask)).view(np.uint64)).sum(axis=1, dtype=np.int64)
        left = left[counts <= most]
        if not len(left):
            break
    return left


def _key_rows(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """table, key, node and fp: each node at each of its keys."""
    kind = nodes.schema["node"].dataType.simpleString()
    orders = rings(tables, bits)
    powers = (1 << np.arange(bits, dtype=np.int64))[::-1]
    fields = nodes.sparkSession.createDataFrame([], f"table int, key bigint, node {kind}, fp binary").schema
    arrow = _arrow_schema(fields)

    def keyed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                node, fp = part.column(0), part.column(1)
                every = np.unpackbits(np.frombuffer(b"".join(fp.to_pylist()), np.uint8).reshape(-1, LONG // 8), axis=1)
                for t in range(tables):
                    keys = every[:, orders[t, :bits]].astype(np.int64) @ powers
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), t, np.int32)), pa.array(keys), node, fp], schema=arrow)

    return mapped(nodes.select("node", "fp"), keyed, fields)


def similar_links(nodes: DataFrame, similarity: float, bits: int, tables: int) -> DataFrame:
    """Candidate edges a, b between nodes (node, fp: long fingerprints) that look similar; those of keys of many also have their table and key.

    Two fingerprints meet where one of `tables` keys of `bits` is equal. Rows of a key are sorted next to each other. Of
    a few rows all pairs are compared, side by side for all keys of a batch; more rows are compared in their task, RUN at a
    time, and give a spanning forest of those that look similar. Of earlier rows only those that nothing linked stay, so
    that a task's memory is bounded by the texts of a key that are not alike; such a key of several runs is a row without a and b.
    A forest whose edges all hold joins all that its key can; the others are up to `family_links`, and keys of several runs to `apart_links` before.
    """
    kind = nodes.schema["node"].dataType.simpleString()
    limit, orders = differing(similarity), rings(tables, bits)
    edge_fields = nodes.sparkSession.createDataFrame([], f"a {kind}, b {kind}, table int, key bigint").schema
    edge_arrow = _arrow_schema(edge_fields)

    def edge_rows(a, b, tables, keys):
        few = len(a) - len(tables)
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip([a, b, [None] * few + tables, [None] * few + keys], edge_arrow)], schema=edge_arrow)

    def compare(batches):
        carried = None  # rows of the last key, few, whose others may follow
        large = None  # table and key, nodes and fingerprints of the rows of a key of many that nothing linked
        for batch in batches:
            if carried is not None:
                batch = pa.Table.from_batches([carried, batch]).combine_chunks().to_batches()[0]
                carried = None
            if batch.num_rows == 0:
                continue
            table, key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            fps = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, LONG // 8)
            cut = np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.append(0, cut), np.append(cut, batch.num_rows)
            size, run = ends - starts, np.repeat(np.arange(len(starts)), ends - starts)
            few = size <= FEW
            if large is not None:
                few[0] &= large[0] != (int(table[0]), int(key[0]))
            if few[-1]:
                carried = batch.slice(int(starts[-1]))
                few[-1] = False
            one, two = [], []
            for d in range(1, FEW):
                at = np.flatnonzero((run[d:] == run[:-d]) & few[run[d:]])
                apart = np.bitwise_count((fps[at] ^ fps[at + d]).view(np.uint64)).sum(axis=1, dtype=np.int64)
                at = at[apart <= limit]
                one.append(at)
                two.append(at + d)
            first, second = np.concatenate(one), np.concatenate(two)
            a, b = node.take(pa.array(first)).to_pylist(), node.take(pa.array(second)).to_pylist()
            of_table, of_key = [], []
            for i in np.flatnonzero(~few).tolist():
                if carried is not None and i == len(starts) - 1:
                    break
                here = (int(table[starts[i]]), int(key[starts[i]]))
                names, prints = (list(large[1]), large[2]) if large is not None and large[0] == here else ([], np.zeros((0, LONG // 8), np.uint8))
                for at in range(int(starts[i]), int(ends[i]), RUN):
                    stop = min(int(ends[i]), at + RUN)
                    if names:  # rows that an earlier run's forest holds aren't compared with this one
                        a.append(None)
                        b.append(None)
                        of_table.append(here[0])
                        of_key.append(here[1])
                    names += node.slice(at, stop - at).to_pylist()
                    prints = np.concatenate([prints, fps[at:stop]])
                    found, roots = _forest(prints, orders[here[0]], bits, limit)
                    a += [names[x] for x, _ in found]
                    b += [names[y] for _, y in found]
                    of_table += [here[0]] * len(found)
                    of_key += [here[1]] * len(found)
                    names, prints = [names[x] for x in roots], prints[roots]
                large = (here, names, prints)
            yield edge_rows(a, b, of_table, of_key)
        if carried is not None and carried.num_rows > 1:
            names = carried.column(2).to_pylist()
            prints = np.frombuffer(b"".join(carried.column(3).to_pylist()), np.uint8).reshape(-1, LONG // 8)
            apart = np.bitwise_count((prints[:, None] ^ prints[None]).view(np.uint64)).sum(axis=2, dtype=np.int64)
            found = np.argwhere(np.triu(apart <= limit, 1)).tolist()
            yield edge_rows([names[x] for x, _ in found], [names[y] for _, y in found], [], [])

    dealt = _key_rows(nodes, bits, tables).repartition("table", "key").sortWithinPartitions("table", "key", "node")
    return mapped(dealt, compare, edge_fields).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "table", "key").distinct()


def apart_links(keys: DataFrame, nodes: DataFrame, roots: DataFrame, similarity: float, bits: int, tables: int) -> DataFrame:
    """Every pair a, b of rows of one of the keys (table, key) that looks similar and isn't linked by `roots` yet, in no certain order.

    For keys of several runs, whose forests don't compare all rows; pairs within one group need no other link.
    A pair is given by the first key that it shares. A key's rows are dealt into blocks of
    some RUN rows and each pair of blocks is a tile of its own, so that a task holds two blocks however many rows a key has.
    """
    kind = nodes.schema["node"].dataType.simpleString()
    limit = differing(similarity)
    masks = _key_masks(bits, tables)
    edge_fields = nodes.sparkSession.createDataFrame([], f"a {kind}, b {kind}").schema
    edge_arrow = _arrow_schema(edge_fields)
    named = nodes.join(roots.select(F.col("node").alias("_node"), "root"), F.col("node") == F.col("_node"), "left").select(
        F.col("node").alias("_node"), "fp", F.coalesce("root", "node").alias("root")
    )
    rows = stored(_key_rows(nodes, bits, tables).select("table", "key", "node").join(keys, ["table", "key"]).join(named, F.col("node") == F.col("_node")).select("table", "key", "node", "fp", "root"))
    counted = rows.groupBy("table", "key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("n")).filter("least != most")
    several = counted.select("table", "key", F.ceil(F.col("n") / RUN).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node", "table"), F.col("blocks")).cast("int")
    tile = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j"))))
    tiled = rows.join(several, ["table", "key"]).withColumn("block", own).withColumn("tile", tile).select("table", "key", "tile.i", "tile.j", "block", "node", "fp", "root")
    dealt = tiled.repartition("table", "key", "i", "j").sortWithinPartitions("table", "key", "i", "j", "block", "node")

    def pairs(batches):
        node, root, block = (pa.chunked_array([b.column(i) for b in batches]).combine_chunks() for i in (5, 7, 4))
        prints = np.concatenate([np.frombuffer(b"".join(b.column(6).to_pylist()), np.uint64).reshape(-1, LONG // 64) for b in batches])
        table, same = int(batches[0].column(0)[0].as_py()), batches[0].column(2)[0] == batches[0].column(3)[0]
        group, block = root.dictionary_encode().indices.to_numpy(), block.to_numpy()
        second = 0 if same else int(np.searchsorted(block, block[-1]))
        for i in range(0, len(prints) if same else second, 256):
            stop = i + 256 if same else min(i + 256, second)
            for j in range(i if same else second, len(prints), RUN):
                counts = np.bitwise_count(prints[i:stop, None] ^ prints[None, j : j + RUN]).sum(axis=2, dtype=np.int64)
                x, y = np.nonzero((counts <= limit) & (group[i:stop, None] != group[None, j : j + RUN]))
                x, y = x[x + i < y + j] + i, y[x + i < y + j] + j
                differ = prints[x] ^ prints[y]
                for t in range(table):
                    other = ((differ & masks[t]) != 0).any(axis=1)
                    x, y, differ = x[other], y[other], differ[other]
                if len(x):
                    yield pa.RecordBatch.from_arrays([node.take(pa.array(x)), node.take(pa.array(y))], schema=edge_arrow)

    def compare(batches):
        held, here = [], None  # the rows of one tile
        for batch in batches:
            if batch.num_rows == 0:
                continue
            marks = np.stack([batch.column(c).to_numpy() for c in range(4)])
            cut = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if here != marks[:, start].tolist():
                    if held and (held[0].column(2)[0] == held[0].column(3)[0] or held[0].column(4)[0] != held[-1].column(4)[-1]):
                        yield from pairs(held)
                    held, here = [], marks[:, start].tolist()
                held.append(batch.slice(start, end - start))
        if held and (held[0].column(2)[0] == held[0].column(3)[0] or held[0].column(4)[0] != held[-1].column(4)[-1]):
            yield from pairs(held)

    return mapped(dealt, compare, edge_fields).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _forest(prints: np.ndarray, ring: np.ndarray, bits: int, limit: int) -> tuple[list[tuple[int, int]], list[int]]:
    """A spanning forest of the similar fingerprints, of least differences, and its roots.

    Each tree grows by the fingerprint that is nearest to it, so that its edges hold wherever nearer ones do.
    """
    out, roots = [], []
    wide = np.ascontiguousarray(prints).view(np.uint64)
    left = np.arange(len(prints))
    best, parent = np.full(len(prints), LONG + 1), np.full(len(prints), -1)
    while len(left):
        k = int(best[left].argmin())
        at = int(left[k])
        if best[at] > limit:
            roots.append(at)
        else:
            out.append((int(parent[at]), at))
        left = np.delete(left, k)
        near = left[_near(prints[left] ^ prints[at], ring, bits, limit)] if len(left) else left
        apart = np.bitwise_count(wide[near] ^ wide[at]).sum(axis=1, dtype=np.int64)
        nearer = apart < best[near]
        best[near[nearer]], parent[near[nearer]] = apart[nearer], at
    return out, roots


def _sets(met: DataFrame, nodes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """node and shingles, the sorted hashes of 32 bits of its text's set of n-word shingles, for the nodes of the one-column table `met`."""
    kind = nodes.schema["node"].dataType.simpleString()
    ids = nodes.join(met.toDF("_node").distinct(), F.col("node") == F.col("_node"), "left_semi").select("node", F.col("least.doc_id").alias("_id"), F.col("least.mark").alias("_mark"))

    def make():
        def shingled(text):
            return np.unique(np.fromiter((xxhash.xxh32_intdigest(x) for x in shingles(utf8(text).lower().split(), n)), np.uint32)).tobytes()

        return lambda keys, texts: {"node": keys, "shingles": [shingled(t) for t in texts]}

    chosen = docs.withColumn("mark", F.xxhash64("text")).join(ids, (F.col("doc_id") == F.col("_id")) & (F.col("mark") == F.col("_mark")))
    return stored(on_arrow(chosen, [F.col("node"), F.col("text")], make, f"node {kind}, shingles binary").groupBy("node").agg(F.min("shingles").alias("shingles")))


def _enough(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both)


def similar_enough(edges: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, similarity: float) -> DataFrame:
    """The edges a, b of nodes whose texts' sets of n-word shingles have that Jaccard similarity or more.

    nodes names a row for each node by `least`, its doc_id and `mark`, a hash of its text; docs has doc_id and text. Sets are made for the
    texts of edges alone, as sorted hashes of 32 bits.
    """
    kind = edges.schema["a"].dataType.simpleString()
    sets = _sets(edges.select(F.explode(F.array("a", "b"))), nodes, docs, n)
    one, two = (sets.select(F.col("node").alias(f"_{c}"), F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = edges.join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b"))

    def check():
        enough = lambda x, y: _enough(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), similarity)
        return lambda a, b, x, y: {"a": a, "b": b, "same": list(map(enough, x, y))}

    return on_arrow(both, [F.col(c) for c in ("a", "b", "sa", "sb")], check, f"a {kind}, b {kind}, same boolean").filter("same").select("a", "b")


#: Bytes of shingle sets that one block of a family holds, about.
SETS = 32 << 20


def _key_masks(bits: int, tables: int) -> np.ndarray:
    """[tables, LONG / 64]: the bits of each table's key."""
    masks = np.zeros((tables, LONG), np.uint8)
    for t, order in enumerate(rings(tables, bits)):
        masks[t, order[:bits]] = 1
    return np.packbits(masks, axis=1).view(np.uint64)


def family_links(families: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, similarity: float, bits: int, tables: int) -> DataFrame:
    """Links a, b that hold, of families (node, family, root): enough of them to join all rows of a family that share a key, look similar and are.

    All pairs of a family in different groups (`root`) that share a key and look similar are compared by their sets, unless links found
    before in the same task join them. So each row of the result is a link and joins two groups, however many pairs fail. A family is dealt into
    blocks of some RUN rows and SETS bytes, and each pair of blocks is a task's tile.
    """
    kind, limit, masks = nodes.schema["node"].dataType.simpleString(), differing(similarity), _key_masks(bits, tables)
    edge_fields = nodes.sparkSession.createDataFrame([], f"a {kind}, b {kind}").schema
    edge_arrow = _arrow_schema(edge_fields)
    sets = _sets(families.select("node"), nodes, docs, n)
    rows = stored(families.join(nodes.select("node", "fp"), "node").join(sets, "node").select("family", "node", "root", "fp", "shingles"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / RUN, F.sum(F.octet_length("shingles")) / SETS)).cast("int").alias("blocks")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    tile = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j"))))
    dealt = rows.join(rows.groupBy("family").agg(blocks), "family").withColumn("block", block).withColumn("tile", tile).select("family", "tile.i", "tile.j", "block", "node", "root", "fp", "shingles")
    ordered = dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "block", "node")

    def links(batches):
        same = batches[0].column(1)[0] == batches[0].column(2)[0]
        block, node, root = (pa.chunked_array([b.column(c) for b in batches]).combine_chunks() for c in (3, 4, 5))
        prints = np.concatenate([np.frombuffer(b"".join(b.column(6).to_pylist()), np.uint64).reshape(-1, LONG // 64) for b in batches])
        shingled = [np.frombuffer(x, np.uint32) for b in batches for x in b.column(7).to_pylist()]
        names, block = node.to_pylist(), block.to_numpy()
        second = 0 if same else int(np.searchsorted(block, block[-1]))
        if not same and second == 0:
            return  # rows of one block alone
        group = root.dictionary_encode().indices.to_numpy().astype(np.int64)
        found = []
        for x in range(len(names) if same else second):
            first = max(x + 1, second)
            apart = np.bitwise_count(prints[first:] ^ prints[x]).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero((apart <= limit) & (group[first:] != group[x]))
            differ = prints[first:][near] ^ prints[x]
            near = near[((differ[:, None] & masks[None]) == 0).all(axis=2).any(axis=1)]
            for y in (near[np.argsort(apart[near], kind="stable")] + first).tolist():
                if group[x] != group[y] and _enough(shingled[x], shingled[y], similarity):
                    found.append((x, y))
                    group[group == group[y]] = group[x]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in c], f.type) for c, f in zip(zip(*found), edge_arrow)], schema=edge_arrow)

    def compare(batches):
        held, here = [], None  # the rows of one tile
        for batch in batches:
            if batch.num_rows == 0:
                continue
            marks = np.stack([batch.column(c).to_numpy() for c in range(3)])
            cut = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
                if here != marks[:, start].tolist():
                    if held:
                        yield from links(held)
                    held, here = [], marks[:, start].tolist()
                held.append(batch.slice(start, end - start))
        if held:
            yield from links(held)

    return mapped(ordered, compare, edge_fields).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _similar(docs: DataFrame, n: int, similarity: float, found: float) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, mark, digest) of docs (doc_id, text) with ids, and for each digest (_digest) `kept`, the least doc_id and mark of its group."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        return lambda keys, marks, texts: {"doc_id": keys, "mark": marks, "digest": [shingle_digest(t, n) for t in texts], "fp": [long_fingerprint(t, n) for t in texts]}

    named = docs.filter(F.col("doc_id").isNotNull())
    held = stored(on_arrow(named, [F.col("doc_id"), F.xxhash64("text"), F.col("text")], make, f"doc_id {kind}, mark bigint, digest binary, fp binary"))
    # numbers of rows, fixed by being written, name the nodes: one id may have several texts
    nodes = stored(held.groupBy("digest").agg(F.min(F.struct("doc_id", "mark")).alias("least"), F.min("fp").alias("fp")).withColumn("node", F.monotonically_increasing_id()))
    bits = max(LEAST_BITS, nodes.count().bit_length() + 2)
    p = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    tables = int(np.ceil(np.log(1 - found) / np.log1p(-((1 - p) ** bits))))
    candidates = stored(similar_links(nodes, similarity, bits, tables))
    pairs = candidates.filter("a is not null").select("a", "b")
    # forests of all tables' keys hold many edges a node, of which few are needed to know who is joined
    edges = stored(similar_enough(pairs.distinct(), nodes, docs, n, similarity))
    roots = components(thinned(edges))
    # keys of several runs: rows that a run's forest held weren't compared with later runs
    keys = stored(candidates.filter("a is null").select("table", "key").distinct())
    forests = candidates.filter("table is not null and a is not null").select("a", "b")
    if not keys.isEmpty():
        apart = stored(apart_links(keys, nodes, roots, similarity, bits, tables))
        pairs, forests = pairs.unionByName(apart), forests.unionByName(apart)
    # a family is what candidates join, whether they hold or not; one with a forest's failed edge between two groups is compared in whole
    at = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    ends = forests.join(at("a"), "a", "left").join(at("b"), "b", "left").filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b"))
    lost = stored(ends.select("a").distinct())
    if not lost.isEmpty():
        families = components(thinned(pairs)).withColumnRenamed("root", "family")
        broken = lost.join(families, F.col("a") == F.col("node")).select("family").distinct()
        own = families.join(broken, "family", "left_semi").join(roots, "node", "left").select("node", "family", F.coalesce("root", "node").alias("root"))
        more = stored(family_links(own, nodes, docs, n, similarity, bits, tables))
        if not more.isEmpty():
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    rooted = checkpointed(nodes.select("digest", "least", "node").join(roots, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("kept"))
    return held.select("doc_id", "mark", "digest"), rooted.join(least, "root").select(F.col("digest").alias("_digest"), "kept")


def similar_groups(df: DataFrame, n: int = 5, similarity: float = 0.8, found: float = 0.91, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and component_id, the least doc_id of the row's group of similar texts, for each row.

    Similarity is that of the sets of n-word shingles; long fingerprints find candidates and the sets decide: a pair that shares a key
    and looks similar is checked unless other checked links already join it, however many rows the key has. Keys have LEAST_BITS, or
    two bits more than the number of distinct texts has digits, so that texts that aren't alike seldom meet whatever the size; there are as many tables as
    find a pair of exactly that similarity with probability `found` (one of 0.9 similarity then with over 0.999).
    Texts with equal sets of shingles are one node and always one group; different sets with equal fingerprints are candidates like any
    others. Rows with equal ids and different texts are nodes of their own. Rows without id have component_id null.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    held, whole = _similar(docs, n, similarity, found)
    rows = held.join(whole, F.col("digest") == F.col("_digest")).select("doc_id", F.col("kept.doc_id").alias("component_id"))
    return rows.unionByName(docs.filter(F.col("doc_id").isNull()).select("doc_id", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, n: int = 5, similarity: float = 0.8, found: float = 0.91) -> DataFrame:
    """The rows of docs, with their columns, that have the least id of their group of similar texts.

    Rows go by id and text: of rows with one id and different texts each stays or goes by its own group. Rows without id stay; of
    repeated rows (equal id and text) one stays.
    """
    held, whole = _similar(docs.select("doc_id", "text"), n, similarity, found)
    met = stored(held.join(whole, F.col("digest") == F.col("_digest")).select("doc_id", "mark", "kept"))
    gone = met.filter((F.col("doc_id") != F.col("kept.doc_id")) | (F.col("mark") != F.col("kept.mark"))).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct()
    left = docs.join(gone, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__mark")), "left_anti")
    twice = met.groupBy("doc_id", "mark").count().filter("count > 1")
    if twice.isEmpty():
        return left
    return left.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"]).unionByName(left.filter(F.col("doc_id").isNull()))
