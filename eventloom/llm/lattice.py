"""Language-model scores by a subword lattice over an existing vocabulary.

A word's probability is the sum over all of its segmentations, by a forward recursion in log space. The pieces are those
of an existing vocabulary; its scores, ranks of a merge list, give the first weights by Zipf's law, and one pass of expected
counts over the corpus's words gives the final ones. A word seen in training is also a piece of its own: it keeps its
count less a discount, and what the discounts free goes to the lattice, so that all words' probabilities sum to one at most.

Weights differ by class of text. Classes are found without labels: a mixture fitted on a bounded sample is only their start, and passes over
all training texts count them, as they do all words by class. A text's probability is the sum over classes of the class's share times the text's probability
in it, in which words that the text has used become likelier, as in an urn that gets each drawn word back twice.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, _arrow_schema, stored, utf8
from .classes import BINS, Classes, fit
from .language_id import remainder

#: The vocabulary's mark for the start of a word.
MARK = "▁"
#: Share of the weight of pieces inside words that goes to single bytes of characters outside the vocabulary.
BYTES = 1e-4
#: Bytes of text that share one table of words.
BLOCK = 24 << 20
#: Words whose lattices are built side by side.
WORDS = 8192
#: Words of texts that are scored side by side, but for longer texts.
SIDE = 16384
#: Share of what discounts free that goes to the lattice; the rest goes by counts over all classes.
TO_LATTICE = 0.9
#: Words that the urn of a text holds to begin with.
URN = 3000.0
BASE = np.uint64(0x100000001B3)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 20


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: pieces that start words (MARK and the rest) and pieces inside words, with logs of weights by class."""

    texts: tuple[str, ...]
    starts: np.ndarray
    logs: np.ndarray  # [pieces, classes]
    stop: np.ndarray  # [classes], probability that a word ends after a piece

    def fitted(self, expected: np.ndarray, words: np.ndarray) -> Pieces:
        """Weights of each class in proportion to its expected counts; the weights before count as one more piece of each kind."""
        weights, logs = np.exp(self.logs), self.logs.copy()
        for kind, total in ((self.starts, 1.0), (~self.starts, 1.0 - BYTES)):
            added = expected[kind] + weights[kind] / weights[kind].sum(axis=0)
            logs[kind] = np.log(total * added / added.sum(axis=0))
        pieces = expected.sum(axis=0)
        stop = np.where(pieces > 0, np.clip(words / np.maximum(pieces, 1e-9), 0.01, 0.99), self.stop)
        return Pieces(self.texts, self.starts, logs, stop)


def vocabulary(pieces: list[tuple[str, float]], classes: int = 1, offset: float = 10.0) -> Pieces:
    """Pieces (text, score) of a vocabulary; a score is minus a rank, and a piece weighs as 1 / (rank + offset).

    Special, byte and unused pieces, those with the word mark inside and those with capitals A to Z, which no lower-cased
    word holds, are left out. The mark alone always starts words. All classes begin alike.
    """
    kept = {MARK: 0.0}
    for text, score in pieces:
        if text and MARK not in text[1:] and not (text[0] == "<" and text[-1] == ">" and len(text) > 1) and not any("A" <= c <= "Z" for c in text):
            kept[text] = score
    texts = tuple(kept)
    starts = np.array([t.startswith(MARK) for t in texts])
    weights = 1 / (np.maximum(-np.array(list(kept.values())), 0) + offset)
    logs = np.log(weights)
    logs[starts] -= math.log(weights[starts].sum())
    logs[~starts] += math.log(1 - BYTES) - math.log(weights[~starts].sum())
    return Pieces(texts, starts, np.repeat(logs[:, None], classes, axis=1), np.full(classes, 0.25))


def _hashed(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


class Lattice:
    """Log probabilities of words under the pieces of a vocabulary."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.whole = pieces
        self.longest = max(len(t) for t in pieces.texts)
        # two open tables; the second, by another multiplier, holds what finds its place taken in the first
        self.keys = np.zeros((2, 1 << TABLE_BITS), np.uint64)
        self.ids = np.full((2, 1 << TABLE_BITS), len(pieces.texts), np.int32)
        self.spread = [SPREAD, np.uint64(0xC2B2AE3D27D4EB4F)]
        for i, t in enumerate(pieces.texts):
            h = np.uint64(_hashed(t))
            for k in range(2):
                at = self._slots(np.array([h]), k)[0]
                if self.ids[k, at] == len(pieces.texts):
                    self.keys[k, at], self.ids[k, at] = h, i
                    break
            else:
                raise ValueError("the vocabulary is too large for its tables")

    def in_class(self, k: int | None) -> Lattice:
        """Confines what follows to one class, or to none again."""
        every = self.whole
        self.pieces = every if k is None else Pieces(every.texts, every.starts, every.logs[:, [k]], every.stop[[k]])
        return self

    def _slots(self, h: np.ndarray, k: int) -> np.ndarray:
        return ((h * self.spread[k]) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _found(self, h: np.ndarray) -> np.ndarray:
        none = len(self.pieces.texts)
        at = self._slots(h, 0)
        out = self.ids[0, at]
        # few places of the first table are taken; only what finds another's there can be in the second
        other = np.flatnonzero(out < none)
        other = other[self.keys[0, at[other]] != h[other]]
        if len(other):
            at = self._slots(h[other], 1)
            out[other] = np.where(self.keys[1, at] == h[other], self.ids[1, at], none)
        return out

    def _group(self, codes: np.ndarray, expected: np.ndarray | None, weight: np.ndarray | None) -> np.ndarray:
        """codes: [words, length] code points, the mark first. Adds weighted expected counts of pieces to `expected`."""
        n, length = codes.shape
        pieces, none = self.pieces, len(self.pieces.texts)
        prefix, powers = np.zeros((length + 1, n), np.uint64), [np.uint64(1)]
        for j in range(length):
            prefix[j + 1] = prefix[j] * BASE + codes[:, j] + np.uint64(1)
            powers.append(np.uint64(int(powers[-1]) * int(BASE) & 0xFFFFFFFFFFFFFFFF))
        on, off = np.log1p(-pieces.stop), np.log(pieces.stop)
        alpha = np.full((length + 1, n, len(on)), -np.inf)
        alpha[0] = 0
        arcs = []
        width = np.ones(codes.shape, np.int64) + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        spelled = math.log(BYTES / 256)
        for j in range(1, length + 1):
            for i in range(max(0, j - self.longest), j):
                ids = self._found(prefix[j] - prefix[i] * powers[j - i])
                rows = np.flatnonzero(ids < none)
                # a piece with the mark starts a word and no other does
                rows = rows[pieces.starts[ids[rows]] == (i == 0)]
                value = pieces.logs[ids[rows]] + (on if i else 0.0)
                if j - i == 1 and i and len(rows) < n:
                    has = np.zeros(n, bool)
                    has[rows] = True
                    bare = np.flatnonzero(~has)
                    rows = np.concatenate([rows, bare])
                    value = np.concatenate([value, on * width[bare, i][:, None] + (spelled * width[bare, i])[:, None]])
                    ids[bare] = none
                if len(rows):
                    alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + value)
                    if expected is not None:
                        arcs.append((i, j, rows, ids[rows], value))
        total = alpha[length] + off
        if expected is not None:
            beta = np.full(alpha.shape, -np.inf)
            beta[length] = off
            for i, j, rows, ids, value in reversed(arcs):
                through = value + beta[j, rows]
                beta[i, rows] = np.logaddexp(beta[i, rows], through)
                share = np.exp(alpha[i, rows] + through - total[rows]) * weight[rows]
                known = ids < none
                for k in range(len(on)):
                    expected[:, k] += np.bincount(ids[known], weights=share[known, k], minlength=none)
        return total

    def logs_of(self, words: list[str], weight: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """The natural log of each word's probability by class. With `expected`, adds expected counts of pieces, times weight, to it."""
        out = np.empty((len(words), len(self.pieces.stop)))
        by: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by.setdefault(len(w), []).append(k)
        for length, which in by.items():
            step = max(1, min(WORDS, (WORDS * 24) // (length + 1)))
            for at in range(0, len(which), step):
                part = which[at : at + step]
                text = "".join(MARK + words[k] for k in part)
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), length + 1).astype(np.uint64)
                out[part] = self._group(codes, expected, None if weight is None else weight[part])
        return out


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Texts and scores of a vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A to Z) words between ASCII white space."""
    return utf8(text).lower().split()


def _block_words(dealt: DataFrame, classes: Classes) -> DataFrame:
    """word, blocks (those whose texts hold it) and counts (32-bit numbers: how often training texts of each class do).

    A row of class -1 - k and without word stands for each class: its counts are the class's training texts.
    """
    spark = dealt.sparkSession
    fields = spark.createDataFrame([], "block int, word binary, class int, n bigint").schema
    arrow = _arrow_schema(fields)
    shared = spark.sparkContext.broadcast(classes)

    def count(batches):
        # one partition is one block; its words are bounded by its bytes
        found = shared.value
        counts = [Counter() for _ in found.prior]
        texts_of = Counter()
        held: set[bytes] = set()
        block = None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                b, texts, out = [c.to_pylist() for c in batch.slice(at, SLICE).columns]
                block = b[0]
                for t, o in zip(texts, out):
                    if o:
                        held.update(words_of(t))
                    else:
                        k = found.of(t)
                        texts_of[k] += 1
                        counts[k].update(words_of(t))
        if block is None:
            return
        for c in counts:
            held.difference_update(c)
        for k, (words, numbers) in enumerate([*((list(c), list(c.values())) for c in counts), (list(held), [0] * len(held))]):
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block, np.int32)), pa.array(part, pa.binary()), pa.array(np.full(len(part), k % len(counts), np.int32)), pa.array(numbers[at : at + 50_000], pa.int64())], schema=arrow)
        rows = [(block, b"", -1 - k, n) for k, n in texts_of.items()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow)] if rows else [pa.array([], f.type) for f in arrow], schema=arrow)

    rows = dealt.select("block", "text", "held_out").mapInArrow(count, fields)
    by_word = rows.repartition("word").sortWithinPartitions("word", "block")
    out_fields = spark.createDataFrame([], "word binary, blocks array<int>, counts binary").schema
    out_arrow = _arrow_schema(out_fields)
    number = len(classes.prior)

    def merged(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        word, block, kind, n = batch.columns
        row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, batch.num_rows)))
        kind, blocks = kind.to_numpy(), block.to_numpy()
        sums = np.bincount(row * number + np.where(kind < 0, -1 - kind, kind), weights=n.to_numpy(), minlength=len(starts) * number)
        once = np.append(True, (row[1:] != row[:-1]) | (blocks[1:] != blocks[:-1]))
        ends = np.append(0, np.cumsum(np.bincount(row[once], minlength=len(starts))))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(blocks[once]))
        packed = sums.astype("<u8").reshape(-1, number)
        return pa.RecordBatch.from_arrays([word.take(pa.array(starts)), lists.cast(out_arrow.field("blocks").type), pa.array([r.tobytes() for r in packed], pa.binary())], schema=out_arrow)

    def merge(batches):
        # rows of a word follow each other; those of the last word of a batch are added up until another word comes
        word, blocks, counts = None, [], np.zeros(number)

        def added(part: pa.RecordBatch) -> None:
            block, kind = part.column(1).to_numpy(), part.column(2).to_numpy()
            own = block[np.append(True, block[1:] != block[:-1])]
            blocks.append(own[1:] if blocks and len(blocks[-1]) and own[0] == blocks[-1][-1] else own)
            if not len(blocks[-1]):
                blocks.pop()
            counts[:] += np.bincount(np.where(kind < 0, -1 - kind, kind), weights=part.column(3).to_numpy(), minlength=number)

        def whole() -> pa.RecordBatch:
            packed = counts.astype("<u8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([word], pa.binary()), pa.array([np.concatenate(blocks)], out_arrow.field("blocks").type), pa.array([packed], pa.binary())], schema=out_arrow)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = batch.column(0)
            new = np.append(True, pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False).astype(bool))
            starts = np.flatnonzero(new)
            begin = 0
            if word is not None:
                if names[0].as_py() == word:
                    begin = int(starts[1]) if len(starts) > 1 else batch.num_rows
                    added(batch.slice(0, begin))
                    starts = starts[1:]
                    if not len(starts):
                        continue
                yield whole()
            last = int(starts[-1])
            if last > begin:
                yield merged(batch.slice(begin, last - begin), starts[:-1] - begin)
            word = names[last].as_py()
            blocks.clear()
            counts[:] = 0
            added(batch.slice(last))
        if word is not None:
            yield whole()

    return by_word.select("word", "block", "class", "n").mapInArrow(merge, out_fields)


def _gathered(batches, rows: int = 1 << 16):
    """Tables of `rows` rows or more, but for the last: lattices are the faster the more words of a length there are."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _text(words: list[bytes]) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in words]


def _counts(packed: list[bytes], number: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<u8").reshape(-1, number).astype(float)


def _expected(words: DataFrame, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, dict]:
    """Expected counts of the pieces and the number of words by class, each training word of a class counted once; and
    by class the sum of counts and the words that occur, and that do once and twice, besides the words of all."""
    number = len(pieces.stop)
    shared = words.sparkSession.sparkContext.broadcast(pieces)
    fields = words.sparkSession.createDataFrame([], "piece int, class int, value double").schema
    arrow = _arrow_schema(fields)
    names = ("tokens", "kinds", "once", "twice")

    def expect(batches):
        lattice, expected = Lattice(shared.value), np.zeros((len(shared.value.texts), number))
        facts = np.zeros((len(names), number + 1))
        for batch in _gathered(batches):
            own, counts = _text(batch.column(0).to_pylist()), _counts(batch.column(1).to_pylist(), number)
            wide = np.column_stack([counts, counts.sum(axis=1)])
            facts += np.stack([wide.sum(axis=0), (wide > 0).sum(axis=0), (wide == 1).sum(axis=0), (wide == 2).sum(axis=0)])
            for k in range(number):
                which = np.flatnonzero(counts[:, k])
                if len(which):
                    part = expected[:, [k]]
                    lattice.in_class(k).logs_of([own[i] for i in which], np.ones((len(which), 1)), part)
                    expected[:, [k]] = part
        piece, kind = np.nonzero(expected)
        at = np.indices(facts.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(piece, -1 - at[0]).astype(np.int32)), pa.array(np.append(kind, at[1]).astype(np.int32)), pa.array(np.append(expected[piece, kind], facts.ravel()))], schema=arrow
        )

    sums = words.filter(F.length("word") > 0).select("word", "counts").mapInArrow(expect, fields).groupBy("piece", "class").agg(F.sum("value").alias("value")).collect()
    expected, facts = np.zeros((len(pieces.texts), number)), np.zeros((len(names), number + 1))
    for r in sums:  # a row for each piece and class at most
        (facts if r["piece"] < 0 else expected)[-1 - r["piece"] if r["piece"] < 0 else r["piece"], r["class"]] = r["value"]
    return expected, facts[1, :-1], dict(zip(names, facts))


@dataclass(frozen=True)
class Model:
    """What is common to all words: by class the shares of texts, the ends, the discounts and what they free."""

    prior: np.ndarray
    end: np.ndarray
    tokens: np.ndarray
    discount: np.ndarray
    free: np.ndarray
    all_words: float

    def values(self, counts: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """Log probabilities of words by class."""
        with np.errstate(divide="ignore"):
            own = np.maximum(counts - self.discount, 0) / self.tokens
            shared = self.free * (1 - TO_LATTICE) * counts.sum(axis=1, keepdims=True) / max(self.all_words, 1)
            return np.logaddexp(np.log(own + shared), np.log(self.free * TO_LATTICE) + lattice)

    def text(self, ids: np.ndarray, values: np.ndarray) -> float:
        """The log10 probability of a text of words `ids`, with the end after them, over all classes."""
        return float(self.texts(ids, np.array([len(ids)]), values)[0])

    def texts(self, ids: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
        """`text` of several texts side by side: ids has their words one after another, sizes how many each has."""
        total = self.prior + np.log(self.end) + sizes[:, None] * np.log1p(-self.end)
        if len(ids):
            # the words of a text sorted; each is drawn as often as it has stood before
            place = np.sort(np.repeat(np.arange(len(sizes)), sizes) * len(values) + ids)
            new = np.append(True, place[1:] != place[:-1])
            first = np.flatnonzero(new)
            drawn = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            of, word = np.divmod(place, len(values))
            logs = values[word].astype(float)
            again = np.flatnonzero(~new)
            logs[first] += math.log(URN)
            logs[again] = np.log(URN * np.exp(logs[again]) + drawn[again, None])
            logs -= np.log(URN + np.arange(sizes.max()))[np.arange(len(ids)) - (np.cumsum(sizes) - sizes)[of], None]
            some = np.flatnonzero(sizes)
            total[some] += np.add.reduceat(logs, (np.cumsum(sizes) - sizes)[some], axis=0)
        return np.logaddexp.reduce(total, axis=1) / math.log(10)


def refined(texts: DataFrame, classes: Classes, rounds: int) -> Classes:
    """Classes counted anew, `rounds` times, over all rows of the one-column table `texts`, each in the class that it is likeliest in. Counts are whole numbers, so reruns agree."""
    spark = texts.sparkSession
    fields = spark.createDataFrame([], "bin int, class int, value bigint").schema
    arrow = _arrow_schema(fields)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(classes)

        def count(batches, shared=shared):
            found = shared.value
            sums = np.zeros((BINS + 1, len(found.prior)))
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    found.add(batch.column(0).slice(at, SLICE).to_pylist(), sums)
            place, kind = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(kind.astype(np.int32)), pa.array(sums[place, kind].astype(np.int64))], schema=arrow)

        sums = np.zeros((BINS + 1, len(classes.prior)))
        for r in texts.mapInArrow(count, fields).groupBy("bin", "class").agg(F.sum("value").alias("value")).collect():  # a row for each bin and class at most
            sums[r["bin"], r["class"]] = r["value"]
        classes = Classes.counted(sums)
    return classes


def score(df: DataFrame, vocabulary_path: str, folds: int = 7, held_fold: int = 2, classes: int = 6, sample: int = 1000, rounds: int = 2, block: int = BLOCK, passes: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of each whole text.

    The rows outside the held fold teach. Null texts are empty: the end alone. Null ids count as the empty text for the
    fold. Repeated rows count as often as they are there. Without training rows no token is known and the lattice has
    the first weights. An empty table gives none. Other columns aren't read. `classes` classes start from a fit on `sample` training texts, those with
    the least hashes, and are then counted in `passes` passes over all of them, as all other counts are. Pieces are weighed in `rounds` passes, one or more.

    Texts are dealt into blocks by a hash; the words of a block are gathered in one task and counted by word over all
    blocks. Each distinct word's lattice is built once, and its values go back to the blocks that hold the word. What a
    task holds is bounded by a block, whose number follows the input; the driver gets sums and one number a piece and class.
    """
    spark = df.sparkSession
    rows = df.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), (remainder("doc_id", folds) == held_fold).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(8, -(-size // block))
    mixed = F.xxhash64(F.col("doc_id").cast("string"), F.lit("class sample"))
    least = df.filter(remainder("doc_id", folds) != held_fold).select("doc_id").orderBy(mixed, "doc_id").limit(sample)
    chosen = df.select("doc_id", "text").join(F.broadcast(least.distinct()), "doc_id", "left_semi").orderBy(mixed, "text").limit(sample)
    found = fit([r["text"] for r in chosen.collect()], classes)
    found = refined(rows.filter(~F.col("held_out")).select("text"), found, passes)
    number = len(found.prior)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(blocks)).cast("int"))
    words = stored(_block_words(dealt.repartitionById(blocks, F.col("block")), found))
    ends = words.filter(F.length("word") == 0).select("counts").collect()  # one row
    texts_of = _counts([r["counts"] for r in ends], number).sum(axis=0) if ends else np.zeros(number)
    pieces = vocabulary(read_pieces(vocabulary_path), number)
    for _ in range(rounds):
        expected, kinds_of, facts = _expected(words, pieces)
        pieces = pieces.fitted(expected, kinds_of)
    trained = int(texts_of.sum())
    kinds, tokens = int(facts["kinds"][-1]) + (trained > 0), int(facts["tokens"][-1]) + trained
    once, twice, own_tokens = facts["once"][:-1], facts["twice"][:-1], facts["tokens"][:-1]
    discount = np.clip(np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5), 0.1, 0.9)
    model = Model(
        np.log((texts_of + 0.5) / (trained + 0.5 * number)), (texts_of + 0.5) / (own_tokens + texts_of + 1), np.maximum(own_tokens, 1), discount,
        np.where(own_tokens > 0, np.clip(discount * facts["kinds"][:-1] / np.maximum(own_tokens, 1), 1e-6, 1), 1.0), float(facts["tokens"][-1]),
    )
    end_base = math.log10((trained + 1) / (tokens + kinds + 1))

    shared = spark.sparkContext.broadcast(pieces)
    valued_fields = spark.createDataFrame([], "blocks array<int>, data binary").schema
    valued_arrow = _arrow_schema(valued_fields)

    def value(batches):
        lattice = Lattice(shared.value)
        for batch in _gathered(batches):
            word = batch.column(0).to_pylist()
            logs = lattice.logs_of(_text(word)).astype("<f4")
            data = [c + x.tobytes() + w for c, x, w in zip(batch.column(1).to_pylist(), logs, word)]
            where = batch.column(2).combine_chunks().cast(valued_arrow.field("blocks").type)
            yield pa.RecordBatch.from_arrays([where, pa.array(data, pa.binary())], schema=valued_arrow)

    valued = words.filter(F.length("word") > 0).select("word", "counts", "blocks").mapInArrow(value, valued_fields)
    sent = valued.select(F.explode("blocks").alias("block"), F.lit(True).alias("is_word"), "data", F.lit(None).cast(df.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"))
    texts = dealt.select("block", F.lit(False).alias("is_word"), F.col("text").cast("binary").alias("data"), "doc_id", "held_out")
    both = sent.unionByName(texts).repartitionById(blocks, F.col("block")).sortWithinPartitions(F.desc("is_word"))
    kind = df.schema["doc_id"].dataType.simpleString()
    fields = spark.createDataFrame([], f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").schema
    arrow = _arrow_schema(fields)
    head = number * 12

    def finish(batches):
        of: dict[bytes, int] = {}
        heads, table = [], None
        for batch in batches:
            is_word = batch.column(0).to_numpy(zero_copy_only=False)
            first = int(is_word.sum())  # words come first
            if first:
                data = batch.column(1).slice(0, first).to_pylist()
                at = len(of)
                of.update(zip([d[head:] for d in data], range(at, at + first)))
                heads.append(b"".join([d[:head] for d in data]))
            if first == batch.num_rows:
                continue
            if table is None:
                values, totals, at = np.empty((len(of), number), np.float32), np.empty(len(of)), 0
                for joined in heads:
                    raw = np.frombuffer(joined, np.uint8).reshape(-1, head)
                    counts = np.ascontiguousarray(raw[:, : number * 8]).view("<u8").astype(float)
                    values[at : at + len(raw)] = model.values(counts, np.ascontiguousarray(raw[:, number * 8 :]).view("<f4").astype(float))
                    totals[at : at + len(raw)] = counts.sum(axis=1)
                    at += len(raw)
                table, heads = (np.log10((totals + 1) / (tokens + kinds + 1)), totals > 0, values), []
            base, known, values = table
            for cut in range(first, batch.num_rows, SLICE):
                part = batch.slice(cut, min(SLICE, batch.num_rows - cut))
                out, met = [], []
                data, key, held = (part.column(c).to_pylist() for c in (1, 2, 3))
                for text in data:
                    own = text.lower().split()
                    ids = np.fromiter(map(of.__getitem__, own), np.int64, len(own))
                    met.append(ids)
                    out.append((len(own) + 1, int(known[ids].sum()) + (trained > 0), tokens, float(base[ids].sum()) + end_base))
                scores, at = [], 0
                while at < len(met):  # some texts side by side, as many as have SIDE words
                    stop, words_in = at + 1, len(met[at])
                    while stop < len(met) and words_in + len(met[stop]) <= SIDE:
                        words_in += len(met[stop])
                        stop += 1
                    scores += model.texts(np.concatenate(met[at:stop]), np.array([len(x) for x in met[at:stop]]), values).tolist()
                    at = stop
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip([key, held, *zip(*out), scores], arrow)], schema=arrow)

    return both.select("is_word", "data", "doc_id", "held_out").mapInArrow(finish, fields)
