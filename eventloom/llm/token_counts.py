"""Token counts by a byte-level BPE, with a whole-token shortcut.

`prove` finds, once on the driver, the vocabulary strings that the library gives back as one token when they stand alone.
A text is cut into the library's pre-tokens; a pre-token that is such a string counts one without any merge, and only
the others go through the merges. Distinct segments are counted once for each slice of rows.
"""

from __future__ import annotations

from collections import Counter
import os
from pathlib import Path

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import on_arrow, per_worker, utf8

#: Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A segment starts at a space before something that isn't white space: the pattern never runs across such a place.
SEGMENT = regex.compile(r"(?=[ ]\S)", regex.V1)
SPACE = regex.compile(r"\s", regex.V1).match
#: Segments, and pre-tokens, whose counts a worker keeps.
KEPT = 300_000


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def prove(tokenizer: Tokenizer) -> frozenset[str]:
    """The vocabulary strings that are one pre-token and that the merges, applied to them alone, make one token."""
    bytes_of, pattern, added = byte_alphabet(), regex.compile(PATTERN), {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    texts = []
    for piece in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(bytes_of[c] for c in piece).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text not in added and pattern.fullmatch(text) and pattern.findall(text) == [text]:
            texts.append(text)
    return frozenset(t for t, e in zip(texts, tokenizer.encode_batch_fast(texts, add_special_tokens=False)) if len(e.ids) == 1)


class Counts:
    """Counts tokens of texts as the library gives them, without special tokens at the ends."""

    def __init__(self, tokenizer: Tokenizer, proven: frozenset[str]):
        self.tokenizer, self.proven = tokenizer, proven
        self.findall = regex.compile(PATTERN).findall
        self.added = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
        self.known: dict[str, int] = {}  # by what follows a space
        self.bare: dict[str, int] = {}  # by the segment itself
        self.merged: dict[str, int] = {}
        self.characters = {b: c for c, b in byte_alphabet().items()}

    def _merge(self, pieces: list[str]) -> None:
        if len(self.merged) > KEPT:
            self.merged.clear()
        merge, characters = self.tokenizer.model.tokenize, self.characters
        for p in set(pieces).difference(self.merged):
            # the library's merges take a pre-token in the vocabulary's characters for bytes
            self.merged[p] = len(merge(p.encode().decode("latin-1").translate(characters)))

    def _learn(self, segments: list[str], to: dict[str, int], lead: str = "") -> None:
        """Puts the count of lead + s under s, for each distinct segment s."""
        if len(to) > KEPT:
            to.clear()
        findall, proven = self.findall, self.proven
        split = [(s, findall(lead + s)) for s in segments]
        rest = [[p for p in pieces if p not in proven] for _, pieces in split]
        self._merge([p for r in rest for p in r])
        merged = self.merged
        for (s, pieces), r in zip(split, rest):
            to[s] = len(pieces) - len(r) + sum(map(merged.__getitem__, r))

    def of(self, texts: list[str | None]) -> list[int]:
        """A count for each text; null and empty texts have none. Texts that hold an added token go to the library whole."""
        return [self.one(t) if t else 0 for t in texts]

    def one(self, text: str) -> int:
        if any(a in text for a in self.added):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        head, *rest = text.split(" ")
        known = self.known
        new = set(rest).difference(known)
        if any(not x or SPACE(x) for x in new) or SPACE(head) or not head:
            parts = segments(text)
            self._learn([s for s in dict.fromkeys(parts)], self.bare)
            return sum(map(self.bare.__getitem__, parts))
        if new:
            self._learn(list(new) if len(known) <= KEPT else list(set(rest)), known, " ")
        self._learn([head], self.bare)
        return self.bare[head] + sum(map(known.__getitem__, rest))


def segments(text: str) -> list[str]:
    """The text cut before each space that something else than white space follows."""
    return [x for x in SEGMENT.split(text) if x]


def count(df: DataFrame, tokenizer: str, keys: list[Column], names: list[str], text: str = "text", limit: int = 1024) -> DataFrame:
    """keys under names, n_bytes, n_tokens and over_limit (n_tokens > limit) for each row, from its whole text.

    `tokenizer` is the path of a vocabulary file in the library's JSON form on the driver; its content, of a fixed size,
    is broadcast with the proven strings. Null texts are empty: no bytes, no tokens. Repeated rows give equal results,
    an empty table none; only the keys and the text are read.
    """
    content = Path(tokenizer).read_text()
    shared = df.sparkSession.sparkContext.broadcast((content, prove(plain(content))))

    def make():
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        held, proven = shared.value
        counts = _counts(held, proven)

        def apply(*c):
            n = counts.of(c[-1])
            return dict(zip(names, c[:-1])) | {"n_bytes": [len(utf8(t)) for t in c[-1]], "n_tokens": n, "over_limit": [x > limit for x in n]}

        return apply

    kinds = df.select(*[k.alias(n) for k, n in zip(keys, names)]).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", n_bytes bigint, n_tokens bigint, over_limit boolean"
    return on_arrow(df, [*keys, F.col(text)], make, schema, _counts)


@per_worker
def _counts(content: str, proven: frozenset[str]) -> Counts:
    """One for each worker process, so that what it has learned serves all of the worker's tasks of counting."""
    return Counts(plain(content), proven)


def plain(content: str) -> Tokenizer:
    """The library's tokenizer without truncation and padding."""
    out = Tokenizer.from_str(content)
    out.no_truncation()
    out.no_padding()
    return out
