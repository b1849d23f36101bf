"""Byte-level BPE by backtracking over longest matches, and decoding.

An Aho-Corasick automaton over the vocabulary gives the longest token at each
place of a pre-token in one pass. The encoder takes the longest token and
accepts it if it may stand after the one before it: two tokens may stand side
by side if merging them apart never crosses their border earlier than the
merges that make them (`Vocabulary.fits`; results are kept in a table). If no
token fits, the last token is taken back and a shorter one tried, and a place
that has led nowhere is not tried again. The result is what repeated merging
by rank gives, in linear time.

Decoding joins all tokens' bytes into one array and gathers by an offset table.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import batches_with, each_text, in_batches, kept, with_fields

#: The public pre-tokenisation pattern of this vocabulary.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words that a worker remembers in each of two generations, and pairs in all.
WORD_CACHE, PAIR_CACHE = 50_000, 60_000
#: Pre-tokens that are joined, and ids that are decoded, at a time.
BLOCK = 1 << 16
#: Longer pre-tokens are encoded without being remembered.
CACHED_LENGTH = 64
#: Texts whose characters all lie below this one take an equal pattern for the faster `re`.
LATIN_END = 0x250


def _class(*kinds: str) -> str:
    found = "".join(re.escape(chr(c)) for c in range(128, LATIN_END) if unicodedata.category(chr(c))[0] in kinds)
    return found


def _latin_pattern() -> re.Pattern:
    letters, numbers = "A-Za-z" + _class("L"), "0-9" + _class("N")
    space = r"\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(rf" ?[{letters}]+| ?[{numbers}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{space}{letters}{numbers}]+"
                      rf"|[{space}]+(?![^{space}])|[{space}]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary file: printable
    bytes stand for themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """Tokens of a byte-level BPE file; ids of merged tokens follow merge rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, back = spec["model"], {ch: b for b, ch in byte_letters().items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for t, i in model["vocab"].items():
            self.tokens[i] = bytes(back[c] for c in t)
        for t, i in self.special.items():
            self.tokens[i] = t.encode()
        ids = model["vocab"]
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            pair, made = (ids[a], ids[b]), ids[a + b]
            self.merged.setdefault(pair, made)
            self.parts.setdefault(made, pair)
        rank = {made: i for i, made in enumerate(self.parts)}
        if any(rank[m] <= max(rank.get(a, -1), rank.get(b, -1)) for m, (a, b) in self.parts.items()):
            raise ValueError("a merge comes before the merges that make its parts")
        #: a token's place in merge order; single bytes come before all merges
        self.order = {i: rank.get(i, -1) for i in range(size)}
        self.automaton = ahocorasick.Automaton()
        for i in ids.values():
            self.automaton.add_word(self.tokens[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.single = {self.tokens[i].decode("latin-1"): i for i in ids.values()}
        self.packed = [i.to_bytes(4, "little") for i in range(size)]
        self.length = [len(t) for t in self.tokens]
        #: the longest token that is a proper prefix of each
        self.shorter = [self._prefix(t.decode("latin-1")) for t in self.tokens]
        self._fits: dict[tuple[int, int], bool] = {}
        self._latin = _latin_pattern()
        self._beyond = re.compile(f"[^\x00-{chr(LATIN_END - 1)}]")
        self._any = regex.compile(PRETOKENS)
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = _Words(self)
        lengths = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.joined = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by rank leaves `left` and `right` apart: no pair
        that meets at their border, while both are still being built, merges
        before the merges that build them."""
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) >= PAIR_CACHE:
                self._fits.clear()
            known = self._fits[left, right] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        order, parts = self.order, self.parts
        a, b = left, right
        # Undo the later of the two merges step by step. The pair (a, b) stands
        # at the border from when both exist until `until`, the undone merge.
        until = len(order) + 1
        while True:
            made = self.merged.get((a, b))
            # of two equal ranks the left place merges first, and the right part of `left` is left of the border
            if made is not None and order[made] < until:
                return False
            if a not in parts and b not in parts:
                return True
            if order[a] > order[b]:
                until, a = order[a], parts[a][1]
            else:
                until, b = order[b] + 1, parts[b][0]

    def _prefix(self, word: str) -> int | None:
        return next((self.single[word[:k]] for k in range(len(word) - 1, 0, -1) if word[:k] in self.single), None)

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token, given as its bytes read as Latin-1."""
        whole = self.single.get(word)
        if whole is not None:
            return [whole]
        n, fits, size, longest, shorter = len(word), self.fits, self.length, self.automaton.iter_long, self.shorter
        ids: list[int] = []
        dead: set[int] = set()
        matches, at = longest(word), 0
        while at < n:
            token, moved = next(matches)[1], False
            while True:
                end = at + size[token]
                if (not ids or fits(ids[-1], token)) and end not in dead:
                    ids.append(token)
                    at = end
                    break
                moved = True
                token = shorter[token]
                if token is None:  # nothing fits here: the token before must be shorter
                    dead.add(at)
                    token = ids.pop()
                    at -= size[token]
            if moved:
                matches = longest(word, at)
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self._special is not None and "<" in text:
            pieces = self._special.split(text)
            if len(pieces) > 1:
                return b"".join(self.special[p].to_bytes(4, "little") if i % 2 else self._plain(p)
                                for i, p in enumerate(pieces))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        pattern = self._any if self._beyond.search(text) else self._latin
        if len(text) <= BLOCK:
            return b"".join(map(self.words.__getitem__, pattern.findall(text)))
        out, found = bytearray(), pattern.finditer(text)
        while some := [self.words[m.group()] for m in itertools.islice(found, BLOCK)]:
            out += b"".join(some)
        return bytes(out)

    def decode(self, ids: bytes) -> bytes:
        """The tokens' bytes, one after the other."""
        if not ids:
            return b""
        if len(ids) > 4 * BLOCK:
            out = bytearray()
            for at in range(0, len(ids), 4 * BLOCK):
                out += self.decode(ids[at:at + 4 * BLOCK])
            return bytes(out)
        at = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        start, length = self.offsets[at], self.offsets[at + 1] - self.offsets[at]
        ends = np.cumsum(length)
        gather = np.repeat(start - ends + length, length)
        gather += np.arange(ends[-1])
        return self.joined[gather].tobytes()


class _Words(dict):
    """Encoded pre-tokens, made when first asked for. A full generation
    becomes the old one, from which words still in use are taken over."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.old = vocabulary, {}

    def __missing__(self, word: str) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            v = self.vocabulary
            packed = b"".join([v.packed[i] for i in v.encode_word(word.encode("utf-8").decode("latin-1"))])
        if len(word) <= CACHED_LENGTH:
            if len(self) >= WORD_CACHE:
                self.old = dict(self)
                self.clear()
            self[word] = packed
        return packed


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once in each Python worker."""
    return kept(__name__, path, Vocabulary)


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds `ids_col`, the token ids as little-endian unsigned 32-bit integers.

    The whole text is encoded; a null or empty text has no tokens. Special
    tokens of the file are recognised in the text. Repeated rows are encoded
    each; an existing column named `ids_col` is replaced. `path` must exist on
    every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        yield from batches_with(batches, **{ids_col: lambda b: pa.array(map(v.encode, each_text(b, text_col)), pa.binary())})

    return in_batches(df, run, with_fields(df.schema, **{ids_col: T.BinaryType()}))


def decode(df: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Adds `decoded_col`, the text of the ids, special tokens included; bytes
    that are not UTF-8 give U+FFFD. Null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)

        def column(batch: pa.RecordBatch) -> pa.Array:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            return pa.array((v.decode(x or b"").decode("utf-8", "replace") for x in ids), pa.string())

        yield from batches_with(batches, **{decoded_col: column})

    return in_batches(df, run, with_fields(df.schema, **{decoded_col: T.StringType()}))


def round_trip(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str = "decoded") -> DataFrame:
    """`encode` and `decode` of its ids in one pass over the rows; the text
    column itself is not returned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            ids = [v.encode(t) for t in each_text(batch, text_col)]
            back = [v.decode(x).decode("utf-8", "replace") for x in ids]
            rest = batch.drop_columns([text_col])
            yield from batches_with(iter([rest]), **{ids_col: lambda _, x=ids: pa.array(x, pa.binary()),
                                                     decoded_col: lambda _, x=back: pa.array(x, pa.string())})

    rest = T.StructType([f for f in df.schema.fields if f.name != text_col])
    return in_batches(df, run, with_fields(rest, **{ids_col: T.BinaryType(), decoded_col: T.StringType()}))
