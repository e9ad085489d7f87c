"""Byte-pair encoding and decoding.

Encoding is exact and linear in the length of a piece: an Aho-Corasick automaton finds the
longest token at every position, a walk takes them from the left and goes back to the next
shorter token where two neighbours could not both stand, and a table says which pairs can.
Two tokens can stand side by side when undoing their merges, latest first, never shows a
pair across the border that the merges would have joined earlier.

Decoding looks up each id in one table of bytes by offset.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from terrane.llm.common import arrow_map, texts_of

# Fixed value: how byte-level tokenizers cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces and pairs that a task remembers. Beyond half of it, those not met since the last time
#: are forgotten.
MEMORY = 300_000


def latin_pieces() -> re.Pattern:
    """``PIECES`` for texts whose characters are all below 256, on the faster standard engine."""
    low = [chr(c) for c in range(256)]
    kinds = ["".join(map(re.escape, filter(test, low))) for test in (
        lambda c: unicodedata.category(c)[0] == "L",
        lambda c: unicodedata.category(c)[0] == "N",
        lambda c: regex.match(r"\s", c) is not None)]
    letter, digit, blank = kinds
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{blank}{letter}{digit}]+"
        f"|[{blank}]+(?![^{blank}])|[{blank}]+")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a vocabulary file: printable ones for
    themselves, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Lately(dict):
    """What ``make`` gives for the keys met lately, ``most`` of them. ``older`` has those met
    before them, and gives back what is met again, so that frequent ones stay."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.most // 2:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class Vocabulary:
    """Tokens of a byte-level vocabulary file, whose ids follow the order of the merges."""

    def __init__(self, content: str):
        file = json.loads(content)
        kind = file["pre_tokenizer"]
        if kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError("only byte-level vocabularies without a prefix space are known")
        model, letters = file["model"], byte_letters()
        self.ids: dict[str, int] = model["vocab"]
        if missing := set(letters) - set(self.ids):
            raise ValueError(f"the vocabulary lacks {len(missing)} bytes")
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.cut_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        ) if self.special else None
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.letters = {b: x for b, x in enumerate(letters)}
        self.four = [i.to_bytes(4, "little") for i in range(size)]
        self.length, self.shorter = [0] * size, [-1] * size
        self.left, self.right = list(range(size)), list(range(size))
        self.joined: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.automaton.add_word(text, i)
            self.length[i] = len(text)
            self.shorter[i] = next(
                (self.ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids),
                -1)
        self.automaton.make_automaton()
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b, ab = self.ids[a], self.ids[b], self.ids[a + b]
            self.joined[a, b] = ab
            self.left[ab], self.right[ab] = a, b
        self.size = size
        self.stands = Lately(lambda pair: self.compatible(*divmod(pair, size)), MEMORY)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between the tokens ``a`` and ``b`` alone."""
        x, y, earliest, result = a, b, len(self.left), True
        while True:
            merged = self.joined.get((x, y))
            if merged is not None and merged < earliest:
                result = False
                break
            undo_left = x > y
            if (undo_left and self.right[x] == x) or (not undo_left and self.left[y] == y):
                undo_left = not undo_left  # one byte is left of it: undo the other
                if (x if undo_left else y) == (self.right[x] if undo_left else self.left[y]):
                    break
            if undo_left:
                earliest, x = x, self.right[x]
            else:
                earliest, y = y + 1, self.left[y]
        return result

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a piece as little-endian unsigned 32-bit numbers."""
        text = piece.encode().decode("latin-1").translate(self.letters)
        if (whole := self.ids.get(text)) is not None:
            return self.four[whole]
        return b"".join(map(self.four.__getitem__, self.walk(text)))

    def walk(self, text: str) -> list[int]:
        """Tokens of ``text`` whose neighbours are all compatible: the longest ones from the left,
        and from where two are not, shorter ones and the longest after them."""
        size, length, shorter = len(text), self.length, self.shorter
        stands, ids, longest = self.stands.__getitem__, self.size, self.automaton.iter_long
        lost: set[int] = set()
        taken: list[int] = []
        before, at = -1, 0
        ahead = longest(text)
        token = next(ahead)[1]
        while True:
            end = at + length[token]
            if end not in lost and (before < 0 or stands(before * ids + token)):
                taken.append(token)
                if end == size:
                    return taken
                before, at = token, end
                if ahead is None:
                    ahead = longest(text, at)
                token = next(ahead)[1]
                continue
            ahead = None  # it goes on behind the token that does not stand here
            token = shorter[token]
            while token < 0:
                lost.add(at)
                token = taken.pop()
                at -= length[token]
                token = shorter[token]
                before = taken[-1] if taken else -1


class Spellings:
    """Bytes of all tokens of a vocabulary file, one after the other, and where each begins.
    Tasks that only decode need no more."""

    def __init__(self, content: str):
        file = json.loads(content)
        ids = file["model"]["vocab"]
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        back = {x: b for b, x in enumerate(byte_letters())}
        spelled = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for text, i in ids.items():
            spelled[i] = bytes(map(back.__getitem__, text))
        for text, i in special.items():
            spelled[i] = text.encode()
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in spelled])])

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        if not len(ends):
            return ""
        index = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        return self.bytes[index].tobytes().decode("utf-8", "replace")


class Pieces(Lately):
    """Ids of the pieces met lately."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(lambda piece: vocabulary.encode_piece(piece), MEMORY)

    def __missing__(self, piece: str) -> bytes:
        return super().__missing__(piece) if len(piece) <= 64 else self.make(piece)


class Encoder:
    def __init__(self, content: str):
        self.content, self.vocabulary = content, Vocabulary(content)
        self.pieces = Pieces(self.vocabulary)
        self.cut, self.cut_latin = regex.compile(PIECES), latin_pieces()

    def encode_plain(self, text: str) -> bytes:
        """Ids of a text in which no string is special."""
        try:
            text.encode("latin-1")
            cut = self.cut_latin
        except UnicodeEncodeError:
            cut = self.cut
        return b"".join(map(self.pieces.__getitem__, cut.findall(text)))

    def encode(self, text: str) -> bytes:
        special = self.vocabulary.special
        if not any(x in text for x in special):
            return self.encode_plain(text)
        return b"".join(
            self.vocabulary.four[special[part]] if part in special else self.encode_plain(part)
            for part in self.vocabulary.cut_special.split(text))

    def decode(self, ids: bytes) -> str:
        return spellings(self.content).decode(ids)


@lru_cache(maxsize=2)
def encoder(content: str) -> Encoder:
    return Encoder(content)


@lru_cache(maxsize=2)
def spellings(content: str) -> Spellings:
    return Spellings(content)


def _content(docs: DataFrame, path: str):
    """The vocabulary file, about 1.5 MB whatever the data, for all executors."""
    with open(path, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of whole texts, as little-endian unsigned 32-bit numbers.

    Null and empty texts have no ids (an empty binary). The string of a special token in a
    text is that token. Rows are kept as they are, repeated ones too; an empty table gives
    an empty one. Other columns stay; ``out`` must not be one of them.
    """
    content = _content(docs, path)

    def run(batch: pa.RecordBatch, own: Encoder) -> dict[str, pa.Array]:
        return {out: pa.array([own.encode(x) for x in texts_of(batch, text)], pa.binary())}

    return arrow_map(docs, run, f"`{out}` binary", lambda: encoder(content.value))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the texts of its ids; null ids give the empty text. Bytes that are no
    UTF-8 become replacement characters."""
    content = _content(df, path)

    def run(batch: pa.RecordBatch, own: Spellings) -> dict[str, pa.Array]:
        return {out: pa.array([own.decode(x or b"") for x in batch.column(ids).to_pylist()],
                              pa.string())}

    return arrow_map(df, run, f"`{out}` string", lambda: spellings(content.value))
