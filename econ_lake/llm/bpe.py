"""Operator 2, BPE encoding and decoding: a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the places of a word, each with the rank of the pair that starts there; an inner node
has the least of its two, with ties to the left.  The root is thus the leftmost lowest-rank merge.  A merge changes
three leaves at most (the pair's, its left neighbour's, the swallowed symbol's), each a path of logarithmic length,
and the work ends when the root has no pair.

Words are encoded once and remembered in a bounded dictionary.

Defined results: a null text counts as empty and has no tokens; special strings inside texts become their ids, as
the library does by default; a null doc_id stays null; repeated rows give a row each; an empty table gives no rows;
pairs of equal rank merge from the left; texts are read whole, whatever their length; other columns stay as they are in
``encode`` (but for those with the names of its results) and aren't read by ``encode_digests``.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from econ_lake.llm.shared import pieces

#: More than any rank with its place; a place is added to it as to a rank.
NO_PAIR = 1 << 62
#: Words whose tokens are remembered by a Python worker.
REMEMBERED = 250_000


class PairTree:
    """The least (rank, place) over the places of a word, by a segment tree in one list."""

    def __init__(self, leaves: list[int]):
        self.size = 1 << (len(leaves) - 1).bit_length()
        level = leaves + [NO_PAIR] * (self.size - len(leaves))
        levels = [level]
        while len(level) > 1:
            level = [a if a <= b else b for a, b in zip(level[::2], level[1::2], strict=True)]
            levels.append(level)
        self.node = [NO_PAIR]
        for level in reversed(levels):
            self.node += level

    def put(self, place: int, value: int) -> None:
        """Changes a leaf and what depends on it."""
        node, k = self.node, self.size + place
        if node[k] == value:
            return
        node[k] = value
        while k > 1:
            other = node[k ^ 1]
            k >>= 1
            least = value if value <= other else other
            if node[k] == least:
                return
            node[k] = value = least


def byte_letters() -> dict[int, str]:
    """Byte-level alphabets show printable Latin-1 bytes as themselves and the rest, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


# The letters and numbers that Unicode 16 has beyond 15.1.  The tokenizers library's patterns know them,
# Python's database may not; what later versions add is neither letter nor number to it.
LATER = {
    "L": [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
          (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
          (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
          (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)],
    "N": [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
          (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)],
}
# Capitals that Unicode 16 and 17 added, in runs, and the first of each run's small letters.  The
# library's lower-casing knows both versions.
LATER_SMALL = [(0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
               (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B),
               (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB)]
SMALL = {c: small + c - first for first, last, small in LATER_SMALL for c in range(first, last + 1)}
#: All characters that LATER, LATER_SMALL or a version of Unicode may tell otherwise are among these.
RARE = re.compile("[\u0250-\U0010FFFF]")
LATER_CAPITAL = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b, _ in LATER_SMALL) + "]")


@lru_cache(maxsize=1)
def categories() -> str:
    """The first letter of each code point's general category: Python's, and what LATER adds."""
    out = [unicodedata.category(chr(point))[0] for point in range(sys.maxunicode + 1)]
    for kind, ranges in LATER.items():
        for first, last in ranges:
            out[first:last + 1] = kind * (last + 1 - first)
    return "".join(out)


@lru_cache(maxsize=2)
def members(kind: str) -> str:
    """The ranges of all letters (L) or numbers (N), for a character class."""
    return "".join(f"\\U{m.start():08x}-\\U{m.end() - 1:08x}" for m in re.finditer(f"{kind}+", categories()))


@lru_cache(maxsize=1)
def otherwise_classed() -> re.Pattern:
    """A class of the characters that the regex package takes for a letter or number and the library doesn't, or the
    other way round."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    odd: set[str] = set()
    for kind in "LN":
        odd |= set(regex.findall(f"\\p{{{kind}}}", every)) ^ {chr(m.start()) for m in re.finditer(kind, categories())}
    points = sorted(map(ord, odd))
    runs = [k for k in range(len(points)) if not k or points[k] != points[k - 1] + 1]
    ranges = [(points[a], points[b - 1]) for a, b in zip(runs, [*runs[1:], len(points)], strict=True)]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "]" if ranges else "(?!)")


class WordBPE:
    """A byte-level BPE whose words end in a suffix, read from a tokenizers file of that kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or spec["decoder"] is not None:
            raise ValueError("not a tokenizer of the kind that this class reads")
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        # a pair's rank, in the upper half of a leaf; the lower one is the place
        self.rank: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.rank.setdefault(self.vocab[a] << 32 | self.vocab[b], rank << 32)
        self.merged = [self.vocab[a + b] for a, b in model["merges"]]
        pattern = split["pattern"]["Regex"].replace("\\s", "\\p{White_Space}")
        self.words = regex.compile(pattern)
        # texts with a character that the regex package classes otherwise than the library go by written-out classes,
        # which are slow; both kinds often stand in a class of their own, where a nested one isn't understood
        for kind in "LN":
            pattern = pattern.replace(f"[\\p{{{kind}}}]", f"[{members(kind)}]").replace(f"\\p{{{kind}}}", members(kind))
        self.exact_words, self.odd = regex.compile(pattern), otherwise_classed()
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        letters = byte_letters()
        self.inner = {b: self.vocab[c] for b, c in letters.items()}
        self.last = {b: self.vocab[c + self.suffix] for b, c in letters.items()}
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def encode_word(self, word: str) -> list[int]:
        """The ids of one pre-token."""
        raw = word.encode("utf-8", "replace")
        sym = [self.inner[b] for b in raw]
        sym[-1] = self.last[raw[-1]]
        if len(sym) == 1:
            return sym
        rank, merged, n = self.rank.get, self.merged, len(sym)
        tree = PairTree([k + rank(sym[k] << 32 | sym[k + 1], NO_PAIR) for k in range(n - 1)])
        node, put = tree.node, tree.put
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (best := node[1]) < NO_PAIR:
            k = best & 0xFFFFFFFF
            gone = after[k]
            sym[k] = new = merged[best >> 32]
            sym[gone] = -1
            after[k] = right = after[gone]
            if gone < n - 1:
                put(gone, NO_PAIR)
            if right < n:
                before[right] = k
                put(k, k + rank(new << 32 | sym[right], NO_PAIR))
            else:
                put(k, NO_PAIR)
            if (left := before[k]) >= 0:
                put(left, left + rank(sym[left] << 32 | new, NO_PAIR))
        return [s for s in sym if s >= 0]

    def pre_tokens(self, text: str) -> list[str]:
        """The words of a text without special strings: NFC, then lower case letter by letter, then the pattern."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma
            if RARE.search(text):  # a single range, so that most texts are looked through fast
                if LATER_CAPITAL.search(text):
                    text = text.translate(SMALL)
                text = text.lower()
                return (self.exact_words if self.odd.search(text) else self.words).findall(text)
        return self.words.findall(text.lower())

    def split(self, text: str) -> list[str]:
        """All pre-tokens; a special string is one, marked by a leading NUL."""
        if "<|" not in text:
            return self.pre_tokens(text)
        out: list[str] = []
        for k, part in enumerate(self.specials.split(text)):
            if k % 2:
                out.append("\0" + part)
            elif part:
                out += self.pre_tokens(part)
        return out

    def learn(self, word: str) -> tuple[str, str]:
        """Ids and tokens of a pre-token, each joined by spaces."""
        ids = [self.special[word[1:]]] if word[0] == "\0" and word[1:] in self.special else self.encode_word(word)
        return " ".join(map(str, ids)), self.decode(ids)

    def look_up(self, text: str) -> list[tuple[str, str]]:
        """What ``learn`` gives for each pre-token; of two bounded dictionaries, the older is dropped when one fills."""
        known, out = self.known, []
        for word in self.split(text):
            got = known.get(word)
            if got is None:
                got = self.older.get(word) or self.learn(word)
                if len(word) < 200:
                    if len(known) >= REMEMBERED:
                        self.older, self.known = known, {}
                        known = self.known
                    known[word] = got
            out.append(got)
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _ in self.look_up(text) for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder, so tokens are joined by spaces."""
        return " ".join(self.token[i] for i in ids)

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, SHA-256 of the ids and of the decoded text."""
        if not (got := self.look_up(text)):
            return 0, _sha(""), _sha("")
        ids, tokens = (" ".join(x) for x in zip(*got, strict=True))
        return ids.count(" ") + 1, _sha(ids), _sha(tokens)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBPE:
    return WordBPE(path)


def encode(docs: DataFrame, path: str, decoded: bool = True) -> DataFrame:
    """The rows of ``docs`` with n_tokens, ids and, if wanted, the decoded text behind their own columns.

    Columns of ``docs`` with one of these names give way.
    """
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    new += [T.StructField("decoded", T.StringType())] * decoded
    names = [f.name for f in new]
    own = [f for f in docs.schema.fields if f.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for part in pieces(batches):
            ids = [bpe.encode(t or "") for t in part.column("text").to_pylist()]
            columns = [pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))]
            if decoded:
                columns.append(pa.array([bpe.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays([part.column(f.name) for f in own] + columns,
                                             [f.name for f in own] + names)

    return docs.select(*[F.col(f"`{f.name}`") for f in own]).mapInArrow(run, T.StructType([*own, *new]))


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row, without moving the ids out of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for part in pieces(batches):
            rows = [bpe.digests(t or "") for t in part.column("text").to_pylist()]
            n, ids, decoded = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.array(n, np.int64)), pa.array(ids, pa.string()),
                 pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
