"""Operator 3, token counts: rank-synchronous merging of ragged numpy arrays.

The pre-tokens of a batch are one flat array of symbols with a sequence number each.  In every step each sequence
applies its own lowest-rank pair, all sequences at once, until no pair of any sequence is a piece; what counts is
the symbols that survive.  Counts of pre-tokens are kept in a bounded dictionary.

Pre-tokens: no piece of the vocabulary goes over from another character to the space mark (checked when the
model is read), so texts fall apart there, and at line ends, which no longer piece has.

A round goes over all symbols of a sequence.  Pre-tokens of more than LONG characters (text without spaces, encoded
data) would need as many rounds as they have different pieces, so they are merged one by one instead, by a heap of
places in which a merge touches its two neighbours only: n log n for n characters.

Defined results: a null text counts as empty and has no tokens; a null doc_id stays null; repeated rows give
a row each; an empty table gives no rows; pairs of equal rank merge from the left; other columns are
not read; texts are read whole, whatever their length.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from econ_lake.llm.shared import pieces, utf8

LIMIT = 4096
SPACE = "▁"
NO_PAIR = np.iinfo(np.int64).max
#: Characters of a pre-token above which it is merged by a heap.
LONG = 256
#: Pre-tokens whose count is remembered by a Python worker.
REMEMBERED = 400_000


class PieceCounter:
    """Token counts by a sentencepiece BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.vocab_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        # rank 0 is the best score; symbols are numbered by rank
        ids.sort(key=lambda i: (-model.get_score(i), i))
        self.symbols = {model.id_to_piece(i): rank for rank, i in enumerate(ids)}
        if any(SPACE in p.lstrip(SPACE) for p in self.symbols):
            raise ValueError("a piece goes over from a word to a space: texts can't be cut there")
        alone = [c for c in "\n\r\t" if not any(c in p and len(p) > 1 for p in self.symbols)]
        self.pattern = re.compile(f"{SPACE}*[^{SPACE}{''.join(alone)}]+|{SPACE}+|[{''.join(alone) or SPACE}]")
        pairs = sorted((self.symbols[p[:k]] * len(ids) + self.symbols[p[k:]], rank)
                       for p, rank in self.symbols.items() for k in range(1, len(p))
                       if p[:k] in self.symbols and p[k:] in self.symbols)
        self.keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.merged = np.array([m for _, m in pairs] or [0], np.int64)
        # a symbol is steady if all that it merges to has a higher rank: only then the other places of its pair
        # can be merged at once, as no better pair comes up between them
        self.steady = np.ones(len(ids) + 1, bool)
        for key, rank in pairs:
            for part in divmod(key, len(ids)):
                self.steady[part] &= rank > part
        self.pairs = dict(pairs)
        self.letter = {p: r for p, r in self.symbols.items() if len(p) == 1}
        self.known: dict[str, int] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * len(self.symbols) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.merged[at], NO_PAIR)

    def counts(self, tokens: list[str]) -> np.ndarray:
        """The number of symbols that are left of each pre-token."""
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        chars = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, which = np.unique(chars, return_inverse=True)
        of_kind = np.array([self.letter.get(chr(c), -1) for c in kinds], np.int64)
        fallback = np.array([1 if k >= 0 else len(chr(c).encode("utf-8", "replace"))
                             for c, k in zip(kinds, of_kind, strict=True)], np.int64)
        seq = np.repeat(np.arange(len(tokens)), size)
        total = np.bincount(seq, weights=fallback[which], minlength=len(tokens)).astype(np.int64)
        sym = of_kind[which]
        while len(sym) > 1:
            rank = np.full(len(sym), NO_PAIR)
            inside = seq[1:] == seq[:-1]
            rank[:-1][inside] = self._rank(sym[:-1][inside], sym[1:][inside])
            heads = np.flatnonzero(np.concatenate([[True], ~inside]))
            best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(sym))))
            active = best != NO_PAIR
            if not active.any():
                break
            sym, seq, rank, best = sym[active], seq[active], rank[active], best[active]
            here = rank == best
            first = here & (np.diff(seq, prepend=-1) != 0)  # is the first symbol of its sequence the place?
            order = np.cumsum(here)
            start = np.flatnonzero(np.diff(seq, prepend=-1))
            base = np.repeat(order[start] - here[start], np.diff(np.append(start, len(seq))))
            first = here & (order - base == 1)
            # places in a run (a a a) overlap: every second one counts, from the left
            run = np.arange(len(here)) - np.maximum.accumulate(np.where(here, 0, np.arange(len(here)) + 1))
            take = first | (here & self.steady[np.where(here, best, -1)] & (run % 2 == 0))
            at = np.flatnonzero(take)
            np.subtract.at(total, seq[at], 1)
            sym = sym.copy()
            sym[at] = best[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, seq = sym[keep], seq[keep]
        return total

    def count_long(self, token: str) -> int:
        """The number of symbols that are left of one pre-token: the leftmost lowest-rank pair is merged, again and
        again."""
        letter, pair, size = self.letter, self.pairs.get, len(self.symbols)
        sym = [letter.get(c, -1) for c in token]
        total = sum(1 if s >= 0 else len(c.encode("utf-8", "replace")) for s, c in zip(sym, token, strict=True))
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def rank(k: int):
            right = after[k]
            if right >= n or sym[k] < 0 or sym[right] < 0:
                return None
            return pair(sym[k] * size + sym[right])

        heap = [(r, k) for k in range(n - 1) if (r := rank(k)) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            r, k = heapq.heappop(heap)
            if gone[k] or rank(k) != r:
                continue  # the pair that stood here was merged with a neighbour
            right = after[k]
            gone[right], sym[k], total = 1, r, total - 1
            after[k] = far = after[right]
            if far < n:
                before[far] = k
            for place in (k, before[k]):
                if place >= 0 and (new := rank(place)) is not None:
                    heapq.heappush(heap, (new, place))
        return total

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        split = [self.split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list(set().union(*split).difference(self.known)) if split else []
        self.known.update((t, self.count_long(t)) for t in new if len(t) > LONG)
        new = [t for t in new if len(t) <= LONG]
        for k in range(0, len(new), 200_000):
            part = new[k:k + 200_000]
            self.known.update(zip(part, self.counts(part).tolist(), strict=True))
        get = self.known.__getitem__
        return [sum(map(get, tokens)) for tokens in split]


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row; texts are read whole and nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_path).count
        for part in pieces(batches):
            _, at = utf8(part.column("text"))
            n = np.array(count([t or "" for t in part.column("text").to_pylist()]), np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(at)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
