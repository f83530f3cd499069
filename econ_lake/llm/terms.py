"""What the classifiers share: hashed n-gram indicators of whole texts, and a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.shared import ASCII_LOWER, BLANK, Words, mix, ngrams, pieces, utf8

BITS = 18
#: Bytes by kind: capitals, other letters (and all beyond ASCII), digits; the rest stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B], _SHAPE[0x61:0x7B], _SHAPE[0x30:0x3A], _SHAPE[0x80:] = 0x41, 0x61, 0x30, 0x61


def _buckets(rows: np.ndarray, hashes: np.ndarray, kind: int) -> np.ndarray:
    """Row and hashed term in one number."""
    term = mix(hashes + np.uint64(kind * 7919 + 1)) >> np.uint64(64 - BITS)
    return rows.astype(np.int64) << BITS | term.astype(np.int64)


def _grams(rows: np.ndarray, h: np.ndarray, n: int, kind: int) -> np.ndarray:
    if len(h) < n:
        return np.zeros(0, np.int64)
    inside = rows[:len(h) - n + 1] == rows[n - 1:]
    return _buckets(rows[:len(h) - n + 1][inside], ngrams(h, n)[inside], kind)


#: Lengths in bytes of the word beginnings that are terms too: roots that take many endings.
STEMS = (4, 5)


def word_terms(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The distinct (row, term) of lower-cased letter runs and of their beginnings."""
    blank = BLANK.copy()
    blank[0x21:0x30] = blank[0x3A:0x41] = blank[0x5B:0x61] = blank[0x7B:0x80] = True
    words = Words(ASCII_LOWER[data], at, blank)
    rows, size = words.rows(), words.end - words.start
    out = [np.unique(_buckets(rows, words.hashes(), 1))]
    for most in STEMS:
        long = size > most
        out.append(np.unique(_buckets(rows[long], words.hashes(most=most)[long], 20 + most)))
    return np.unique(np.concatenate(out))


def style_terms(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The distinct (row, term) of words, and of one to three consecutive word shapes.

    A shape tells the kinds of a word's characters, repeats left out, and whether the word repeats the last one.
    """
    words = Words(ASCII_LOWER[data], at)
    rows, h = words.rows(), words.hashes()
    kinds = _SHAPE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    keep = edge[:-1].copy()
    keep[1:] |= kinds[1:] != kinds[:-1]
    if len(keep):
        keep[0] = True
    shapes = Words(kinds[keep], np.concatenate([[0], np.cumsum(keep)])[at])
    again = np.zeros(len(h), np.uint64)
    again[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    shape = mix(shapes.hashes() + again)
    return np.unique(np.concatenate(
        [np.unique(_grams(rows, h, 1, 0))] + [np.unique(_grams(rows, shape, k, 10 + k)) for k in (1, 2, 3)]))


Terms = Callable[[np.ndarray, np.ndarray], np.ndarray]


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, bound: int, terms: Terms
                    ) -> tuple[list[np.ndarray], np.ndarray]:
    """The terms of at most ``bound`` labelled documents, those with the least hash of their id, and their labels.

    ``labels`` holds the rows to learn from.  At most ``bound`` ids are broadcast, and their terms collected.
    """
    chosen = (labels.filter(F.col(column).isin(0, 1)).select("doc_id", F.col(column).cast("int").alias("label"))
              .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(bound))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            got = terms(*utf8(part.column("text")))
            cut = np.searchsorted(got, np.arange(part.num_rows + 1, dtype=np.int64) << BITS)
            flat = pa.array((got & ((1 << BITS) - 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"),
                 pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), flat)], ["doc_id", "label", "terms"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = texts.mapInArrow(run, f"doc_id {kind}, label int, terms array<int>").toArrow()
    lists = got.column("terms").combine_chunks()
    cut = lists.offsets.to_numpy() if len(lists) else np.zeros(1, np.int32)
    flat = lists.values.to_numpy() if len(lists) else np.zeros(0, np.int32)
    rows = [flat[cut[k]:cut[k + 1]] for k in range(len(lists))]
    label = got.column("label").to_numpy()
    # in the order of the ids, whatever the tasks' order
    order = sorted(range(len(rows)), key=lambda k: (str(got["doc_id"][k]), len(rows[k]), int(label[k])))
    return [rows[k] for k in order], label[order].astype(np.int64)


def scored(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """doc_id and score of each row; ``score`` is given the bytes and offsets of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score(*utf8(part.column("text"))))],
                                             ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def kept_rows(docs: DataFrame, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text ``keep`` says True for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            yield part.filter(pa.array(keep(*utf8(part.column("text")))))

    return docs.mapInArrow(run, docs.schema)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % n


def verdicts(rows: DataFrame, held_out: Column) -> DataFrame:
    return rows.select("doc_id", held_out.alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
