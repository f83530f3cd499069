"""Operator 13, importance resampling towards a target distribution, over hashed n-grams.

Each text is normalised to words with one space between them and scanned once, keeping the running CRC register
after every byte.  CRC is linear over GF(2): the checksum of any n-gram follows from the registers before and after
it, the first shifted over the n-gram's length and cancelled out.  Shifting over 2^k bytes is a matrix, applied by
four table look-ups.

Buckets are counted over all documents and all target texts; a document's weight is the sum of its features' gains,
and a Gumbel number from the hash of its id makes the highest scores a draw without replacement.

Defined results: a null or empty text has no words, weight 0, and can't be drawn; a null doc_id counts as empty text
in the hash and as larger than any other in ties; repeated rows get a row each, with consecutive ranks; empty tables
give no rows, or gains over no target features; other columns are not read; texts are scanned whole, whatever their
length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.shared import ASCII_LOWER, Words, pieces, stored, utf8

LONGEST, BUCKETS, PERCENT, SEED, LEAST_WORDS = 1, 10_000, 10, 2024, 20
#: Fixed value: the reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)
#: 1 for the bytes between words: all of ASCII but letters (after lower-casing) and digits.
GAP = np.zeros(256, bool)
GAP[:0x80] = True
GAP[0x30:0x3A] = GAP[0x61:0x7B] = False
#: Bytes of a lane; the lanes of a text stream are scanned side by side.
LANE = 256


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ POLYNOMIAL, table >> 1).astype(np.uint32)
    return table


TABLE = _byte_table()


class Shift:
    """Registers moved over runs of zero bytes: tables for 2^k bytes, made when first used."""

    def __init__(self):
        one = np.arange(256, dtype=np.uint32)
        # over one byte: the lowest byte goes through the table, the others move down
        self.tables = [np.stack([TABLE[one], one, one << 8, one << 16]).astype(np.uint32)]

    def table(self, k: int) -> np.ndarray:
        while len(self.tables) <= k:
            last = self.tables[-1]
            self.tables.append(np.stack([self._apply(last, row) for row in last]))
        return self.tables[k]

    @staticmethod
    def _apply(table: np.ndarray, register: np.ndarray) -> np.ndarray:
        return (table[0][register & 255] ^ table[1][register >> 8 & 255]
                ^ table[2][register >> 16 & 255] ^ table[3][register >> 24])

    def over(self, register: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Each register after so many zero bytes."""
        out = register.copy()
        for k in range(int(length.max()).bit_length() if len(length) else 0):
            some = np.flatnonzero(length >> k & 1)
            out[some] = self._apply(self.table(k), out[some])
        return out


SHIFT = Shift()


def running(data: np.ndarray) -> np.ndarray:
    """The register before each byte and after the last one, from an empty register."""
    lanes = -(-len(data) // LANE)
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[:len(data)] = data
    across = np.ascontiguousarray(padded.reshape(lanes, LANE).T)
    register = np.zeros(lanes, np.uint32)
    for column in across:
        register = TABLE[(register ^ column) & 255] ^ (register >> 8)
    # what each lane begins with: the end of the one before it, moved over a lane
    begin, tables = np.zeros(lanes, np.uint32), SHIFT.table(LANE.bit_length() - 1).tolist()
    value, ends = 0, register.tolist()
    for k in range(1, lanes):
        value = (tables[0][value & 255] ^ tables[1][value >> 8 & 255] ^ tables[2][value >> 16 & 255]
                 ^ tables[3][value >> 24] ^ ends[k - 1])
        begin[k] = value
    out = np.zeros((LANE + 1, lanes), np.uint32)
    out[0] = register = begin
    for k, column in enumerate(across):
        out[k + 1] = register = TABLE[(register ^ column) & 255] ^ (register >> 8)
    flat = np.ascontiguousarray(out[:LANE].T).reshape(-1)
    return np.append(flat, out[LANE, -1] if lanes else np.uint32(0))[:len(data) + 1]


class Features:
    """The n-grams of texts laid end to end: their rows and checksums; ``n_words`` per row."""

    def __init__(self, data: np.ndarray, at: np.ndarray, longest: int = LONGEST):
        words = Words(ASCII_LOWER[data], at, GAP)
        self.n_words, rows = np.diff(words.first), words.rows()
        size = words.end - words.start
        # the normalised stream: every word moves to its place, and a space stands behind it
        start = np.concatenate([[0], np.cumsum(size + 1)]).astype(np.int64)
        stream = np.full(start[-1], 0x20, np.uint8)
        stream[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = words.data[
            np.arange(size.sum()) + np.repeat(words.start - np.cumsum(size) + size, size)]
        register = running(stream)
        self.rows, self.crc = [], []
        for n in range(1, longest + 1):
            first = np.arange(max(0, len(size) - n + 1))
            first = first[rows[first] == rows[first + n - 1]]
            begin, end = start[first], start[first + n] - 1
            # the register behind the n-gram, without what came before it, as if it had begun with ones
            crc = register[end] ^ SHIFT.over(register[begin] ^ ONES, end - begin) ^ ONES
            self.rows.append(rows[first])
            self.crc.append(crc)
        self.rows, self.crc = np.concatenate(self.rows), np.concatenate(self.crc)


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket; one partial count per task and bucket is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for part in pieces(batches):
            n += np.bincount(Features(*utf8(part.column("text")), longest).crc % buckets, minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain: a thousand times the log ratio of its smoothed shares, floored."""
    k, total, wanted = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t + 1) * float(total + k)) / (float(s + 1) * float(wanted + k))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            found = Features(*utf8(part.column("text")), longest)
            total = np.zeros(part.num_rows, np.int64)
            np.add.at(total, found.rows, gain[found.crc % len(gain)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(found.n_words.astype(np.int64)),
                 pa.array(np.bincount(found.rows, minlength=part.num_rows).astype(np.int64)), pa.array(total)],
                ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel(seed: int):
    """A thousand times a Gumbel number that follows from seed and doc_id, floored."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(mark, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def drawn(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` with rank: 1, 2, 3... of the share drawn by score, null for the others.

    All rows are dealt out by ranges of the order and sorted within them; a rank is a place within its range plus
    the rows of the ranges before it, so nothing is sorted or numbered in one task.
    """
    spark = rows.sparkSession
    order = [(F.col("n_words") < least_words).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("__at", F.monotonically_increasing_id()), "in_order")
    split = F.shiftright("__at", 33)
    ranges = placed.groupBy(split.alias("__range")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_words") >= least_words).alias("can")).orderBy("__range")
    offset, before, can = [], 0, 0
    for r in ranges.collect():  # a row per range
        offset.append((r["__range"], before))
        before, can = before + r.n, can + r.can
    offsets = F.broadcast(spark.createDataFrame(offset, "__range long, before long"))
    rank = F.col("before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (placed.withColumn("__range", split).join(offsets, "__range")
            .withColumn("rank", F.when(rank <= percent * can // 100, rank)).drop("__range", "__at", "before"))


def resample(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS,
             percent: int = PERCENT, seed: int = SEED, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank, n_words."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = weights(docs, gain, longest).withColumn("score", F.col("weight") + gumbel(seed))
    return drawn(rows, percent, least_words).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
