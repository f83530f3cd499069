"""Helpers of the ``llm`` operators: shared scratch tables and vectorised text work on Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ------------------------------------------------------------------ scratch


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local one only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jsc.isDefined():
            return jsc.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-scratch-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def written() -> int:
    """The number of tables that ``stored`` has written so far and that weren't released."""
    return len(_WRITTEN)


def release(spark: SparkSession, first: int) -> None:
    """Deletes the tables that ``stored`` has written from number ``first`` on, but for the last one."""
    for path in _WRITTEN[first:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    del _WRITTEN[first:-1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ columns

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text):
    """Lower-cases A-Z and nothing else.  ``lower`` does that, and faster, where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


# ------------------------------------------------------------------ text in numpy

#: 1 for the bytes that separate words in ``[^\x20\x09-\x0D]+``.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, other bytes unchanged.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 32

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S32, _S29 = np.uint64(32), np.uint64(29)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> _S32)) * _C1
    h = (h ^ (h >> _S29)) * _C2
    return h ^ (h >> _S32)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, end to end, and the n+1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20):
    """The batches in slices of about ``limit`` bytes of text; one longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + 64)
        first = 0
        while first < batch.num_rows:
            done = size[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(size, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


class Words:
    """The words of texts laid end to end: ``start``/``end`` byte positions, ``first[i]:first[i+1]`` those of row i."""

    def __init__(self, data: np.ndarray, at: np.ndarray, blank: np.ndarray = BLANK):
        self.data, self.at = data, at
        word = ~blank[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        opens, closes = word & edge[:-1], word & edge[1:]
        opens[1:] |= word[1:] & ~word[:-1]
        closes[:-1] |= word[:-1] & ~word[1:]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, at)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.first))

    def hashes(self, seed: int = 0, most: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first ``most`` bytes, taken eight bytes at a time."""
        size = self.end - self.start
        if most is not None:
            size = np.minimum(size, most)
        h = mix(size.astype(np.uint64) + np.uint64(seed + 1))
        if not len(h):
            return h
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data),), "<u8", padded, strides=(1,))
        left, at, live = size, self.start, None
        while True:
            part = eight[at] & _MASK[np.minimum(left, 8)]
            if live is None:
                h = mix(h ^ part)
            else:
                h[live] = mix(h[live] ^ part)
            more = left > 8
            if not more.any():
                return h
            live = np.flatnonzero(more) if live is None else live[more]
            at, left = at[more] + 8, left[more] - 8


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n consecutive entries of h (in order); len(h)-n+1 of them."""
    out = mix(h[:len(h) - n + 1])
    for k in range(1, n):
        out = mix(out + h[k:len(h) - n + 1 + k])
    return out
