"""Operator 1, substring dedup: suffix automata of reference shards, along which passages are streamed.

A word is removed if it lies in a window of LENGTH consecutive words whose sequence also starts earlier (in a row
of smaller doc_id, or before in the same one).

1. Every window has an anchor: of its 6-word grams, the leftmost one of least hash.  Equal windows have equal
   anchors.  Consecutive windows with the same anchor form a run of some 27 words; equal runs have equal hashes.
2. Anchors are counted over all documents.  Runs with an anchor of their own can't hold a repeated window; of equal
   runs, all but the first are repeated as a whole.  Counting is combined before each shuffle.
3. What is left, runs that share an anchor but differ, goes into reference shards by anchor, with their words.
   A shard is sorted by anchor and place.  Each run is streamed along the suffix automaton of the runs before it;
   where the matching statistic (the longest suffix that occurs in the automaton) reaches LENGTH, the maximal span is
   repeated.  Then the run is added.  An automaton is begun anew, at the next anchor, when it is large.
4. Anchors with more than HOT_RUNS different runs are split: each of their windows is a run of its own, keyed by
   its hash, so equal ones are again combined before they are shuffled, and no task holds such an anchor.

A broadcast automaton would need a reference of bounded size, or as many passes over all documents as there are
shards; so the shards are dealt out by anchor, and only passages that can match are streamed along them.

Defined results: a null or empty text has no words; a null doc_id is smaller than all others; rows with the same
doc_id and text are one document (neither is earlier); different texts must have different ids; an empty table gives
no rows; other columns are not read; texts are read whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.shared import Words, mix, ngrams, pieces, stored, utf8

LENGTH = 20
#: Words of an anchor: fewer make runs longer, and anchors less rare.
ANCHOR = 6
#: An anchor with more different runs than this is split into windows.
HOT_RUNS = 20_000
#: Words of the reference after which an automaton is begun anew.
AUTOMATON_WORDS = 100_000

_BASE = np.uint64(0xD6E8FEB86659FD93)


class SuffixAutomaton:
    """Suffix automaton of several sequences of numbers."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: list[int]) -> None:
        """Adds a sequence; the symbols before it have no part in it."""
        follow, link, length = self.next, self.link, self.length
        last = 0
        for symbol in sequence:
            known = follow[last].get(symbol)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._split(last, symbol, known)
                continue
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and symbol not in follow[at]:
                follow[at][symbol] = new
                at = link[at]
            if at >= 0:
                known = follow[at][symbol]
                link[new] = known if length[known] == length[at] + 1 else self._split(at, symbol, known)
            last = new

    def _split(self, at: int, symbol: int, state: int) -> int:
        """A state for the shorter part of ``state``, which is reached from ``at`` by the symbol."""
        follow, link, length = self.next, self.link, self.length
        new = len(follow)
        follow.append(dict(follow[state]))
        length.append(length[at] + 1)
        link.append(link[state])
        link[state] = new
        while at >= 0 and follow[at].get(symbol) == state:
            follow[at][symbol] = new
            at = link[at]
        return new

    def holds(self, sequence: list[int]) -> bool:
        """Whether the sequence occurs as a whole in one of those added."""
        state = 0
        for symbol in sequence:
            if (state := self.next[state].get(symbol)) is None:
                return False
        return True

    def spans(self, sequence: list[int], least: int) -> list[tuple[int, int]]:
        """The maximal spans of the sequence that occur in what was added and are of ``least`` symbols or more."""
        follow, link, length = self.next, self.link, self.length
        state = size = 0
        out: list[tuple[int, int]] = []
        for end, symbol in enumerate(sequence, 1):
            while (to := follow[state].get(symbol)) is None and state:
                state = link[state]
                size = length[state]
            if to is None:
                continue
            state = to
            size += 1
            if size >= least:
                if out and out[-1][1] >= end - size:
                    out[-1] = (min(out[-1][0], end - size), end)
                else:
                    out.append((end - size, end))
        return out


def least_grams(gram: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` consecutive grams, the place of the leftmost least one."""
    place, value, size = np.arange(len(gram)), gram, 1
    while size < width:
        move = min(size, width - size)
        left = value[:-move] <= value[move:]
        place = np.where(left, place[:-move], place[move:])
        value = np.where(left, value[:-move], value[move:])
        size += move
    return place


def runs(words: Words, length: int = LENGTH) -> dict[str, np.ndarray]:
    """The runs of all rows: row, at (first word within the row), windows, anchor, content."""
    h, rows = words.hashes(), words.rows()
    if len(h) < length:
        return {k: np.zeros(0, np.int64) for k in ("row", "at", "windows", "anchor", "content")}
    gram = ngrams(h, ANCHOR)
    place = least_grams(gram, length - ANCHOR + 1)
    window = np.flatnonzero(rows[:len(h) - length + 1] == rows[length - 1:])
    where = place[window]
    begins = np.ones(len(window), bool)
    begins[1:] = (where[1:] != where[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(begins)
    start, count = window[first], np.diff(np.append(first, len(window)))
    end = start + count + length - 1
    power = np.multiply.accumulate(np.full(len(h), _BASE))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power)])
    # (sum of h[k] * base^k over the run) / base^start, by the inverse of the base modulo 2^64
    back = np.multiply.accumulate(np.full(len(h), np.uint64(pow(int(_BASE), -1, 1 << 64))))
    content = mix((total[end] - total[start]) * back[start] + count.astype(np.uint64))
    return {"row": rows[start], "at": start - words.first[rows[start]], "windows": count,
            "anchor": gram[where[first]].view(np.int64), "content": content.view(np.int64)}


def spots(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, content, doc_id, mark, at, windows) of every run of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            got = runs(Words(*utf8(part.column("text"))), length)
            rows = pa.array(got["row"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(got["anchor"]), pa.array(got["content"]), part.column("doc_id").take(rows),
                 part.column("mark").take(rows), pa.array(got["at"].astype(np.int32)),
                 pa.array(got["windows"].astype(np.int32))],
                ["anchor", "content", "doc_id", "mark", "at", "windows"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"anchor long, content long, doc_id {kind}, mark int, at int, windows int")


def same_document(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))


def passages(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The words of the wanted runs, as hashes: (anchor, doc_id, mark, at, words).

    For a run that is marked hot, each window is a row, with the window's hash in place of the anchor.
    """
    per_document = wanted.groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("at", "windows", "anchor", "hot")).alias("runs"))
    texts = docs.alias("d").join(per_document.alias("w"), same_document("d", "w")).select(
        "d.doc_id", "d.mark", "d.text", "w.runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            words = Words(*utf8(part.column("text")))
            h = words.hashes()
            window = ngrams(h, length) if len(h) >= length else h[:0]
            row, anchor, at, content = [], [], [], []
            for k, own in enumerate(part.column("runs").to_pylist()):
                for r in own:
                    start = int(words.first[k]) + r["at"]
                    if r["hot"]:
                        for i in range(r["windows"]):
                            row.append(k)
                            anchor.append(int(window[start + i].view(np.int64)))
                            at.append(r["at"] + i)
                            content.append(None)
                    else:
                        row.append(k)
                        anchor.append(r["anchor"])
                        at.append(r["at"])
                        content.append(h[start:start + r["windows"] + length - 1].tobytes())
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), part.column("doc_id").take(rows), part.column("mark").take(rows),
                 pa.array(at, pa.int32()), pa.array(content, pa.binary())],
                ["anchor", "doc_id", "mark", "at", "words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"anchor long, doc_id {kind}, mark int, at int, words binary")


def along_automata(rows: DataFrame, length: int) -> DataFrame:
    """The repeated spans (doc_id, mark, at, end) of different runs with the same anchor, shard by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, size, now, place = SuffixAutomaton(), 0, None, None
        for batch in batches:
            row, at, end = [], [], []
            for k, (anchor, first, words, *document) in enumerate(zip(*(batch.column(c).to_pylist() for c in (
                    "anchor", "at", "words", "doc_id", "mark")), strict=True)):
                if (anchor, first, document) == place:  # the same document again
                    continue
                place = anchor, first, document
                if anchor != now:
                    now = anchor
                    if size > AUTOMATON_WORDS:
                        automaton, size = SuffixAutomaton(), 0
                sequence = np.frombuffer(words, np.int64).tolist()
                found = automaton.spans(sequence, length)
                for a, b in found:
                    row.append(k)
                    at.append(first + a)
                    end.append(first + b)
                # spans that overlap are one: covered as a whole, a run can still have new windows across a seam
                if found != [(0, len(sequence))] or not automaton.holds(sequence):
                    automaton.add(sequence)
                    size += len(sequence)
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("mark").take(rows), pa.array(at, pa.int32()),
                 pa.array(end, pa.int32())], ["doc_id", "mark", "at", "end"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "at", "mark")
            .mapInArrow(run, f"doc_id {kind}, mark int, at int, end int"))


def later_ones(rows: DataFrame, first: DataFrame, key: list[str]) -> DataFrame:
    """The rows that aren't the first of their key."""
    found = first.select(*key, F.col("first.doc_id").alias("first_id"), F.col("first.at").alias("first_at"))
    return rows.join(found, key).filter(~(F.col("doc_id").eqNullSafe(F.col("first_id"))
                                          & (F.col("at") == F.col("first_at"))))


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc_id, mark, at, end): the word spans that also start earlier; ``docs`` has doc_id, mark and text."""
    every = spots(docs, length)
    # written, so that the join has its own exchange on either side and a hot anchor's rows can be split
    shared = stored(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("low"),
                                                F.max("content").alias("high")).filter("n > 1").select(
        "anchor", (F.col("low") != F.col("high")).alias("mixed")), "shared-anchors")
    hits = stored(every.join(shared, "anchor"), "shared-runs")
    first = stored(hits.groupBy("anchor", "content", "mixed").agg(
        F.min(F.struct("doc_id", "at", "mark", "windows")).alias("first"), F.count(F.lit(1)).alias("n")), "first-runs")
    copies = later_ones(hits, first.filter("n > 1"), ["anchor", "content"]).select(
        "doc_id", "mark", "at", (F.col("at") + F.col("windows") + (length - 1)).alias("end"))
    mixed = first.filter("mixed").select("anchor", "first.*")
    # each such anchor has more than hot_runs of all runs, so there are few; still, nothing is broadcast by hand
    hot = mixed.groupBy("anchor").count().filter(F.col("count") > hot_runs).select("anchor", F.lit(True).alias("hot"))
    wanted = mixed.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    words = stored(passages(docs, wanted, length), "passages")
    windows = words.filter(F.col("words").isNull()).drop("words")
    again = later_ones(windows, windows.groupBy("anchor").agg(F.min(F.struct("doc_id", "at")).alias("first")),
                       ["anchor"]).select("doc_id", "mark", "at", (F.col("at") + length).alias("end"))
    return copies.unionByName(again).unionByName(along_automata(words.filter(F.col("words").isNotNull()), length))


def dedup(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _cut(docs, length, hot_runs, f"doc_id {kind}, n_words long, n_removed long, kept string",
                lambda kept: kept.decode("utf-8"))


def dedup_digests(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _cut(docs, length, hot_runs, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string",
                lambda kept: hashlib.sha256(kept).hexdigest())


def _cut(docs: DataFrame, length: int, hot_runs: int, schema: str, show) -> DataFrame:
    docs = docs.select("doc_id", "text", F.hash("text").alias("mark"))
    spans = repeated_spans(docs, length, hot_runs).groupBy("doc_id", "mark").agg(
        F.collect_set(F.struct("at", "end")).alias("spans"))  # no more than the words of a document
    rows = docs.alias("d").join(spans.alias("s"), same_document("d", "s"), "left").select(
        "d.doc_id", "d.text", "s.spans")
    name = schema.split(" ")[-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            total, removed, kept = [], [], []
            for text, own in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                words = (text or "").encode("utf-8").split()  # of bytes: by ASCII white space only
                total.append(len(words))
                if own:
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, [s["at"] for s in own], 1)
                    np.add.at(edges, [s["end"] for s in own], -1)
                    stay = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
                    removed.append(len(words) - len(stay))
                    words = [words[k] for k in stay]
                else:
                    removed.append(0)
                kept.append(show(b" ".join(words)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", name])

    return rows.mapInArrow(run, schema)
