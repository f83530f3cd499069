"""Operator 9, n-gram Jaccard join: a universe-partition pigeonhole.

A document's set is its distinct 5-word shingles (A-Z lower-cased).  Sets of Jaccard 0.8 or more differ in at most
H elements, H by their sizes.  The universe of shingles is dealt out by hash into segments, whose number follows
the size band; a set is indexed by hashes of its (non-empty) segments.

* Equality: H differences spoil H segments at most.  Put in one order over all sets, the first H + 1 segments of two
  similar sets share one.  The order is by cost: the number of sets that have the segment's rarest shingle, from a
  count sketch of fixed size over all documents.  So of more segments than needed the cheapest are used.
* One-deletion neighbourhoods: tiny sets (up to 8) are one segment, which may differ in one element; they are indexed
  by the whole set and by the set without each of its elements.
* Bands: a pair belongs to the band of its smaller set.  Sets just above a band's lower end are indexed in both.

Sets with an index entry in common are candidates.  A parity bitmap (two sets differ in no fewer elements than their
bitmaps in bits) drops most wrong ones, then the shingles of both whole texts are compared.

Equal sets are brought together first; only one of them takes part.  Of an entry with up to GROUP sets all pairs are
candidates.  Of a larger one, all sets are candidates with one hub, the set that is in most large entries (of near
copies, the one with the fewest changes).  Where that doesn't bring all its sets into one component, those outside
its largest component are compared with all its sets of other components, block by block within tasks, and what
their bitmaps allow are candidates too: no link is lost, and no pairs but these leave a task.

Defined results: a text without words (or null) has an empty set and is linked with nothing; a null doc_id takes part
in equal sets only, and is never the least; rows with the same doc_id are one document; an empty table gives no rows;
a similarity of exactly 0.8 links; other columns are not read; texts are read whole, whatever their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.components import components
from econ_lake.llm.shared import ASCII_LOWER, Words, mix, ngrams, pieces, stored, utf8

SHINGLE = 5
#: Jaccard of 0.8 or more, in hundredths.
LEAST = 80
#: Cells of the count sketch, and of a block of it.
CELLS, BLOCK = 1 << 22, 1 << 16
TINY, SMALL = 8, 128
GROUP = 24
#: Sets of a large entry whose bitmaps a task holds at a time.
BLOCK_SETS = 2_048
#: Rows up to which ids are broadcast; beyond, the joins shuffle.
BROADCAST_ROWS = 1_000_000
#: Texts that are compared with one other in a task.
PER_SALT = 512

_U = np.uint64


# ------------------------------------------------------------------ sets


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    data, at = utf8(column)
    words = Words(ASCII_LOWER[data], at)
    h = words.hashes()
    grams = ngrams(h, SHINGLE) if len(h) >= SHINGLE else h[:0]
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif b > a:
            out.append(mix(ngrams(h[a:b], b - a) + _U(b - a)))
        else:
            out.append(h[:0])
    return out


def set_hash(u: np.ndarray, key: int = 1) -> int:
    """An order-free 64-bit hash of a set, signed."""
    return int(mix(u + _U(key)).sum(dtype=np.uint64).view(np.int64))


def parity_bits(u: np.ndarray) -> bytes:
    """A bitmap that flips one bit per element; its width follows the size, in powers of two."""
    width = max(64, 8 << (len(u).bit_length() - 1)) if len(u) else 64
    return np.packbits(np.bincount((u >> _U(17)).astype(np.int64) & (width - 1), minlength=width).astype(np.uint8) & 1,
                       bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """The number of bits in which two parity bitmaps differ, at the lesser of their widths."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap (or the rows of bitmaps) that the same set has at a lesser width."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def most_apart(total: int) -> int:
    """The most elements in which two similar sets can differ that have ``total`` elements together."""
    return total - 2 * -(-LEAST * total // (100 + LEAST))


def most_apart_up_to(total: int) -> int:
    """The same for any total up to this one; the bound repeats, one higher, every nine."""
    return max(most_apart(t) for t in range(max(0, total - 9), total + 1))


# ------------------------------------------------------------------ index entries


def band(n: int) -> int:
    """The least size of n's band: 1 (tiny), 8 (small), then powers of two from 128."""
    return 1 if n < TINY else TINY if n < SMALL else 1 << (n.bit_length() - 1)


def bands(n: int) -> list[tuple[int, int]]:
    """The bands in which a set of n elements is indexed, each with the largest size that it can meet there."""
    own = band(n)
    out = [(own, 100 * n // LEAST)]
    if own > 1 and -(-LEAST * n // 100) < own:
        out.append((band(own - 1), own - 1))
    return out


def entries(u: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """The index entries of a set; ``cost`` is the sketch, by cell."""
    n, out = len(u), []
    for base, largest in bands(n):
        salt = _U(base * 2 + 1)
        if base == 1:
            each = mix(u + salt)
            whole = each.sum(dtype=np.uint64)
            if 4 <= n < TINY:
                out.append(mix(np.array([whole + _U(n)])))
            if n > 4:
                out.append(mix(whole - each + _U(n - 1)))
            continue
        if base == TINY:  # segments of one shingle each
            entry, price = mix(u + salt), cost[cells(u)]
            need = n - -(-LEAST * (n + -(-LEAST * n // 100)) // (100 + LEAST)) + 1
        else:
            spread = mix(u + salt)
            segment = (spread >> _U(32)) % _U(base * 3 // 4)
            order = np.argsort(segment, kind="stable")
            heads = np.flatnonzero(np.diff(segment[order], prepend=_U(1 << 40)))
            entry = mix(np.add.reduceat(spread[order], heads) + segment[order][heads])
            price = np.minimum.reduceat(cost[cells(u)][order], heads)
            need = most_apart_up_to(n + largest) + 1
        if len(entry) < need:
            raise ValueError(f"{len(entry)} segments of {n} shingles: {need} are needed; use more of them")
        if len(entry) > need:
            rank = price.astype(np.uint64) << _U(56) | entry >> _U(8)
            entry = entry[np.argpartition(rank, need - 1)[:need]]
        out.append(entry)
    return np.concatenate(out) if out else u[:0]


def cells(u: np.ndarray) -> np.ndarray:
    return (u >> _U(40)).astype(np.int64) & (CELLS - 1)


# ------------------------------------------------------------------ passes over the documents


def _set_rows(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n, s1, s2, bits.  Per task: its part of the sketch, in blocks (block, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(CELLS, np.uint32)
        for part in pieces(batches):
            sets = shingle_sets(part.column("text"))
            np.add.at(sketch, cells(np.concatenate(sets)), np.uint32(1))
            n = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()),
                 pa.array([set_hash(u) for u in sets], pa.int64()),
                 pa.array([set_hash(u, 0x5BD1E995) for u in sets], pa.int64()),
                 pa.array(list(map(parity_bits, sets)), pa.binary()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        own = [k for k in range(CELLS // BLOCK) if sketch[k * BLOCK:(k + 1) * BLOCK].any()]
        packed = [zlib.compress(sketch[k * BLOCK:(k + 1) * BLOCK].tobytes(), 1) for k in own]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(own), kind)] + [pa.nulls(len(own), pa.int64())] * 3 + [pa.nulls(len(own), pa.binary()),
             pa.array(own, pa.int32()), pa.array(packed, pa.binary())], names)

    from pyspark.sql.pandas.types import to_arrow_type

    names = ["doc_id", "n", "s1", "s2", "bits", "block", "counts"]
    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, s1 long, s2 long, "
                                "bits binary, block int, counts binary")


def _costs(parts: DataFrame) -> np.ndarray:
    """The sketch of all documents on a logarithmic scale, one byte a cell: CELLS bytes, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block != now:
                    if now is not None:
                        yield row(now, total)
                    now, total = block, np.zeros(BLOCK, np.uint64)
                total += np.frombuffer(zlib.decompress(counts), np.uint32)
        if now is not None:
            yield row(now, total)

    def row(block: int, total: np.ndarray) -> pa.RecordBatch:
        level = np.minimum(255, np.round(8 * np.log2(1.0 + total))).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([level.tobytes()], pa.binary())],
                                          ["block", "counts"])

    cost = np.zeros(CELLS, np.uint8)
    for block, level in (parts.select("block", "counts").repartition(CELLS // BLOCK, "block")
                         .sortWithinPartitions("block").mapInArrow(run, "block int, counts binary").collect()):
        cost[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(level, np.uint8)
    return cost


def _entry_rows(docs: DataFrame, cost: np.ndarray) -> DataFrame:
    """(entry, set, n) of all index entries."""
    sketch = docs.sparkSession.sparkContext.broadcast(cost)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            sets = {set_hash(u): u for u in shingle_sets(part.column("text")) if len(u)}
            own = [entries(u, sketch.value) for u in sets.values()]
            many = list(map(len, own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*own, np.zeros(0, np.uint64)]).view(np.int64)),
                 pa.array(np.repeat(np.array(list(sets), np.int64), many)),
                 pa.array(np.repeat(np.array([len(u) for u in sets.values()], np.int32), many))],
                ["entry", "set", "n"])

    return docs.select("text").mapInArrow(run, "entry long, set long, n int")


def _candidates(rows: DataFrame, group: int = GROUP) -> DataFrame:
    """Pairs (a, b) of sets with an entry in common; of entries with more than ``group`` sets, the rows (entry, a, n).

    Rows are streamed in the order of entries, and no more than ``group`` of them are held over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        large = None  # a large entry that goes on
        for batch in batches:
            got = [np.concatenate([k, c.to_numpy()]) for k, c in zip(kept, batch.columns, strict=True)]
            if not len(got[0]):
                continue
            new = np.ones(len(got[0]), bool)
            new[1:] = (got[0][1:] != got[0][:-1]) | (got[1][1:] != got[1][:-1])
            entry, sets, n = (x[new] for x in got)
            heads = np.flatnonzero(np.diff(entry, prepend=~entry[:1]))
            size = np.diff(np.append(heads, len(entry)))
            if large is not None and entry[0] == large:
                yield members(entry[:size[0]], sets[:size[0]], n[:size[0]])
                heads, size = heads[1:], size[1:]
            kept = [x[:0] for x in kept]
            if len(heads):  # the last entry may go on in the next batch
                large = entry[heads[-1]] if size[-1] > group else None
                if large is None:
                    kept = [x[heads[-1]:] for x in (entry, sets, n)]
                    heads, size = heads[:-1], size[:-1]
            yield from (x for x in whole(entry, sets, n, heads, size) if x.num_rows)
        if len(kept[0]):
            yield from whole(*kept, np.array([0]), np.array([len(kept[0])]))

    def whole(entry, sets, n, heads, size) -> list[pa.RecordBatch]:
        """What entries give that begin at ``heads`` and have ``size`` rows."""
        heads, size = heads[size > 1], size[size > 1]
        if not len(heads):
            return []
        first, many = np.repeat(heads, size), np.repeat(size, size)
        at = first + np.arange(len(first)) - np.repeat(np.cumsum(size) - size, size)
        big = many > group
        out = [members(entry[at[big]], sets[at[big]], n[at[big]])]
        at, last = at[~big], (first + many)[~big]
        for step in range(1, group):
            left = at[at + step < last]
            if not len(left):
                break
            right = left + step
            fit = similar_sizes(n[left], n[right]) & (sets[left] != sets[right])
            left, right = left[fit], right[fit]
            out.append(pa.RecordBatch.from_arrays(
                [pa.nulls(len(left), pa.int64()), pa.array(sets[left]), pa.array(sets[right]),
                 pa.nulls(len(left), pa.int32())], ["entry", "a", "b", "n"]))
        return out

    def members(entry, sets, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(entry), pa.array(sets), pa.nulls(len(sets), pa.int64()), pa.array(n.astype(np.int32))],
            ["entry", "a", "b", "n"])

    return (rows.repartition("entry").sortWithinPartitions("entry", "set")
            .mapInArrow(run, "entry long, a long, b long, n int"))


def similar_sizes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(x, y).astype(np.int64) >= LEAST * np.maximum(x, y).astype(np.int64)


def _hub_pairs(large: DataFrame) -> DataFrame:
    """Pairs (a, b) of each set of a large entry with the entry's hub."""
    often = large.groupBy("a").agg(F.count(F.lit(1)).alias("often"))
    hubs = (large.join(often, "a").groupBy("entry").agg(
        F.max_by(F.struct(F.col("a").alias("hub"), F.col("n").alias("hub_n")), F.struct("often", "a")).alias("h"))
        .select("entry", "h.*"))
    fit = 100 * F.least("n", "hub_n") >= LEAST * F.greatest("n", "hub_n")
    return large.join(hubs, "entry").filter(fit & (F.col("a") != F.col("hub"))).select(
        F.col("hub").alias("a"), F.col("a").alias("b")).distinct()


# ------------------------------------------------------------------ comparison


def at_hand(df: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it has BROADCAST_ROWS at most; else joins shuffle it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose parity bitmaps allow a link: (u, u_set, v, v_set), by the least doc_id of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bits_apart(a, b) <= most_apart(na + nb) for a, b, na, nb in zip(
                *(batch.column(c).to_pylist() for c in ("u_bits", "v_bits", "u_n", "v_n")), strict=True)]
            yield batch.select(["u", "u_set", "v", "v_set"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str, key: str) -> DataFrame:
        return nodes.select(F.col("doc_id").alias(name), F.col("s1").alias(key), F.col("n").alias(f"{name}_n"),
                            F.col("bits").alias(f"{name}_bits"))

    kind = nodes.schema["doc_id"].dataType.simpleString()
    return (pairs.join(side("u", "a"), "a").join(side("v", "b"), "b")
            .withColumnsRenamed({"a": "u_set", "b": "v_set"})
            .mapInArrow(run, f"u {kind}, u_set long, v {kind}, v_set long"))


def _verified(docs: DataFrame, near: DataFrame) -> DataFrame:
    """The links (u, v) among the pairs: both whole texts are compared.

    The texts v of one u meet it in tasks of PER_SALT each; a task holds the shingles of one u at a time."""
    near = stored(near, "near-pairs")
    hubs = near.groupBy("u", "u_set").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "salts", F.ceil(F.col("n") / PER_SALT).cast("int"))
    ones = hubs.select(F.col("u").alias("doc_id"), F.col("u_set").alias("expected"), "u", "u_set",
                       F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("part"))
    others = near.join(hubs, ["u", "u_set"]).select(
        F.col("v").alias("doc_id"), F.col("v_set").alias("expected"), "u", "u_set",
        F.pmod(F.xxhash64("v"), "salts").cast("int").alias("salt"), F.lit(1).alias("part"))
    sent = stored(ones.unionByName(others), "to-compare")
    rows = docs.join(at_hand(sent), "doc_id").select("u", "u_set", "salt", "part", "doc_id", "expected", "text")
    key = ["u", "u_set", "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, None
        for part in pieces(batches):
            u, v = [], []
            for at, which, doc_id, expected, mine in zip(
                    zip(*(part.column(c).to_pylist() for c in key), strict=True),
                    *(part.column(c).to_pylist() for c in ("part", "doc_id", "expected")),
                    shingle_sets(part.column("text")), strict=True):
                if set_hash(mine) != expected:  # another text with the same doc_id
                    continue
                if which == 0:
                    now, own = at, mine
                elif at == now:
                    same = int(np.isin(mine, own, assume_unique=True).sum())
                    if 100 * same >= LEAST * (len(mine) + len(own) - same):
                        u.append(at[0])
                        v.append(doc_id)
            yield pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind)], ["u", "v"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    name = docs.schema["doc_id"].dataType.simpleString()
    return (rows.repartition(*key).sortWithinPartitions(*key, "part", "doc_id")
            .mapInArrow(run, f"u {name}, v {name}"))


def _unresolved(large: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates (a, b) across components, of large entries whose sets aren't all in one.

    The sets outside an entry's largest component meet all its sets, these in blocks of BLOCK_SETS: a task holds the
    bitmaps of one block and streams the others along it.
    """
    of_set = nodes.filter("doc_id is not null").select(F.col("s1").alias("a"), "doc_id", "bits").join(
        found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "a", "bits", F.coalesce("component", "doc_id").alias("component"))
    rows = stored(large.join(of_set, "a"), "large-entries")
    parts = rows.groupBy("entry", "component").agg(F.count(F.lit(1)).alias("sets"))
    torn = stored(parts.groupBy("entry").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("sets").alias("sets"),
        F.max_by("component", F.struct("sets", "component")).alias("main")).filter("parts > 1").select(
        "entry", "main", F.ceil(F.col("sets") / BLOCK_SETS).cast("int").alias("blocks")), "torn-entries")
    rows = rows.join(torn, "entry")
    block = F.pmod(F.xxhash64("a"), "blocks").cast("int")
    loose = F.col("component") != F.col("main")
    targets = rows.withColumns({"block": block, "role": F.lit(0), "loose": loose})
    seekers = rows.filter(loose).withColumns({
        "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "role": F.lit(1), "loose": F.lit(True)})
    columns = ["entry", "block", "role", "a", "n", "component", "loose", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, []
        for batch in batches:
            seeking = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != now:
                    yield from meet(seeking, block)
                    now, block, seeking = row[:2], [], []
                (seeking if row[2] else block).append(row[3:])
            yield from meet(seeking, block)

    def meet(seeking: list, block: list) -> Iterator[pa.RecordBatch]:
        """The pairs of a seeker and a set of the block that may be links; of two loose ones, each pair once."""
        for wide in sorted({len(x[4]) for x in seeking}):
            for far in sorted({len(x[4]) for x in block}):
                left, right = [x for x in seeking if len(x[4]) == wide], [x for x in block if len(x[4]) == far]
                words = min(wide, far) // 8
                a, n, part = (np.array([x[k] for x in left]) for k in (0, 1, 2))
                b, m, other, free = (np.array([x[k] for x in right]) for k in (0, 1, 2, 3))
                bits = folded(np.frombuffer(b"".join(x[4] for x in left), np.uint64).reshape(len(left), -1), words)
                most = folded(np.frombuffer(b"".join(x[4] for x in right), np.uint64).reshape(len(right), -1), words)
                for k in range(len(left)):
                    fit = (part[k] != other) & (~free | (a[k] < b)) & similar_sizes(n[k], m)
                    at = np.flatnonzero(fit)
                    if len(at):
                        apart = np.bitwise_count(bits[k] ^ most[at]).sum(1)
                        total = n[k] + m[at]
                        at = at[apart <= total - 2 * -(-LEAST * total // (100 + LEAST))]
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), a[k])), pa.array(b[at])], ["a", "b"])

    key = columns[:2]
    return (targets.select(*columns).unionByName(seekers.select(*columns)).repartition(*key)
            .sortWithinPartitions(*key, "role", "a").mapInArrow(run, "a long, b long").distinct())


def similar_groups(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles, component_id of each row."""
    docs = docs.select("doc_id", "text")
    first = stored(_set_rows(docs), "sets")
    sets = first.filter("block is null").drop("block", "counts")
    cost = _costs(first.filter("block is not null"))
    key = ["n", "s1", "s2"]
    nodes = stored(sets.filter("n > 0").groupBy(*key).agg(F.min("doc_id").alias("doc_id"),
                                                          F.first("bits").alias("bits")), "nodes")
    # copies of a set add nothing to the index
    copies = stored(sets.join(nodes.select(*key, F.col("doc_id").alias("least")), key).filter("doc_id <> least")
                    .select("doc_id"), "copies")
    indexed = docs.join(at_hand(copies), "doc_id", "left_anti")
    found = stored(_candidates(_entry_rows(indexed, cost), group), "candidates")
    large = found.filter("entry is not null").select("entry", "a", "n").distinct()
    pairs = found.filter("entry is null").select("a", "b").unionByName(_hub_pairs(large)).distinct()
    links = stored(_verified(docs, _near(pairs, nodes)), "links")
    classes = stored(components(links), "classes")
    if not large.isEmpty():
        more = stored(_unresolved(large, nodes, classes), "more-pairs")
        if not more.isEmpty():
            links = links.unionByName(_verified(docs, _near(more, nodes)))
            classes = stored(components(links), "classes")
    of_node = nodes.select(*key, F.col("doc_id").alias("node")).join(classes, "node", "left").select(
        *key, F.coalesce("component", "node").alias("component"))
    return sets.join(of_node, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows, with all columns, whose doc_id is the least of its group; the others go."""
    gone = stored(similar_groups(docs).filter("doc_id <> component_id").select("doc_id").distinct(), "near-copies")
    return docs.join(at_hand(gone), "doc_id", "left_anti").select(*docs.columns)
