"""Operator 12, language-model scoring: a hidden Markov model over the words of a text.

Base: smoothed counts of single words over all training texts.  Model: a chain of STATES hidden states; each state
has its own share of every frequent word and one share of all other words together, within which the base's shares
hold.  So a text's log probability is that of the base plus the log likelihood of the chain over the ratios
(share in the state / share in the base), and every word, known or not, has its own probability.

* Counting: one partial count per task and word is shuffled.  Words with more than 1/LISTED of all tokens are
  broadcast (there are fewer than LISTED of them whatever the input), and of those the ones with more than 1/SYMBOLS
  are the model's symbols.  All other words are joined with their counts by a shuffle, where no word is hot.
* Baum-Welch: a pass over the stored symbols of all training texts; each task adds up its expected counts, a row per
  symbol is aggregated across the tasks, and the driver gets the bounded tables of the next round.
* Likelihood: texts are cut into blocks; a block's forward recursion is a product of STATES x STATES matrices, scaled
  as it goes; the blocks' matrices are chained per text.  That is exact, and blocks of many texts run side by
  side however long the texts are.

Defined results: a null or empty text is its end token alone; a null doc_id counts as empty text in the remainder;
without training texts the base's share of anything is 1; repeated rows are learned from once each and get a row
each; an empty table gives no rows; other columns are not read; texts are read whole.  Words are compared by 64-bit
hashes.  Sums of doubles follow the order of tasks in their last digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from econ_lake.llm.shared import ASCII_LOWER, Words, mix, pieces, stored, utf8
from econ_lake.llm.terms import remainder

PARTS, HELD_OUT = 10, 0
SMOOTHING = 0.1
STATES, ROUNDS = 8, 4
#: A state's share of a symbol is so much of what it counted; the rest comes from the base, which keeps ratios bounded.
TRUST = 0.95
SYMBOLS, LISTED = 1 << 16, 1 << 20
#: The token behind the last word of a text.
END = np.int64(np.array(mix(np.array([0x656E64], np.uint64))).view(np.int64)[0])
#: Tokens of a block, blocks handled side by side, and steps between two scalings.
BLOCK, SIDE_BY_SIDE, SCALED = 128, 4096, 8
#: Distinct words that a task counts before it passes their counts on.
COUNTED = 1_000_000


def token_hashes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all rows of a batch, ends included, as hashes, and the n+1 offsets of the rows."""
    data, at = utf8(part.column("text"))
    words = Words(ASCII_LOWER[data], at)
    return (np.insert(words.hashes().view(np.int64), words.first[1:], END),
            words.first + np.arange(part.num_rows + 1))


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c): how often each token occurs in the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, c = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in pieces(batches):
            new, n = np.unique(token_hashes(part)[0], return_counts=True)
            h, back = np.unique(np.concatenate([h, new]), return_inverse=True)
            c = np.bincount(back, weights=np.concatenate([c, n]), minlength=len(h)).astype(np.int64)
            if len(h) > COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c)], ["h", "c"])
                h, c = h[:0], c[:0]
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c)], ["h", "c"])

    return texts.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Base:
    """The listed words, sorted by hash, with counts; ``symbol`` numbers those that the chain knows, -1 the others."""

    tokens: int
    types: int
    h: np.ndarray
    c: np.ndarray
    symbol: np.ndarray

    @property
    def whole(self) -> float:
        return self.tokens + SMOOTHING * (self.types + 1)

    @property
    def other(self) -> int:
        """The symbol of all words without one of their own."""
        return int(self.symbol.max(initial=-1)) + 1

    def shares(self) -> np.ndarray:
        """The base's share of each symbol."""
        own = (self.c[self.symbol >= 0] + SMOOTHING) / self.whole
        return np.append(own, max(1 - own.sum(), SMOOTHING / self.whole))


def base_of(counts: DataFrame, symbols: int = SYMBOLS, listed: int = LISTED) -> Base:
    """Reads the totals and the listed words: fewer than ``listed`` rows."""
    total = counts.agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    tokens, types = total.tokens or 0, total.types
    got = counts.filter(F.col("c") > tokens / listed).toArrow()
    h, c = got["h"].to_numpy(), got["c"].to_numpy()
    order = np.argsort(h)
    h, c = h[order], c[order]
    own = c > tokens / symbols
    return Base(tokens, types, h, c, np.where(own, np.cumsum(own) - 1, -1))


def sequences(docs: DataFrame, base: Base) -> DataFrame:
    """One row per document: rid, doc_id, held_out, n_tokens, known and log10 share of its listed tokens, its symbols
    as 2-byte integers end to end, and its other words with their numbers of occurrences."""
    logs = np.log10((base.c + SMOOTHING) / base.whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            h, at = token_hashes(part)
            row = np.repeat(np.arange(part.num_rows), np.diff(at))
            place = np.minimum(np.searchsorted(base.h, h), max(0, len(base.h) - 1))
            listed = base.h[place] == h if len(base.h) else np.zeros(len(h), bool)
            symbol = np.where(listed, base.symbol[place], -1) if len(base.h) else np.full(len(h), -1)
            seq = np.where(symbol >= 0, symbol, base.other).astype("<u2")
            n = np.bincount(row[listed], minlength=part.num_rows)
            log = np.bincount(row[listed], weights=logs[place[listed]] if len(logs) else None,
                              minlength=part.num_rows).astype(float)
            # the other words: per row, each once
            order = np.lexsort((h[~listed], row[~listed]))
            r, w = row[~listed][order], h[~listed][order]
            first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (w[1:] != w[:-1])])[:len(r)])
            cut = np.searchsorted(r[first], np.arange(part.num_rows + 1)).astype(np.int32)
            often = np.diff(np.append(first, len(r))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("rid"), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(at)),
                 pa.array(n.astype(np.int64)), pa.array(log),
                 pa.Array.from_buffers(pa.binary(), part.num_rows, [
                     None, pa.py_buffer((at * 2).astype(np.int32).tobytes()), pa.py_buffer(seq.tobytes())]),
                 pa.ListArray.from_arrays(pa.array(cut), pa.array(w[first])),
                 pa.ListArray.from_arrays(pa.array(cut), pa.array(often))],
                ["rid", "doc_id", "held_out", "n_tokens", "known", "log", "seq", "other", "often"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    held_out = (remainder(F.col("doc_id"), PARTS) == HELD_OUT).alias("held_out")
    return docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", held_out, "text").mapInArrow(
        run, f"rid long, doc_id {kind}, held_out boolean, n_tokens long, known long, log double, seq binary, "
             "other array<long>, often array<int>")


@dataclass
class Chain:
    """start: of the state before the first token; step: from state to state; ratio: per symbol and state, the state's
    share over the base's."""

    start: np.ndarray
    step: np.ndarray
    ratio: np.ndarray


class Blocks:
    """The symbols of a batch cut into blocks, longest first, so that at each step a head of them is still on."""

    def __init__(self, column: pa.Array):
        at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // 2
        raw = column.buffers()[2]
        self.seq = np.frombuffer(raw, "<u2") if raw is not None else np.zeros(0, "<u2")
        size = np.diff(at)
        self.per_row = -(-size // BLOCK)
        self.row = np.repeat(np.arange(len(size)), self.per_row)
        self.nth = np.arange(len(self.row)) - np.repeat(np.cumsum(self.per_row) - self.per_row, self.per_row)
        self.start = at[:-1][self.row] + self.nth * BLOCK
        self.size = np.minimum(BLOCK, at[1:][self.row] - self.start)

    def groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
        """(numbers of the blocks, symbols as steps x blocks, blocks that are on at each step)."""
        order = np.argsort(-self.size, kind="stable")
        for k in range(0, len(order), SIDE_BY_SIDE):
            some = order[k:k + SIDE_BY_SIDE]
            steps = int(self.size[some[0]])
            place = self.start[some][None] + np.arange(steps)[:, None]
            on = np.searchsorted(-self.size[some], -np.arange(steps), "left")
            yield some, self.seq[np.minimum(place, len(self.seq) - 1)], on.tolist()


def transfers(blocks: Blocks, chain: Chain) -> tuple[np.ndarray, np.ndarray]:
    """Per block the product of its steps, scaled, and the log of the scale."""
    s = len(chain.start)
    product, log = np.empty((len(blocks.row), s, s)), np.zeros(len(blocks.row))
    for some, symbols, on in blocks.groups():
        m, scale = np.repeat(np.eye(s)[None], len(some), 0), np.zeros(len(some))
        for t, n in enumerate(on):
            m[:n] = (m[:n].reshape(-1, s) @ chain.step).reshape(n, s, s) * chain.ratio[symbols[t, :n]][:, None, :]
            if t % SCALED == SCALED - 1:
                top = m[:n].max((1, 2))
                m[:n] /= top[:, None, None]
                scale[:n] += np.log(top)
        product[some], log[some] = m, scale
    return product, log


def chained(blocks: Blocks, product: np.ndarray, log: np.ndarray, chain: Chain
            ) -> tuple[np.ndarray, np.ndarray]:
    """The forward vector before each block, scaled, and each row's natural log likelihood."""
    rows, s = len(blocks.per_row), len(chain.start)
    before, now, total = np.empty((len(blocks.row), s)), np.repeat(chain.start[None], rows, 0), np.zeros(rows)
    for k, at in rounds_of(blocks):
        before[at] = now[k]
        v = (now[k][:, None, :] @ product[at])[:, 0]
        size = v.sum(1)
        now[k] = v / size[:, None]
        total[k] += np.log(size) + log[at]
    return before, total


def rounds_of(blocks: Blocks, last_first: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their next block), until no row has one left."""
    first = np.cumsum(blocks.per_row) - blocks.per_row
    for n in range(int(blocks.per_row.max(initial=0))):
        rows = np.flatnonzero(blocks.per_row > n)
        yield rows, first[rows] + (blocks.per_row[rows] - 1 - n if last_first else n)


def expected(blocks: Blocks, chain: Chain, emit: np.ndarray, step: np.ndarray, start: np.ndarray) -> float:
    """Adds the expected counts of all rows of a batch to the three tables; returns their log likelihood."""
    s = len(chain.start)
    product, log = transfers(blocks, chain)
    before, total = chained(blocks, product, log, chain)
    behind, now = np.empty((len(blocks.row), s)), np.ones((len(blocks.per_row), s))
    for k, at in rounds_of(blocks, last_first=True):
        behind[at] = now[k]
        v = (product[at] @ now[k][:, :, None])[:, :, 0]
        now[k] = v / v.sum(1)[:, None]
    if len(now):
        first = chain.start * now
        start += (first / first.sum(1)[:, None]).sum(0)
    for some, symbols, on in blocks.groups():
        a = before[some]
        alpha = [a]
        for t, n in enumerate(on):
            a = (a[:n] @ chain.step) * chain.ratio[symbols[t, :n]]
            a /= a.sum(1)[:, None]
            alpha.append(a)
        b = behind[some].copy()
        states = np.empty((sum(on), s))
        end = len(states)
        for t in range(len(on) - 1, -1, -1):
            n, last = on[t], alpha[t][:on[t]]
            ahead = chain.ratio[symbols[t, :n]] * b[:n]
            come = last @ chain.step
            ahead /= (come * ahead).sum(1)[:, None]
            states[end - n:end] = come * ahead
            end -= n
            step += last.T @ ahead * chain.step
            b[:n] = ahead @ chain.step.T
        flat = np.concatenate([symbols[t, :n] for t, n in enumerate(on)])
        for k in range(s):
            emit[:, k] += np.bincount(flat, weights=states[:, k], minlength=len(emit))
    return float(total.sum())


def first_chain(base: Base, states: int, seed: int = 1) -> Chain:
    """Sticky steps, and shares off the base's at random."""
    rng = np.random.default_rng(seed)
    share = base.shares()[:, None] * rng.uniform(0.5, 1.5, (base.other + 1, states))
    step = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(step, 0.9)
    return Chain(np.full(states, 1 / states), step / step.sum(1)[:, None],
                 share / share.sum(0) / base.shares()[:, None])


def trained_once(seqs: DataFrame, chain: Chain, base: Base) -> tuple[Chain, float]:
    """A round of Baum-Welch over all training texts: the next chain, and the log likelihood under this one.

    The rows that tasks give: a symbol with its expected counts by state; behind the symbols the steps from each
    state, the start, and the log likelihood.
    """
    s, n = len(chain.start), base.other + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((n + s + 2, s))
        for part in pieces(batches, "seq"):
            table[n + s + 1, 0] += expected(Blocks(part.column("seq")), chain, table[:n], table[n:n + s], table[n + s])
        some = np.flatnonzero(np.abs(table).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(list(table[some]), pa.list_(pa.float64()))],
                                         ["symbol", "n"])

    parts = seqs.filter("not held_out").select("seq").mapInArrow(run, "symbol long, n array<double>")
    got = parts.groupBy("symbol").agg(*[F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(s)]).toArrow()
    table = np.zeros((n + s + 2, s))
    table[got["symbol"].to_numpy()] = np.stack([got[f"n{k}"].to_numpy() for k in range(s)], 1)
    emit, step, start, log = table[:n], table[n:n + s] + 1 / s, table[n + s] + 1 / s, table[n + s + 1, 0]
    share = base.shares()[:, None]
    emit = TRUST * (emit + share) / (emit + share).sum(0) + (1 - TRUST) * share
    return Chain(start / start.sum(), step / step.sum(1)[:, None], emit / share), float(log)


def fit(seqs: DataFrame, base: Base, states: int = STATES, rounds: int = ROUNDS) -> Chain:
    chain = first_chain(base, states)
    for _ in range(rounds):
        chain, _ = trained_once(seqs, chain, base)
    return chain


def gains(seqs: DataFrame, chain: Chain) -> DataFrame:
    """rid, doc_id, held_out, n_tokens, known, log, and gain: the log10 likelihood of the chain over the base."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "seq"):
            blocks = Blocks(part.column("seq"))
            _, total = chained(blocks, *transfers(blocks, chain), chain)
            yield pa.RecordBatch.from_arrays(
                [*part.drop_columns("seq").columns, pa.array(total / np.log(10))], [*names, "gain"])

    rows = seqs.select("rid", "doc_id", "held_out", "n_tokens", "known", "log", "seq")
    names = rows.columns[:-1]
    kind = seqs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"rid long, doc_id {kind}, held_out boolean, n_tokens long, known long, log double, "
                                "gain double")


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, symbols: int = SYMBOLS, listed: int = LISTED
          ) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    learn = docs.filter(remainder(F.col("doc_id"), PARTS) != HELD_OUT)
    counts = stored(word_counts(learn), "counts")
    base = base_of(counts, symbols, listed)
    seqs = stored(sequences(docs, base), "sequences")
    rows = gains(seqs, fit(seqs, base, states, rounds))
    # the words that aren't listed, known or not: no word has more than 1/LISTED of the tokens
    other = seqs.select("rid", F.explode(F.arrays_zip("other", "often")).alias("w")).select("rid", "w.*")
    c = F.coalesce("c", F.lit(0))
    shares = (other.join(counts.filter(F.col("c") <= base.tokens / listed), other.other == F.col("h"), "left")
              .groupBy("rid").agg(F.sum(F.col("often") * F.log10((c + SMOOTHING) / base.whole)).alias("more"),
                                  F.sum(F.when(c > 0, F.col("often")).otherwise(0)).alias("more_known")))
    total = F.col("log") + F.coalesce("more", F.lit(0.0))
    return rows.join(shares, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(base.tokens).cast("long").alias("train_tokens"), total.alias("base_score"),
        (total + F.col("gain")).alias("score"))
