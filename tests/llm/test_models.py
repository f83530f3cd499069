"""Centroid clustering, Markov scores and importance resampling against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from econ_lake.llm import centroids, markov, resampling

# ------------------------------------------------------------------ centroids


def brute_clusters(rows, k, rounds, size, seed=2):
    pts = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
           if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]

    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def mark(i):
        return hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()

    cents = [v for _, v in sorted(pts, key=lambda p: (mark(p[0]), [x.to_bytes(4, 'little', signed=True) for x in p[1]]))
             [:k]]

    def assign():
        return [min((apart(v, c), j) for j, c in enumerate(cents)) for _, v in pts]

    for _ in range(rounds):
        near = [j for _, j in assign()]
        for j in range(len(cents)):
            own = [v for (_, v), a in zip(pts, near, strict=True) if a == j]
            if own:
                cents[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    last = assign()
    inertia = Counter()
    for d, j in last:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(pts, last, strict=True))


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("cluster", T.StringType()), T.StructField("v", T.StringType())])


def vectors(seed, n, size, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.uniform(-3, 3) for _ in range(size)] for _ in range(6)]
    out = [(k, [float(np.float32(m + rng.gauss(0, spread))) for m in rng.choice(middles)]) for k in range(n)]
    # repeated vectors, repeated rows, a tie half way, and vectors that aren't whole
    out += [(n + k, out[3][1]) for k in range(40)] + [out[5], out[5], (None, out[9][1]), (None, out[9][1])]
    out += [(n + 90, None), (n + 91, []), (n + 92, [0.5] * (size - 1)), (n + 93, [float("nan")] + [0.0] * (size - 1)),
            (n + 94, [float("inf")] * size), (n + 95, [None] + [0.0] * (size - 1)), (n + 96, [0.0] * size)]
    return out


@pytest.mark.parametrize(("seed", "size", "k", "spread"), [(1, 64, 40, 0.3), (2, 2, 9, 1.0), (3, 1, 5, 0.01)])
def test_clusters_like_brute_force(spark, seed, size, k, spread):
    rows = vectors(seed, 300, size, spread)
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VECTORS)
    got = Counter(tuple(r) for r in centroids.clusters(frame, k, 4, size=size).collect())
    assert got == brute_clusters(rows, k, 4, size)


def test_few_and_no_vectors(spark):
    few = vectors(4, 20, 64)[:3]
    frame = spark.createDataFrame([(i, v, None, None) for i, v in few], VECTORS)
    assert Counter(tuple(r) for r in centroids.clusters(frame).collect()) == brute_clusters(few, 40, 5, 64)
    for none in ([], [(1, None, None, None), (2, [1.0], None, None)]):
        rows = centroids.clusters(spark.createDataFrame(none, VECTORS))
        assert rows.count() == 0 and rows.columns[:3] == ["vec_id", "cluster", "distance"]


def test_vectors_that_a_long_cannot_measure_are_refused(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64, None, None)], VECTORS)
    with pytest.raises(Exception, match="don't fit a long"):
        centroids.clusters(frame).collect()


def test_the_search_skips_what_cannot_be_near():
    """Two far groups: a walk in one of them ends before the other's centroids; ties go to the smaller number."""
    cents = np.array([[0, 0], [4, 0], [1000, 0], [1004, 0], [1000, 4], [4, 0]], np.int64)
    near, far = centroids.Orchard(cents).nearest(np.array([[2, 0], [4, 1], [1003, 0], [1000, 2]], np.int64))
    assert near.tolist() == [0, 1, 3, 2] and far.tolist() == [4, 1, 1, 4]


# ------------------------------------------------------------------ Markov scores


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def learns(doc_id):
    return crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 != 0


def plain_base(pairs):
    c = Counter(w for i, t in pairs if learns(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return c, n, v


def plain_log(symbols, chain):
    """The forward recursion of one text, one token at a time."""
    a, log = chain.start, 0.0
    for s in symbols:
        a = (a @ chain.step) * chain.ratio[s]
        log += math.log(a.sum())
        a = a / a.sum()
    return log


def column_of(seqs):
    at = np.concatenate([[0], np.cumsum([2 * len(s) for s in seqs])]).astype(np.int32)
    flat = np.concatenate([np.array(s, "<u2") for s in seqs])
    return pa.Array.from_buffers(pa.binary(), len(seqs), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(flat.tobytes())])


def some_chain(rng, states, symbols):
    def shares(*shape):
        x = rng.uniform(0.1, 1, shape)
        return x / x.sum(-1, keepdims=True)

    return markov.Chain(shares(states), shares(states, states), rng.uniform(0.05, 20, (symbols, states)))


@pytest.mark.parametrize(("block", "side"), [(128, 4096), (4, 3), (1, 1)])
def test_expected_counts_like_a_plain_forward_backward(monkeypatch, block, side):
    monkeypatch.setattr(markov, "BLOCK", block)
    monkeypatch.setattr(markov, "SIDE_BY_SIDE", side)
    rng = np.random.default_rng(5)
    s, b = 3, 11
    chain = some_chain(rng, s, b)
    seqs = [rng.integers(0, b, n).tolist() for n in (1, 2, 9, 130, 300, 1, 37)]
    emit, step, start = np.zeros((b, s)), np.zeros((s, s)), np.zeros(s)
    total = markov.expected(markov.Blocks(column_of(seqs)), chain, emit, step, start)
    assert total == pytest.approx(sum(plain_log(q, chain) for q in seqs), rel=1e-12)
    want_e, want_t, want_s = np.zeros((b, s)), np.zeros((s, s)), np.zeros(s)
    for q in seqs:
        alpha = [chain.start]
        for x in q:
            a = (alpha[-1] @ chain.step) * chain.ratio[x]
            alpha.append(a / a.sum())
        beta = np.ones(s)
        for t in range(len(q) - 1, -1, -1):
            pair = alpha[t][:, None] * chain.step * (chain.ratio[q[t]] * beta)[None]
            pair /= pair.sum()
            want_t += pair
            want_e[q[t]] += pair.sum(0)
            beta = chain.step @ (chain.ratio[q[t]] * beta)
            beta /= beta.sum()
        want_s += chain.start * beta / (chain.start * beta).sum()
    assert np.allclose(emit, want_e) and np.allclose(step, want_t) and np.allclose(start, want_s)


@pytest.mark.parametrize(("symbols", "listed"), [(markov.SYMBOLS, markov.LISTED), (40, 60), (1, 1)])
def test_scores_like_a_plain_model(spark, doc_frame, corpus, symbols, listed):
    """Base, counts and exact likelihood, with all words listed, with some of them, and with none."""
    pairs = [*corpus, (None, "one"), (3, "one ONE"), (3, "one ONE"), (900, "never seen before " * 3),
             (901, " ".join(f"w{k % 50}" for k in range(3000)))]
    docs = doc_frame(pairs)
    c, n, v = plain_base(pairs)
    whole = n + 0.1 * (v + 1)
    learn = docs.filter(markov.remainder(docs.doc_id, 10) != 0)
    base = markov.base_of(markov.word_counts(learn), symbols, listed)
    assert (base.tokens, base.types) == (n, v)
    chain = markov.fit(markov.sequences(docs, base), base, 4, 2)
    shares = base.shares()
    assert shares.sum() == pytest.approx(1)
    assert np.allclose((chain.ratio * shares[:, None]).sum(0), 1) and np.allclose(chain.step.sum(1), 1)
    rank = {int(h): int(s) for h, s in zip(base.h, base.symbol, strict=True) if s >= 0}

    def hashed(words):
        at = np.cumsum([0] + [len(w.encode()) + 1 for w in words])
        data = np.frombuffer(" ".join([*words, ""]).encode(), np.uint8)
        return markov.Words(data, np.array([0, len(data)])).hashes().view(np.int64) if len(at) > 1 else []

    want = Counter()
    for i, t in pairs:
        w = tokens(t)
        symbol = [rank.get(int(h), base.other) for h in [*hashed(w[:-1]), markov.END]]
        b = sum(math.log10((c[x] + 0.1) / whole) for x in w)
        want[i, not learns(i), len(w), sum(c[x] > 0 for x in w), n, round(b, 6),
             round(b + plain_log(symbol, chain) / math.log(10), 5)] += 1
    got = markov.score(docs, 4, 2, symbols, listed).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6),
                    round(r.score, 5)) for r in got) == want


def test_training_helps_and_held_out_texts_gain(spark, doc_frame):
    """Texts of two kinds of words: the chain tells the kinds apart, counts of single words can't."""
    rng = random.Random(3)
    pairs = [(k, " ".join(f"{'ab'[k % 2]}{rng.randrange(30)}" for _ in range(60))) for k in range(300)]
    docs = doc_frame(pairs)
    learn = docs.filter(markov.remainder(docs.doc_id, 10) != 0)
    base = markov.base_of(markov.word_counts(learn))
    seqs = markov.sequences(docs, base)
    chain, logs = markov.first_chain(base, 4), []
    for _ in range(4):
        chain, log = markov.trained_once(seqs, chain, base)
        logs.append(log)
    assert logs == sorted(logs) and logs[-1] > logs[0]
    held = [r for r in markov.score(docs, 4, 6).collect() if r.held_out]
    assert held and all(r.score > r.base_score for r in held)


def test_no_documents_and_none_to_learn_from(spark, doc_frame):
    assert markov.score(doc_frame([])).count() == 0
    out = next(k for k in range(1000) if not learns(k))
    rows = markov.score(doc_frame([(out, "a b"), (out, None)])).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, 0, 0), (3, 0, 0)]
    assert all(r.base_score == pytest.approx(0) and r.score == pytest.approx(0) for r in rows)


# ------------------------------------------------------------------ importance resampling


def grams(text, longest):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[k:k + n]) for n in range(1, longest + 1) for k in range(len(w) - n + 1)]


@pytest.mark.parametrize(("lane", "longest"), [(256, 1), (4, 3), (1, 2)])
def test_checksums_from_prefixes(monkeypatch, corpus, lane, longest):
    monkeypatch.setattr(resampling, "LANE", lane)
    texts = [t or "" for _, t in corpus] + ["Straße ÉTÉ  中文 x", "a" * 3000, "", "9"]
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = resampling.Features(np.frombuffer(b"".join(raw), np.uint8), at, longest)
    want = Counter((k, crc32(g.encode())) for k, t in enumerate(texts) for g in grams(t, longest)[1])
    assert Counter(zip(got.rows.tolist(), got.crc.tolist(), strict=True)) == want
    assert got.n_words.tolist() == [grams(t, 1)[0] for t in texts]


def brute_draw(pairs, items, longest, buckets, percent, seed=2024):
    def bucketed(text):
        return Counter(crc32(g.encode()) % buckets for g in grams(text, longest)[1])

    s = sum((bucketed(t) for _, t in pairs), Counter())
    t = sum((bucketed(x) for x in items), Counter())
    total, wanted = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (total + buckets) / ((s[b] + 1) * (wanted + buckets))))

    rows = []
    for i, text in pairs:
        own = bucketed(text)
        weight = sum(gain(b) * n for b, n in own.items())
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, sum(own.values()), weight, score, grams(text, 1)[0]))
    can = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = can[:percent * len(can) // 100]
    rank = {}
    for k, r in enumerate(drawn, 1):
        rank.setdefault(r, []).append(k)
    return Counter((*r[:4], rank[r].pop(0) if rank.get(r) else None) for r in rows)


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(1, 10_000, 10), (3, 50, 45)])
def test_draw_like_brute_force(spark, doc_frame, corpus, longest, buckets, percent):
    long = " ".join(f"w{k % 70}" for k in range(30_000))
    pairs = [*corpus, (500, corpus[30][1]), (40, corpus[40][1]), (40, corpus[40][1]), (None, corpus[20][1]), (7000, long)]
    items = ["w1 w2 w3 the", None, "", "nowhere W5 " * 30]
    target = spark.createDataFrame([(k, x) for k, x in enumerate(items)], "item_id long, text string")
    got = resampling.resample(doc_frame(pairs).repartition(5), target, longest, buckets, percent)
    assert Counter(tuple(r)[:5] for r in got.collect()) == brute_draw(pairs, items, longest, buckets, percent)


def test_empty_tables(spark, doc_frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resample(doc_frame([]), none).count() == 0
    rows = resampling.resample(doc_frame([(1, "a b"), (2, None)]), none).collect()
    assert sorted((r.doc_id, r.n_features, r.rank) for r in rows) == [(1, 2, None), (2, 0, None)]
