"""Texts beyond the megabyte that tasks read at a time, held against brute force; plain versions of two operators' steps."""

import hashlib
import math
import random
import struct
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from test_dedup import brute_groups, brute_substrings, lower
from test_models import brute_draw, plain_base, tokens
from test_text_checks import brute_hits

from econ_lake.llm import (bpe, chat, decontaminate, exact_dedup, jaccard_join, markov, quality, resampling, sharding,
                           substring_dedup, terms, token_counts, toxicity)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def pairs():
    """A long text, a near copy, a copy in capitals, one with a long unbroken word, and short ones beside them."""
    rng = random.Random(31)
    vocabulary = [f"word{k}é" if k % 50 == 0 else f"word{k}" for k in range(5000)]
    long = [rng.choice(vocabulary) for _ in range(150_000)]
    near = list(long)
    for _ in range(300):
        near[rng.randrange(len(near))] = f"other{rng.randrange(10**6)}"
    unbroken = "".join(rng.choice("abcdefgh") for _ in range(30_000))
    text = " ".join(long)
    assert len(text) > 1 << 20
    return [(1, text), (2, " ".join(near)), (3, text.replace("word", "WORD")), (4, " ".join([unbroken, *long[:130_000]])),
            (5, " ".join(long[-30:])), (6, "short"), (7, None)]


@pytest.fixture(scope="module")
def docs(doc_frame, pairs):
    return doc_frame(pairs).repartition(2)


def test_substrings(docs, pairs):
    got = Counter(tuple(r) for r in substring_dedup.dedup_digests(docs).collect())
    assert got == brute_substrings(pairs)


def test_copies_and_near_copies(docs, pairs):
    rows = {r.doc_id: r for r in exact_dedup.mark_duplicates(docs).collect()}
    assert {i: (r.keep_id, r.text_sha256) for i, r in rows.items()} == {
        i: (3 if i in (1, 3) else i, sha(lower(t))) for i, t in pairs}
    assert {tuple(r) for r in jaccard_join.similar_groups(docs).collect()} == brute_groups(pairs)


def test_benchmark_passages(spark, docs, pairs):
    words = pairs[0][1].split()
    items = [(0, " ".join(words[-40:])), (1, " ".join(words[70_000:70_030])), (2, "nowhere")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert Counter(tuple(r) for r in decontaminate.report(docs, frame).collect()) == brute_hits(pairs, items, 13)


def test_tokens(docs, pairs):
    sentencepiece, tokenizers = pytest.importorskip("sentencepiece"), pytest.importorskip("tokenizers")
    P = pytest.importorskip("public_tokenizers")
    path, model = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
    library, pieces = tokenizers.Tokenizer.from_file(path), sentencepiece.SentencePieceProcessor(model_file=model)
    library.no_truncation()
    library.no_padding()
    ids = {r.doc_id: r for r in bpe.encode_digests(docs, path).collect()}
    counts = {r.doc_id: r for r in token_counts.token_counts(docs, model).collect()}
    for i, t in pairs:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert (ids[i].n_tokens, ids[i].ids_sha256, ids[i].decoded_sha256) == (
            len(want), sha(" ".join(map(str, want))), sha(library.decode(want, skip_special_tokens=False)))
        assert (counts[i].n_bytes, counts[i].n_tokens) == (len((t or "").encode()), len(pieces.encode(t or "")))


def test_a_long_turn(spark, pairs):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    text = pairs[0][1] + "<|end|>"
    frame = spark.createDataFrame([Row(conv_id=1, turn=0, role="user", text="q"),
                                   Row(conv_id=1, turn=1, role="assistant", text=text)])
    (row,) = chat.report(frame, path).collect()
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, len(text), sha(text))
    assert row.turns_sha256 == sha(f"user\nq\nassistant\n{text}\n")


def test_sizes(docs, pairs):
    rows = sharding.assign(docs, shards=3).collect()
    assert {(r.doc_id, r.size, r.text_crc32) for r in rows} == {
        (i, len((t or "").encode()) + 16, crc32((t or "").encode())) for i, t in pairs}


def test_base_and_model_scores(docs, pairs):
    c, n, v = plain_base(pairs)
    for r in markov.score(docs, 3, 1).collect():
        w = tokens(dict(pairs)[r.doc_id])
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and -math.inf < r.score < 0


def test_draw(spark, docs, pairs):
    target = spark.createDataFrame([(1, "word1 word2 word3")], "item_id long, text string")
    got = Counter(tuple(r)[:5] for r in resampling.resample(docs, target, 1, 10_000, 50).collect())
    assert got == brute_draw(pairs, ["word1 word2 word3"], 1, 10_000, 50)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_read_to_the_end(spark, doc_frame, module, pairs):
    """Rows whose remainder keeps them out of the sample differ only in their last words, beyond a megabyte."""
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["plain", "calm", "table", "river"]) for _ in range(30)) +
              (" FILTH!! FILTH!!" if i % 2 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i, _ in texts], "doc_id long, quality int, toxic int")
    filler = "plain calm table river " * 60_000
    got = {r.doc_id: r.score for r in module.score(
        doc_frame([*texts, (9000, filler), (9001, filler + "FILTH!! FILTH!!")]), labels).collect()}
    assert len(filler) > 1 << 20 and 0 <= min(got.values()) <= max(got.values()) <= 1
    assert (got[9001] > got[9000]) == (module is toxicity) and got[9001] != got[9000]


# ------------------------------------------------------------------ plain versions


def plain_place(number, n, seed):
    """Feistel rounds in turn over two halves, then again until the place lies below n."""
    xxhash = pytest.importorskip("xxhash")
    bits = max(2, (n - 1).bit_length())
    low, high = bits // 2, bits - bits // 2

    def hashed(value, key):  # a long, then an int seeded by its hash
        first = xxhash.xxh64_intdigest(struct.pack("<q", value), 42)
        return xxhash.xxh64_intdigest(struct.pack("<i", key), first)

    at = number
    while True:
        left, right = at >> low, at & ((1 << low) - 1)
        for k in range(sharding.ROUNDS):
            if k % 2:
                right ^= hashed(left, seed + k) & ((1 << low) - 1)
            else:
                left ^= hashed(right, seed + k) & ((1 << high) - 1)
        at = left << low | right
        if at < n:
            return at


@pytest.mark.parametrize("n", [2, 3, 5, 33, 64, 700])
def test_places_like_a_plain_walk(spark, n):
    got = spark.range(n).select("id", sharding.permuted(F.col("id"), n, 11).alias("p")).collect()
    assert {r.id: r.p for r in got} == {k: plain_place(k, n, 11) for k in range(n)}


def test_log_ratios_like_plain_counts():
    rows, sign = [np.array(x, int) for x in ([3, 5], [5], [5, 9], [], [9])], np.array([1, 1, -1, -1, -1])
    got, size = quality.log_ratios(rows, sign), 1 << terms.BITS
    up, down = Counter([3, 5, 5]), Counter([5, 9, 9])
    for term in (3, 5, 9, 10):
        want = math.log((up[term] + 1) / (3 + size)) - math.log((down[term] + 1) / (3 + size))
        assert got[term] == pytest.approx(want)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dual_descent_like_descent_on_the_primal(seed):
    rng = np.random.default_rng(seed)
    scale = rng.normal(size=15)
    rows = [np.flatnonzero(rng.random(15) < 0.4) for _ in range(60)]
    sign = np.where(rng.random(60) < 0.5, 1, -1)
    w, bias = quality.dual_descent(rows, sign, scale, cost=0.1, epochs=5000)
    x = np.zeros((60, 16))
    for k, own in enumerate(rows):
        x[k, own] = scale[own]
    x[:, 15] = 1
    plain, step = np.zeros(16), 1 / (1 + 2 * 0.1 * np.linalg.eigvalsh(x.T @ x).max())
    for _ in range(5000):
        short = np.maximum(0, 1 - sign * (x @ plain))
        plain -= step * (plain - 2 * 0.1 * x.T @ (sign * short))
    assert np.allclose([*w, bias], plain, atol=5e-3)


def test_a_score_of_one_half_counts_as_label_one(spark, doc_frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        rows = module.score(doc_frame([(1, "a"), (1, "a"), (2, None)]), none).collect()
        assert [(r.score, r.predicted) for r in rows] == [(0.5, 1)] * 3
