import hashlib
import random

import pytest

from econ_lake.llm import bpe, token_counts

P = pytest.importorskip("public_tokenizers")

ODD = ["", " ", "  a", "a  b \n\n c\t", "<|endoftext|>x<|startoftext|>", "<|ENDOFTEXT|>", "ΑΣ Σ ΣΑΣ", "İstanbul",
       "ﬁ Å é", "x" * 3000, "aaaa" * 50, " " * 37 + "x", "▁▁a▁", "😀 ok 中文字", "a\x00b\x1cc\x85d\xa0e",
       "don't you'Ll 'start", "123 4½", "</s>[INST] <s>", "ǅ ſ ẞ K", "\r\n", "\n\n\n", "\0<|endoftext|>"]


def odd_texts():
    rng = random.Random(3)
    return ODD + ["".join(rng.choice("ab c\n▁éΣ's1٣<|>　\t") for _ in range(rng.randrange(60))) for _ in range(800)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_like_the_library(spark, doc_frame):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    texts = [*odd_texts(), None]
    docs = doc_frame(list(enumerate(texts)))
    got = {r.doc_id: r for r in bpe.encode_digests(docs, path).collect()}
    full = {r.doc_id: r for r in bpe.encode(docs, path).collect()}
    for k, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(want, skip_special_tokens=False)
        assert (got[k].n_tokens, got[k].ids_sha256, got[k].decoded_sha256) == (
            len(want), sha(" ".join(map(str, want))), sha(said)), text
        assert (full[k].ids, full[k].decoded, full[k].source) == (want, said, "s")


def test_segment_tree_gives_the_leftmost_least():
    rng = random.Random(5)
    for _ in range(200):
        leaves = [rng.randrange(5) << 32 | k for k in range(rng.randrange(1, 20))]
        tree = bpe.PairTree(list(leaves))
        for _ in range(10):
            assert tree.node[1] == min(leaves)
            k = rng.randrange(len(leaves))
            leaves[k] = rng.choice([bpe.NO_PAIR, rng.randrange(5) << 32 | k])
            tree.put(k, leaves[k])


def test_words_are_the_same_when_the_memory_is_small(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    path = P.path("word_bpe_49k.json")
    small, large = bpe.WordBPE(path), bpe.tokenizer(path)
    text = "some words come again and some words don't " * 3
    assert small.encode(text) == large.encode(text)


def test_counts_like_the_library(spark, doc_frame):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [*odd_texts(), None]
    rows = token_counts.token_counts(doc_frame(list(enumerate(texts))), path, limit=20).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        n = len(library.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 20), text


def test_counts_without_steady_pairs():
    """One place of a sequence at a time gives the same as all at once."""
    path = P.path("piece_bpe_32k.model")
    slow, fast = token_counts.PieceCounter(path), token_counts.counter(path)
    slow.steady[:] = False
    texts = ["banana bandana " * 4, "mississippi  " * 3, "aaaaaaa bbbbabab"]
    assert slow.count(texts) == fast.count(texts)


def test_empty_tables_and_null_ids(spark, doc_frame):
    for run in (lambda d: bpe.encode_digests(d, P.path("word_bpe_49k.json")),
                lambda d: bpe.encode(d, P.path("word_bpe_49k.json")),
                lambda d: token_counts.token_counts(d, P.path("piece_bpe_32k.model"))):
        assert run(doc_frame([])).count() == 0
        rows = run(doc_frame([(None, "x"), (None, "x"), (1, None)])).collect()
        assert sorted((r.doc_id is None, r.n_tokens > 0) for r in rows) == [(False, False), (True, True), (True, True)]


def test_bpe_like_the_library_for_all_code_points():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    own = bpe.WordBPE(path)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for first in range(0, len(points), 1 << 17):
        texts = [" ".join(f"a{chr(c)}B {chr(c)}{chr(c)}" for c in points[k:k + 16]) for k in range(first, min(len(points), first + (1 << 17)), 16)]
        for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
            assert own.encode(text) == want.ids, text


def test_long_words_are_counted_as_short_ones_are(monkeypatch):
    rng = random.Random(8)
    counter = token_counts.PieceCounter(P.path("piece_bpe_32k.model"))
    words = ["".join(rng.choice("abcdeftinors") for _ in range(rng.randrange(1, 120))) for _ in range(200)]
    words += ["a" * k for k in range(1, 60)] + ["中文字é" * 9, "\x00\u0378" * 5, "x"]
    assert [counter.count_long(w) for w in words] == counter.counts(words).tolist()


def test_a_word_of_a_million_letters_like_the_library():
    import time

    import sentencepiece

    path, rng = P.path("piece_bpe_32k.model"), random.Random(9)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for text in ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000)), "ab" * 40_000,
                 "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(50_000))):
        begun = time.process_time()
        assert token_counts.PieceCounter(path).count([text]) == [len(library.encode(text))]
        assert time.process_time() - begun < 60
