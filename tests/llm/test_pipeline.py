"""The corpus pipeline against brute force, stage by stage, on a small table of its own."""

import random
import re

import pytest
from test_dedup import brute_groups, lower
from test_text_checks import brute_hits

P = pytest.importorskip("public_tokenizers")


def tables():
    rng = random.Random(31)
    words = [f"word{k}" for k in range(400)]
    docs, labels = [], []

    def add(text, good):
        docs.append((len(docs), text))
        labels.append((len(labels), int(good), 0))

    for _ in range(260):
        w = [rng.choice(words) for _ in range(rng.randrange(20, 60))]
        good = rng.random() < 0.75
        add(" ".join(w if good else [x.upper() + "!!" for x in w]), good)
    texts = [t for _, t in docs[:60]]
    for t in texts[:20]:
        add(t.capitalize(), True)
    for t in texts[20:50]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        add(" ".join(w), True)
    items = [(k, " ".join(t.split()[3:18])) for k, t in enumerate(texts[50:58])]
    return docs, labels[::2], items


def test_stages_like_brute_force(spark, tmpdir_path):
    import corpus_pipeline as C
    from tokenizers import Tokenizer

    from econ_lake.llm import quality
    from econ_lake.llm.queries import tokenizer_path

    docs, labels, items = tables()
    full = spark.createDataFrame([(i, t, "en", "s", len(t), "extra") for i, t in docs],
                                 "doc_id long, text string, lang string, source string, n_chars long, digest string")
    full.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmpdir_path}/benchmark.parquet")

    good = {r.doc_id for r in quality.score(full, spark.read.parquet(f"{tmpdir_path}/labels.parquet")).collect()
            if r.predicted}
    left = [(i, t) for i, t in docs if i in good]
    assert 0 < len(left) < len(docs)
    want = [len(left)]
    last = {lower(t): i for i, t in left}
    left = [(i, t) for i, t in left if last[lower(t)] == i]
    want.append(len(left))
    least = {i: c for i, _, c in brute_groups(left)}
    left = [(i, t) for i, t in left if least[i] == i]
    want.append(len(left))
    bad = {k[0] for k in brute_hits(left, items, 13) if k[5]}
    left = [(i, t) for i, t in left if i not in bad]
    want.append(len(left))
    assert sorted(set(want), reverse=True) == want  # every stage drops something

    frame, got = spark.read.parquet(f"{tmpdir_path}/documents.parquet"), []
    for name, stage in C.STAGES[:-1]:
        frame = C.stored(stage(spark, frame, tmpdir_path), re.sub(r"\W", "", name))
        assert frame.columns == full.columns
        got.append(frame.count())
    assert got == want

    library = Tokenizer.from_file(tokenizer_path(spark, "word_bpe_49k.json"))
    rows = C.run(spark, tmpdir_path).collect()
    assert {(r.doc_id, r.text, r.digest, tuple(r.ids)) for r in rows} == {
        (i, t, "extra", tuple(library.encode(t, add_special_tokens=False).ids)) for i, t in left}
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_last_stage_decodes_like_the_library(spark, tmpdir_path):
    import corpus_pipeline as C
    from tokenizers import Tokenizer

    from econ_lake.llm.queries import tokenizer_path

    texts = ["Two  words", "", "don't <|endoftext|> ΑΣ 😀", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = Tokenizer.from_file(tokenizer_path(spark, "word_bpe_49k.json"))
    rows = dict(C.STAGES)["bpe"](spark, docs, tmpdir_path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.ids, r.decoded) == (ids, library.decode(ids, skip_special_tokens=False))


def test_pipeline_of_empty_tables(spark, tmpdir_path):
    import corpus_pipeline as C

    for name, kind in (("documents", "doc_id long, text string"), ("benchmark", "item_id long, text string"),
                       ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], kind).write.parquet(f"{tmpdir_path}/{name}.parquet")
    assert C.run(spark, tmpdir_path).count() == 0
