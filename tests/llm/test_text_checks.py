import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import Row

from econ_lake.llm import chat, decontaminate, quality, sharding, toxicity

# ------------------------------------------------------------------ decontamination


def words(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def brute_hits(pairs, items, size):
    wins = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + size]), set()).add(item)
    out = Counter()
    for i, t in pairs:
        w, hit, found = words(t), set(), set()
        for k in range(len(w)):
            for n in {len(x) for x in wins}:
                own = tuple(w[k:k + n])
                if len(own) == n and own in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[own]
        ids = ",".join(sorted(map(str, found)))
        out[i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
            len(hit) > 0 and 20 * len(hit) >= len(w)] += 1
    return out


def benchmark_of(corpus):
    rng = random.Random(4)
    items = [(k, " ".join((corpus[rng.randrange(20, 150)][1] or "x").split()[:rng.randrange(1, 40)]))
             for k in range(30)]
    return items + [(2, items[3][1]), (77, None), (78, "..."), (79, "One"), (80, "nowhere at all")]


@pytest.mark.parametrize("at_once", [1_000_000, 7])
def test_hits_like_brute_force(spark, doc_frame, corpus, monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "WINDOWS_AT_ONCE", at_once)
    monkeypatch.setattr(decontaminate, "WORDS_AT_ONCE", at_once)
    size = 13 if at_once > 7 else 30
    pairs = [*corpus, (3, "one ONE"), (3, "one ONE"), (None, "one")]
    items = benchmark_of(corpus) if at_once > 7 else benchmark_of(corpus)[:6]
    want = brute_hits(pairs, items, size)
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert Counter(tuple(r) for r in decontaminate.report(doc_frame(pairs), frame, size).collect()) == want
    clean = decontaminate.drop_contaminated(doc_frame(pairs), frame, size)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(
        str(k[0]) for k, n in want.items() if not k[5] for _ in range(n))
    assert clean.columns == doc_frame([]).columns


@pytest.mark.parametrize("at_once", [500_000, 0])
def test_contaminated_documents_go_without_a_shuffle_of_texts(spark, doc_frame, corpus, monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "KEYS_AT_ONCE", at_once, raising=False)
    pairs = [*corpus, (3, "one ONE"), (None, "one"), (None, None), (None, "nothing of it")]
    items = benchmark_of(corpus)
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the documents are larger than any threshold
    try:
        clean = decontaminate.drop_contaminated(
            doc_frame(pairs), spark.createDataFrame(items, "item_id long, text string"))
        plan = clean._jdf.queryExecution().executedPlan().toString()
        got = Counter(str(r.doc_id) for r in clean.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)
    assert ("Exchange hashpartitioning" in plan) == (at_once == 0), plan
    assert got == Counter(str(k[0]) for k, n in brute_hits(pairs, items, 13).items() if not k[5] for _ in range(n))


def test_no_items_and_no_documents(spark, doc_frame):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.report(doc_frame([(1, "a b"), (2, None)]), none).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in rows) == [(1, 2, 0, False), (2, 0, 0, False)]
    assert decontaminate.report(doc_frame([]), none).count() == 0


# ------------------------------------------------------------------ sharding


def test_shards_are_even_and_reproducible(spark, doc_frame, corpus):
    pairs = [*corpus, (None, None), (None, "x"), (5, "again"), (5, "again")]
    docs = doc_frame(pairs)
    rows = sharding.assign(docs, shards=7).collect()
    assert len(rows) == len(pairs)
    per = Counter(r.shard for r in rows)
    assert set(per) == set(range(7)) and max(per.values()) - min(per.values()) <= 1
    for shard, n in per.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    want = Counter((i, len((t or "").encode()) + 16, crc32((t or "").encode())) for i, t in pairs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    again = sharding.assign(docs.repartition(5), shards=7).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))] != sorted(i for i, _ in corpus)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000])
def test_places_are_a_permutation(spark, n):
    from pyspark.sql import functions as F

    got = spark.range(n).select(sharding.permuted(F.col("id"), n, 3).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(n))


def test_no_rows_no_shards(doc_frame):
    assert sharding.assign(doc_frame([])).count() == 0


# ------------------------------------------------------------------ chat


def test_conversations_come_back(spark):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_50k.json")
    rng = random.Random(9)
    odd = ["", "hello", "</s>[INST] ok [/INST]", "<|end|><\\|end|><\\\\|end|>", "<|endoftext|>", "é😀\x00\n\n ", None,
           "<<|turn|>|turn|>", "a" * 5000, "[[INST]\\", "<|im_start|>user"]
    turns = [Row(conv_id=c, turn=k, role=rng.choice(["user", "assistant", "system", None, "<|end|>"]),
                 text=rng.choice(odd), extra=1) for c in (1, 2, 3, None) for k in range(rng.randrange(1, 9))]
    turns += [turns[0], Row(conv_id=4, turn=None, role="assistant", text="x", extra=1)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, extra int")
    got = {r.conv_id: r for r in chat.report(frame, path).collect()}
    for c in (1, 2, 3, 4, None):
        own = sorted(((t.turn is not None, t.turn or 0, t.role or "", t.text or "") for t in turns if t.conv_id == c))
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        shown = "".join(f"<|turn|>{chat.escape(r)}<|text|>{chat.escape(x)}<|end|>" for _, _, r, x in own)
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256, got[c].formatted_chars) == (
            len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), len(shown))
        assert shown.count("<|end|>") == shown.count("<|turn|>") == len(own)
    assert chat.report(frame.limit(0), path).count() == 0


def test_escapes_can_be_undone():
    rng = random.Random(1)
    parts = [*chat.CONTROL, *chat.FOREIGN, "<", "[", "\\", "|", "s>", "x", "INST]"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROL + chat.FOREIGN)


# ------------------------------------------------------------------ classifiers


def labelled(n=900):
    rng = random.Random(21)
    good, insults, groups = [f"word{k}" for k in range(200)], ["idiots", "scum"], ["greens", "blues"]
    pairs, labels = [], []
    for i in range(n):
        w = [rng.choice(good) for _ in range(rng.randrange(10, 60))]
        kind = rng.random()
        junk = kind < 0.3
        if junk:
            w = [x.upper() + "!!" for x in w]
        toxic = False
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        if insult:
            w.insert(rng.randrange(len(w)), rng.choice(insults))
        if group:
            w.insert(rng.randrange(len(w)), rng.choice(groups))
        toxic = insult and group
        pairs.append((i, " ".join(w)))
        labels.append((i, int(not junk), int(toxic)))
    return pairs, labels


def accuracy(rows, labels, column):
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    return sum(r.predicted == labels[r.doc_id][column] for r in held) / len(held)


def test_classifiers_hold_out(spark, doc_frame):
    pairs, labels = labelled()
    docs = doc_frame([*pairs, (5000, None), (5001, ""), (5001, ""), (None, "word1")])
    frame = spark.createDataFrame([*labels, (1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    by_id = {i: (q, t) for i, q, t in labels}
    rows = quality.score(docs, frame).collect()
    assert len(rows) == len(pairs) + 4 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows if r.doc_id is not None)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)
    assert accuracy([r for r in rows if r.doc_id in by_id], by_id, 0) > 0.97
    rows = toxicity.score(docs, frame).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    # neither an insult nor a group alone is toxic
    assert accuracy([r for r in rows if r.doc_id in by_id], by_id, 1) > 0.9


def test_held_out_labels_are_not_learned(spark, doc_frame):
    pairs, labels = labelled(300)
    turned = [(i, 1 - q if crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    kind = "doc_id long, quality int, toxic int"
    a = quality.score(doc_frame(pairs), spark.createDataFrame(labels, kind)).collect()
    b = quality.score(doc_frame(pairs), spark.createDataFrame(turned, kind)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels(spark, doc_frame, module):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = module.score(doc_frame([(1, "a"), (2, None)]), none).collect()
    assert [r.score for r in rows] == [0.5, 0.5]
    assert module.score(doc_frame([]), none).count() == 0
    ones = spark.createDataFrame([(k, 1, 1) for k in range(9)], "doc_id long, quality int, toxic int")
    rows = module.score(doc_frame([(k, "a") for k in range(9)]), ones).collect()
    assert len({r.score for r in rows}) == 1 and rows[0].score > 0.5


def test_toxicity_learns_pairs_whose_members_tell_nothing_alone(spark, doc_frame):
    """Toxic where two marker words are both there or both not: no single word tells, all pairs must be learned."""
    rng = random.Random(1)
    texts, toxic = [], []
    for _ in range(2000):
        w = [f"word{rng.randrange(300)}x" for _ in range(rng.randrange(10, 40))]
        a, b = rng.random() < 0.5, rng.random() < 0.5
        for there, word in ((a, "alphamark"), (b, "zetamark")):
            if there:
                w.insert(rng.randrange(len(w)), word)
        texts.append(" ".join(w))
        toxic.append(int(a == b))
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    held = [r for r in toxicity.score(doc_frame(list(enumerate(texts))), labels).collect() if r.held_out]
    right = sum(r.predicted == toxic[r.doc_id] for r in held) / len(held)
    assert len(held) > 300 and right > 0.9 and len({r.score for r in held}) > len(held) / 2


def test_factorization_machine_like_a_naive_sum_over_pairs():
    import itertools

    import numpy as np

    rng = np.random.default_rng(2)
    machine = toxicity.FactorizationMachine(np.arange(20), 0.3, rng.normal(size=20), rng.normal(size=(20, 8)))
    docs = [rng.choice(20, n, replace=False) for n in (0, 1, 2, 7, 20)]
    rows, terms = np.repeat(np.arange(5), [len(d) for d in docs]), np.concatenate(docs)
    want = [0.3 + sum(machine.linear[i] for i in d)
            + sum(float(machine.factors[i] @ machine.factors[j]) for i, j in itertools.combinations(d, 2)) for d in docs]
    assert np.allclose(machine.raw(rows, terms, 5), want)
