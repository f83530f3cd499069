import hashlib
import re
from collections import Counter, defaultdict

from econ_lake.llm import exact_dedup, jaccard_join, substring_dedup


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ------------------------------------------------------------------ substrings


def brute_substrings(pairs, length=20):
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0))
    first = {}
    for i, t in order:
        w = words(t)
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k:k + length]), (i, k))
    out = Counter()
    for i, t in pairs:
        w = words(t)
        gone = {k + j for k in range(len(w) - length + 1) if first[tuple(w[k:k + length])] != (i, k)
                for j in range(length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def run_substrings(docs, **options):
    return Counter(tuple(r) for r in substring_dedup.dedup_digests(docs, **options).collect())


def test_substrings_like_brute_force(doc_frame, corpus):
    want = brute_substrings(corpus)
    assert sum(n > 0 for _, _, n, _ in want) > 20
    assert run_substrings(doc_frame(corpus)) == want


def test_hot_anchors_are_split_by_windows(doc_frame, corpus):
    assert run_substrings(doc_frame(corpus), hot_runs=1) == brute_substrings(corpus)


def test_windows_across_a_seam_are_references(doc_frame):
    pairs = []
    for seed in range(12):  # other words, so other anchors
        c = [f"s{seed}c{k}" for k in range(22)]
        for text in (c[:20] + [f"x{seed}"], [f"y{seed}"] + c[2:], c, [f"z{seed}"] + c[1:21] + [f"w{seed}"]):
            pairs.append((len(pairs), " ".join(text)))
    want = brute_substrings(pairs)
    assert all(n == 20 for i, _, n, _ in want if i % 4 == 3)
    assert run_substrings(doc_frame(pairs)) == want


def test_substrings_of_odd_tables(doc_frame):
    assert run_substrings(doc_frame([])) == {}
    long = " ".join(f"x{k}" for k in range(30_000))
    pairs = [(None, "a " * 50), (3, long), (3, long), (5, "q " + long[:400]), (4, None)]
    assert run_substrings(doc_frame(pairs)) == brute_substrings(pairs)


def test_kept_text(doc_frame):
    text = " ".join(f"x{k}" for k in range(25))
    rows = substring_dedup.dedup(doc_frame([(1, text), (2, "new " + text + " end")])).collect()
    assert {(r.doc_id, r.kept) for r in rows} == {(1, text), (2, "new end")}


def test_automaton_spans():
    automaton = substring_dedup.SuffixAutomaton()
    automaton.add([1, 2, 3, 4, 2, 3])
    automaton.add([7, 1, 2, 9])
    for sequence in ([1, 2, 3, 4], [2, 3, 7, 1, 2], [4, 2, 3, 1, 2, 9, 9, 7], [5, 5]):
        got = {k for a, b in automaton.spans(sequence, 2) for k in range(a, b)}
        parts = [[1, 2, 3, 4, 2, 3], [7, 1, 2, 9]]
        grams = {tuple(p[k:k + 2]) for p in parts for k in range(len(p) - 1)}
        assert got == {k + j for k in range(len(sequence) - 1) if tuple(sequence[k:k + 2]) in grams for j in (0, 1)}


def test_automaton_holds_what_occurs_in_one_sequence():
    automaton = substring_dedup.SuffixAutomaton()
    automaton.add([1, 2, 3, 4])
    automaton.add([3, 4, 5, 6])
    assert automaton.spans([1, 2, 3, 4, 5, 6], 2) == [(0, 6)]
    assert not automaton.holds([1, 2, 3, 4, 5, 6])
    assert automaton.holds([2, 3, 4]) and automaton.holds([4, 5, 6])


# ------------------------------------------------------------------ exact


def test_exact_like_brute_force(doc_frame, corpus):
    pairs = [*corpus, (500, "Same"), (501, "sAME"), (501, "same"), (None, "same"), (None, "alone")]
    groups = defaultdict(list)
    for i, t in pairs:
        groups[lower(t)].append(i)
    rows = exact_dedup.mark_duplicates(doc_frame(pairs)).collect()
    assert len(rows) == len(pairs)
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        own = [r for r in rows if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in own)
        assert {(r.keep_id, r.group_size) for r in own} == {(keep, len(ids))}
        assert [r.doc_id for r in own if r.kept] == [keep]
    kept = exact_dedup.drop_duplicates(doc_frame(pairs)).collect()
    assert len(kept) == len(groups) and {lower(r.text) for r in kept} == set(groups)
    assert kept[0].source == "s" and kept[0].digest == "digest"


def test_hot_digests_are_joined_apart(doc_frame, monkeypatch):
    pairs = [(k, "hot" if k % 3 else f"text {k}") for k in range(3000)]
    rows = exact_dedup.mark_duplicates(doc_frame(pairs)).collect()
    assert len(rows) == 3000 and sum(r.kept for r in rows) == 1001
    assert {r.group_size for r in rows} == {1, 2000}


def test_index_grows_by_what_is_new(spark, doc_frame, tmpdir_path):
    index = exact_dedup.DigestIndex(spark, "digest_index_test", f"{tmpdir_path}/index", buckets=4)
    try:
        index.append(exact_dedup.digests(doc_frame([(1, "a"), (2, "b"), (3, "A")])))
        new = exact_dedup.digests(doc_frame([(9, "b"), (10, "c"), (11, "C")]))
        plan = index.unseen(exact_dedup.groups(new))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan
        assert [(r.keep_id, r.group_size) for r in index.unseen(exact_dedup.groups(new)).collect()] == [(11, 2)]
        index.append(new)
        assert sorted((r.keep_id, r.group_size) for r in index.read().collect()) == [(3, 2), (9, 2), (11, 2)]
        assert index.unseen(exact_dedup.groups(new)).count() == 0
        index.append(exact_dedup.digests(doc_frame([(4, "B"), (12, "a")])))  # the largest id stays, whenever it came
        assert sorted((r.keep_id, r.group_size) for r in index.read().collect()) == [(9, 3), (11, 2), (12, 3)]
    finally:
        index.drop()
        assert not index.exists() and not spark.catalog.tableExists(index.sightings)


def test_exact_of_an_empty_table(doc_frame):
    assert exact_dedup.mark_duplicates(doc_frame([])).count() == 0
    assert exact_dedup.drop_duplicates(doc_frame([])).count() == 0


# ------------------------------------------------------------------ near copies


def shingles(text):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute_groups(pairs):
    sets = [shingles(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(pairs)):
        for b in range(a):
            if sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                    root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        least[find(k)] = min(least.get(find(k), i), i)
    return {(i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(pairs)}


def near_copies():
    """Texts of all size bands with a few words changed, added or left out, so that Jaccard lies around 0.8."""
    import random

    rng = random.Random(11)
    pairs = []
    for n in [*range(5, 20), 60, 127, 128, 131, 140, 160, 255, 256, 300, 400, 700]:
        base = [f"b{rng.randrange(10**6)}" for _ in range(n + 4)]
        for _ in range(4):
            t = list(base)
            for _ in range(rng.randrange(0, 2 + n // 40)):
                t[rng.randrange(len(t))] = f"c{rng.randrange(10**6)}"
            t = t[:len(t) - rng.randrange(0, 1 + n // 6)]
            pairs.append((len(pairs), " ".join(t)))
    return pairs


def run_groups(docs, **options):
    return {tuple(r) for r in jaccard_join.similar_groups(docs, **options).collect()}


def test_groups_like_brute_force(doc_frame, corpus):
    pairs = corpus + [(1000 + i, t) for i, t in near_copies()]
    want = brute_groups(pairs)
    assert sum(i != c for i, _, c in want) > 60
    assert run_groups(doc_frame(pairs)) == want


def test_large_entries_lose_no_link(doc_frame, corpus):
    pairs = corpus + [(1000 + i, t) for i, t in near_copies()]
    assert run_groups(doc_frame(pairs), group=1) == brute_groups(pairs)


def test_copies_stay_out_of_the_index_at_any_size(doc_frame, monkeypatch):
    pairs = [*((k, "one text of which there are many copies here") for k in range(40)),
             *((100 + i, t) for i, t in near_copies())]
    seen, entry_rows = [], jaccard_join._entry_rows

    def spy(docs, cost):
        seen.append(docs.count())
        return entry_rows(docs, cost)

    monkeypatch.setattr(jaccard_join, "_entry_rows", spy)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    assert run_groups(doc_frame(pairs)) == brute_groups(pairs)
    assert seen[0] <= len(pairs) - 39


def test_groups_of_odd_tables(doc_frame):
    assert run_groups(doc_frame([])) == set()
    pairs = [(1, None), (2, ""), (3, "one two"), (4, "ONE two"), (4, "one two"), (5, "one two three")]
    assert run_groups(doc_frame(pairs)) == brute_groups(pairs)
    rows = jaccard_join.similar_groups(doc_frame([(None, "a b c d e f"), (7, "a b c d e f")])).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(None, 7), (7, 7)}
    kept = jaccard_join.keep_one(doc_frame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (None, "x")])).collect()
    assert {r.doc_id for r in kept} == {1, 3, None}


def test_parity_never_exceeds_the_difference():
    import numpy as np

    rng = np.random.default_rng(2)
    for n, m, same in ((10, 12, 9), (100, 300, 80), (1000, 900, 500), (3, 2000, 1)):
        pool = rng.integers(0, 2**63, n + m, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n - same:n - same + m])
        apart = len(np.setxor1d(a, b))
        assert jaccard_join.bits_apart(jaccard_join.parity_bits(a), jaccard_join.parity_bits(b)) <= apart
