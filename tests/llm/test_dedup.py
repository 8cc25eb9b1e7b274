"""SimHash groups and suffix deduplication against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from loomseq.llm.components import connected_components
from loomseq.llm.simhash import keep_one, linked_sets, near_duplicates
from loomseq.llm.suffix_dedup import cut_repeats, dedup_report, places, united


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(texts):
    fps = [brute_fingerprint(t) for _, t in texts]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(texts):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [(key, fp, least.get(find(i))) for i, ((key, _), fp) in enumerate(zip(texts, fps))]


def near_texts(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    out = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(3, 300))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    rng.shuffle(out)
    return list(enumerate(out))


def groups_of(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=str)


def test_groups_are_those_of_all_pairs(spark):
    texts = near_texts()
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert groups_of(near_duplicates(df)) == sorted(brute_groups(texts), key=str)


def test_groups_of_odd_rows(nasty, empty):
    texts = [(r.doc_id, r.text) for r in nasty.collect()]
    assert groups_of(near_duplicates(nasty)) == sorted(brute_groups(texts), key=str)
    assert near_duplicates(empty).count() == 0


def test_keep_one_keeps_the_smallest(spark, nasty, empty):
    kept = keep_one(nasty)
    assert kept.columns == nasty.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "7", "8", "None"]  # 3 and 4 have no words, as 2
    assert keep_one(empty).count() == 0
    again = keep_one(spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words altogether here")], "doc_id long, text string"))
    assert sorted(r.text for r in again.collect()) == ["a b c d e f", "other words altogether here"]


def test_linked_sets_find_chains():
    fps = np.array([0, 0b111, 0b111111, 0xFFFF << 40], np.int64)
    assert [sorted(s.tolist()) for s in linked_sets(fps, 3)] == [[0, 7, 63]]


def test_components_of_paths_stars_and_lone_nodes(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 300)] + [(7, 7)] + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def brute_repeats(texts):
    """(id, n_removed, n_spans, sha256) by the definition; rows of one id and text are one place."""
    seen = {}
    order = sorted(set(texts), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    for key, text in order:
        data = (text or "").encode()
        for s in range(len(data) - 99):
            seen.setdefault(data[s : s + 100], (key, text, s))
    out = []
    for key, text in texts:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            if seen[data[s : s + 100]] != (key, text, s):
                gone[s : s + 100] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((key, int(gone.sum()), runs, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdefgh é ñ") for _ in range(rng.choice([60, 99, 100, 101, 180, 400]))) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            parts.append(rng.choice(shared)[rng.randrange(5) :] if rng.random() < 0.6 else "".join(rng.choice("xyz ") for _ in range(rng.randrange(150))))
        out.append("".join(parts))
    out += ["a" * 500, "a" * 130, "ab" * 200, out[3], out[3] + "!"]
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_are_those_of_all_windows(spark, seed):
    texts = passages(seed)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert sorted(((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in dedup_report(df).collect()), key=str) == brute_repeats(texts)


def test_removal_of_odd_rows(nasty, empty):
    texts = [(r.doc_id, r.text) for r in nasty.collect()]
    got = dedup_report(nasty).collect()
    assert sorted(((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute_repeats(texts)
    assert sorted(r.n_bytes for r in got) == sorted(len((t or "").encode()) for _, t in texts)
    assert dedup_report(empty).count() == 0 and cut_repeats(empty).count() == 0


def test_crowded_first_digits_take_the_way_of_whole_windows(spark, monkeypatch):
    import loomseq.llm.suffix_dedup as S

    rng = random.Random(9)
    common = "".join(rng.choice("abcdef") for _ in range(130))
    texts = [(i, "".join(rng.choice("uvwxyz") for _ in range(90)) + common + "".join(rng.choice("uvwxyz") for _ in range(90))) for i in range(40)]
    expected = brute_repeats(texts)
    monkeypatch.setattr(S, "PLACES", 1)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in S.dedup_report(df).collect()), key=str) == expected


def test_frequent_first_digits_are_dealt_to_parts(spark, monkeypatch):
    import loomseq.llm.suffix_dedup as S

    monkeypatch.setattr(S, "SAMPLE", 1)
    monkeypatch.setattr(S, "FREQUENT", 2)
    texts = passages(3, 40)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert len(S._frequent(df.withColumnRenamed("doc_id", "doc"))) > 5
    assert sorted(((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in S.dedup_report(df).collect()), key=str) == brute_repeats(texts)


def test_cutting_keeps_whole_characters_and_columns(spark, nasty):
    long = "é" * 60
    df = spark.createDataFrame([(1, "x" + long), (2, "y" + long + "z")], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in cut_repeats(df).collect()}
    assert kept[2] == "yz" and kept[1].startswith("x")
    out = cut_repeats(nasty)
    assert out.columns == nasty.columns and out.count() == nasty.count()
    assert {r.doc_id: r.text for r in out.collect()}[2] is None


def test_blocks_of_a_long_text_find_the_same_places(monkeypatch):
    import loomseq.llm.suffix_dedup as S

    rng = random.Random(2)
    data = bytes(rng.choice(b"abcd ") for _ in range(20_000))
    whole = [x.tolist() for x in places(data)]
    monkeypatch.setattr(S, "BLOCK", 1000)
    assert [x.tolist() for x in places(data)] == whole


def test_united_runs():
    a, b = united(np.array([5, 0, 20, 8]), np.array([10, 3, 30, 12]))
    assert list(zip(a.tolist(), b.tolist())) == [(0, 3), (5, 12), (20, 30)]


def test_similar_groups_are_those_of_exact_jaccard(spark, nasty, empty, monkeypatch):
    from loomseq.llm import jaccard

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 8)))
    footer, texts = [word() for _ in range(12)], []
    for size in (8, 20, 40, 60, 100, 250):
        for _ in range(4):
            base = [word() for _ in range(size)] + footer
            texts.append(base)
            for changes in (1, 1, 2, 3, 4):
                copy = list(rng.choice(texts[-3:]))
                for _ in range(changes):
                    copy[rng.randrange(len(copy))] = word()
                texts.append(copy)
    rng.shuffle(texts)
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    brute = {i: find(i) for i in range(len(texts))}
    assert 30 < len(set(brute.values())) < len(texts) - 30
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "SAMPLE", 2)
    monkeypatch.setattr(jaccard, "WORTH", 0)
    assert {r.doc_id: r.component_id for r in jaccard.similar_groups(df).collect()} == brute
    kept = keep_one(nasty, 5, similarity=True)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 5, 7, 8] and kept.columns == nasty.columns
    assert keep_one(empty, 5, similarity=True).count() == 0


def test_another_text_under_the_id_of_a_copy_stays(spark):
    rows = [(1, "a b c d e f g"), (5, "a b c d e f g"), (5, "quite other words that stand alone here")]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [rows[0], rows[2]]


def test_sketches_never_differ_by_more_than_the_sets():
    from loomseq.llm.jaccard import parity_sketch, sketch_distance

    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 64, 65, 300, 5000):
        for m in (0, 1, 60, 130, 4000):
            both = rng.integers(0, 1 << 63, min(n, m) * 9 // 10, np.uint64)
            a, b = (np.unique(np.r_[both, rng.integers(0, 1 << 63, k - len(both), np.uint64)]) for k in (n, m))
            assert sketch_distance(parity_sketch(a), parity_sketch(b)) <= len(np.setxor1d(a, b))
            assert sketch_distance(parity_sketch(a), parity_sketch(a)) == 0


def test_shared_rows_across_batches():
    from loomseq.llm.jaccard import _shared

    rng = np.random.default_rng(4)
    for seed in range(5):
        rows = sorted((int(k), int(c)) for k, c in zip(rng.integers(0, 60, 300), rng.integers(0, 8 * (seed + 1), 300)))
        names = ["key", "class", "n", "pos"]
        classes = {}
        for k, c in rows:
            classes.setdefault(k, set()).add(c)
        for size in (1, 2, 3, 7, 300):
            batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*((k, c, c, 0) for k, c in rows[i : i + size])), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=names) for i in range(0, 300, size)]
            got = sorted((r["key"], r["class"]) for b in _shared(iter(batches)) for r in b.to_pylist())
            assert got == sorted((k, c) for k, cs in classes.items() if len(cs) > 1 for c in cs)


def test_the_stage_links_fingerprints_and_similar_sets(spark):
    """Of three pairs one is near by its fingerprints alone, one by its sets alone, one by neither."""
    import random

    from corpus_pipeline import simhash_near_dedup
    from loomseq.llm.jaccard import shingle_set
    from loomseq.llm.simhash import fingerprint

    rng = random.Random(5)
    words = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    apart = lambda a, b: ((fingerprint(a, 5) ^ fingerprint(b, 5)) & (1 << 64) - 1).bit_count()

    def share(a, b):
        x, y = (set(shingle_set(t, 5).tolist()) for t in (a, b))
        return len(x & y) / len(x | y)

    def pair(by_bits, by_sets):
        while True:
            if by_bits:
                passage = words(15) * 40
                a, b = (" ".join(passage + words(20)) for _ in range(2))
            else:
                base, at = words(80), rng.randrange(20, 60)
                a, b = " ".join(base), " ".join(base[:at] + words(1 if by_sets else 30) + base[at + 1 :])
            if (apart(a, b) <= 3) == by_bits and (share(a, b) >= 0.8) == by_sets:
                return a, b

    texts = [t for kind in ((True, False), (False, True), (False, False)) for t in pair(*kind)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash_near_dedup(spark, docs, "").collect()) == [0, 2, 4, 5]
