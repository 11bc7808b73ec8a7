import random

import numpy as np
import pytest

from linkwright.llm import nearcopies, simhash


def fingerprint(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return int(simhash.fold(*simhash.shingle_hashes(data, np.array([0, len(data)]), nearcopies.SHINGLE))[0])


def test_repeats_do_not_part_equal_shingle_sets(spark):
    """Equal shingle sets, one word 8 or 400 times in a row: one group, however far the fingerprints are."""
    texts = []
    for seed in range(6):
        rng = random.Random(seed)
        words = [f"w{seed}x{rng.randint(0, 10**6)}" for _ in range(300)]
        texts += [" ".join([*words, *["spam"] * n]) for n in (8, 400)]
    apart = [(fingerprint(a) ^ fingerprint(b)).bit_count() for a, b in zip(texts[::2], texts[1::2])]
    assert max(apart) > 26
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in nearcopies.keep_one(docs).collect()) == list(range(0, 12, 2))


def test_long_texts_are_judged_by_whole_shingle_sets(spark):
    """Pairs of over SKETCH shingles, just above and just below 0.8: all judged rightly."""
    texts, want = [], []
    for seed in range(24):
        rng = random.Random(seed)
        words = [f"w{rng.randint(0, 10**9)}" for _ in range(2404)]  # 2,400 shingles
        # a changed tail of t words is t other shingles: (2400 - t) / (2400 + t)
        t = 266 if seed % 2 else 270  # 0.8005 and 0.7978
        texts += [" ".join(words), " ".join(words[:-t] + [f"n{rng.randint(0, 10**9)}" for _ in range(t)])]
        want += [2 * seed] if seed % 2 else [2 * seed, 2 * seed + 1]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in nearcopies.keep_one(docs).collect()) == want


def _cloud(seed, n, words=220):
    """Texts that differ from one base in a few places each, some of them from one another's variants."""
    rng = random.Random(seed)
    base = [f"b{seed}x{k}" for k in range(words)]
    out = []
    for i in range(n):
        t = list(rng.choice(out).split()) if out and rng.random() < 0.3 else list(base)
        for _ in range(rng.randint(1, 9)):
            t[rng.randrange(words)] = f"c{rng.randint(0, 10**9)}"
        out.append(" ".join(t))
    return out


def _brute(texts, least=0.8):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= least * (len(a) + len(sets[j]) - both) - 1e-9:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted({find(i) for i in range(len(texts))})


@pytest.mark.parametrize(("crowd", "levels"), [(32, 4), (3, 3), (3, 0)])
def test_crowds_are_grouped_as_by_brute_force(spark, crowd, levels):
    """The same groups whatever counts as a crowd and however many levels there are; copies stay linear."""
    texts = [t for seed in range(3) for t in _cloud(seed, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    tell = []
    got = nearcopies.groups(docs, margin=nearcopies.MARGIN, crowd=crowd, levels=levels, tell=tell)
    best = {}
    for r in got.collect():
        best[r["root"]] = min(best.get(r["root"], r["_id"]), r["_id"])
    want = _brute(texts)
    # a link is found with a chance of 0.998 a pair; these texts are chosen once and for all
    assert sorted(best.values()) == want
    assert all(pairs <= rows * max(crowd / 2, nearcopies.HUBS) for rows, pairs in tell[:levels])


@pytest.mark.parametrize("sent", [0, 100_000])
def test_hot_hubs_meet_their_edges_however_many_they_are(spark, monkeypatch, sent):
    """The same verdicts whether hubs of several parts are broadcast or joined."""
    monkeypatch.setattr(nearcopies, "SENT_HUBS", sent)
    sketches = spark.createDataFrame([(i, list(range(100)) if i % 2 else list(range(50, 150))) for i in range(40)], "th bigint, sketch array<bigint>")
    edges = spark.createDataFrame([(h, i) for h in (0, 1) for i in range(2, 40)], "hub bigint, th bigint")
    got = nearcopies._verified(edges, sketches, nearcopies.whole(0.8), 5).collect()
    assert sorted((r["hub"], r["th"]) for r in got) == [(h, i) for h in (0, 1) for i in range(2, 40) if i % 2 == h]


def test_no_nodes_no_groups(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, extra string")
    assert nearcopies.keep_one(docs).collect() == []
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b")], "doc_id bigint, text string")
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in nearcopies.keep_one(docs).collect()) == [(False, 1), (True, 0)]
