import random

from linkwright.llm import nearcopies


def test_fingerprints_link_first(spark):
    """Texts of close fingerprints are grouped by SimHash, verified: without any block of least hashes, pairs of one
    changed end in 400 words are found, others are not; texts without words stay apart."""
    rng = random.Random(5)
    texts = []
    for i in range(8):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(400)]
        texts += [" ".join(words), " ".join([*words[:-1], "changed"])]
    texts += ["", " ", "a b c"]
    known = nearcopies._identified(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    nodes = nearcopies._signatures(known, nearcopies.SHINGLE).drop("id", "bands")
    roots = nearcopies._by_fingerprint(nodes, known, nearcopies.SHINGLE, 0.8, nearcopies.MARGIN)
    named = {r["_th"]: r["_id"] // 2 for r in known.where("_id < 16").collect()}
    found = {}
    for r in roots.collect():
        found.setdefault(r["root"], set()).add(named[r["node"]])
    assert len(found) >= 4 and all(len(x) == 1 for x in found.values())


def test_blocks_are_counted_without_a_join(spark):
    """A block's rows get its number of nodes where they are: no row is made by joining a block to its count."""
    rows = [(1, 7, t, 5, t % 2) for t in range(6)] + [(1, 8, t, 5, 3) for t in range(4)]
    shared = nearcopies._shared(spark.createDataFrame(rows, "k int, v bigint, th bigint, n int, root bigint"))
    assert sorted((r["v"], r["c"]) for r in shared.collect()) == [(7, 6)] * 6
    assert "Join" not in shared._jdf.queryExecution().optimizedPlan().toString()
