import pytest

from linkwright.llm import decontaminate


@pytest.mark.parametrize("seed", [0, 1])
def test_block_size_does_not_change_the_result(spark, seed):
    """Overlapping items, in one block or many: the same documents go and the same words are cut."""
    w = [f"word{seed}x{i}" for i in range(100)]
    one = lambda a, b: " ".join(w[a:b])
    rows = [(1, " ".join(w)), (2, one(0, 40)), (3, "own text " * 9 + one(20, 36) + " the end of it" * 3), (4, None), (5, f"{one(0, 12)} {one(60, 75)} " + "free words here " * 20), (5, "no hit")]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id bigint, text string, n_chars bigint")
    # 40 and 25 of document 1's words in two items; overlaps of a few words; neighbours that touch
    spans = [(0, 40), (70, 95), (20, 32), (26, 37), (60, 70), (65, 76)]
    items = [(f"b{k}", one(a, b)) for k, (a, b) in enumerate(spans)] + [(f"c{k}", f"other{k} " * 12) for k in range(6)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    assert len(decontaminate.benchmark_blocks(bench, 100)) > 5
    got = [sorted(map(tuple, decontaminate.remove_spans(docs, bench, size).collect()), key=str) for size in (decontaminate.BLOCK_BYTES, 100)]
    assert got[0] == got[1] and 1 not in {r[0] for r in got[0]} and len(got[0]) == 4
