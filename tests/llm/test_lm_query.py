import math

import numpy as np
import zstandard

from linkwright.llm import lm


def test_query_scores_by_three_words(spark, tmp_path):
    """The registered query backs off from word triples: 'a b c' occurs in another document, 'x b c' does not."""
    texts = ["a b c", "a b c", "x b c", "a b d"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["score"] for r in lm.op7_lm(spark, str(tmp_path)).collect()}
    # others of 0: a 2, a b 2, a b c 1 of 9 words; of 2: no x, b 3, b c 2, no x b c
    first = 2 / 9 * 2 / 2 * (1 / 2) * 0.4**0
    third = 0.4 / (1 + 9) * (0.4 * 3 / 9) * (0.4 * 2 / 3)
    assert math.isclose(got[0], math.log10(first), abs_tol=1e-5) and math.isclose(got[2], math.log10(third), abs_tol=1e-5)


def test_packed_keys():
    rng = np.random.default_rng(3)
    for n in (1, 2, 1000):
        for top in (5, 1 << 33, (1 << 48) - 1):
            keys = np.sort(rng.integers(0, top, n, np.uint64, endpoint=True))
            keys[-1] = top
            assert (lm._unpacked(lm._packed(keys, zstandard.ZstdCompressor()), n, zstandard.ZstdDecompressor()) == keys).all()
