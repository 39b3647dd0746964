import numpy as np
import pytest

from ordstrata.llm.near_dups import Shingler, missed, near_duplicates, radius_of, signature


@pytest.mark.parametrize("percent", [70, 80, 85, 90, 100])
def test_few_links_share_no_key(percent):
    assert missed(percent) <= 1e-5


def test_far_signatures_of_a_link_are_linked(spark):
    """Sets that share 80 of 100 shingles, whose signatures differ in more than 19 of 48."""
    shingle, rows = Shingler(5), []
    for seed in range(20_000):
        same = [f"{seed}s{i}" for i in range(84)]
        texts = [" ".join([*same, *(f"{seed}{c}{i}" for i in range(10))]) for c in "ab"]
        a, b = (shingle(t) for t in texts)
        if 19 < (signature(a) != signature(b)).sum() <= radius_of(80):
            assert 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
            rows += [(2 * seed, texts[0]), (2 * seed + 1, texts[1])]
            if len(rows) >= 6:
                break
    assert rows
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for r in near_duplicates(table, 5, 80).collect():
        assert r.component_id == r.doc_id // 2 * 2
