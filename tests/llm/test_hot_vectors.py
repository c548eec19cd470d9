import numpy as np
import pytest

from lanewright.llm import embedding_dedup


@pytest.mark.parametrize(("share", "noise"), [(3, 0.05), (3, 0.09), (2, 0.13)])
def test_links_of_one_large_group(spark, share, noise):
    """64 dimensions, a third or half of the rows near copies of one vector, against brute force."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(1200, 64))
    k = len(v) // share
    v[:k] = v[0] + noise * rng.normal(size=(k, 64))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.98).sum(axis=1) - 1
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    assert want.sum() > 50_000 and all(got[i] <= want[i] for i in got)
    assert sum(got.values()) >= 0.99 * want.sum()
